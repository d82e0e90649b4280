"""Archives as crawls write them, whole and damaged."""

import base64
import gzip
import hashlib
import random
import time

import pytest

from tallybook.llm import warc


def record(n, payload, digest=None, fold=False):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + payload
    digest = digest or f"sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}"
    uri = f"http://h/{n}\r\n  /folded" if fold else f"http://h/{n}"
    head = (
        f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{n}>\r\nWARC-Target-URI: {uri}\r\nWARC-Payload-Digest: {digest}\r\n"
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def payload(n, size=900):
    return random.Random(n).randbytes(size // 2) + b"text " * (size // 10)


def sound(data):
    return [r["record_id"].split(":")[-1].rstrip(">") for r in warc.salvage(data) if r["type"]]


def test_digests_of_either_form_are_checked():
    good = hashlib.sha1(payload(1)).hexdigest()
    (found,) = warc.salvage(record(1, payload(1)))
    assert found["payload_digest"] == good and found["reason"] is None
    (found,) = warc.salvage(record(1, payload(1), f"SHA1:{good.upper()}"))
    assert found["payload_digest"] == good
    other = base64.b32encode(hashlib.sha1(b"other").digest()).decode()
    (gap,) = warc.salvage(record(1, payload(1), f"sha1:{other}"))
    assert gap["type"] is None and gap["reason"] == "payload digest differs"
    assert sound(record(1, payload(1), "md5:abc")) == sound(record(1, payload(1), "sha1:?")) == ["1"]


def test_folded_header_lines():
    (found,) = warc.salvage(record(7, payload(7), fold=True))
    assert found["uri"] == "http://h/7 /folded" and found["payload"] == payload(7)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.9, 0.999])
def test_records_before_the_cut_of_a_member_are_kept(share):
    whole = b"".join(record(n, payload(n)) for n in range(60))
    packed = gzip.compress(whole)
    cut = packed[: int(len(packed) * share)]
    found = sound(cut)
    assert found == [str(n) for n in range(len(found))]
    assert abs(len(found) - 60 * share) < 4
    assert {r["reason"] for r in warc.salvage(cut) if r["type"]} == {"broken gzip member"}


def test_records_before_a_damage_and_members_after_it_are_kept():
    first = gzip.compress(b"".join(record(n, payload(n)) for n in range(40)))
    rest = [gzip.compress(record(n, payload(n))) for n in range(40, 45)]
    for at in (len(first) // 3, len(first) // 2, len(first) - 6):
        broken = bytearray(first)
        broken[at : at + 3] = b"\xff\xff\xff"
        found = sound(bytes(broken) + b"".join(rest))
        assert found[-5:] == ["40", "41", "42", "43", "44"]
        assert found[:-5] == [str(n) for n in range(len(found) - 5)] and len(found) - 5 >= 40 * at / len(first) - 3


def test_bytes_are_read_or_logged():
    draw = random.Random(3)
    for seed in range(20):
        parts = [record(n, payload(n)) if draw.random() < 0.5 else gzip.compress(record(n, payload(n))) for n in range(6)]
        at = draw.randrange(6)
        noise = draw.randbytes(draw.randint(1, 50))
        data = b"".join(parts[:at]) + noise + b"".join(parts[at:])
        rows = list(warc.salvage(data))
        assert [r["record_id"] for r in rows if r["type"]] == [f"<urn:uuid:{n}>" for n in range(6)]
        covered = sorted((r["start"], r["end"]) for r in rows)
        assert covered[0][0] == 0 and covered[-1][1] == len(data)
        assert all(a[1] == b[0] for a, b in zip(covered, covered[1:]))
    assert list(warc.salvage(b"")) == []


def test_time_grows_with_the_archive():
    def seconds(members):
        data = b"".join(gzip.compress(record(n, payload(n % 50, 20_000)), 1) for n in range(members))
        started = time.perf_counter()
        assert len(sound(data)) == members
        return time.perf_counter() - started

    seconds(50)
    assert seconds(2400) < 10 * max(0.05, seconds(600))
    broken = b"".join(record(n, payload(n), "sha1:" + "0" * 40) for n in range(3000))
    started = time.perf_counter()
    assert sound(broken) == []
    assert time.perf_counter() - started < 5


def test_gaps_are_logged_by_file(spark, tmp_path):
    folder = tmp_path / "archives"
    folder.mkdir()
    (folder / "part-0.warc").write_bytes(record(0, payload(0)) + b"noise")
    (folder / "part-1.warc.gz").write_bytes(gzip.compress(record(1, payload(1))) + gzip.compress(record(2, payload(2)))[:-30])
    (folder / "part-2.warc").write_bytes(b"")
    rows = warc.read_warc(spark, str(folder))
    assert rows.where("type is not null").count() == 2
    found = sorted((r.file.rsplit("/", 1)[1], r.end - r.start, r.reason) for r in warc.gaps(rows).collect())
    assert [(f, why) for f, _, why in found] == [("part-0.warc", "no version line"), ("part-1.warc.gz", "broken gzip member")]
    assert found[0][1] == 5
