"""Repair of conversations against exhaustive search and SQL."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tallybook.llm import repair as r
from tallybook.llm.queries import ORACLES

duckdb = pytest.importorskip("duckdb")
SCHEMA = "conv_id long, turn long, role string, text string, key string, place long"


def slow(codes):
    """Least (cost, audit) by trying every edit at every row, with up to three turns inserted before each."""
    ways = {r.NONE: (0, "")}

    def offer(into, state, way):
        if state not in into or way < into[state]:
            into[state] = way

    def inserted(known):
        known = dict(known)
        for _ in range(3):
            for state, (cost, audit) in list(known.items()):
                offer(known, {0: 2, 1: 2, 2: 3, 3: 2}[state], (cost + 5, audit + "I"))
        return known

    for code in codes:
        after = {}
        for state, (cost, audit) in inserted(ways).items():
            offer(after, state, (cost + 2, audit + "D"))
            for role, to, befores in (("s", 1, (0,)), ("u", 2, (0, 1, 3)), ("a", 3, (2,))):
                if code != "#" and state in befores:
                    more = 5 * code.isupper()
                    if code.lower() == role:
                        offer(after, to, (cost + more, audit + "K"))
                    if to != 1:
                        offer(after, to, (cost + more + 1, audit + "R"))
        ways = after
    return min(way for state, way in inserted(ways).items() if state in (0, 3))


def test_search_finds_the_least_audit_of_all_short_conversations():
    for n in range(5):
        for codes in itertools.product("#suaxSUAX", repeat=n):
            assert r.whole("".join(codes)) == slow(codes), codes


def test_search_and_pieces_on_longer_ones():
    draw = random.Random(3)
    for _ in range(300):
        codes = "".join(draw.choice("##suuuaaaxSUAX") for _ in range(draw.randint(6, 40)))
        cost, audit = slow(codes)
        assert r.whole(codes) == (cost, audit)
        assert r._whole.__wrapped__(codes) == (cost, audit)
        size = draw.randint(1, 7)
        tables = [r.table(codes[i : i + size]) for i in range(0, len(codes), size)]
        bare = [{(e, n): (c, k) for e, n, c, _, k in t} for t in tables]
        level = [r.joined(bare[i : i + 3]) for i in range(0, len(bare), 3)]
        top = r.joined([{(e, n): (c, k) for e, n, c, _, k in t} for t in level])
        assert r.closed(top)[0] == cost


def test_audits_leave_well_formed_roles():
    draw = random.Random(4)
    for _ in range(200):
        codes = "".join(draw.choice("#suaxSUAX") for _ in range(draw.randint(0, 12)))
        _, audit = r.whole(codes)
        left = "".join({1: "s", 2: "u", 3: "a"}[after] for _, letter, _, after in r.walk(codes, r.NONE, audit) if letter != "D")
        assert re.fullmatch("(s?(ua)+)?", left)
        assert len(audit) - audit.count("I") == len(codes)


def rows_of(draw):
    texts = ["Yes.", "No", " ", "", "Why?  \n", "Ünï!", "a.b", "Yes.", None]
    rows = []
    for conv in [*range(40), 2**53 + 1, 2**53 + 2, None]:
        for turn in range(draw.randint(1, 9)):
            turn = None if draw.random() < 0.05 else turn + draw.choice([0, 0, 0, 3])
            rows.append((conv, turn, draw.choice(["system", "user", "assistant", "tool", "", None]), draw.choice(texts), "clash", 7))
    rows += [(500, i, "user" if i % 2 else "assistant", f"text {i}" + ".!?x"[i % 4], "clash", 7) for i in range(400)]
    rows += [(501, 1, "user", "same.", "clash", 7)] * 60
    rows += [(502, i, "user", "same.", "clash", 7) for i in range(60)]
    return rows + [(503, 0, "user", "x" * 200_000 + ".", None, None)]


def expected(rows):
    """Damage, faults and repair row by row."""
    out = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text, *_ in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        if harm == 4:
            role = "user"
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(harm, text)
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(harm, 1)
    found = {}
    for conv, turns in out.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(t[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in turns:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
        cost, audit = slow([r.row_code(t[1][:1], f) for t, f in zip(turns, faults)])
        lines, row = [], 0
        for letter in audit:
            if letter != "D":
                odd = lines and lines[0][0][:1] == "s"
                role = ("user", "assistant")[(len(lines) - bool(odd)) % 2]
                lines.append((turns[row][1], turns[row][2]) if letter == "K" else (role, turns[row][2] if letter == "R" else ""))
            row += letter != "I"
        known = {t[0] for t in turns if t[0] is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()
        found[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize(("most", "fan"), [(1024, 256), (7, 3)])
def test_repair_equals_brute_force(spark, most, fan):
    rows = rows_of(random.Random(8))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    repaired = r.repair(r.damaged(frame), most=most, fan=fan)
    found = r.summarised(frame, repaired).collect()
    assert {row["conv_id"]: tuple(row[c] for c in COLUMNS) for row in found} == expected(rows)
    letters = repaired.edits.groupBy("letter").count().collect()
    assert sum(row["count"] for row in letters) == sum(len(row["audit"]) for row in found)


def test_query_equals_sql(spark, tmp_path):
    rows = rows_of(random.Random(9))[:-1]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = r.summarised(frame, r.repair(r.damaged(frame), most=50)).collect()
    frame.write.parquet(f"{tmp_path}/c")
    with duckdb.connect() as engine:
        engine.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
        want = engine.execute(ORACLES["op11_repair"]).fetchall()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    repaired = r.repair(r.damaged(none))
    assert r.summarised(none, repaired).collect() == repaired.rows.collect() == repaired.edits.collect() == []


def test_a_conversation_without_rows_left(spark):
    gone = next(i for i in range(10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.", None, None)], SCHEMA)
    (row,) = r.summarised(frame, r.repair(r.damaged(frame))).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
