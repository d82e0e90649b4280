"""SimHash near-dedup and removal of repeated strings, against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallybook.llm import simhash, suffixes
from tallybook.llm.components import components

SCHEMA = "doc_id long, text string, component_id string, root string"


def slow_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    parent = {p: p for p in prints}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[top(a)] = top(b)
    return {p: top(p) for p in parent}


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 400))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base[:25]):
        parts = t.split(" ")
        parts[draw.randrange(len(parts))] = "changed"
        rows.append((100 + i, "\t".join(parts).upper()))
        rows.append((200 + i, t))
    return rows + [(300, None), (301, ""), (302, " \n\t"), (303, "one"), (303, "one"), (None, "one"), (304, "Ünï čödé" * 3), (305, "x " * 70_000)]


def test_simhash_equals_brute_force(spark, texts):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in texts], SCHEMA)
    found = [r for r in simhash.near_duplicates(docs).collect()]
    assert len(found) == len(texts)
    prints = [slow_print(t) for _, t in texts]
    tops = slow_components(set(prints))
    least = {}
    for (i, _), p in zip(texts, prints, strict=True):
        if i is not None:
            least[tops[p]] = min(i, least.get(tops[p], i))
    want = Counter((i, f"{p:016x}", least[tops[p]]) for (i, _), p in zip(texts, prints, strict=True))
    assert Counter((r.doc_id, f"{r.print & (2**64 - 1):016x}", r.component_id) for r in found) == want


def test_links_within_three_bits_are_all_found(spark):
    draw = random.Random(1)
    base = [draw.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << k for k in draw.sample(range(64), draw.randint(1, 5))) for b in base for _ in range(4)]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in base + near})
    found = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "print long"), 3).collect()}
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert found == want and want


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (7, 6), (500, 500)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}


def test_one_of_each_group_stays_with_all_columns(spark):
    rows = [(5, "a b c d", "x", None), (3, "A  b c d", "y", "z"), (3, "A  b c d", "y", "z"), (9, None, "n", None), (8, "", "n", None), (None, "lone words stay", None, None)]
    kept = simhash.first_of_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[1], rows[4], rows[5]], key=str)
    assert simhash.first_of_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def slow_cut(texts, length):
    seen = Counter()
    data = [(i, (t or "").encode()) for i, t in texts]
    for _, b in data:
        seen.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall("1+", "".join("01"[int(g)] for g in gone)))
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    draw = random.Random(seed)

    def prose(n):
        return "".join(draw.choice(["ab", "c", "é", " ", "the ", "0"]) for _ in range(n))

    shared = [prose(180) for _ in range(4)]
    rows = [(i, prose(draw.randint(0, 300)) + "".join(draw.sample(shared, 2)) + prose(40)) for i in range(30)]
    rows += [(50 + i, t[: draw.randint(0, len(t))] + "!" + t[draw.randint(0, len(t)) :]) for i, t in rows[:15]]
    rows += [(90, "ab" * 700), (91, "x" * 199), (92, "x" * 200), (93, "x" * 201), (94, None), (95, ""), (97, prose(60_000) + rows[3][1]), (96, rows[0][1]), (96, rows[0][1]), (None, rows[1][1])]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, lead string")
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffixes.remove_repeats(docs).collect())
    assert found == slow_cut(rows, 200)


def test_no_rows_no_repeats(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
