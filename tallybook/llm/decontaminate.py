"""Documents that hold passages of a benchmark, up to a share of edits."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallybook.llm.common import materialized, mix, small_batches, window_hashes

_WORD = re.compile(r"\w+")
_WAVE = 1 << 18
# Share of a text that may be edited; length of a passage that counts by itself, and how far passages lie apart.
EDITS, PASSAGE, STRIDE = 0.08, 240, 32


def plain(text: str | None) -> str:
    """Words in lower case, one space between."""
    return " ".join(_WORD.findall((text or "").lower()))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass(frozen=True)
class Grams:
    """Q-grams of some items, each with where it occurs: ``owners`` and ``offsets`` from its start on."""

    q: int
    hashes: np.ndarray
    starts: np.ndarray
    owners: np.ndarray
    offsets: np.ndarray
    seen: np.ndarray
    bits: int


@dataclass(frozen=True)
class Index:
    """One block of items. ``needs`` are the q-grams a band must share for a whole item, ``least`` for a passage of it."""

    ids: list[int | None]
    words: list[str]
    items: list[np.ndarray]
    budgets: np.ndarray
    needs: np.ndarray
    least: np.ndarray
    grams: list[Grams]
    short: list[int]


def _gram_length(n: int, budget: int, q: int) -> int:
    """The greatest length up to ``q`` of which a copy with ``budget`` edits must still share one: ``n - q + 1 - k * q >= 1``."""
    return min(q, n // (budget + 1))


def build_index(rows: list[tuple[int | None, str]], q: int, edits: float, passage: int = PASSAGE) -> Index:
    """``rows`` are (id, plain text). Items shorter than ``q`` are looked for as they are in ``find``."""
    items = [_points(text) for _, text in rows]
    budgets = np.array([int(len(i) * edits) for i in items], np.int64)
    sizes = np.array([_gram_length(len(i), int(k), q) for i, k in zip(items, budgets, strict=True)], np.int64)
    needs = np.array([max(1, len(i) - g + 1 - k * g) for i, g, k in zip(items, sizes, budgets, strict=True)], np.int64)
    of_passage = max(1, passage - q + 1 - int(passage * edits) * q)
    least = np.where([len(i) > passage for i in items], np.minimum(needs, of_passage), needs)
    short = [i for i, item in enumerate(items) if 0 < len(item) < q]
    grams = []
    for size in sorted({int(g) for i, g in zip(items, sizes, strict=True) if len(i) >= q}):
        chosen = [i for i, item in enumerate(items) if len(item) >= q and sizes[i] == size]
        hashes = [window_hashes(items[i], size) for i in chosen]
        owners = np.repeat(np.array(chosen), [len(h) for h in hashes])
        offsets = np.concatenate([np.arange(len(h)) for h in hashes])
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        values, starts = np.unique(flat[order], return_index=True)
        # Some 32 places for each gram, so that few others are looked up.
        bits = min(27, max(12, int(np.ceil(np.log2(32 * len(values))))))
        seen = np.zeros(1 << bits, bool)
        seen[(mix(values) >> np.uint64(64 - bits)).astype(np.int64)] = True
        grams.append(Grams(size, values, np.append(starts, len(flat)), owners[order], offsets[order], seen, bits))
    return Index([r[0] for r in rows], [r[1] for r in rows], items, budgets, needs, least, grams, short)


def banded_distance(item: np.ndarray, region: np.ndarray, budget: int) -> tuple[int, int]:
    """Least edits that turn ``item`` into some part of ``region``, and where that part ends.

    The band holds the diagonals on which an alignment of at most ``budget`` edits can lie: one
    cell for each start in the region that leaves room, and ``budget`` more on either side.
    Results above the budget only say that it is above.
    """
    n, m = len(item), len(region)
    wide = m - n + 2 * budget + 1  # diagonals -budget .. m - n + budget
    if wide < 1:
        return budget + 1, 0
    far = np.int64(n + m + 1)
    diagonals = np.arange(-budget, m - n + budget + 1)
    places = np.arange(wide)
    row = np.where((diagonals >= 0) & (diagonals <= m), 0, far)  # the part may start anywhere
    padded = np.concatenate((np.full(budget + 1, 0xFFFFFFFF, np.uint32), region, np.full(n + budget + 2, 0xFFFFFFFF, np.uint32)))
    for i in range(1, n + 1):
        # Cell (i, j) with j = i + diagonal; region[j - 1] is padded[i + place].
        swap = row + (padded[i : i + wide] != item[i - 1])
        drop = np.append(row[1:] + 1, far)
        best = np.minimum(swap, drop)
        ends = diagonals + i
        best[(ends < 0) | (ends > m)] = far
        if i <= budget:
            best[ends == 0] = i
        row = np.minimum.accumulate(best - places) + places  # characters inserted
        row[(ends < 0) | (ends > m)] = far
        if row.min() > budget:
            return budget + 1, 0
    at = int(row.argmin())
    return int(row[at]), int(n + diagonals[at])


def _bands(points: np.ndarray, index: Index, grams: Grams) -> list[tuple[int, int, int, int]]:
    """(item, least diagonal, greatest diagonal, shared q-grams) of the bands that share enough with an item or a passage of it."""
    found: dict[tuple[int, int], int] = {}
    hashes = window_hashes(points, grams.q)
    at = np.flatnonzero(grams.seen[(mix(hashes) >> np.uint64(64 - grams.bits)).astype(np.int64)])
    place = np.minimum(np.searchsorted(grams.hashes, hashes[at]), len(grams.hashes) - 1)
    known = grams.hashes[place] == hashes[at]
    at, place = at[known], place[known]
    low, n = grams.starts[place], grams.starts[place + 1] - grams.starts[place]
    # Very frequent q-grams: the postings are walked in waves of bounded size.
    edges = np.searchsorted(np.cumsum(n), np.arange(_WAVE, int(n.sum()) + _WAVE, _WAVE)) + 1
    start = 0
    for stop in edges.tolist():
        a, lo, k = at[start:stop], low[start:stop], n[start:stop]
        start = stop
        if not len(a):
            continue
        inside = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        posting = np.repeat(lo, k) + inside
        owner = grams.owners[posting]
        diagonal = np.repeat(a, k) - grams.offsets[posting]
        size = index.budgets[owner] + 1
        band = diagonal // size
        keys = np.concatenate((owner << 40 | (band + (1 << 39)), owner << 40 | (band - 1 + (1 << 39))))
        values, times = np.unique(keys, return_counts=True)
        if len(edges) == 1:  # the usual case: all in one wave
            enough = times >= index.least[values >> 40]
            values, times = values[enough], times[enough]
        for value, count in zip(values.tolist(), times.tolist(), strict=True):
            key = (value >> 40, (value & ((1 << 40) - 1)) - (1 << 39))
            found[key] = found.get(key, 0) + count
    kept = sorted((*k, count) for k, count in found.items() if count >= index.least[k[0]])
    return [(i, b * int(index.budgets[i] + 1), (b + 2) * int(index.budgets[i] + 1) - 1, count) for i, b, count in kept]


def _closest(word: str, item: np.ndarray, text: str, points: np.ndarray, first: int, last: int, budget: int) -> tuple[int, int] | None:
    """(edits, end) of the closest part of ``text[first:last]``; an exact occurrence needs no alignment."""
    at = text.find(word, first, last)
    if at >= 0:
        return 0, at + len(word)
    if not budget:
        return None
    edits, end = banded_distance(item, points[first:last], budget)
    return (edits, first + end) if edits <= budget else None


def find(text: str, index: Index, q: int, edits: float = EDITS, passage: int = PASSAGE, stride: int = STRIDE) -> list[tuple[int | None, int, int]]:
    """(item id, end in the plain text, edits): the best place in each retained region, verified.

    Whole items count first. Of an item longer than ``passage`` that is not there as a whole, passages of that
    length, one every ``stride`` characters and the last, count with edit budgets of their own.
    """
    points, best, parts = _points(text), {}, {}
    for grams in index.grams:
        for i, low, high, count in _bands(points, index, grams):
            item, word, budget = index.items[i], index.words[i], int(index.budgets[i])
            first = max(0, low - budget)
            last = max(first, high + len(item) + budget + 1)
            if count >= index.needs[i]:
                if (hit := _closest(word, item, text, points, first, last, budget)) and (i not in best or hit < best[i]):
                    best[i] = hit
            if i in best or len(item) <= passage:
                continue
            allowed = int(passage * edits)
            for start in sorted({*range(0, len(item) - passage, stride), len(item) - passage}):
                if parts.get(i, (1, 0))[0] == 0:
                    break
                begin = max(0, low + start - allowed)
                end = max(begin, high + start + passage + allowed + 1)
                hit = _closest(word[start : start + passage], item[start : start + passage], text, points, begin, end, allowed)
                if hit and (i not in parts or hit < parts[i]):
                    parts[i] = hit
    best = parts | best
    for i in index.short:
        if (at := f" {text} ".find(f" {index.words[i]} ")) >= 0:
            best[i] = (0, at + len(index.words[i]))
    return [(index.ids[i], end, edits) for i, (edits, end) in sorted(best.items())]


def _blocks(benchmark: DataFrame, most_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct items in blocks of at most ``most_chars`` characters, or of one item."""
    block, size = [], 0
    for row in benchmark.toLocalIterator():
        text = plain(row["text"])
        if not text:
            continue
        if block and size + len(text) > most_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def _hits(text: str | Column, rows: list[tuple[int | None, str]], q: int, edits: float) -> Column:
    held: list[Index] = []

    @pandas_udf("array<struct<item_id:bigint,end:bigint,edits:bigint>>")
    def of(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(build_index(rows, q, edits))
        return pd.Series([[{"item_id": i, "end": e, "edits": k} for i, e, k in find(plain(t), held[0], q, edits)] for t in texts])

    return of(text)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, q: int = 8, edits: float = EDITS, block_chars: int = 4_000_000) -> DataFrame:
    """All rows and columns of ``docs`` and ``leaks``: ``item_id``, ``end``, ``edits`` of the benchmark items a text holds.

    Texts and items are compared as words in lower case, one space between; ``end`` is a position
    in that form. An item of ``n`` characters may be changed by up to ``k = edits * n`` insertions,
    deletions and substitutions. By the q-gram lemma a part that close shares at least
    ``n - q + 1 - k * q`` q-grams with it, all within ``k + 1`` neighbouring diagonals, so within one
    of the overlapping bands of ``2 * (k + 1)``; for short items a smaller ``q`` keeps that above zero. Bands with that
    many are verified: by an exact search, else by a banded alignment. An item longer than PASSAGE is also
    held by a text with a passage of that length of it, one every STRIDE characters, within the same share of edits.
    Of several places of an item the one with the fewest edits is given, then the first.

    Each pass over the documents carries one block of items of at most ``block_chars``
    characters, however large the benchmark is; between passes the documents are written. Items without a word match nothing; items shorter
    than ``q`` must occur as whole words. Null and empty texts hold nothing. Items repeated, with
    equal texts or ids, are items of their own. Repeated rows are judged alike; a former column
    ``leaks`` is replaced. Empty tables give no leaks.
    """
    small_batches(docs.sparkSession)
    items = benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text")
    none = F.array().cast("array<struct<item_id:bigint,end:bigint,edits:bigint>>")
    marked = docs.withColumn("leaks", none)
    for n, rows in enumerate(_blocks(items, block_chars)):
        if n:
            # One block a pass: a plan with several would hold all their indexes in every worker.
            marked = materialized(marked, "leaks")
        marked = marked.withColumn("leaks", F.concat("leaks", _hits("text", rows, q, edits)))
    return marked


__all__ = ["banded_distance", "build_index", "find", "find_contamination", "plain"]
