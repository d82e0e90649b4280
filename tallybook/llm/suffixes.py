"""Removal of repeated byte strings by sorted suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import materialized, mix, sliding_min, small_batches, width, window_hashes

LEAD = 32  # bytes of the string that stands for a run of windows
BLOCK = 16  # neighbouring windows that are compared together
_WINDOWS = 1 << 16  # looked at together; their places fit in _PLACE
_PLACE = np.uint64((1 << 18) - 1)
_ROWS = 200_000
_KEY = ["doc_id", "text_hash"]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def runs_of(data: np.ndarray, ends: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of neighbouring windows of ``length`` bytes whose least ``LEAD``-byte string is at one place, the leftmost.

    ``data`` is a row of texts, ``ends`` where each place's text ends; windows lie within a text.
    Equal windows have equal leads at the same distance: ``anchor`` is that from the start of the
    run. ``text`` identifies the bytes that the run covers.
    """
    grams = window_hashes(data, LEAD)
    keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    least = (sliding_min(keys, length - LEAD + 1) & _PLACE).astype(np.int64)
    inside = np.arange(len(least)) + length <= ends[: len(least)]
    start = np.flatnonzero(inside & np.concatenate(([True], (least[1:] != least[:-1]) | ~inside[:-1])))
    stop = np.append(start[1:], len(least))
    size = np.cumsum(np.append(0, inside))[stop] - np.cumsum(np.append(0, inside))[start]
    place = least[start]
    # The covered bytes as strings of LEAD bytes, one after the other and one at the end.
    last = start + size - 1 + length - LEAD
    text = grams[last] + size.astype(np.uint64)
    for step in range(0, 2 * length - LEAD, LEAD):
        text = mix(text + grams[np.minimum(start + step, last)])
    return {"start": start, "n": size, "anchor": place - start, "lead": _signed(grams[place]), "text": _signed(text)}


def _runs(length: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch["text"]]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            data = np.frombuffer(b"".join(texts), np.uint8)
            owner = np.repeat(np.arange(len(texts)), sizes)
            end = np.cumsum(sizes)
            for at in range(0, len(data) - length + 1, _WINDOWS):
                part = slice(at, at + _WINDOWS + length - 1)
                found = runs_of(data[part], end[owner[part]] - at, length)
                of_text = owner[found["start"] + at]
                found["start"] += at - (end - sizes)[of_text]
                yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[of_text], "text_hash": batch["text_hash"].to_numpy()[of_text]} | found)

    return of


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows in larger pieces; their order is kept."""
    held, n = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            n += len(batch)
        if n >= _ROWS:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _changes(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for values in columns:
        new[1:] |= values[1:] != values[:-1]
    return new


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Judges pieces of text, runs or blocks, that stand sorted by ``lead`` and ``text``.

    ``whole``: the text occurs again, so all its windows are repeated. ``deeper``: its lead has
    other texts too, so that parts may be; of equal texts one is looked at. ``single``: the same,
    but windows must be compared one by one, because the piece lies at either end of what is seen
    here and its equals may lie beyond. A lead that stands alone has no equals, and its piece is
    done with.
    """
    for rows in _chunks(batches):
        lead, text = rows["lead"].to_numpy(), rows["text"].to_numpy()
        new_lead, new_text = _changes(lead), _changes(lead, text)
        group, sort = np.cumsum(new_lead) - 1, np.cumsum(new_text) - 1
        whole = np.bincount(sort)[sort] > 1
        several = np.bincount(group[new_text])[group] > 1
        unsure = (group == 0) | (group == group[-1])
        rows["whole"], rows["single"], rows["deeper"] = whole, unsure & new_text, several & new_text & ~unsure
        yield rows.loc[rows["whole"] | rows["single"] | rows["deeper"], [*_KEY, "start", "n", "anchor", "whole", "single", "deeper"]]


def _of_texts(parts):
    """Rows of all texts of a batch in one frame; ``parts`` gives the columns for a text and its pieces."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            frames = []
            for doc_id, text_hash, text, pieces in zip(*(batch[c] for c in (*_KEY, "text", "pieces")), strict=True):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                at = np.array([(p["start"], p["n"], p["anchor"]) for p in pieces], np.int64).T
                columns = parts(data, *at, text_hash)
                frames.append((doc_id, text_hash, columns))
            if frames:
                sizes = [len(columns["start"]) for _, _, columns in frames]
                out = {"doc_id": batch["doc_id"].repeat(sizes).to_numpy(), "text_hash": np.repeat(batch["text_hash"].to_numpy(), sizes)}
                out |= {name: np.concatenate([columns[name] for _, _, columns in frames]) for name in frames[0][2]}
                yield pd.DataFrame(out)

    return of


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _blocks(length: int):
    """Runs cut into blocks of ``BLOCK`` windows at distances from the anchor that are the same for all equals.

    ``lead`` is the core that all windows of a block share: where it stands alone, none is
    repeated. ``text`` is all that they cover: where it occurs again, all are.
    """

    def of(data: np.ndarray, start: np.ndarray, n: np.ndarray, anchor: np.ndarray, text_hash: int) -> dict[str, np.ndarray]:
        place = start + anchor
        low, high = (anchor - n + 1) // BLOCK, anchor // BLOCK
        count = high - low + 1
        # Runs that meet at the end of what was looked at together have blocks in common.
        known = np.unique(np.repeat(place, count) << 16 | _ranges(low, count))
        place, step = known >> 16, known & 0xFFFF
        last = place - step * BLOCK  # the block's last window
        first = last - (BLOCK - 1)
        # The step is part of the lead: neighbouring runs may cut the same block.
        core = mix(window_hashes(data, length - BLOCK + 1)[last] + step.astype(np.uint64))
        covered = window_hashes(data, length + BLOCK - 1)
        inside = (first >= 0) & (first < len(covered))
        own = mix(core + last.astype(np.uint64)) ^ np.int64(text_hash).view(np.uint64)  # at the edge of a text: as in equal texts only
        text = np.where(inside, covered[np.clip(first, 0, max(0, len(covered) - 1))], own) if len(covered) else own
        begin = np.maximum(first, 0)
        size = np.minimum(last, len(data) - length) - begin + 1
        return {"start": begin, "n": size, "anchor": place - begin, "lead": _signed(core), "text": _signed(text)}

    return of


def _windows(length: int):
    def of(data: np.ndarray, start: np.ndarray, n: np.ndarray, anchor: np.ndarray, text_hash: int) -> dict[str, np.ndarray]:
        at = np.unique(_ranges(start, n))
        tokens = np.lib.stride_tricks.sliding_window_view(data, 8)[at]
        token = np.ascontiguousarray(tokens).view(">i8").ravel().astype(np.int64)
        return {"start": at, "token": token, "rest": _signed(window_hashes(data, length)[at])}

    return of


def _compare_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows equal to a neighbour, and the first and last of each piece, which may have equals beyond."""
    for rows in _chunks(batches):
        new = _changes(rows["token"].to_numpy(), rows["rest"].to_numpy())
        sort = np.cumsum(new) - 1
        rows["equal"] = np.bincount(sort)[sort] > 1
        rows["end"] = False
        rows.loc[[0, len(rows) - 1], "end"] = True
        yield rows.loc[rows["equal"] | rows["end"]]


def _typed(docs: DataFrame, rest: str) -> str:
    return f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash bigint, {rest}"


def repeated_spans(docs: DataFrame, *, length: int = 200) -> DataFrame:
    """``doc_id``, ``text_hash``, ``spans``: starts of windows of ``length`` bytes that occur elsewhere too.

    A span is ``start`` and ``n``, the number of windows from there on. Rows alike in ``doc_id`` and text
    are one row here, but repeat each other.

    Rounds of sorted comparison, each over a table that Spark's sampled splitters deal out by range
    and sort within. The first sorts *runs*, sparse suffixes that stand for up to ``length`` windows
    with one common lead; most of a corpus ends there, as its leads stand alone. What shares a lead
    but not the whole text is sorted in blocks of ``BLOCK`` windows, and what then is still open, the
    edges of repeated parts, in single windows: suffixes cut at ``length``, by their first eight
    bytes, then by a hash of the whole. Equal windows that a splitter parts are found by comparing
    what lies at the ends of the buckets. Position is part of the range, so any number of equal
    strings spreads over the buckets.
    """
    if length < LEAD + 8:
        raise ValueError(f"length must be at least {LEAD + 8}")
    spark = docs.sparkSession
    small_batches(spark)
    parts = width(spark)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    piece = "start int, n smallint, anchor smallint"
    found = f"{piece}, lead bigint, text bigint"
    runs = materialized(texts.mapInPandas(_runs(length), _typed(docs, found)), "runs")
    judged = materialized(_judged(runs, parts, _typed(docs, f"{piece}, whole boolean, single boolean, deeper boolean")), "judged")

    deeper = _with_texts(texts, _pieces(judged.where("deeper")), "inner").select(*_KEY, "text", "pieces")
    blocks = materialized(deeper.mapInPandas(_of_texts(_blocks(length)), _typed(docs, found)), "blocks")
    blocks = materialized(_judged(blocks, parts, _typed(docs, f"{piece}, whole boolean, single boolean, deeper boolean")), "judged")

    open_ = judged.where("single").unionByName(blocks.where("single or deeper"))
    probed = _with_texts(texts, _pieces(open_), "inner").select(*_KEY, "text", "pieces")
    windows = probed.mapInPandas(_of_texts(_windows(length)), _typed(docs, "start int, token bigint, rest bigint"))
    windows = materialized(windows, "windows")
    order = ["token", "rest"]
    sorted_windows = windows.repartitionByRange(parts, *order, *_KEY, "start").sortWithinPartitions(*order)
    found = sorted_windows.mapInPandas(_compare_windows, _typed(docs, "start int, token bigint, rest bigint, equal boolean, end boolean"))
    found = materialized(found, "found")

    ends = found.where("end")
    beyond = ends.groupBy(*order).agg(F.count("*").alias("n")).where("n > 1").select(*order)
    hits = found.where("equal").select(*_KEY, "start").unionByName(ends.join(beyond, order).select(*_KEY, "start"))
    whole = judged.where("whole").unionByName(blocks.where("whole"))
    spans = hits.withColumn("n", F.lit(1)).unionByName(whole.select(*_KEY, "start", F.col("n").cast("int").alias("n")))
    return spans.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "n")).alias("spans"))


def _judged(pieces: DataFrame, parts: int, schema: str) -> DataFrame:
    dealt = pieces.repartitionByRange(parts, "lead", "text", *_KEY, "start").sortWithinPartitions("lead", "text")
    return dealt.mapInPandas(_compare, schema)


def _pieces(rows: DataFrame) -> DataFrame:
    """The pieces of each text, at most as many as it has bytes."""
    piece = F.struct("start", F.col("n").cast("int").alias("n"), F.col("anchor").cast("int").alias("anchor"))
    return rows.groupBy(*_KEY).agg(F.collect_set(piece).alias("pieces"))


def _with_texts(texts: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """``other`` beside the texts; its rows are built into a table, so the texts need no sort."""
    right = other.select(F.col("doc_id").alias("other_id"), F.col("text_hash").alias("other_hash"), *[c for c in other.columns if c not in _KEY])
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash"))
    return texts.join(right.hint("shuffle_hash"), same, how).drop("other_id", "other_hash")


def remove_repeats(docs: DataFrame, *, length: int = 200) -> DataFrame:
    """``doc_id``, ``kept`` (the bytes that stay), ``n_bytes``, ``n_removed``, ``n_spans`` per row.

    A text is its UTF-8 bytes, null and empty texts none. Every byte goes that lies in a string of ``length`` bytes which
    also starts elsewhere, in the same or in any other row; overlaps count, and all strings are
    judged on the input. Rows repeated, with equal or null ``doc_id`` too, repeat each other, so texts of ``length`` bytes or
    more go whole in all of them. Other columns are ignored; an empty table gives an empty result.
    """
    spans = repeated_spans(docs, length=length)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                if spans is None:
                    rows.append((doc_id, data, len(data), 0, 0))
                    continue
                edges = np.zeros(len(data) + 1, np.int64)
                np.add.at(edges, [s["start"] for s in spans], 1)
                np.add.at(edges, [s["start"] + s["n"] - 1 + length for s in spans], -1)
                gone = np.cumsum(edges)[:-1] > 0
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                rows.append((doc_id, kept, len(data), int(gone.sum()), n_spans))
            yield pd.DataFrame(rows, columns=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    joined = _with_texts(texts, spans, "left").select("doc_id", "text", "spans")
    return joined.mapInPandas(cut, f"doc_id {dict(docs.dtypes)['doc_id']}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")

