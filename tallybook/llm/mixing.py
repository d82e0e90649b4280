"""Mixing sources to target sizes by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import materialized, n_words

# Sources are given these weights in turn. Fixed values.
WEIGHTS = (5, 2, 1)

_UNITS = 1 << 10  # sums are taken in whole 1024ths, so that they don't depend on the order
_STEPS = 1 << 20  # parts of a copy; their sum stays a long up to 8 * 10^12 documents a source
_MOST_SOURCES_SENT = 10_000
_ROUNDS = 200


def _placed(sources: DataFrame) -> DataFrame:
    """Adds ``place``, from 0, by code point, null last. Each range of sources is numbered by itself, after those before it."""
    order = F.col("source").asc_nulls_last()
    parts = materialized(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return parts.withColumn("own", own).join(F.broadcast(starts), "part").withColumn("place", F.col("start") + F.col("own")).drop("part", "start", "own")


def source_targets(sources: DataFrame, *, share: float, most: float, weights: Sequence[int]) -> DataFrame:
    """``source``, ``source_size``, ``target`` from ``source``, ``source_size`` (one row each).

    Sources by code point, null last, have the weights in turn and share ``share`` times all sizes.
    A target stops at ``most`` times its source's size; the excess is shared by weight among the
    others, again and again until no target is above. The water level rises to its end in as many
    sums as there are rounds of sharing.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = materialized(_placed(sources).select("source", "source_size", weight.alias("weight")), "weights")
    full = F.col("source_size") * most
    total, weighing = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, before = (share * total / weighing if weighing else 0.0), None
    while level != before:
        stopped = full <= F.col("weight") * F.lit(level)
        taken, open_weight = sources.agg(F.sum(F.when(stopped, full)), F.sum(F.when(~stopped, F.col("weight")))).first()
        if not open_weight:
            break
        level, before = (share * total - (taken or 0.0)) / open_weight, level
    return sources.select("source", "source_size", F.least(full, F.col("weight") * F.lit(level)).cast("double").alias("target"))


def _rate(most: float) -> Column:
    """Copies of a document that the tilt of its source asks for."""
    tilted = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))))
    return F.when(F.col("all_full"), F.lit(float(most))).when(F.col("target") <= 0, F.lit(0.0)).otherwise(tilted)


def _whole_sum(value: Column) -> Column:
    """Sum that does not depend on the order, nor overflows a long."""
    return F.sum(F.round(value * _UNITS).cast("decimal(38,0)")).cast("double") / _UNITS


def tilts(sizes: DataFrame, targets: DataFrame, *, most: float) -> DataFrame:
    """``targets`` with ``n_docs``, ``mean``, ``all_full`` and the ``tilt`` that meets each target.

    The rates closest to one copy each in relative entropy, with the source's words summing to its
    target and no rate above ``most``, are ``min(most, exp(tilt * size / mean size))``. The dual is
    convex in the tilt; every round takes a Newton step for all sources at once, within a
    bracket. ``sizes`` is the histogram ``source``, ``size``, ``n``. Sums are of whole numbers, so
    reruns agree.
    """
    counts = sizes.groupBy("source").agg(F.sum("n").alias("n_docs"))
    key = F.col("s.source").eqNullSafe(F.col("c.source"))
    state = targets.alias("s").join(counts.alias("c"), key).select(
        "s.*",
        "n_docs",
        F.greatest(F.col("source_size") / F.col("n_docs"), F.lit(1e-9)).alias("mean"),
        (F.col("target") >= F.col("source_size") * most).alias("all_full"),
        F.lit(0.0).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.lit(False).alias("done"),
    )
    state = materialized(state, "tilts")
    for _ in range(_ROUNDS):
        rate = _rate(most)
        z = F.col("size") / F.col("mean")
        gain = F.when(rate < most, rate * z).otherwise(0.0)
        words = F.col("size") * F.col("n")
        open_ = state.where("not done and not all_full and target > 0").alias("s")
        sums = (
            sizes.alias("h").join(open_, F.col("h.source").eqNullSafe(F.col("s.source")))
            .groupBy(F.col("s.source").alias("key"))
            .agg(
                _whole_sum(words * rate).alias("taken"),
                _whole_sum(words * gain).alias("slope"),
            )
        )
        over = F.col("taken") - F.col("target")
        low = F.when(over < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(over >= 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.when(F.col("slope") > 0, -over / F.col("slope")).otherwise(-F.signum(over) * 1e9)
        reach = F.greatest(F.lit(2.0), F.abs("tilt"))
        newton = F.col("tilt") + F.greatest(-reach, F.least(reach, step))
        outside = (newton <= low) | (newton >= high)
        stepped = F.when(F.coalesce(outside & low.isNotNull() & high.isNotNull(), F.lit(False)), (low + high) / 2).otherwise(newton)
        close = F.abs(over) <= F.greatest(F.lit(0.5), F.col("target") * 1e-9)
        met = F.coalesce(close | (F.abs(stepped - F.col("tilt")) <= 1e-13 * reach), F.lit(True))
        joined = state.alias("s").join(sums, F.col("s.source").eqNullSafe(F.col("key")), "left")
        known = [c for c in state.columns if c not in ("tilt", "low", "high", "done")]
        state = materialized(
            joined.select(*known, F.when(met, F.col("tilt")).otherwise(stepped).alias("tilt"), low.alias("low"), high.alias("high"), met.alias("done")),
            "tilts",
        )
        if state.where("not done").isEmpty():
            break
    return state


def _copies(docs: DataFrame, *, rows_a_bucket: int) -> DataFrame:
    """Adds ``copies``: the rates rounded so that running sums of parts stay within one copy.

    Documents of a source stand in the order of their size class, a bucket of their hash, and their
    size. Where the running sum of the parts passes a whole number, the document gets one copy
    more; those above and below it are of like size, so words are kept too. A source has a bucket
    for every ``rows_a_bucket`` of its ``n_docs`` documents, so that one of a class holds about that many
    at most, however large the source is. Buckets are added up within their class, then classes
    within their source: no task holds a whole source, or all its buckets.
    """
    whole = F.floor("rate")
    part = F.round((F.col("rate") - whole) * _STEPS).cast("long")
    buckets = F.ceil(F.col("n_docs") / rows_a_bucket)
    rows = docs.select(
        "*",
        whole.cast("long").alias("whole"),
        part.alias("part"),
        F.floor(F.log2(F.col("size") + 1) * 8).alias("class"),
        F.pmod(F.xxhash64("doc_id", "size"), buckets).alias("bucket"),
    )
    group = ["source", "class", "bucket"]
    earlier = (Window.unboundedPreceding, -1)
    sums = rows.groupBy(*group).agg(F.sum("part").alias("bucket_part"))
    classes = sums.groupBy("source", "class").agg(F.sum("bucket_part").alias("class_part"))
    in_source = F.sum("class_part").over(Window.partitionBy("source").orderBy("class").rowsBetween(*earlier))
    classes = classes.select(F.col("source").alias("c_source"), F.col("class").alias("c_class"), F.coalesce(in_source, F.lit(0)).alias("class_offset"))
    in_class = F.sum("bucket_part").over(Window.partitionBy("source", "class").orderBy("bucket").rowsBetween(*earlier))
    sums = sums.withColumn("bucket_offset", F.coalesce(in_class, F.lit(0)))
    sums = sums.join(classes, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("class") == F.col("c_class")))
    sums = sums.select(*[F.col(c).alias(f"b_{c}") for c in group], (F.col("class_offset") + F.col("bucket_offset")).alias("offset"))
    same = F.col("source").eqNullSafe(F.col("b_source")) & (F.col("class") == F.col("b_class")) & (F.col("bucket") == F.col("b_bucket"))
    inside = Window.partitionBy(*group).orderBy("size", F.xxhash64("doc_id", "size"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("until", F.sum("part").over(inside)).join(sums, same)
    until = F.col("offset") + F.col("until") + _STEPS // 2
    more = F.floor(until / _STEPS) - F.floor((until - F.col("part")) / _STEPS)
    return placed.withColumn("copies", F.col("whole") + more)


def _settled(copied: DataFrame, *, most: float, rounds: int = 3) -> DataFrame:
    """``copied`` with one copy more or less of up to ``rounds`` documents a source.

    Each is the one whose size comes closest to what the source still misses or has too much, and
    only if that brings its words nearer to the target.
    """
    few = copied.select("source").distinct().count() <= _MOST_SOURCES_SENT
    small = F.broadcast if few else (lambda rows: rows)
    off = copied.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("off"))
    off = materialized(off.select(F.col("source").alias("key"), "off"), "off")
    changed = None
    for _ in range(rounds):
        open_ = copied if changed is None else copied.join(small(changed.select("row_no")), "row_no", "left_anti")
        rows = open_.join(small(off), F.col("source").eqNullSafe(F.col("key")))
        nearer = (F.col("size") > 0) & (F.col("size") < 2 * F.abs("off"))
        may = F.when(F.col("off") > 0, F.col("copies") + 1 <= most).otherwise(F.col("copies") > 0)
        order = F.struct(F.abs(F.col("size") - F.abs("off")).alias("gap"), F.xxhash64("doc_id", "size").alias("hash"), "doc_id", "row_no", "size")
        picked = rows.where(nearer & may).groupBy("key").agg(F.min(order).alias("pick"), F.signum(F.first("off")).cast("long").alias("more"))
        picked = materialized(picked.select(F.col("key").alias("picked_key"), "pick.row_no", F.col("pick.size").alias("picked_size"), "more"), "changes")
        left = F.col("off") - F.coalesce(F.col("more") * F.col("picked_size"), F.lit(0))
        off = materialized(off.join(picked, F.col("key").eqNullSafe(F.col("picked_key")), "left").select("key", left.alias("off")), "off")
        step = picked.select("row_no", "more")
        changed = step if changed is None else changed.unionByName(step)
    more = F.coalesce(F.col("more"), F.lit(0))
    return copied.join(small(changed), "row_no", "left").withColumn("copies", F.col("copies") + more).drop("more")


def mix_sources(
    docs: DataFrame,
    *,
    share: float = 1.5,
    most: float = 2.0,
    weights: Sequence[int] = WEIGHTS,
    rows_a_bucket: int = 1 << 16,
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``rate``, ``copies``, ``taken`` per row.

    ``size`` is the number of words, 0 for a null text. Targets are those of ``source_targets``.
    ``taken`` = ``copies`` * ``size``; ``copies`` is the rate rounded down or up, so at most
    ``most`` rounded up. A few copies a source are then added or taken away, so that its words come
    as near to the target as whole documents can easily bring them.

    A null source is a source of its own, the last. Empty and null texts have size 0 and one copy
    (``most`` copies where the whole source is taken in full, none if the target is 0). Rows
    repeated, with equal or null ``doc_id`` too, are rows of their own. Other columns are ignored;
    an empty table gives an empty result.
    """
    rows = docs.select("doc_id", "source", n_words("text").alias("size"), F.monotonically_increasing_id().alias("row_no"))
    rows = materialized(rows, "sizes")  # from here on a row keeps its number
    sizes = materialized(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialized(source_targets(sources, share=share, most=most, weights=weights), "targets")
    state = tilts(sizes, targets, most=most).select(F.col("source").alias("key"), "source_size", "target", "n_docs", "mean", "all_full", "tilt")
    if state.count() <= _MOST_SOURCES_SENT:
        state = F.broadcast(state)
    joined = rows.join(state, F.col("source").eqNullSafe(F.col("key"))).drop("key")
    copied = _copies(joined.withColumn("rate", _rate(most)), rows_a_bucket=rows_a_bucket)
    copied = materialized(copied.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "row_no"), "copies")
    settled = _settled(copied, most=most)
    return settled.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
