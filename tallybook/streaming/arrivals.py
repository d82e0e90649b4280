"""Curate transaction files as they arrive.

The raw directory is not partitioned, so a daily run has to look at all of it. A file stream
remembers what it has read and hands over only new files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybook.operators.merge import partition_days, upsert_partitioned
from tallybook.plans.totals import mark_touched
from tallybook.plans.zones import Zones
from tallybook.schemas import CURATED_TRANSACTIONS, TRANSACTION_KEY
from tallybook.sources.manifest import file_groups, read_groups
from tallybook.sources.workspace import scratch

_LISTED = "path string, modificationTime timestamp, length long, content binary"


def curate_arrivals(
    spark: SparkSession, zones: Zones, checkpoint: str, max_files: int | None = None, **policy
) -> StreamingQuery:
    """Upsert all files that arrived since the last call, then stop.

    A batch may hold any days, late ones too: only their partitions are rewritten. A batch
    that is repeated after a failure upserts the same rows again, which changes nothing unless
    rows repeat a key: those are all kept when first written, and matching them again fails, as
    does a key that several later rows match, unless ``policy`` (that of ``upsert_partitioned``)
    says which is the latest. With ``on_duplicate="distinct"`` rows of earlier batches are recognised by the curated
    table itself, however old they are, and the result does not depend on the batches. The stream hands over the names of new
    files, and only their footers are read: columns that no schema declares are kept, and files may differ in their types.
    """
    reader = spark.readStream.format("binaryFile").schema(_LISTED).option("pathGlobFilter", "*.parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def upsert(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        paths = [r["path"] for r in batch.select("path").orderBy("path").collect()]
        rows = read_groups(session, file_groups(session, paths)).where(F.col("event_time").isNotNull())
        with scratch(session) as copies:
            dated = copies.keep(rows.withColumn("date", F.to_date("event_time")), "arrived")
            days = partition_days(dated, "date")
            mark_touched(session, zones, dated, days)
            upsert_partitioned(
                session, zones.transactions, dated, TRANSACTION_KEY, CURATED_TRANSACTIONS,
                days=days, **policy,
            )

    return (
        reader.load(zones.raw_transactions)
        .select("path")
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
