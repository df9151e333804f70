"""Streaming re-aim of the weekly incremental chart load.

Chart pages land as JSON files in a folder; a Structured Streaming query
reads them with a fixed schema, flattens the items and loads every
micro-batch with ``foreachBatch``: placeholder tracks for unknown ids, facts
and a ledger of the files they came from, published in one commit.

A replayed micro-batch is skipped before anything is read of the fact table:
by its epoch, which the commit that loaded it keeps for this query, and, where
the query's checkpoint was lost, by its files, which the ledger names.  Files
that are new in a batch are loaded without the others.  The anti-join on the
deterministic keys stays behind that for entries that come in two files.
``trigger(availableNow=True)`` processes what has landed and stops, which is the
weekly job; a processing-time trigger makes it continuous.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartlake import config as C
from chartlake import schemas as S
from chartlake.functions import calendar as cal
from chartlake.plans import warehouse as wh
from chartlake.session import cut_lineage
from chartlake.sources import staging as st

#: Column of the file an entry came from.
FILE = "landed_file"
#: New files of a batch that are broadcast to its entries.
BROADCAST_FILES = 100_000


def chart_entry_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of flattened chart entries from landed pages."""
    reader = spark.readStream.schema(S.CHART_PAGE_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.json(landing_dir).withColumn(FILE, F.col("_metadata.file_path"))
    flat = st.flatten_chart_items(st.chart_items(pages), F.lit(None).cast("string"))
    return flat.withColumn("chart_date", cal.parse_api_date("chart_date")).drop("raw_json", "fetched_at")


def new_files(tx: wh.Transaction, batch: DataFrame) -> DataFrame:
    """Files of a batch that the ledger does not name.  Both sides are lists of files."""
    ledger = wh.log.read_batches(tx.spark, tx.root, "loaded_file", tx.view.of("loaded_file")).select(F.col("file").alias(FILE))
    return batch.select(FILE).distinct().join(ledger, FILE, "left_anti")


def load_batch(root: str, cfg: C.LoadConfig = C.DEFAULT_LOAD):
    """The ``foreachBatch`` function: load of one micro-batch, once."""

    def _load(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        if query and epoch_id <= wh.log.current(spark, root).loads.get(query, -1):
            return

        def stage(tx: wh.Transaction) -> None:
            files = cut_lineage(new_files(tx, batch))
            n = files.count()
            if n:
                entries = batch.join(F.broadcast(files) if n <= BROADCAST_FILES else files, FILE, "left_semi")
                wh.stage_charts(tx, entries.filter(F.col("song_uuid").isNotNull()).drop(FILE), cfg)
                tx.append(files.select(F.lit(query).alias("query"), F.lit(epoch_id).alias("epoch"), F.col(FILE).alias("file")), "loaded_file")
            if query:
                tx.loads.pop(query, None)  # the last to publish stands last
                tx.loads[query] = epoch_id

        wh.publish(spark, root, stage)

    return _load


def start_chart_stream(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    checkpoint_dir: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    cfg: C.LoadConfig = C.DEFAULT_LOAD,
) -> StreamingQuery:
    """Start the landed-pages -> warehouse stream."""
    writer = (
        chart_entry_stream(spark, landing_dir, max_files_per_trigger)
        .writeStream.foreachBatch(load_batch(root, cfg))
        .option("checkpointLocation", checkpoint_dir)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
