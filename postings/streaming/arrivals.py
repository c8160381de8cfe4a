"""Load days as their files arrive, with the batch operators.

A run processes the files that landed since the last one and stops. New files, pages
and ledgers alike, only tell which days changed, by their names, so a file that cannot be parsed counts as well;
each of these days is then loaded whole, through the gate and by replacement, so a day that grows over several
runs or a batch that is retried ends in the same table. A stream does not see a file that is written
again under its name, as a day's ledger is: the days of such files are taken from the manifest when a run starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from postings.operators.sizing import fetched
from postings.plans.bronze import load_days
from postings.sources import manifest, warehouse


def load_arrivals(
    spark: SparkSession,
    folder: str,
    progress: str,
    table: str = warehouse.RAW_TABLE,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Start a run; ``progress`` is the stream's checkpoint folder on shared storage."""
    warehouse.ensure_layers(spark)
    warehouse.create_raw_table(spark, table)
    manifest.ensure_tables(spark, table)
    if again := manifest.rewritten_days(spark, folder, table):
        load_days(spark, folder, *map(str, again), table=table)
    # names only: the contents are not read here
    arriving = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "{raw,status}_*.json")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select(manifest.day_in_name(F.element_at(F.split("path", "/"), -1)).alias("run_date"))
    )

    def load(batch: DataFrame, _: int) -> None:
        # at most one day per file of the batch; loaded in the caller's session, which
        # then sees the replaced files of the table
        touched = sorted(str(row.run_date) for row in fetched(batch.distinct(), "days of a batch", files_per_batch) if row.run_date)
        if touched:
            load_days(spark, folder, *touched, table=table)

    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
