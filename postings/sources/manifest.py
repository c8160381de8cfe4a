"""Which landed files a raw table holds, and so which days have to be read.

One row per landed file and day partition: name, length, time, whether it could be parsed and how many ads it has, whether
its day was loaded, and the state of the day's raw partition after that. A listing of the folder (names, lengths and
times; no file is opened) against these rows tells the days whose files changed, and a listing of the raw
partitions tells the days that someone else wrote. All other days are neither read nor parsed.

A file belongs to the day in its name; a file without one is no landed page or ledger.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.operators.sizing import fetched
from postings.sources.warehouse import file_states, partition_days, replace_days

SCHEMA = (
    "folder string, file_name string, length long, modified timestamp, readable boolean, n_ads long, loaded boolean, "
    "raw_state string, run_date date"
)
PROBLEMS = "folder string, pair string, problem string, evidence string, run_date date"
DAY_IN_NAME = r"^(?:raw|status)_(\d{4}-\d{2}-\d{2})[_.].*json$"


def files_table(table: str) -> str:
    return f"{table}_landed"


def problems_table(table: str) -> str:
    return f"{table}_problems"


def ensure_tables(spark: SparkSession, table: str) -> None:
    for name, schema in ((files_table(table), SCHEMA), (problems_table(table), PROBLEMS)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet PARTITIONED BY (run_date)")


def day_in_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, DAY_IN_NAME, 1), F.lit("")).try_cast("date")


def landed_files(spark: SparkSession, folder: str, *days: str) -> DataFrame:
    """(file_name, length, modified, run_date) of the page files and ledgers of the folder; contents are not read."""
    of_days = "{" + ",".join(days) + "}*" if days else "*"
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{{raw,status}}_{of_days}.json").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    named = files.select(name.alias("file_name"), "length", F.col("modificationTime").alias("modified"))
    return named.withColumn("run_date", day_in_name(F.col("file_name"))).where("run_date IS NOT NULL")


def _digest() -> Column:
    """What a set of files is told by, whatever their order."""
    return F.concat_ws(":", F.count("*"), F.bit_xor(F.xxhash64("file_name", "length", F.unix_micros("modified"))))


def changed_days(spark: SparkSession, folder: str, table: str, *days: str, rejected_too: bool = False) -> tuple[list[date], DataFrame]:
    """The days to read, and the listing that tells it.

    A day is read if its files are not those noted, if it was loaded and its raw partition is not the one noted, or, with
    ``rejected_too``, if it was not loaded. A day whose files are all gone is no reason to touch its rows.
    """
    listing = landed_files(spark, folder, *days)
    noted = spark.table(files_table(table)).where(F.col("folder") == folder)
    if days:
        noted = noted.where(F.col("run_date").cast("string").isin(*days))
    now = listing.groupBy("run_date").agg(_digest().alias("now"))
    before = noted.groupBy("run_date").agg(_digest().alias("noted"), F.bool_and("loaded").alias("loaded"), F.max("raw_state").alias("raw_state"))
    raw = file_states(spark, table, "run_date").withColumnRenamed("state", "raw_now")
    # one row per day on all three sides
    found = now.join(before, "run_date", "left").join(raw, "run_date", "left")
    differs = ~F.col("now").eqNullSafe(F.col("noted"))
    overwritten = F.col("loaded") & ~F.col("raw_state").eqNullSafe(F.col("raw_now"))
    again = F.col("loaded").eqNullSafe(F.lit(False)) & F.lit(rejected_too)
    rows = fetched(found.where(differs | F.coalesce(overwritten, F.lit(False)) | again).select("run_date"), "days to read")
    return sorted(r.run_date for r in rows), listing


def rewritten_days(spark: SparkSession, folder: str, table: str) -> list[date]:
    """Days that were read before and whose files changed since, by a file written again under its name, say."""
    changed, _ = changed_days(spark, folder, table)
    known = set(partition_days(spark, files_table(table)))
    return [d for d in changed if d in known]


def note(spark: SparkSession, folder: str, table: str, listing: DataFrame, pages: DataFrame, problems: DataFrame, changed: list[date], loaded: list[date]) -> None:
    """Write down what was read of the ``changed`` days and which of them were ``loaded``; ``listing`` was taken before they were read."""
    state = file_states(spark, table, "run_date")
    parsed = pages.groupBy(F.col("source_file").alias("file_name")).agg(F.bool_and(~F.col("unreadable")).alias("parsed"), F.sum("n").alias("n_ads"))
    bad_ledgers = problems.where(F.col("problem") == "unreadable").where("pair IS NULL").select("run_date", F.lit(True).alias("bad")).distinct()
    files = (
        listing.where(F.col("run_date").isin(changed)).join(parsed, "file_name", "left").join(state, "run_date", "left").join(bad_ledgers, "run_date", "left")
    )
    was_loaded = F.col("run_date").isin(loaded) if loaded else F.lit(False)
    readable = F.when(F.col("file_name").startswith("raw_"), F.coalesce("parsed", F.lit(True))).otherwise(F.col("bad").isNull())
    replace_days(files.select(
        F.lit(folder).alias("folder"), "file_name", "length", "modified", readable.alias("readable"), "n_ads", was_loaded.alias("loaded"),
        F.when(was_loaded, F.col("state")).alias("raw_state"), "run_date"), files_table(table))
    # A day without problems has to lose its old ones, so each day has a row of its own.
    days = spark.createDataFrame([(d,) for d in changed], "run_date date")
    known = days.join(problems.where("run_date IS NOT NULL"), "run_date", "left")
    replace_days(known.select(F.lit(folder).alias("folder"), "pair", "problem", "evidence", "run_date"), problems_table(table))


def noted_problems(spark: SparkSession, folder: str, table: str, *days: str) -> DataFrame:
    """The problems of all days that were read of the folder, as found when they were read last."""
    found = spark.table(problems_table(table)).where((F.col("folder") == folder) & F.col("problem").isNotNull())
    if days:
        found = found.where(F.col("run_date").cast("string").isin(*days))
    return found.select("run_date", "pair", "problem", "evidence")
