"""Warehouse tables: one database per layer, days as partitions."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings import fixed
from postings.operators.sizing import fetched

RAW, STAGING, INTERMEDIATE, MARTS = "raw", "staging", "intermediate", "marts"
RAW_TABLE = "raw.vacancy_results"


def ensure_layers(spark: SparkSession) -> None:
    for layer in (RAW, STAGING, INTERMEDIATE, MARTS):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def create_raw_table(spark: SparkSession, table: str = RAW_TABLE) -> None:
    """Create the typed raw table partitioned by ``run_date`` unless it exists."""
    columns = ", ".join(f"{n} {t.simpleString()}" for n, t in fixed.RAW_COLUMNS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (run_date)"
    )


def is_partitioned(spark: SparkSession, table: str, by: str = "run_date") -> bool:
    return any(c.name == by and c.isPartition for c in spark.catalog.listColumns(table))


def ensure_partitioned(spark: SparkSession, table: str = RAW_TABLE, by: str = "run_date") -> bool:
    """Rebuild an unpartitioned table by day and swap its location; True when rebuilt.

    The rows are written beside the old table first, and the old one is dropped
    only when the new files are complete.
    """
    if not spark.catalog.tableExists(table) or is_partitioned(spark, table, by):
        return False
    old = spark.table(table)
    layer, name = table.split(".")
    path = f"{spark.catalog.getDatabase(layer).locationUri}/{name}_by_{by}_{uuid.uuid4().hex}"
    old.hint("rebalance", by).write.partitionBy(by).parquet(path)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in old.schema)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return True


def replace_days(rows: DataFrame, table: str = RAW_TABLE, by: str = "run_date") -> None:
    """Replace exactly the days present in ``rows``; other days stay. Safe to repeat.

    The rebalance hint gives each day few files and splits a dominating day
    over several tasks.
    """
    spark = rows.sparkSession
    stored = rows.select(*spark.table(table).columns)
    with _dynamic_overwrite(spark):
        stored.hint("rebalance", by).write.insertInto(table, overwrite=True)


def save_table(df: DataFrame, table: str, by: str | None = None) -> DataFrame:
    """Materialise a table, by day when ``by`` is given, and return it as read back."""
    if by:
        df = df.hint("rebalance", by)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once and read back, for plans that read it several times.

    The files go to the shared folder named by ``spark.checkpoint.dir``, so a
    lost executor costs a read, not a recomputation, and the columns stay
    prunable. What is written inside :func:`intermediates` can be dropped by it; cleaning the rest is up to the folder's owner.
    """
    path = f"{_shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    for scope in _SCOPES.get():
        scope.add(written, path)
    return written


class Intermediates:
    """What :func:`stored` wrote in a scope, and whether it may go; ``then`` is called after each write."""

    def __init__(self, then: Callable[[SparkSession], None] | None = None) -> None:
        self._written: list[tuple[DataFrame, str]] = []
        self._then = then

    def add(self, df: DataFrame, path: str) -> None:
        self._written.append((df, path))
        if self._then:
            self._then(df.sparkSession)

    def drop(self, *but: DataFrame) -> None:
        """Delete all of it but the frames ``but``. The caller knows that no other frame still reads it."""
        for df, path in self._written:
            if not any(df is kept for kept in but):
                _delete(df.sparkSession, path)
        self._written = [w for w in self._written if any(w[0] is kept for kept in but)]

    def read_by(self, df: DataFrame) -> bool:
        """Whether ``df`` reads any of it."""
        files = df.inputFiles()
        return any(f"/{path.rsplit('/', 1)[1]}/" in name for _, path in self._written for name in files)


_SCOPES: ContextVar[tuple[Intermediates, ...]] = ContextVar("scopes", default=())


@contextmanager
def intermediates(then: Callable[[SparkSession], None] | None = None) -> Iterator[Intermediates]:
    """A scope that notes what :func:`stored` writes inside it, in inner scopes too, and calls ``then`` after each write.

    Written rows are on shared storage, so once the rows made from them are written, losing
    an executor needs them no more.
    """
    scope = Intermediates(then)
    token = _SCOPES.set((*_SCOPES.get(), scope))
    try:
        yield scope
    finally:
        _SCOPES.reset(token)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{_shared_folder(spark)}/{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """A new database below the shared folder, for tables that are written and read back; dropping it is up to its owner."""
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{_shared_folder(spark)}/{name}'")
    return name


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    return _local_folder()


@cache
def _local_folder() -> str:
    """Stand-in for the shared folder on a single machine; gone when the process ends."""
    folder = tempfile.mkdtemp(prefix="postings-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def partition_days(spark: SparkSession, table: str) -> list[date]:
    """The days of a table partitioned by them, in order, from the catalogue alone."""
    names = (r.partition.split("=")[1] for r in fetched(spark.sql(f"SHOW PARTITIONS {table}"), f"days of {table}"))
    return sorted(date.fromisoformat(n) for n in names if n != "__HIVE_DEFAULT_PARTITION__")


def file_states(spark: SparkSession, table: str, by: str) -> DataFrame:
    """(day, state) of every day partition, from the listing of its files; none is opened.

    Every write of a day makes files of new names, so whoever wrote it changes the state.
    """
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(about["Location"])
    day = F.nullif(F.regexp_extract("path", rf"/{by}=(\d{{4}}-\d{{2}}-\d{{2}})/", 1), F.lit("")).try_cast("date").alias(by)
    named = files.select(day, F.element_at(F.split("path", "/"), -1).alias("name"), "length").where(F.col(by).isNotNull())
    return named.groupBy(by).agg(F.concat_ws(":", F.count("*"), F.bit_xor(F.xxhash64("name", "length"))).alias("state"))


def drop_days(spark: SparkSession, table: str, days: Iterable[date]) -> None:
    (by,) = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    for day in days:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({by} = DATE'{day}')")


def save_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def row_count(spark: SparkSession, table: str = RAW_TABLE) -> int:
    return spark.table(table).agg(F.count("*")).first()[0]


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Table inserts read the overwrite mode from the session, not from writer options."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)
