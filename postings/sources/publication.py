"""Versions of a set of tables, published as one.

A build replaces tables one after another, so whoever reads them meanwhile sees
half of it. A publication is a folder of its own: rows go to new folders that
nothing refers to yet, and a small file then names the folders of every table of
the new version. That file is the one swap. A build that dies before it leaves
all tables at the old version, and readers of an old version keep its files
until :func:`vacuum`.

A table by day sends only the days whose files changed since the version before;
the other days stay where they are and are named again. A publication has one
writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postings.operators.sizing import fetched
from postings.sources.warehouse import file_states

VERSIONS = "_versions"
#: The only part of a table that is not by day.
WHOLE = ""


class NotPublished(LookupError):
    """No such version, or no such table in it."""


def publish(spark: SparkSession, root: str, *tables: str) -> int:
    """Publish catalog tables under the last part of their names and return the new version's number.

    A table by day sends its changed days, all of them after a change of its columns; any other table is written whole.
    Days that left a table leave the version. Tables published before and not named stay as they were. NULL days are no
    day of a table: the layers admit none.
    """
    last = max(versions(spark, root), default=0)
    published = dict(_named(spark, root, last)) if last else {}
    for table in tables:
        name = table.split(".")[-1]
        published[name] = _sent(spark, f"{root}/{name}", table, published.get(name))
    _swap(spark, root, last + 1, published)
    return last + 1


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A published table, of the newest version by default. A filter on its day prunes folders."""
    return _frame(spark, root, name, _named(spark, root, _of(spark, root, version)))


def views(spark: SparkSession, root: str, version: int | None = None) -> int:
    """All tables of one version as temporary views, so that the queries of a session agree; returns the version."""
    version = _of(spark, root, version)
    published = _named(spark, root, version)
    for name in published:
        _frame(spark, root, name, published).createOrReplaceTempView(name)
    return version


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the versions that can be read, in order."""
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{root}/{VERSIONS}") if n.endswith(".json") and not n.startswith((".", "_")))


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forget all but the last ``keep`` versions and delete the folders that no version names, also those of builds that died."""
    if keep < 1:
        raise ValueError("the last version is always kept")
    known = versions(spark, root)
    for version in known[:-keep]:
        _delete(spark, f"{root}/{VERSIONS}/{version:09d}.json")
    kept = {f"{name}/{path}" for v in known[-keep:] for name, t in _named(spark, root, v).items() for _, path in t["parts"].values()}
    builds = {"/".join(k.split("/")[:2]) for k in kept}
    gone = []
    for name in _names(spark, root):
        for build in _names(spark, f"{root}/{name}") if name != VERSIONS else []:
            at = f"{name}/{build}"
            days = [f"{at}/{d}" for d in _names(spark, f"{root}/{at}") if "=" in d] if at in builds and at not in kept else []
            gone += [d for d in days if d not in kept] if at in builds else [at]
    for path in gone:
        _delete(spark, f"{root}/{path}")
    return sorted(gone)


def _sent(spark: SparkSession, folder: str, table: str, before: dict | None) -> dict:
    """What a version says of a table, after the folders it lacks were written."""
    rows = spark.table(table)
    schema = rows.schema.json()
    by = next((c.name for c in spark.catalog.listColumns(table) if c.isPartition), None)
    build = f"build=b{uuid.uuid4().hex}"
    if by is None:
        rows.write.parquet(f"{folder}/{build}")
        return {"schema": schema, "by": None, "parts": {WHOLE: ["", build]}}
    now = {str(r[by]): r.state for r in fetched(file_states(spark, table, by), f"days of {table}")}
    parts = before["parts"] if before and (before["schema"], before["by"]) == (schema, by) else {}
    parts = {day: part for day, part in parts.items() if now.get(day) == part[0]}
    if changed := sorted(now.keys() - parts.keys()):
        some = rows.where(F.col(by).isin([F.lit(d).cast("date") for d in changed])) if parts else rows
        some.hint("rebalance", by).write.partitionBy(by).parquet(f"{folder}/{build}")
        written = set(_names(spark, f"{folder}/{build}"))
        # A day may have files and no rows; then it has no folder, and the version does not name it.
        parts |= {d: [now[d], f"{build}/{by}={d}"] for d in changed if f"{by}={d}" in written}
    return {"schema": schema, "by": by, "parts": parts}


def _frame(spark: SparkSession, root: str, name: str, published: dict) -> DataFrame:
    if name not in published:
        raise NotPublished(name)
    table = published[name]
    schema = StructType.fromJson(json.loads(table["schema"]))
    if not table["parts"]:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/{name}/{path}" for _, path in table["parts"].values()]
    return spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(*paths).select(*schema.names)


def _of(spark: SparkSession, root: str, version: int | None) -> int:
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise NotPublished(f"{root}, version {version or 'newest'}")
    return version or known[-1]


def _named(spark: SparkSession, root: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{root}/{VERSIONS}/{version:09d}.json", wholetext=True).first().value)


def _swap(spark: SparkSession, root: str, version: int, published: dict) -> None:
    """Name the version. The file is complete when it gets its name, and no name is given twice."""
    fs, at = _at(spark, f"{root}/{VERSIONS}/{version:09d}.json")
    _, hidden = _at(spark, f"{root}/{VERSIONS}/.{uuid.uuid4().hex}")
    fs.mkdirs(at.getParent())
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(json.dumps(published).encode()))
    finally:
        out.close()
    if fs.exists(at) or not fs.rename(hidden, at):
        raise RuntimeError(f"version {version} of {root} was published by someone else")


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _at(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at
