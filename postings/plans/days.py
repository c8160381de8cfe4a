"""The fact, the attribute history and the marts by day, advanced by the days that changed.

A day's fact rows depend on its ads, on the observed day before it, and on what is known of its ads from earlier days. That
is kept as state rows by day (``STATES``) with a snapshot of all ads now and then (``SNAPSHOTS``), so a new day reads
itself, its predecessor and the state. A reloaded or dropped day changes what follows it, so all days
from the earliest changed one on are made again, one after the other, from the state before it; beyond
``REPLAY_DAYS`` of them one pass over the whole history is cheaper, with the same rows.

``BUILT`` notes which state of each day's ads the tables hold. It is cut back before the first day is written and
completed after the last, so a build that dies is done again from where it began.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.operators import state
from postings.operators.sizing import fetched
from postings.plans import gold, silver
from postings.sources.warehouse import drop_days, partition_days, replace_days, save_table, stored

FACTS = "marts.fct_vacancy_daily"
HISTORY = "marts.dim_vacancy"
STATES = "intermediate.ad_states"
CLOSED = "intermediate.ad_versions_closed"
SNAPSHOTS = "intermediate.ad_snapshots"
BUILT = "intermediate.facts_built_from"

#: Days made again one by one; more are made in one pass over everything.
REPLAY_DAYS = 31
#: Observed days between two snapshots, and so the most state partitions that a day reads.
SNAPSHOT_EVERY = 30
SK = "vacancy_sk"
KEYS = (silver.KEY, silver.DAY, silver.VERSIONED)


def refresh(spark: SparkSession, ads_table: str, ads_built: DataFrame, full: bool = False) -> list[date] | None:
    """Bring fact, states and history up to the ads; the days that were made again or left, or None for all.

    ``ads_built`` tells per day what its ads were built from; days whose entry differs from the one noted here changed.
    """
    ads = spark.table(ads_table)
    now = {r.run_date: (r.state, r.rules) for r in fetched(ads_built.select("run_date", "state", "rules"), "days of the ads table")}
    made = {}
    if not full and all(spark.catalog.tableExists(t) for t in (BUILT, FACTS, STATES, CLOSED)):
        made = {r.run_date: (r.state, r.rules) for r in fetched(spark.table(BUILT), "days of the fact table")}
    changed = {d for d in now.keys() | made.keys() if now.get(d) != made.get(d)}
    days = partition_days(spark, ads_table)
    first = min(changed, default=None)
    again = [d for d in days if first is not None and d >= first]
    if not made or len(again) > REPLAY_DAYS:
        rebuild(ads)
        _note(spark, now)
        _publish(spark)
        return None
    if first is not None:
        _note(spark, {d: s for d, s in made.items() if d < first})
        _cut(spark, first)
        for day in again:
            at = days.index(day)
            advance(ads, day, days[at - 1] if at else None)
        _note(spark, now)
    _publish(spark)
    return sorted({*again, *(d for d in made if first is not None and d >= first)})


def rebuild(ads: DataFrame) -> None:
    """All days in one pass, each with its own state rows, so that any of them can be made again later."""
    spark = ads.sparkSession
    for table in (SNAPSHOTS, CLOSED):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = save_table(state.states(ads, *KEYS), STATES, silver.DAY)
    save_table(state.closed_versions(rows, *KEYS, SK).withColumn("closed_on", F.col("valid_to")), CLOSED, "closed_on")
    save_table(gold.fact(ads), FACTS, silver.DAY)


def advance(ads: DataFrame, day: date, previous: date | None) -> None:
    """Write the state rows, closed versions and fact of one day. Safe to repeat."""
    spark = ads.sparkSession
    of_day = F.col(silver.DAY) == F.lit(day)
    today = ads.where(of_day)
    replace_days(state.advanced(today, _known(spark, day), *KEYS), STATES, silver.DAY)
    rows = spark.table(STATES).where(of_day)
    replace_days(state.closed_versions(rows, *KEYS, SK).withColumn("closed_on", F.col("valid_to")), CLOSED, "closed_on")
    yesterday = None if previous is None else spark.table(FACTS).where(F.col(silver.DAY) == F.lit(previous))
    replace_days(gold.fact_of_day(today, rows, yesterday), FACTS, silver.DAY)
    _snapshot(spark, day)


def _known(spark: SparkSession, day: date | None) -> DataFrame:
    """The state of all ads before ``day``, or after all days."""
    rows, since = spark.table(STATES), _last_snapshot(spark, day)
    snapshot = None if since is None else spark.table(SNAPSHOTS).where(F.col("as_of") == F.lit(since))
    return state.before(rows, *KEYS, day, snapshot, since)


def _last_snapshot(spark: SparkSession, day: date | None) -> date | None:
    if not spark.catalog.tableExists(SNAPSHOTS):
        return None
    return max((d for d in partition_days(spark, SNAPSHOTS) if day is None or d < day), default=None)


def _snapshot(spark: SparkSession, day: date) -> None:
    """One row per ad after ``day``, once enough days have passed since the last; the day itself counts."""
    since = _last_snapshot(spark, day)
    if sum(d <= day and (since is None or d > since) for d in partition_days(spark, STATES)) < SNAPSHOT_EVERY:
        return
    rows = _known(spark, day + timedelta(days=1)).withColumn("as_of", F.lit(day))
    if spark.catalog.tableExists(SNAPSHOTS):
        replace_days(rows, SNAPSHOTS, "as_of")
    else:
        save_table(rows, SNAPSHOTS, "as_of")


def _cut(spark: SparkSession, first: date) -> None:
    """Drop what was made for ``first`` and later days."""
    for table in (STATES, CLOSED, SNAPSHOTS, FACTS):
        if spark.catalog.tableExists(table):
            drop_days(spark, table, [d for d in partition_days(spark, table) if d >= first])


def _note(spark: SparkSession, made: dict) -> None:
    rows = [(d, *s) for d, s in sorted(made.items())]
    save_table(spark.createDataFrame(rows, "run_date date, state string, rules string").coalesce(1), BUILT)


def _publish(spark: SparkSession) -> None:
    """The history as a view: versions that ended, and the one in force of every ad."""
    if spark.catalog.tableExists(HISTORY) and spark.catalog.getTable(HISTORY).tableType != "VIEW":
        spark.sql(f"DROP TABLE {HISTORY}")
    columns = ", ".join([SK, silver.KEY, *silver.VERSIONED, "valid_from", "valid_to", "is_current"])
    carried = ", ".join(state.known_columns(silver.KEY, silver.VERSIONED))
    since = _last_snapshot(spark, None)
    rows = f"SELECT {silver.DAY}, {carried} FROM {STATES}"
    if since is not None:
        rows += f" WHERE {silver.DAY} > DATE'{since}' UNION ALL SELECT as_of, {carried} FROM {SNAPSHOTS} WHERE as_of = DATE'{since}'"
    attributes = ", ".join(f"s.{a}" for a in silver.VERSIONED)
    spark.sql(f"""
        CREATE OR REPLACE VIEW {HISTORY} AS
        SELECT {columns} FROM {CLOSED}
        UNION ALL
        SELECT md5(concat_ws('|', {silver.KEY}, CAST(s.version_from AS STRING))), {silver.KEY}, {attributes},
               s.version_from, CAST(NULL AS DATE), true
        FROM (SELECT {silver.KEY}, max_by(struct({carried}), {silver.DAY}) AS s FROM ({rows}) GROUP BY {silver.KEY})""")


def save_days(df: DataFrame, table: str, days: list[date] | None) -> DataFrame:
    """``df`` as a table by day: all of it, or the rows of ``days``, which leave the table where ``df`` has none of theirs."""
    spark = df.sparkSession
    if days is None or not spark.catalog.tableExists(table):
        return save_table(df, table, silver.DAY)
    if days:
        some = stored(df)
        replace_days(some, table, silver.DAY)
        left = {r[0] for r in fetched(some.select(silver.DAY).distinct(), "days made again")}
        drop_days(spark, table, set(days) - left)
    return spark.table(table)
