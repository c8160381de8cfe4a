"""Completeness of collected pairs and admission of whole days.

Relations used here:

* pages: one row per page, ``run_date, country, role_query, page, n, count_reported``
* expected: ``run_date, pair``
* states: ``run_date, pair, status, pages, collected, count_reported, finished_at``

Pairs per day are bounded by the collection grid, days by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings import fixed
from postings.functions import pair_key
from postings.operators.sizing import measured_small

PAIR = ["run_date", "country", "role_query"]


def expected_grid(
    days: DataFrame, countries: list[str] = fixed.COUNTRIES, queries: list[str] = fixed.QUERIES
) -> DataFrame:
    """Every country with every query on every day of ``days`` (column ``run_date``)."""

    def each(values: list[str]) -> Column:
        return F.explode(F.array(*[F.lit(v) for v in values]))

    return (
        days.select("run_date", each(countries).alias("country"))
        .select("*", each(queries).alias("role_query"))
        .withColumn("pair", pair_key())
    )


def with_expected(ledger: DataFrame, more: DataFrame) -> DataFrame:
    """Ledger pairs plus further ``run_date, pair`` rows; a rerun only adds."""
    return ledger.select("run_date", "pair").unionByName(more.select("run_date", "pair")).distinct()


def last_results(states: DataFrame) -> DataFrame:
    """The latest result recorded per pair."""
    rest = [c for c in states.columns if c not in ("run_date", "pair")]
    newest = F.max(F.struct(F.col("finished_at").alias("at"), F.struct(*rest).alias("row")))
    return (
        states.groupBy("run_date", "pair")
        .agg(newest.getField("row").alias("row"))
        .select("run_date", "pair", "row.*")
    )


def state_of(states: DataFrame, run_date: str, country: str, query: str) -> DataFrame:
    """Recorded status of one pair; no row when nothing was recorded."""
    return last_results(
        states.where((F.col("run_date") == run_date) & (F.col("pair") == f"{country}/{query}"))
    ).select("status")


def pair_completeness(
    pages: DataFrame, page_size: int = fixed.PAGE_SIZE, max_pages: int = fixed.MAX_PAGES
) -> DataFrame:
    """State of every seen pair, judged by its last page in numeric order.

    Complete when the last page is short or the pages reach the reported count.
    Otherwise truncated at the page cap, failed below it.
    """
    last = F.max(F.struct("page", "n", "count_reported"))
    pairs = pages.groupBy(*PAIR).agg(
        last.alias("last"), F.count("*").alias("pages"), F.sum("n").alias("collected")
    )
    reached = (F.col("last.page") - 1) * page_size + F.col("last.n")
    complete = (F.col("last.n") < page_size) | F.coalesce(
        reached >= F.col("last.count_reported"), F.lit(False)
    )
    return pairs.select(
        *PAIR,
        pair_key().alias("pair"),
        F.when(complete, fixed.COMPLETE)
        .when(F.col("last.page") >= max_pages, fixed.TRUNCATED)
        .otherwise(fixed.FAILED)
        .alias("status"),
        "pages",
        "collected",
        F.col("last.page").alias("last_page"),
        F.col("last.count_reported").alias("count_reported"),
    )


def day_problems(
    pages: DataFrame,
    expected: DataFrame,
    states: DataFrame,
    ledger_days: DataFrame | None = None,
    **limits,
) -> DataFrame:
    """What keeps a day from being whole: ``run_date, pair, problem, evidence``.

    A day with a ledger is judged by its expected pairs, a day without one by
    the pages seen. Both relations have one row per pair and day. Without
    ``ledger_days`` the days of ``expected`` are taken.
    """
    in_ledger = ["run_date", "pair"]
    known = last_results(states).select(*in_ledger, "status")
    by_ledger = (
        expected.select(*in_ledger)
        .distinct()
        .join(known, in_ledger, "left")
        .withColumn("problem", F.coalesce("status", F.lit(fixed.NOT_COLLECTED)))
        .where(F.col("problem") != fixed.COMPLETE)
        .select(*in_ledger, "problem", F.lit(fixed.FROM_LEDGER).alias("evidence"))
    )
    judged = (expected if ledger_days is None else ledger_days).select("run_date").distinct()
    by_pages = (
        pair_completeness(pages, **limits)
        .where(F.col("status") != fixed.COMPLETE)
        .join(judged, "run_date", "left_anti")
        .select(
            *in_ledger,
            F.lit(fixed.INCOMPLETE_BY_FILES).alias("problem"),
            F.lit(fixed.FROM_PAGES).alias("evidence"),
        )
    )
    return by_ledger.unionByName(by_pages)


def admit(rows: DataFrame, problems: DataFrame, allow_incomplete: bool = False) -> DataFrame:
    """Rows of whole days only; incomplete days can be allowed, days with unreadable files never."""
    if allow_incomplete:
        problems = problems.where(F.col("problem") == fixed.UNREADABLE)
    closed = measured_small(problems.select("run_date").distinct())
    return rows.join(closed, "run_date", "left_anti").select(*rows.columns)


def load_summary(rows: DataFrame) -> DataFrame:
    """Files, rows, distinct ids and days of what is loaded."""
    # grouped before they are counted, so no task holds all files or ids
    by_file = rows.groupBy("source_file").agg(F.count("*").alias("n"), F.collect_set("run_date").alias("days"))
    by_id = rows.groupBy("source_id").agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("long")
    parts = by_file.agg(
        F.count("source_file").alias("files"), F.sum("n").alias("rows"), zero.alias("ids"),
        F.array_distinct(F.flatten(F.collect_set("days"))).alias("days"),
    ).unionByName(by_id.agg(
        zero.alias("files"), zero.alias("rows"), F.count("source_id").alias("ids"), F.array().cast("array<date>").alias("days"),
    ))
    return parts.agg(
        F.sum("files").alias("files"), F.coalesce(F.sum("rows"), zero).alias("rows"), F.sum("ids").alias("ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("days")))).alias("days"),
    )


def to_collect_again(
    expected: DataFrame, states: DataFrame, pages: DataFrame | None = None
) -> DataFrame:
    """Expected pairs that are not complete yet, or whose pages (``run_date, pair``) are not there any more."""
    done = last_results(states).where(F.col("status") == fixed.COMPLETE)
    if pages is not None:
        done = done.join(pages.select("run_date", "pair").distinct(), ["run_date", "pair"], "left_semi")
    return expected.join(done, ["run_date", "pair"], "left_anti")


def with_states_from_pages(states: DataFrame, by_pages: DataFrame) -> DataFrame:
    """Recorded states, plus ``complete`` for unrecorded pairs whose pages prove it."""
    proven = (
        by_pages.where(F.col("status") == fixed.COMPLETE)
        .select("run_date", "pair", "status", "pages")
        .join(states, ["run_date", "pair"], "left_anti")
    )
    return states.unionByName(proven, allowMissingColumns=True)


def run_totals(states: DataFrame) -> DataFrame:
    """Pairs, pages and rows per day and state."""
    return (
        last_results(states)
        .groupBy("run_date", "status")
        .agg(
            F.count("*").alias("pairs"),
            F.sum("pages").alias("pages"),
            F.sum("collected").alias("collected"),
        )
    )


def incomplete_pairs(states: DataFrame) -> DataFrame:
    return (
        last_results(states)
        .where(F.col("status") != fixed.COMPLETE)
        .select("run_date", "pair", "status")
    )
