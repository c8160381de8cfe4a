"""Landed pages to the raw table, whole days only."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.operators import gate
from postings.operators.sizing import fetched
from postings.sources import landing, manifest, warehouse


class Load(NamedTuple):
    days: list[date]
    summary: DataFrame
    problems: DataFrame


def problems_in(spark: SparkSession, folder: str, pages: DataFrame, *days: str) -> DataFrame:
    """What keeps the landed days from being whole; ``pages`` are their page counts, unreadable files among them."""
    ledger = landing.read_ledger(spark, folder, *days)
    found = gate.day_problems(
        pages.where("NOT unreadable").drop("unreadable"),
        landing.expected_pairs(ledger),
        landing.pair_states(ledger),
        landing.ledger_days(ledger),
    )
    return found.unionByName(landing.unreadable_files(pages, ledger))


def load_days(
    spark: SparkSession,
    folder: str,
    *days: str,
    allow_incomplete: bool = False,
    table: str = warehouse.RAW_TABLE,
) -> Load:
    """Replace every whole day of the landing folder (or of ``days``) in the raw table whose files or rows changed.

    The manifest tells which days these are; all others are left as they are, unread. Returns the days that were
    loaded, their summary as stored, and the problems of all days asked for. A day that was rejected is judged
    again when its files change, or with ``allow_incomplete``. Loading the same folder twice changes nothing.
    A day's pages are parsed once, and written for the two plans that read them: page counts for the gate, and ads.
    """
    warehouse.ensure_layers(spark)
    warehouse.ensure_partitioned(spark, table)
    warehouse.create_raw_table(spark, table)
    manifest.ensure_tables(spark, table)
    changed, listing = manifest.changed_days(spark, folder, table, *days, rejected_too=allow_incomplete)
    loaded: list[date] = []
    if changed:
        with warehouse.intermediates() as made:
            names = [str(d) for d in changed]
            listing = warehouse.stored(listing.where(F.col("run_date").isin(changed)))
            parsed = warehouse.stored(landing.read_pages(spark, folder, *names))
            pages = warehouse.stored(landing.page_counts(parsed, "unreadable", "source_file"))
            problems = warehouse.stored(problems_in(spark, folder, pages, *names))

            flat = landing.flatten_pages(parsed.where("NOT unreadable"))
            warehouse.replace_days(gate.admit(flat, problems, allow_incomplete), table)
            landed = pages.where("n > 0 AND NOT unreadable").select("run_date").distinct()
            loaded = sorted(r.run_date for r in fetched(gate.admit(landed, problems, allow_incomplete), "days loaded"))
            manifest.note(spark, folder, table, listing, pages, problems, changed, loaded)
            made.drop()
    kept = spark.table(table).where(F.col("run_date").isin(loaded))
    return Load(loaded, gate.load_summary(kept), manifest.noted_problems(spark, folder, table, *days))
