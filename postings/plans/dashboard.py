"""Dashboard queries over the flat BI table.

Filters on country, role, contract and date are plain ``where`` calls on the
table before these functions. Groupings without the day hold an ad many times,
so ads are counted by distinct id here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings import fixed
from postings.functions import share
from postings.operators import bitmaps
from postings.operators.measures import measures
from postings.operators.quantiles import CONTINUOUS, DISCRETE, quantiles, with_quantiles
from postings.operators.snapshot import latest, latest_day


def is_open() -> Column:
    return F.col("is_open")


def kpi(bi: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Ads, positions, new, gone and the disclosed share of the open ads."""
    by = by or []
    return measures(
        bi,
        by,
        distinct={
            "n_ads": (is_open(), "source_id"),
            "n_positions": (is_open(), "position_id"),
            "n_new": (F.col("is_new"), "source_id"),
            "n_gone": (F.col("is_gone"), "source_id"),
            "n_disclosed": (is_open() & F.col("is_salary_disclosed"), "source_id"),
        },
    ).withColumn("disclosed_share", F.round(share("n_disclosed", "n_ads"), 6))


TILE_FILTERS = ["observed_on", "country_code", "role_key", "contract_type"]
TILE_MEASURES = ["n_ads", "n_positions", "n_new", "n_gone", "n_disclosed"]


def tile_bitmaps(bi: DataFrame, ads: DataFrame, positions: DataFrame) -> DataFrame:
    """Bitmaps of the KPI tile by everything that it can be filtered by; ``ads`` and ``positions`` number the keys.

    Its size is that of the filters' combinations, times the blocks of keys that occur in each, not of the fact.
    """
    numbered = bi.join(ads.withColumnRenamed("number", "ad"), "source_id", "left").join(positions.withColumnRenamed("number", "position"), "position_id", "left")
    return bitmaps.bitmaps(numbered, TILE_FILTERS, {
        "n_ads": (is_open(), "ad"),
        "n_positions": (is_open(), "position"),
        "n_new": (F.col("is_new"), "ad"),
        "n_gone": (F.col("is_gone"), "ad"),
        "n_disclosed": (is_open() & F.col("is_salary_disclosed"), "ad"),
    })


def kpi_of_tiles(tiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The rows of :func:`kpi` from bitmaps: filters on country, role, contract and day are ``where`` calls on ``tiles``.

    A group that the filters leave without any counted key has no row.
    """
    found = bitmaps.counts(tiles, by or [], TILE_MEASURES)
    return found.withColumn("disclosed_share", F.round(share("n_disclosed", "n_ads"), 6))


def composition(bi: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Crosstab of open ads: one line per value of ``rows``, one column per value given."""
    counted = measures(bi.where(is_open()), [rows, columns], distinct={"n": (F.lit(True), "source_id")})
    table = counted.groupBy(rows).pivot(columns, values).agg(F.sum("n"))
    return table.select(rows, *[F.coalesce(v, F.lit(0)).alias(v) for v in values])


def contract_by_grade(bi: DataFrame) -> DataFrame:
    return composition(bi, "contract_type", "grade", fixed.GRADES)


def time_by_work_mode(bi: DataFrame) -> DataFrame:
    return composition(bi, "contract_time", "remote_type", fixed.WORK_MODES)


def trend(bi: DataFrame) -> DataFrame:
    """Open ads and positions, new and gone per day (the day completes the grain: rows are ads)."""
    return measures(
        bi,
        ["observed_on"],
        counts={"n_ads": is_open(), "n_new": F.col("is_new"), "n_gone": F.col("is_gone")},
        distinct={"n_positions": (is_open(), "position_id")},
    )


def cities(bi: DataFrame) -> DataFrame:
    return measures(
        bi,
        ["city_group", "country_name"],
        distinct={"n_ads": (is_open(), "source_id"), "n_positions": (is_open(), "position_id")},
    )


def salary_matrix(bi: DataFrame, by_day: bool = False) -> DataFrame:
    """Quartiles of the disclosed mid salary of open ads by country and role."""
    by = (["observed_on"] if by_day else []) + ["country_name", "role_name"]
    return quantiles(
        bi.where(is_open() & F.col("is_salary_disclosed")),
        by,
        {
            "salary_mid_p25": ("salary_mid", 0.25, DISCRETE),
            "salary_mid_p50": ("salary_mid", 0.5, CONTINUOUS),
            "salary_mid_p75": ("salary_mid", 0.75, DISCRETE),
        },
        rows_as="n",
    )


def company_life(bi: DataFrame) -> DataFrame:
    """Positions and median days open by company and role, open ads."""
    by = ["company_name", "role_name"]
    shown = bi.where(is_open())
    return with_quantiles(
        measures(shown, by, distinct={"n_positions": (F.lit(True), "position_id")}),
        shown.groupBy(*by).agg(F.percentile("days_open", 0.5).alias("days_open_p50")),
        by,
    )


def week_growth(bi: DataFrame, top: int = 10, days_of: DataFrame | None = None) -> DataFrame:
    """Companies that added most ads in the seven days up to the latest one."""
    end = latest_day(bi if days_of is None else days_of, "observed_on").scalar()
    week = bi.where((F.col("observed_on") > F.date_sub(end, 7)) & F.col("company_name").isNotNull())
    return (
        measures(week, ["company_name"], distinct={"n_added": (F.col("is_new"), "source_id")})
        .where("n_added > 0")
        .orderBy(F.desc("n_added"), "company_name")
        .limit(top)
    )


def longest_open(bi: DataFrame, top: int = 10, days_of: DataFrame | None = None) -> DataFrame:
    """Companies whose ads of the latest day have been open longest."""
    now = latest(bi, "observed_on", days_of).where(is_open() & F.col("company_name").isNotNull())
    found = now.groupBy("company_name").agg(
        F.max("days_open").cast("int").alias("days_open_max"),
        F.percentile("days_open", 0.5).alias("days_open_p50"),
        F.count("*").alias("n_ads"),
    )
    return (
        found.orderBy(F.desc("days_open_max"), F.desc("days_open_p50"), "company_name")
        .limit(top)
    )
