"""Profiling of landed rows and reconciliation reports over the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings import fixed
from postings.functions import folded, headers_with, hours_between, share
from postings.operators.dedup import first_rows
from postings.operators.snapshot import latest, latest_day

PAIR = ["run_date", "country", "role_query"]


# --- profile of landed rows -------------------------------------------------------

def volume(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows collected against the count reported on the last page, per pair."""
    reported = pages.groupBy(*PAIR).agg(
        F.max(F.struct("page", "count_reported")).getField("count_reported").alias("reported")
    )
    collected = rows.groupBy(*PAIR).agg(F.count("*").alias("n"))
    return reported.join(collected, PAIR, "left").select(
        *PAIR, F.coalesce("n", F.lit(0)).alias("collected"), "reported"
    )


def duplicates(rows: DataFrame) -> DataFrame:
    """Rows with an id, distinct ids, and the share of repeats."""
    return rows.agg(
        F.count("source_id").alias("n_rows"), F.count_distinct("source_id").alias("n_ids")
    ).select(
        "n_rows",
        "n_ids",
        (F.col("n_rows") - F.col("n_ids")).alias("n_repeats"),
        F.round(share(F.col("n_rows") - F.col("n_ids"), "n_rows"), 6).alias("repeat_share"),
    )


def overlap(rows: DataFrame) -> DataFrame:
    """How many ids were found by 1, 2, ... queries."""
    per_id = (
        rows.where(F.col("source_id").isNotNull())
        .groupBy("source_id")
        .agg(F.count_distinct("role_query").alias("n_queries"))
    )
    return per_id.groupBy("n_queries").agg(F.count("*").alias("n_ids"))


def salary_fields(rows: DataFrame) -> DataFrame:
    """Per country: flag set, band present, both, and the share of both."""
    flag, band = F.col("salary_is_predicted") == "0", F.col("salary_min").isNotNull()
    return (
        rows.groupBy("country")
        .agg(
            F.count("*").alias("n"),
            F.count_if(flag).alias("n_flag"),
            F.count_if(band).alias("n_band"),
            F.count_if(flag & band).alias("n_both"),
        )
        .withColumn("both_share", F.round(share("n_both", "n"), 6))
    )


def _repeats(rows: DataFrame) -> DataFrame:
    columns = ["country", "company_name", "title"]
    ads = first_rows(rows, "source_id", ["source_file"], columns)
    title = F.btrim("title", F.lit(fixed.WHITE_SPACE))
    named = (folded("company_name") != "") & (folded("title") != "")
    return ads.select("country", "company_name", title.alias("title"), named.alias("named"))


def repeated_positions(rows: DataFrame, top: int = 8) -> DataFrame:
    """Positions advertised under the most different ids."""
    by = ["country", "company_name", "title"]
    return (
        _repeats(rows).where("named").groupBy(*by).agg(F.count("*").alias("n"))
        .where("n > 1")
        .orderBy(F.desc("n"), *by)
        .limit(top)
    )


def repeated_share(rows: DataFrame) -> DataFrame:
    """Ads beyond the first of their position, and their share of all ids."""
    by = ["country", "company_name", "title"]
    per_position = _repeats(rows).groupBy("named", *by).agg(F.count("*").alias("n"))
    return per_position.agg(
        F.sum("n").alias("n_ids"),
        F.coalesce(F.sum(F.when(F.col("named"), F.col("n") - 1)), F.lit(0)).alias("n_extra"),
    ).withColumn("extra_share", F.round(share("n_extra", "n_ids"), 6))


def top_titles(rows: DataFrame, top: int = 15) -> DataFrame:
    return (
        rows.where(folded("title") != "")
        .groupBy(F.btrim("title", F.lit(fixed.WHITE_SPACE)).alias("title"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "title")
        .limit(top)
    )


def term_coverage(rows: DataFrame, text: str, terms: list[str] = fixed.TECHNOLOGIES) -> DataFrame:
    """Rows naming each term, most frequent first; the term NULL stands for any of them.

    One pass: a counter per term and task, no row per hit.
    """
    names = [f"hit_{i}" for i in range(len(terms))]
    searched = rows.select(folded(text).alias("text")).select(
        *[F.col("text").contains(t).alias(n) for n, t in zip(names, terms)]
    )
    counted = searched.agg(
        F.count("*").alias("total"),
        F.count_if(F.greatest(*names)).alias("n_any"),
        *[F.count_if(n).alias(f"n_{i}") for i, n in enumerate(names)],
    )
    lines = F.array(
        F.struct(F.lit(None).cast("string").alias("term"), F.col("n_any").alias("n")),
        *[F.struct(F.lit(t).alias("term"), F.col(f"n_{i}").alias("n")) for i, t in enumerate(terms)],
    )
    return (
        counted.select("total", F.explode(lines).alias("line"))
        .select("line.term", "line.n", F.round(share("line.n", "total"), 6).alias("share"))
        .where((F.col("n") > 0) | F.col("term").isNull())
        .orderBy(F.desc("n"), "term")
    )


def profile(raw: DataFrame, pages: DataFrame, counts: DataFrame, day: str | None = None) -> dict[str, DataFrame]:
    """The seven profile reports over one day: the latest one with rows, or ``day``.

    ``pages`` are the envelopes with their metadata, ``counts`` their page counts.
    """
    if day is None:
        rows = latest(raw, "run_date")
        wanted = latest_day(raw, "run_date").scalar()
    else:
        wanted = F.lit(day).cast("date")
        rows = raw.where(F.col("run_date") == wanted)
    return {
        "volume": volume(rows, counts.where(F.col("run_date") == wanted)),
        "duplicates": duplicates(rows),
        "overlap": overlap(rows),
        "salary_fields": salary_fields(rows),
        "repeated_positions": repeated_positions(rows),
        "top_titles": top_titles(rows),
        "term_coverage": term_coverage(rows, "vacancy_json" if "vacancy_json" in raw.columns else "description"),
        "quota_headers": quota_headers(pages.where(F.col("_meta.run_date").cast("date") == wanted)),
    }


def quota_headers(pages: DataFrame) -> DataFrame:
    """Quota-like response headers of the first page file."""
    first = pages.agg(F.min_by("_meta.response_headers", "source_file").alias("headers"))
    return first.select(F.explode(headers_with("headers")).alias("name", "value"))


# --- reports over the layers --------------------------------------------------------

def layer_counts(raw: DataFrame, staged: DataFrame, ads: DataFrame) -> DataFrame:
    """Rows and distinct ids per layer, and how the ads split into relevant and other.

    An ad id appears in the ads layer once per day, so its rows are counted by id first.
    """
    def counted(layer: str, df: DataFrame, relevant: Column, other: Column) -> DataFrame:
        return df.groupBy("source_id").agg(
            F.count("*").alias("n"), F.count_if(relevant).alias("r"), F.count_if(other).alias("o")
        ).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count("source_id").alias("n_ids"),
            F.coalesce(F.sum("r"), F.lit(0)).alias("n_relevant"),
            F.coalesce(F.sum("o"), F.lit(0)).alias("n_other"),
        ).select(F.lit(layer).alias("layer"), "*")

    nothing = F.lit(False)
    return (
        counted("raw", raw, nothing, nothing)
        .unionByName(counted("staging", staged, nothing, nothing))
        .unionByName(counted("ads", ads, F.col("is_relevant"), ~F.col("is_relevant")))
        .withColumn("other_share", F.round(share("n_other", "n_rows"), 6))
    )


def market_summary(market: DataFrame) -> DataFrame:
    """Totals per country and role with a subtotal per country (role NULL)."""
    totals = ["n_ads", "n_positions", "n_new", "n_gone"]
    return (
        market.rollup("country_code", "role_key")
        .agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in totals])
        .where("level < 3")
        .select("country_code", "role_key", (F.col("level") == 1).alias("is_subtotal"), *totals)
        .orderBy("country_code", F.col("role_key").asc_nulls_last())
    )


def disclosure_share(disclosure: DataFrame) -> DataFrame:
    return disclosure.select(
        "*", F.round(share("n_salary_disclosed", "n_ads"), 6).alias("disclosed_share")
    ).orderBy("country_code", "observed_on")


def salary_medians(salaries: DataFrame) -> DataFrame:
    return salaries.select(
        "observed_on", "country_code", "role_key", "n_disclosed",
        F.round("salary_mid_p50", 0).alias("salary_mid_p50"),
    ).orderBy("country_code", "role_key", "observed_on")


def top_unmatched(unmatched: DataFrame, top: int = 15) -> DataFrame:
    return (
        unmatched.select("n", "country_code", "title", "role_queries")
        .orderBy(F.desc("n"), "title", "country_code", "role_queries")
        .limit(top)
    )


# --- audits -------------------------------------------------------------------------

def age_audit(staged: DataFrame) -> DataFrame:
    """Hours between publication and collection per country."""
    age = hours_between("posted_at", "extracted_at")
    return staged.groupBy("country_code").agg(
        F.count("posted_at").alias("n"),
        F.round(F.max(age), 6).alias("max_hours"),
        F.count_if(age > 48).alias("n_over_48h"),
        F.count_if(age > 72).alias("n_over_72h"),
    )


def clock_audit(staged: DataFrame) -> DataFrame:
    """Ads published after they were collected."""
    ahead = hours_between("extracted_at", "posted_at")
    return (
        staged.where(F.col("posted_at") > F.col("extracted_at"))
        .groupBy("country_code")
        .agg(F.count("*").alias("n"), F.round(F.max(ahead), 6).alias("max_hours"))
    )


def id_stability(ads: DataFrame) -> DataFrame:
    """Ids seen again on a later day, and how many changed their publication or title meanwhile.

    An id has one row per day, so looking one row back replaces a self-join.
    """
    by_day = Window.partitionBy("source_id").orderBy("observed_on")
    before = ads.select(
        "country_code", "observed_on", "posted_at", "title",
        F.lag("observed_on").over(by_day).alias("seen_on"),
        F.lag("posted_at").over(by_day).alias("old_posted_at"),
        F.lag("title").over(by_day).alias("old_title"),
    ).where(F.col("seen_on").isNotNull())
    return before.groupBy("country_code").agg(
        F.count("*").alias("n_seen_again"),
        F.count_if(~F.col("posted_at").eqNullSafe(F.col("old_posted_at"))).alias("n_posted_changed"),
        F.count_if(~F.col("title").eqNullSafe(F.col("old_title"))).alias("n_title_changed"),
    )


def reappeared(daily: DataFrame) -> DataFrame:
    """New ads on a day on which an ad of the same position and city went.

    Both sides are counted per position and city; no pairs are formed.
    """
    place = ["observed_on", "country_code", "position_id", "location_city"]
    per_place = daily.groupBy(*place).agg(
        F.count_if("is_new").alias("n_new"), F.count_if("is_gone").alias("n_gone")
    )
    return (
        per_place.where("n_new > 0 AND n_gone > 0")
        .groupBy("observed_on", "country_code")
        .agg(F.count("*").alias("n_positions"), F.sum("n_new").alias("n_new_ads"))
    )


def volume_anomalies(staged: DataFrame, countries: list[str] = fixed.COUNTRIES) -> DataFrame:
    """Rows per day and country against the seven days before; empty and unusual days are flagged.

    Unusual is more than three standard deviations off the mean of at least two earlier days.
    """
    counted = staged.groupBy("observed_on", "country_code").agg(F.count("*").alias("n"))
    grid = counted.select("observed_on").distinct().select(
        "observed_on", F.explode(F.array(*[F.lit(c) for c in countries])).alias("country_code")
    )
    week = Window.partitionBy("country_code").orderBy("observed_on").rowsBetween(-7, -1)
    filled = grid.join(counted, ["observed_on", "country_code"], "left").select(
        "observed_on", "country_code", F.coalesce("n", F.lit(0)).alias("n")
    )
    usual = filled.select(
        "*",
        F.round(F.avg("n").over(week), 6).alias("usual"),
        F.round(F.stddev_samp("n").over(week), 6).alias("spread"),
    )
    return usual.select(
        "*",
        (F.col("n") == 0).alias("is_empty"),
        F.coalesce(F.abs(F.col("n") - F.col("usual")) > 3 * F.col("spread"), F.lit(False)).alias("is_unusual"),
    )
