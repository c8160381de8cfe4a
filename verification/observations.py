"""Observations derived from the ``events`` table, in staging shape.

One event is one occurrence of an ad in one query's results: user = ad, day =
observation, event type = search query. Titles and contract times shift with
the day, so ads change version, and some ads get a new id or a new date of publication. A country whose turn it is misses its day and
is collected on the following one, so country-days are uncovered, repeats of
one ad may disagree, and no event is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.functions import page_file_name

COUNTRIES = ["gb", "de", "nl", "pl", "us", "ca"]
TITLES = [
    "Senior Data Engineer", "Analytics Engineer", "ML Engineer (Remote)", "Data Scientist",
    "Werkstudent Datenanalyst", "Junior Data Analyst - hybrid", "Lead Machine Learning Engineer",
    "Data Governance Manager", "Angular/NodeJS Developer", "Staff Data Engineer",
    "International Data Analyst", "Jr Dateningenieur", "Principal MLOps, home office",
    "Audit Intern", "Data Analist", "Sr. Datenwissenschaftler",
]
DESCRIPTIONS = [
    "hybrid working, python and sql", "work from home, aws", "on site with spark", "kafka and dbt",
]
# some ads are placed again under a new id while the old one goes, early or late in the month
AGAIN = "CASE WHEN u % 10 = 7 AND dd >= 6 OR u % 10 = 3 AND dd >= 25 THEN 1000000 ELSE 0 END"
# and some change their date of publication on the way
LATER = "CASE WHEN u % 13 = 5 AND dd >= 13 THEN 1 ELSE 0 END"
POSTED = ["2023-12-30 22:00:00", "2024-01-05 09:00:00", "2024-01-20 00:30:00"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listed(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def raw_rows(spark: SparkSession, sf_dir: str, page: str = "1 + event_id % 3") -> DataFrame:
    """The observations under the names of the raw table, as untidy as landed rows.

    Titles carry outer spaces, company names may be blank, and ids or salary
    flags are missing where the event value is out of range.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = table(spark, sf_dir, "events").selectExpr(
        "value",
        "user_id AS u",
        "dayofmonth(ts) AS dd",
        "if((user_id % 6 + dayofmonth(ts)) % 9 = 0, date_add(to_date(ts), 1), to_date(ts)) AS run_date",
        "cast(ts AS timestamp) AS extracted_at",
        f"element_at({_listed(COUNTRIES)}, cast(1 + user_id % 6 AS int)) AS country",
        "event_type AS role_query",
        f"cast({page} AS int) AS page",
    )
    paid = "(country IN ('gb', 'us') OR u % 5 = 0)"
    return base.select(
        page_file_name("run_date", "country", "role_query", "page").alias("source_file"), "*"
    ).selectExpr(
        "source_file",
        "run_date",
        "extracted_at",
        "country",
        "role_query",
        "page",
        "50 * page AS count_reported",
        f"if(value >= 0.5, cast(u + {AGAIN} AS string), NULL) AS source_id",
        f"concat('  ', element_at({_listed(TITLES)}, cast(1 + (u + (dd - 1) div 10) % 16 AS int)), ' ') AS title",
        f"try_element_at({_listed(DESCRIPTIONS)}, cast(1 + u % 5 AS int)) AS description",
        f"cast(try_element_at({_listed(POSTED)}, cast(1 + (u + {LATER}) % 4 AS int)) AS timestamp) AS posted_at",
        "if(u % 11 = 0, '  ', concat(if(u % 2 = 0, 'Co ', 'CO '), cast(u % 17 AS string))) AS company_name",
        f"if({paid}, cast(30000 + (u % 40) * 1000 AS double), NULL) AS salary_min",
        f"if({paid} AND u % 7 <> 1, cast(40000 + (u % 40) * 1500 AS double), NULL) AS salary_max",
        "CASE WHEN value > 200 THEN NULL WHEN country IN ('gb', 'us') AND u % 4 = 0 THEN '1' ELSE '0' END"
        " AS salary_is_predicted",
        "CASE u % 3 WHEN 0 THEN 'permanent' WHEN 1 THEN 'contract' END AS contract_type",
        "CASE (u + (dd - 1) div 15) % 3 WHEN 0 THEN 'full_time' WHEN 1 THEN 'part_time' END AS contract_time",
        "concat(country, ', ', cast(u % 4 AS string)) AS location_display_name",
        "CASE country WHEN 'gb' THEN if(u % 4 = 0, 'London', 'South East')"
        " WHEN 'ca' THEN if(u % 4 = 1, 'Ontario', 'British Columbia')"
        " ELSE concat(country, ' region') END AS location_region",
        "CASE WHEN country = 'gb' THEN if(u % 4 = 0, 'Soho', 'Reading')"
        " WHEN country = 'ca' THEN if(u % 4 = 1, 'Toronto Downtown', 'Vancouver')"
        " WHEN u % 7 <> 2 THEN concat(country, ' city ', cast(u % 4 AS string)) END AS location_city",
        "cast(u % 90 AS double) AS latitude",
        "cast(u % 180 AS double) AS longitude",
        "concat('https://jobs.example/', cast(u AS string)) AS redirect_url",
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows as page envelopes: a page holds the events of one block of 50 event ids.

    Event ids are unique, so no page can hold more than 50 ads.
    """
    ad = F.to_json(F.struct(
        F.col("source_id").cast("bigint").alias("id"),
        "title",
        "description",
        F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
        F.struct(F.col("company_name").alias("display_name")).alias("company"),
        F.struct(
            F.col("location_display_name").alias("display_name"),
            F.array_compact(F.array("country", "location_region", "location_city")).alias("area"),
        ).alias("location"),
        F.struct(F.lit("it-jobs").alias("tag"), F.lit("IT Jobs").alias("label")).alias("category"),
        "latitude", "longitude", "salary_min", "salary_max", "salary_is_predicted",
        "contract_type", "contract_time", "redirect_url",
    ))
    held = (
        raw_rows(spark, sf_dir, "1 + event_id div 50")
        .groupBy("source_file", "run_date", "country", "role_query", "page")
        .agg(F.collect_list(ad).alias("ads"), F.max("extracted_at").alias("at"))
    )
    return held.select(
        F.struct(
            F.lit("events").alias("source"),
            F.col("run_date").cast("string").alias("run_date"),
            F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("extracted_at"),
            "country",
            "role_query",
            "page",
            F.lit(50).alias("results_per_page"),
            F.lit(2).alias("max_days_old"),
            F.size("ads").alias("count_reported"),
            F.create_map(
                F.lit("X-RateLimit-Limit"), F.lit("300"), F.lit("X-Ratelimit-Remaining"), (300 - F.col("page") - F.size("ads")).cast("string"),
                F.lit("Server"), F.lit("x"),
            ).alias("response_headers"),
        ).alias("_meta"),
        F.struct(
            F.size("ads").alias("count"),
            F.col("ads").alias("results"),
        ).alias("payload"),
        "source_file",
    )


def pages(rows: DataFrame) -> DataFrame:
    """Page counts of the raw rows; on some days the source promised five ads more than it gave."""
    page = rows.groupBy("run_date", "country", "role_query", "page").agg(F.count("*").alias("n"))
    promised = page.groupBy("run_date", "country", "role_query").agg(F.sum("n").alias("held"))
    position = F.array_position(F.array(*[F.lit(c) for c in COUNTRIES]), F.col("country")) - 1
    short = (position + F.dayofmonth("run_date")) % 7 == 0
    return page.join(promised, ["run_date", "country", "role_query"]).select(
        "run_date",
        "country",
        "role_query",
        "page",
        "n",
        (F.col("held") + F.when(short, 5).otherwise(0)).alias("count_reported"),
    )
