"""The landing folder: page envelopes, pair ledgers, newline-delimited rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings import fixed
from postings.functions import city_of, region_of, stripped_or_null

CORRUPT = "_unparsed"

def read_pages(spark: SparkSession, folder: str, *days: str) -> DataFrame:
    """Page envelopes, one document per file, with their file name.

    The schema is explicit, so nothing is inferred; small files are packed
    into scan tasks by Spark. ``days`` restrict the listing to their files.
    A file that is no JSON document, or has no metadata of its page, is kept as a row marked ``unreadable``.
    """
    pages = _documents(spark, folder, fixed.ENVELOPE_SCHEMA, _names("raw", "_*", days))
    return pages.select(
        "_meta", "payload", F.col("_metadata.file_name").alias("source_file"), _unreadable("_meta").alias("unreadable")
    )


def read_ledger(spark: SparkSession, folder: str, *days: str) -> DataFrame:
    """Ledgers, one per day; one that is no JSON document is a row marked ``unreadable`` with the day of its file name."""
    ledger = _documents(spark, folder, fixed.LEDGER_SCHEMA, _names("status", "", days))
    return ledger.withColumn("unreadable", _unreadable("run_date")).withColumn(
        "run_date", F.when(F.col("unreadable"), _day_of(F.col("_metadata.file_name"))).otherwise(F.col("run_date"))
    ).drop(CORRUPT)


def _names(kind: str, rest: str, days: tuple[str, ...]) -> str:
    """Glob over the landed file names of a kind, for all days or the given ones."""
    of_days = "{" + ",".join(days) + "}" + rest if days else "*"
    return f"{kind}_{of_days}.json"


def _documents(spark: SparkSession, folder: str, schema: str, names: str) -> DataFrame:
    reader = spark.read.schema(f"{schema}, {CORRUPT} STRING").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("multiLine", True).option("pathGlobFilter", names).json(folder)


def _unreadable(needed: str) -> Column:
    return F.col(CORRUPT).isNotNull() | F.col(needed).isNull()


def _day_of(file_name: Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, r"_(\d{4}-\d{2}-\d{2})[_.]", 1), F.lit(""))


def unreadable_files(pages: DataFrame, ledger: DataFrame) -> DataFrame:
    """One problem row per unreadable page file or ledger: its day and file name; day problems take these as they are."""
    bad_pages = pages.where("unreadable").select(
        _day_of(F.col("source_file")).try_cast("date").alias("run_date"), F.col("source_file").alias("pair"),
        F.lit(fixed.UNREADABLE).alias("problem"), F.lit(fixed.FROM_PAGES).alias("evidence"))
    bad_ledgers = ledger.where("unreadable").select(
        F.col("run_date").try_cast("date").alias("run_date"), F.lit(None).cast("string").alias("pair"),
        F.lit(fixed.UNREADABLE).alias("problem"), F.lit(fixed.FROM_LEDGER).alias("evidence"))
    return bad_pages.unionByName(bad_ledgers)


def ledger_days(ledger: DataFrame) -> DataFrame:
    return ledger.select(F.to_date("run_date").alias("run_date"))


def expected_pairs(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        F.to_date("run_date").alias("run_date"), F.explode("expected_pairs").alias("pair")
    ).distinct()


def pair_states(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        F.to_date("run_date").alias("run_date"), F.explode("pairs").alias("pair", "s")
    ).select("run_date", "pair", "s.*")


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per ad occurrence in the raw layout; pages without results give none.

    Ads keep arriving with missing and extra keys, so the scan hands each over
    as its own JSON text. That text is kept as it came, and the known fields are
    parsed from it in one step: a missing key, or a value of another kind, is NULL.
    """
    ads = pages.select(
        "source_file", "_meta", F.explode("payload.results").alias("vacancy_json")
    )
    rows = ads.withColumn("a", F.from_json("vacancy_json", fixed.AD_TYPE)).withColumn("area", F.coalesce("a.location.area", F.array().cast("array<string>")))
    return rows.select(
        "source_file",
        F.col("_meta.run_date").cast("date").alias("run_date"),
        F.col("_meta.extracted_at").try_cast("timestamp").alias("extracted_at"),
        "_meta.country",
        "_meta.role_query",
        "_meta.page",
        "_meta.results_per_page",
        "_meta.max_days_old",
        "_meta.count_reported",
        F.col("a.id").alias("source_id"),
        "a.title",
        "a.description",
        F.col("a.created").try_cast("timestamp").alias("posted_at"),
        stripped_or_null("a.company.display_name").alias("company_name"),
        F.col("a.salary_min").try_cast("double").alias("salary_min"),
        F.col("a.salary_max").try_cast("double").alias("salary_max"),
        "a.salary_is_predicted",
        "a.contract_type",
        "a.contract_time",
        F.col("a.location.display_name").alias("location_display_name"),
        region_of("area").alias("location_region"),
        city_of("area").alias("location_city"),
        F.to_json("area").alias("location_area_json"),
        F.col("a.latitude").try_cast("double").alias("latitude"),
        F.col("a.longitude").try_cast("double").alias("longitude"),
        F.col("a.category.tag").alias("category_tag"),
        F.col("a.category.label").alias("category_label"),
        "a.redirect_url",
        "vacancy_json",
    )


def page_counts(pages: DataFrame, *more: str) -> DataFrame:
    """One row per page with the number of ads on it, for the completeness rules, and ``more`` of its columns."""
    found = F.coalesce(F.size("payload.results"), F.lit(0))
    return pages.select(
        F.to_date("_meta.run_date").alias("run_date"),
        F.col("_meta.country").alias("country"),
        F.col("_meta.role_query").alias("role_query"),
        F.col("_meta.page").alias("page"),
        F.greatest(found, F.lit(0)).alias("n"),
        F.col("_meta.count_reported").alias("count_reported"),
        *more,
    )


def write_rows(rows: DataFrame, folder: str) -> None:
    """Export raw rows as newline-delimited JSON, timestamps with all their digits."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(folder)


def read_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Newline-delimited rows back, with the raw layout and no inference."""
    return spark.read.schema(fixed.RAW_SCHEMA).json(folder)
