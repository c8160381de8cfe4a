"""The registered queries: every one runs library plans over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings import fixed
from postings.functions import city_group, company_key, location_key, page_file_name, pair_key, role_slug
from postings.operators import gate, presence, spells, state
from postings.operators.bitmaps import dense_numbers
from postings.operators.quantiles import DISCRETE, quantiles
from postings.operators.sizing import fetched
from postings.operators.snapshot import latest_day
from postings.plans import checks, dashboard, gold, reports, silver
from postings.sources import landing, publication, warehouse
from postings.sources.warehouse import stored
from verification.observations import envelopes, pages, raw_rows, table

# the events name their own five search queries, and their pages count as full with six rows
EVENT_QUERIES = ["signup", "click", "view", "error", "purchase"]
EVENT_PAGE_SIZE = 6
# the documents are invented prose without any technology; some of these occur in them, one does not
DOCUMENT_TERMS = ["license", "mit ", "und ", "tion", "the ", "kubernetes"]


class Layers:
    """The layers over the events of one directory, each built from the one below on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @property
    def raw(self) -> DataFrame:
        return raw_rows(self.spark, self.sf_dir)

    @property
    def staged(self) -> DataFrame:
        return silver.stage(self.raw)

    @property
    def deduped(self) -> DataFrame:
        return silver.deduped(self.staged)

    @property
    def ads(self) -> DataFrame:
        return silver.enriched(self.deduped)

    @property
    def coverage(self) -> DataFrame:
        return silver.coverage(self.staged)

    @property
    def daily(self) -> DataFrame:
        return silver.daily(self.ads, self.coverage)

    @property
    def facts(self) -> DataFrame:
        return gold.fact(self.ads, self.coverage)

    @property
    def versions(self) -> DataFrame:
        return gold.dim_vacancy(self.ads)

    @property
    def countries(self) -> DataFrame:
        return gold.dim_country(self.spark)

    @property
    def roles(self) -> DataFrame:
        return gold.dim_role(self.spark)

    # plans that read a layer several times read it stored, as the daily job does

    @cached_property
    def stored_ads(self) -> DataFrame:
        return stored(self.ads)

    @cached_property
    def stored_facts(self) -> DataFrame:
        return stored(self.facts)

    @property
    def stored_bi(self) -> DataFrame:
        return gold.bi_table(self.stored_facts, self.countries, self.roles)

    @property
    def bi(self) -> DataFrame:
        return gold.bi_table(self.facts, self.countries, self.roles)

    # the collection side: pages, and a ledger kept on even days only

    @cached_property
    def pages(self) -> DataFrame:
        return stored(pages(self.raw))

    @property
    def by_pages(self) -> DataFrame:
        return gate.pair_completeness(self.pages, page_size=EVENT_PAGE_SIZE)

    @property
    def days(self) -> DataFrame:
        return self.raw.select("run_date").distinct()

    @property
    def expected(self) -> DataFrame:
        return gate.expected_grid(self.days, fixed.COUNTRIES, EVENT_QUERIES)

    @property
    def ledger_expected(self) -> DataFrame:
        return self.expected.where(F.dayofmonth("run_date") % 2 == 0)

    @property
    def states(self) -> DataFrame:
        """Ledger entries as collected, each recorded twice: first as failed, then with its result."""
        recorded = self.by_pages.where(F.dayofmonth("run_date") % 2 == 0)
        attempts = F.array(
            F.struct(F.lit(fixed.FAILED).alias("status"), F.lit("T01").alias("finished_at")),
            F.struct(F.col("status"), F.lit("T02").alias("finished_at")),
        )
        return recorded.select(
            "run_date", "pair", F.explode(attempts).alias("a"), "pages", "collected", "count_reported"
        ).select("run_date", "pair", "a.status", "pages", "collected", "count_reported", "a.finished_at")

    @property
    def problems(self) -> DataFrame:
        return gate.day_problems(
            self.pages, self.ledger_expected, self.states, page_size=EVENT_PAGE_SIZE
        )


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: zoneless(build(Layers(spark, sf_dir)))
    return build


def zoneless(df: DataFrame) -> DataFrame:
    """UTC timestamps as plain wall-clock values, the kind the given tables and the SQL twins hold."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
        for f in df.schema
    ])


# --- landing and gate ----------------------------------------------------------------

@query
def flatten_pages(x: Layers) -> DataFrame:
    # the JSON text of an ad has no fixed spelling, so it is compared by its id
    flat = landing.flatten_pages(envelopes(x.spark, x.sf_dir))
    id_in_text = F.get_json_object("vacancy_json", "$.id").alias("id_in_text")
    return flat.select(*[c for c in flat.columns if c != "vacancy_json"], id_in_text)


@query
def quota_headers(x: Layers) -> DataFrame:
    return reports.quota_headers(envelopes(x.spark, x.sf_dir))


@query
def expected_pairs(x: Layers) -> DataFrame:
    return x.expected


@query
def pair_completeness(x: Layers) -> DataFrame:
    return x.by_pages


@query
def ledger_states(x: Layers) -> DataFrame:
    return gate.last_results(x.states)


@query
def day_problems(x: Layers) -> DataFrame:
    return x.problems


@query
def gated_rows(x: Layers) -> DataFrame:
    admitted = gate.admit(x.raw, x.problems)
    return admitted.groupBy("run_date", "country", "role_query").agg(F.count("*").alias("n"))


@query
def load_summary(x: Layers) -> DataFrame:
    found = gate.load_summary(gate.admit(x.raw, x.problems))
    return found.withColumn("days", F.array_join("days", ","))


@query
def recollect_list(x: Layers) -> DataFrame:
    known = gate.with_states_from_pages(x.states, x.by_pages)
    return gate.to_collect_again(x.expected, known).select("run_date", "pair")


@query
def recollect_missing_pages(x: Layers) -> DataFrame:
    """As if the page files of one search query were gone."""
    known = gate.with_states_from_pages(x.states, x.by_pages)
    return gate.to_collect_again(x.expected, known, x.by_pages.where("role_query <> 'click'")).select("run_date", "pair")


@query
def run_totals(x: Layers) -> DataFrame:
    return gate.run_totals(x.states)


@query
def incomplete_pairs(x: Layers) -> DataFrame:
    return gate.incomplete_pairs(x.states)


@query
def latest_day_rows(x: Layers) -> DataFrame:
    from postings.operators.snapshot import latest

    return latest(x.raw, "run_date").groupBy("run_date", "country").agg(F.count("*").alias("n"))


# --- staging and classification --------------------------------------------------------

@query
def stage_filter(x: Layers) -> DataFrame:
    return x.staged


@query
def dedup_observations(x: Layers) -> DataFrame:
    return x.deduped


@query
def dedup_two_phase(x: Layers) -> DataFrame:
    return silver.deduped(x.staged, in_two=True)


@query
def classify_role(x: Layers) -> DataFrame:
    return x.ads.groupBy("title", "role_key", "is_relevant").agg(F.count("*").alias("n"))


@query
def classify_grade(x: Layers) -> DataFrame:
    return x.ads.groupBy("title", "grade").agg(F.count("*").alias("n"))


@query
def classify_mode(x: Layers) -> DataFrame:
    by = ["title", "description", "remote_type", "is_remote"]
    return x.ads.groupBy(*by).agg(F.count("*").alias("n"))


@query
def city_groups(x: Layers) -> DataFrame:
    grouped = x.ads.select("country_code", "location_region", "location_city", city_group().alias("city_group"))
    return grouped.groupBy(*grouped.columns).agg(F.count("*").alias("n"))


@query
def surrogate_keys(x: Layers) -> DataFrame:
    return x.ads.select(
        "source_id", "observed_on", "position_id",
        company_key().alias("company_sk"), location_key().alias("location_sk"),
        pair_key("country_code", "role_key").alias("pair"),
        page_file_name("observed_on", "country_code", "role_key", F.lit(1)).alias("file_name"),
    )


# --- presence, history, fact -----------------------------------------------------------

@query
def day_sequence(x: Layers) -> DataFrame:
    return presence.day_sequence(x.staged, "observed_on")


@query
def first_seen(x: Layers) -> DataFrame:
    return presence.first_seen(x.staged, "source_id", "observed_on")


@query
def gone_rows(x: Layers) -> DataFrame:
    gone = presence.gone_rows(x.ads, "source_id", "observed_on", "country_code", x.coverage)
    return gone.select(
        "source_id", "observed_on", "country_code", "title", "role_key", "position_id",
        "first_seen_on", "last_present_on",
    )


@query
def gone_rows_by_join(x: Layers) -> DataFrame:
    gone = presence.gone_rows_by_join(x.ads, "source_id", "observed_on", "country_code")
    return gone.select(
        "source_id", "observed_on", "country_code", "title", "role_key", "position_id",
        "first_seen_on", "last_present_on",
    )


@query
def presence_spells(x: Layers) -> DataFrame:
    """Spells that close after two covered days of absence, holes of their country passed over."""
    return spells.spells(x.stored_ads, "source_id", "observed_on", "country_code", absent_days=2, over_holes=True)


@query
def spells_closed_next_day(x: Layers) -> DataFrame:
    """By the default rule the closed spells are the gone rows."""
    found = spells.spells(x.stored_ads, "source_id", "observed_on", "country_code").where("closed_on IS NOT NULL")
    return found.select("source_id", F.col("closed_on").alias("observed_on"), "country_code", "last_present_on")


@query
def daily_status(x: Layers) -> DataFrame:
    return x.daily


@query
def scd2_history(x: Layers) -> DataFrame:
    return x.versions


@query
def fact(x: Layers) -> DataFrame:
    return x.facts


def _by_days(x: Layers) -> tuple[DataFrame, DataFrame]:
    """(fact, state rows): all days but the last three in one pass, those three one after the other from the state before them."""
    ads, keys = x.stored_ads, (silver.KEY, silver.DAY, silver.VERSIONED)
    days = sorted(r[0] for r in fetched(ads.select(silver.DAY).distinct(), "days"))
    head = ads.where(F.col(silver.DAY) < F.lit(days[-3]))
    facts, known = stored(gold.fact(head)), stored(state.states(head, *keys))
    for before, day in zip(days[-4:], days[-3:]):
        today = ads.where(F.col(silver.DAY) == F.lit(day))
        rows = stored(state.advanced(today, state.before(known, *keys, day), *keys))
        yesterday = facts.where(F.col(silver.DAY) == F.lit(before))
        facts, known = facts.union(stored(gold.fact_of_day(today, rows, yesterday))), known.union(rows)
    return facts, known


@query
def fact_by_days(x: Layers) -> DataFrame:
    return _by_days(x)[0]


@query
def history_by_days(x: Layers) -> DataFrame:
    known, keys = _by_days(x)[1], (silver.KEY, silver.DAY, silver.VERSIONED)
    ended = state.closed_versions(known, *keys, "vacancy_sk")
    return ended.union(state.open_versions(state.before(known, *keys), silver.KEY, silver.VERSIONED, "vacancy_sk"))


@query
def asof_fact(x: Layers) -> DataFrame:
    return gold.fact_by_join(silver.daily(x.stored_ads), gold.dim_vacancy(x.stored_ads))


@query
def merged_fact(x: Layers) -> DataFrame:
    return gold.fact_by_join(silver.daily(x.stored_ads), gold.dim_vacancy(x.stored_ads), merge=True)


# --- dimensions --------------------------------------------------------------------------

@query
def dim_company(x: Layers) -> DataFrame:
    return gold.dim_company(x.ads)


@query
def dim_location(x: Layers) -> DataFrame:
    return gold.dim_location(x.ads)


@query
def dim_date(x: Layers) -> DataFrame:
    return gold.dim_date(x.staged)


@query
def dim_static(x: Layers) -> DataFrame:
    """Ads per entry of the two static dimensions."""
    per_pair = x.ads.groupBy("country_code", "role_key").agg(F.count("*").alias("n_ads"))
    return (
        per_pair.join(F.broadcast(x.countries), "country_code")
        .join(F.broadcast(x.roles), "role_key")
        .select("country_code", "country_name", "currency", "show_salary",
                "role_key", "role_name", "priority", "n_ads")
    )


# --- marts -------------------------------------------------------------------------------

@query
def market_daily(x: Layers) -> DataFrame:
    return gold.market_daily(x.facts)


@query
def salary_daily(x: Layers) -> DataFrame:
    return gold.salary_daily(x.facts, x.countries)


@query
def salary_approx(x: Layers) -> DataFrame:
    """Per group, whether the approximate quantiles lie between the exact ones a hundredth to either side."""
    wanted = {"salary_mid_p50": ("salary_mid", 0.5), "salary_mid_p25": ("salary_mid", 0.25), "salary_mid_p75": ("salary_mid", 0.75),
              "salary_min_p50": ("salary_min", 0.5), "salary_max_p50": ("salary_max", 0.5)}
    facts = x.stored_facts
    sides = {f"{n}_{s}": (c, p + d, DISCRETE) for n, (c, p) in wanted.items() for s, d in (("low", -0.01), ("high", 0.01))}
    bounds = quantiles(gold.charted_salaries(facts, x.countries), gold.SALARY_GROUP, sides)
    # a group without any value of a kind has no quantile of it on either side
    inside = [F.coalesce(F.col(n).between(F.col(f"{n}_low"), F.col(f"{n}_high")), F.col(n).isNull() & F.col(f"{n}_low").isNull()) for n in wanted]
    d = gold.salary_daily(facts, x.countries, approx=True).join(bounds, gold.SALARY_GROUP)
    return d.select(*gold.SALARY_GROUP, "n_disclosed", reduce(and_, inside).alias("inside"))


@query
def salary_sketched(x: Layers) -> DataFrame:
    """Weeks of countries and roles from the sketches of their days."""
    found = stored(gold.salary_sketches(x.facts, x.countries)).withColumn("week", F.to_date(F.date_trunc("week", "observed_on")))
    return gold.salary_of_sketches(found, ["week", "country_code", "role_key", "currency"])


@query
def salary_disclosure(x: Layers) -> DataFrame:
    return reports.disclosure_share(gold.salary_disclosure(x.facts))


@query
def company_role_latest(x: Layers) -> DataFrame:
    return gold.company_role(x.stored_facts)


@query
def city_daily(x: Layers) -> DataFrame:
    return gold.city_daily(x.facts)


@query
def qa_unmatched(x: Layers) -> DataFrame:
    return gold.unmatched_titles(x.ads)


@query
def top_unmatched(x: Layers) -> DataFrame:
    return reports.top_unmatched(gold.unmatched_titles(x.ads))


@query
def bi_flat(x: Layers) -> DataFrame:
    return x.bi


# --- reports and audits --------------------------------------------------------------------

@query
def market_rollup(x: Layers) -> DataFrame:
    return reports.market_summary(gold.market_daily(x.facts))


@query
def salary_medians(x: Layers) -> DataFrame:
    return reports.salary_medians(gold.salary_daily(x.facts, x.countries))


@query
def volume_vs_reported(x: Layers) -> DataFrame:
    return reports.volume(x.raw, x.pages)


@query
def duplicate_rate(x: Layers) -> DataFrame:
    return reports.duplicates(x.raw)


@query
def overlap_histogram(x: Layers) -> DataFrame:
    return reports.overlap(x.raw)


def _latest_profile(x: Layers) -> dict[str, DataFrame]:
    return reports.profile(x.raw, envelopes(x.spark, x.sf_dir), x.pages)


@query
def profile_volume(x: Layers) -> DataFrame:
    return _latest_profile(x)["volume"]


@query
def profile_duplicates(x: Layers) -> DataFrame:
    return _latest_profile(x)["duplicates"]


@query
def profile_salary_fields(x: Layers) -> DataFrame:
    return _latest_profile(x)["salary_fields"]


@query
def salary_fields(x: Layers) -> DataFrame:
    return reports.salary_fields(x.raw)


@query
def repeat_positions(x: Layers) -> DataFrame:
    return reports.repeated_positions(x.raw)


@query
def repeat_share(x: Layers) -> DataFrame:
    return reports.repeated_share(x.raw)


@query
def top_titles(x: Layers) -> DataFrame:
    return reports.top_titles(x.raw)


@query
def keyword_coverage(x: Layers) -> DataFrame:
    return reports.term_coverage(table(x.spark, x.sf_dir, "documents"), "text", DOCUMENT_TERMS)


@query
def keyword_coverage_ads(x: Layers) -> DataFrame:
    return reports.term_coverage(x.raw, "description")


@query
def layer_counts(x: Layers) -> DataFrame:
    return reports.layer_counts(x.raw, x.staged, x.ads)


@query
def age_audit(x: Layers) -> DataFrame:
    return reports.age_audit(x.staged)


@query
def clock_audit(x: Layers) -> DataFrame:
    return reports.clock_audit(x.staged)


@query
def id_stability(x: Layers) -> DataFrame:
    return reports.id_stability(x.ads)


@query
def reappeared(x: Layers) -> DataFrame:
    return reports.reappeared(x.daily)


@query
def volume_anomaly(x: Layers) -> DataFrame:
    return reports.volume_anomalies(x.staged)


@query
def dq_results(x: Layers) -> DataFrame:
    ads = x.stored_ads
    facts = stored(gold.fact(ads))
    return checks.run(
        x.staged, ads, facts, gold.dim_vacancy(ads), gold.dim_company(ads), x.countries, x.roles
    )


# --- dashboard -------------------------------------------------------------------------------

@query
def kpi(x: Layers) -> DataFrame:
    return dashboard.kpi(x.bi)


@query
def kpi_by_country(x: Layers) -> DataFrame:
    return dashboard.kpi(x.bi.where(F.col("contract_type") == "permanent"), ["country_name"])


def _tiles(x: Layers) -> DataFrame:
    bi = stored(x.stored_bi)
    return dashboard.tile_bitmaps(bi, dense_numbers(bi, "source_id"), dense_numbers(bi, "position_id"))


@query
def kpi_tiles(x: Layers) -> DataFrame:
    return dashboard.kpi_of_tiles(_tiles(x))


@query
def kpi_tiles_by_week(x: Layers) -> DataFrame:
    """Weeks of countries from the bitmaps of days and roles."""
    weeks = _tiles(x).withColumn("week", F.to_date(F.date_trunc("week", "observed_on")))
    return dashboard.kpi_of_tiles(weeks, ["week", "country_code"])


@query
def composition(x: Layers) -> DataFrame:
    return dashboard.contract_by_grade(x.bi)


@query
def composition_mode(x: Layers) -> DataFrame:
    return dashboard.time_by_work_mode(x.bi)


@query
def trend(x: Layers) -> DataFrame:
    return dashboard.trend(x.bi)


@query
def city_table(x: Layers) -> DataFrame:
    return dashboard.cities(x.bi)


@query
def salary_matrix(x: Layers) -> DataFrame:
    return dashboard.salary_matrix(x.bi)


@query
def salary_matrix_by_day(x: Layers) -> DataFrame:
    return dashboard.salary_matrix(x.bi, by_day=True)


@query
def company_life(x: Layers) -> DataFrame:
    return dashboard.company_life(x.stored_bi)


@query
def week_growth(x: Layers) -> DataFrame:
    return dashboard.week_growth(x.bi, days_of=x.staged)


@query
def longest_open(x: Layers) -> DataFrame:
    return dashboard.longest_open(x.bi, days_of=x.staged)


@query
def latest_day_of(x: Layers) -> DataFrame:
    return latest_day(x.staged, "observed_on")


# --- round trips: written, replaced and read back below the shared folder --------------------

def _raw_layout(rows: DataFrame) -> DataFrame:
    """The observations in the whole layout of the raw table; what they do not hold is NULL."""
    return rows.select(*[(F.col(n) if n in rows.columns else F.lit(None)).cast(t).alias(n) for n, t in fixed.RAW_COLUMNS])


@query
def ndjson_round_trip(x: Layers) -> DataFrame:
    folder = warehouse.scratch_folder(x.spark)
    landing.write_rows(_raw_layout(x.raw), folder)
    return landing.read_rows(x.spark, folder).select(*x.raw.columns)


@query
def replaced_days(x: Layers) -> DataFrame:
    """All days loaded, then the first ten days loaded again with their first pages only, twice."""
    table = f"{warehouse.scratch_database(x.spark)}.rows"
    warehouse.create_raw_table(x.spark, table)
    rows = _raw_layout(x.raw)
    warehouse.replace_days(rows, table)
    for _ in range(2):
        warehouse.replace_days(rows.where((F.dayofmonth("run_date") <= 10) & (F.col("page") == 1)), table)
    return x.spark.table(table).select(*x.raw.columns)


@query
def repartitioned_table(x: Layers) -> DataFrame:
    """An unpartitioned raw table is rebuilt by day with its rows; doing so again changes nothing."""
    table = f"{warehouse.scratch_database(x.spark)}.rows"
    _raw_layout(x.raw).write.saveAsTable(table)
    rebuilt = [warehouse.ensure_partitioned(x.spark, table) for _ in range(2)]
    found = x.spark.table(table).groupBy("run_date").agg(F.count("*").alias("n"))
    state = f"{rebuilt}, by day: {warehouse.is_partitioned(x.spark, table)}"
    return found.withColumn("state", F.lit(state))


@query
def layer_tables(x: Layers) -> DataFrame:
    """A mart as a table by day, from a staging view and a stored layer."""
    base = warehouse.scratch_database(x.spark)
    warehouse.save_view(x.staged, f"{base}_stg")
    ads = warehouse.save_table(silver.present(x.spark.table(f"{base}_stg")), f"{base}.ads", "observed_on")
    facts = warehouse.save_table(gold.fact(ads), f"{base}.facts", "observed_on")
    return warehouse.save_table(gold.market_daily(facts), f"{base}.market", "observed_on")


@query
def published_versions(x: Layers) -> DataFrame:
    """Market mart published with the first half of each month, then whole: both versions can still be read."""
    base = warehouse.scratch_database(x.spark)
    root, table = warehouse.scratch_folder(x.spark), f"{base}.market"
    market = gold.market_daily(x.stored_facts)
    warehouse.save_table(market.where(F.dayofmonth("observed_on") <= 15), table, "observed_on")
    publication.publish(x.spark, root, table)
    warehouse.replace_days(market.where(F.dayofmonth("observed_on") > 15), table, "observed_on")
    publication.publish(x.spark, root, table)
    both = [publication.read(x.spark, root, "market", v).withColumn("version", F.lit(v)) for v in publication.versions(x.spark, root)]
    return both[0].unionByName(both[1])


@query
def row_counts(x: Layers) -> DataFrame:
    base = warehouse.scratch_database(x.spark)
    warehouse.save_table(x.raw, f"{base}.raw", "run_date")
    warehouse.save_table(x.staged, f"{base}.staged")
    counts = [(name, warehouse.row_count(x.spark, f"{base}.{name}")) for name in ("raw", "staged")]
    return x.spark.createDataFrame(counts, "layer string, n_rows long")


@query
def ledger_grows(x: Layers) -> DataFrame:
    """Pairs noted on even days, then every third day's added; a pair noted before is not added again."""
    every_third = x.expected.where(F.dayofmonth("run_date") % 3 == 0)
    return gate.with_expected(gate.with_expected(x.ledger_expected, every_third), every_third)


@query
def pair_state(x: Layers) -> DataFrame:
    """The state of one pair of every country, looked up one by one on the second day."""
    found = [gate.state_of(x.states, "2024-01-02", c, "click").withColumn("country", F.lit(c)) for c in fixed.COUNTRIES]
    return reduce(DataFrame.union, found)


@query
def role_slugs(x: Layers) -> DataFrame:
    return x.staged.select("title", role_slug("title").alias("slug")).distinct()
