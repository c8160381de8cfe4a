"""Values that have to be exactly these for the results to be right.

Everything here is data, not logic: limits of the collector, file and ledger
formats, title patterns, the two static dimensions, and the column layout of
the raw table.
"""

from pyspark.sql import types as T

# --- fixed values: collection grid and limits --------------------------------
COUNTRIES = ["gb", "de", "nl", "pl", "us", "ca"]
QUERIES = [
    "data engineer",
    "analytics engineer",
    "data analyst",
    "data scientist",
    "ml engineer",
]
PAGE_SIZE = 50
MAX_PAGES = 150

# --- fixed values: ledger states and problem texts ----------------------------
COMPLETE = "complete"
FAILED = "failed"
TRUNCATED = "truncated"
NOT_COLLECTED = "not collected"
INCOMPLETE_BY_FILES = "incomplete by files"
UNREADABLE = "unreadable"
FROM_LEDGER = "status file"
FROM_PAGES = "raw files, no status file"

# Landed file names: raw_<day>_<country>_<query with dashes>_p<page>.json, status_<day>.json

# --- fixed values: title and text patterns, first matching rule wins ----------
ROLE_RULES = [
    ("analytics_engineer", ["%analytics engineer%"]),
    ("ml_engineer", ["%machine learning engineer%", "%ml engineer%", "%mlops%"]),
    ("data_scientist", ["%data scientist%", "%datenwissenschaftler%"]),
    ("data_engineer", ["%data engineer%", "%data engineering%", "%dateningenieur%"]),
    (
        "data_analyst",
        [
            "%data analyst%",
            "%data analytics%",
            "%data quality%",
            "%data governance%",
            "%datenanalyst%",
            "%data analist%",
        ],
    ),
]
NO_ROLE = "other"

GRADE_RULES = [
    (
        "intern",
        [
            "%intern%",
            "%internship%",
            "%werkstudent%",
            "%working student%",
            "%graduate%",
            "%apprentice%",
            "%trainee%",
        ],
    ),
    ("junior", ["%junior%", "%jr.%", "% jr %", "jr %"]),
    (
        "lead",
        [
            "%principal%",
            "%staff %",
            "staff %",
            "% lead%",
            "lead %",
            "%head of%",
            "%director%",
            "%manager%",
        ],
    ),
    ("senior", ["%senior%", "%sr.%", "% sr %"]),
]
NO_GRADE = "mid"

WORK_MODE_RULES = [
    ("hybrid", ["%hybrid%"]),
    ("remote", ["%remote%", "%work from home%", "%wfh%", "%home office%"]),
]
NO_WORK_MODE = "unknown"
REMOTE_MODES = ["remote", "hybrid"]

TECHNOLOGIES = [
    "python", "sql", "spark", "airflow", "dbt", "aws", "azure",
    "gcp", "kafka", "snowflake", "docker", "kubernetes", "tableau", "power bi",
]
QUOTA_WORDS = ["limit", "quota", "remain", "ratelimit"]

# --- fixed values: static dimensions -------------------------------------------
# country_code, country_name, currency, salary_charts
COUNTRY_ROWS = [
    ("gb", "United Kingdom", "GBP", 1),
    ("de", "Germany", "EUR", 0),
    ("nl", "Netherlands", "EUR", 0),
    ("pl", "Poland", "PLN", 0),
    ("us", "United States", "USD", 1),
    ("ca", "Canada", "CAD", 0),
]
# role_key, role_name, priority
ROLE_ROWS = [
    ("analytics_engineer", "analytics engineer", 1),
    ("ml_engineer", "ml engineer", 2),
    ("data_scientist", "data scientist", 3),
    ("data_engineer", "data engineer", 4),
    ("data_analyst", "data analyst", 5),
    ("other", "other", 9),
]
GRADES = ["intern", "junior", "mid", "senior", "lead"]
WORK_MODES = ["hybrid", "remote", "unknown"]

# --- fixed values: characters stripped by the two trims ------------------------
# space separators (Unicode category Zs), as stripped from titles
SPACE_SEPARATORS = (
    " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
# all white space, as stripped from company names
WHITE_SPACE = "\t\n\u000b\f\r\u001c\u001d\u001e\u001f\u0085\u2028\u2029" + SPACE_SEPARATORS

# --- fixed values: layouts -------------------------------------------------------
ENVELOPE_SCHEMA = """
    _meta STRUCT<
        source: STRING, run_date: STRING, extracted_at: STRING, country: STRING,
        role_query: STRING, page: INT, results_per_page: INT, max_days_old: INT,
        count_reported: INT, request_url: STRING,
        response_headers: MAP<STRING, STRING>>,
    payload STRUCT<count: INT, results: ARRAY<STRING>>
"""

AD_TYPE = """STRUCT<
    id: STRING, title: STRING, description: STRING, created: STRING,
    company: STRUCT<display_name: STRING>,
    category: STRUCT<tag: STRING, label: STRING>,
    location: STRUCT<display_name: STRING, area: ARRAY<STRING>>,
    latitude: STRING, longitude: STRING,
    salary_min: STRING, salary_max: STRING, salary_is_predicted: STRING,
    contract_type: STRING, contract_time: STRING, redirect_url: STRING>"""

LEDGER_SCHEMA = """
    run_date STRING, updated_at STRING, expected_pairs ARRAY<STRING>,
    pairs MAP<STRING, STRUCT<
        status: STRING, pages: INT, collected: INT, count_reported: INT,
        finished_at: STRING>>
"""

RAW_COLUMNS = [
    ("source_file", T.StringType()),
    ("run_date", T.DateType()),
    ("extracted_at", T.TimestampType()),
    ("country", T.StringType()),
    ("role_query", T.StringType()),
    ("page", T.IntegerType()),
    ("results_per_page", T.IntegerType()),
    ("max_days_old", T.IntegerType()),
    ("count_reported", T.IntegerType()),
    ("source_id", T.StringType()),
    ("title", T.StringType()),
    ("description", T.StringType()),
    ("posted_at", T.TimestampType()),
    ("company_name", T.StringType()),
    ("salary_min", T.DoubleType()),
    ("salary_max", T.DoubleType()),
    ("salary_is_predicted", T.StringType()),
    ("contract_type", T.StringType()),
    ("contract_time", T.StringType()),
    ("location_display_name", T.StringType()),
    ("location_region", T.StringType()),
    ("location_city", T.StringType()),
    ("location_area_json", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("category_tag", T.StringType()),
    ("category_label", T.StringType()),
    ("redirect_url", T.StringType()),
    ("vacancy_json", T.StringType()),
]
RAW_SCHEMA = T.StructType([T.StructField(n, t) for n, t in RAW_COLUMNS])
