"""SQL twins of the registered queries, over the given tables, for DuckDB.

The common table expressions below restate the layers in SQL in their own way:
ordered ``first`` aggregates for the dedup, a rule table with the lowest
matching priority for the classifiers, ``NOT EXISTS`` for the gone rows,
change points for the history, and an ``ASOF`` join for the fact.
"""

from __future__ import annotations

import re

from postings import fixed
from verification.observations import AGAIN, COUNTRIES, DESCRIPTIONS, LATER, POSTED, TITLES
from verification.queries import DOCUMENT_TERMS, EVENT_PAGE_SIZE, EVENT_QUERIES


def _text_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _rows(rows) -> str:
    def cell(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def _rule_rows(rules) -> str:
    return _rows([(i, label, pattern) for i, (label, patterns) in enumerate(rules) for pattern in patterns])


def _label(rules: str, text: str, default: str) -> str:
    return (
        f"coalesce((SELECT arg_min(r.label, r.rank) FROM {rules} r "
        f"WHERE {text} LIKE r.pattern), '{default}')"
    )


ATTRS = [
    "country_code", "title", "description", "posted_at", "company_name", "salary_min", "salary_max",
    "is_salary_disclosed", "contract_type", "contract_time", "location_display_name",
    "location_region", "location_city", "latitude", "longitude", "redirect_url",
]
# the first of an ad's repeats on a day; remaining ties by the attributes, missing ones first
REPEAT_ORDER = "country_code, role_query, page, source_file, " + ", ".join(f"{a} NULLS FIRST" for a in ATTRS)


def _raw(page: str) -> str:
    return f"""
    SELECT
        'raw_' || run_date || '_' || country || '_' || replace(event_type, ' ', '-') || '_p' || pg || '.json'
            AS source_file,
        run_date, ts AS extracted_at, country, event_type AS role_query, pg AS page,
        50 * pg AS count_reported,
        CASE WHEN value >= 0.5 THEN CAST(u + {AGAIN} AS VARCHAR) END AS source_id,
        '  ' || ({_text_list(TITLES)})[1 + (u + (dd - 1) // 10) % 16] || ' ' AS title,
        ({_text_list(DESCRIPTIONS)})[CASE WHEN u % 5 < 4 THEN 1 + u % 5 END] AS description,
        CAST(({_text_list(POSTED)})[CASE WHEN (u + {LATER}) % 4 < 3 THEN 1 + (u + {LATER}) % 4 END] AS TIMESTAMP) AS posted_at,
        CASE WHEN u % 11 = 0 THEN '  ' ELSE (CASE WHEN u % 2 = 0 THEN 'Co ' ELSE 'CO ' END) || (u % 17) END
            AS company_name,
        CASE WHEN paid THEN CAST(30000 + (u % 40) * 1000 AS DOUBLE) END AS salary_min,
        CASE WHEN paid AND u % 7 <> 1 THEN CAST(40000 + (u % 40) * 1500 AS DOUBLE) END AS salary_max,
        CASE WHEN value > 200 THEN NULL
             WHEN country IN ('gb', 'us') AND u % 4 = 0 THEN '1' ELSE '0' END AS salary_is_predicted,
        CASE u % 3 WHEN 0 THEN 'permanent' WHEN 1 THEN 'contract' END AS contract_type,
        CASE (u + (dd - 1) // 15) % 3 WHEN 0 THEN 'full_time' WHEN 1 THEN 'part_time' END AS contract_time,
        country || ', ' || (u % 4) AS location_display_name,
        CASE country WHEN 'gb' THEN (CASE WHEN u % 4 = 0 THEN 'London' ELSE 'South East' END)
                     WHEN 'ca' THEN (CASE WHEN u % 4 = 1 THEN 'Ontario' ELSE 'British Columbia' END)
                     ELSE country || ' region' END AS location_region,
        CASE WHEN country = 'gb' THEN (CASE WHEN u % 4 = 0 THEN 'Soho' ELSE 'Reading' END)
             WHEN country = 'ca' THEN (CASE WHEN u % 4 = 1 THEN 'Toronto Downtown' ELSE 'Vancouver' END)
             WHEN u % 7 <> 2 THEN country || ' city ' || (u % 4) END AS location_city,
        CAST(u % 90 AS DOUBLE) AS latitude,
        CAST(u % 180 AS DOUBLE) AS longitude,
        'https://jobs.example/' || u AS redirect_url,
        u % 6 AS ci
    FROM (
        SELECT *, country IN ('gb', 'us') OR u % 5 = 0 AS paid
        FROM (
            SELECT event_type, value, ts, user_id AS u, day(ts) AS dd,
                   CASE WHEN (user_id % 6 + day(ts)) % 9 = 0 THEN CAST(ts AS DATE) + 1
                        ELSE CAST(ts AS DATE) END AS run_date,
                   ({_text_list(COUNTRIES)})[1 + user_id % 6] AS country,
                   CAST({page} AS INTEGER) AS pg
            FROM events
        )
    )"""


CTES = {
    "raw_rows": _raw("1 + event_id % 3"),
    "page_rows": _raw("1 + event_id // 50"),
    "pages": f"""
    SELECT run_date, country, role_query, page, n,
           CAST(sum(n) OVER (PARTITION BY run_date, country, role_query) AS BIGINT)
             + CASE WHEN (ci + day(run_date)) % 7 = 0 THEN 5 ELSE 0 END AS count_reported
    FROM (SELECT run_date, country, role_query, page, any_value(ci) AS ci, count(*) AS n
          FROM raw_rows GROUP BY run_date, country, role_query, page)""",
    "by_pages": f"""
    SELECT run_date, country, role_query, country || '/' || role_query AS pair,
           CASE WHEN last_n < {EVENT_PAGE_SIZE}
                  OR (last_page - 1) * {EVENT_PAGE_SIZE} + last_n >= count_reported THEN '{fixed.COMPLETE}'
                WHEN last_page >= {fixed.MAX_PAGES} THEN '{fixed.TRUNCATED}'
                ELSE '{fixed.FAILED}' END AS status,
           pages, collected, last_page, count_reported
    FROM (SELECT run_date, country, role_query, count(*) AS pages, CAST(sum(n) AS BIGINT) AS collected,
                 max(page) AS last_page, max_by(n, page) AS last_n, max_by(count_reported, page) AS count_reported
          FROM pages GROUP BY ALL)""",
    "expected": f"""
    SELECT d.run_date, c.country, q.role_query, c.country || '/' || q.role_query AS pair
    FROM (SELECT DISTINCT run_date FROM raw_rows) d,
         (SELECT unnest({_text_list(fixed.COUNTRIES)}) AS country) c,
         (SELECT unnest({_text_list(EVENT_QUERIES)}) AS role_query) q""",
    "ledger": """
    SELECT run_date, pair, status, pages, collected, count_reported FROM by_pages WHERE day(run_date) % 2 = 0""",
    "problems": f"""
    SELECT e.run_date, e.pair, coalesce(l.status, '{fixed.NOT_COLLECTED}') AS problem,
           '{fixed.FROM_LEDGER}' AS evidence
    FROM expected e LEFT JOIN ledger l ON l.run_date = e.run_date AND l.pair = e.pair
    WHERE day(e.run_date) % 2 = 0 AND l.status IS DISTINCT FROM '{fixed.COMPLETE}'
    UNION ALL
    SELECT run_date, pair, '{fixed.INCOMPLETE_BY_FILES}', '{fixed.FROM_PAGES}'
    FROM by_pages WHERE day(run_date) % 2 = 1 AND status <> '{fixed.COMPLETE}'""",
    "admitted": """
    SELECT * FROM raw_rows WHERE run_date NOT IN (SELECT run_date FROM problems)""",
    "stg": """
    SELECT run_date AS observed_on, extracted_at, country AS country_code, role_query, page, count_reported,
           source_id, trim(title) AS title, description, posted_at,
           CASE WHEN trim(company_name) <> '' THEN trim(company_name) END AS company_name,
           salary_min, salary_max, salary_is_predicted,
           CASE WHEN salary_min IS NULL THEN false ELSE salary_is_predicted = '0' END AS is_salary_disclosed,
           contract_type, contract_time, location_display_name, location_region, location_city,
           latitude, longitude, redirect_url, source_file
    FROM raw_rows WHERE source_id IS NOT NULL""",
    "dedup": "\n    SELECT source_id, observed_on, string_agg(DISTINCT role_query, ', ' ORDER BY role_query) AS role_queries,\n"
    + ",\n".join(f"           coalesce(first({a} ORDER BY {REPEAT_ORDER}), min({a})) AS {a}" for a in ATTRS)
    + "\n    FROM stg GROUP BY source_id, observed_on",
    "role_rules": f"SELECT * FROM (VALUES {_rule_rows(fixed.ROLE_RULES)}) t(rank, label, pattern)",
    "grade_rules": f"SELECT * FROM (VALUES {_rule_rows(fixed.GRADE_RULES)}) t(rank, label, pattern)",
    "mode_rules": f"SELECT * FROM (VALUES {_rule_rows(fixed.WORK_MODE_RULES)}) t(rank, label, pattern)",
    "texts": f"""
    SELECT title, description,
           {_label("role_rules", "t", fixed.NO_ROLE)} AS role_key,
           {_label("grade_rules", "t", fixed.NO_GRADE)} AS grade,
           {_label("mode_rules", "(t || ' ' || d)", fixed.NO_WORK_MODE)} AS remote_type
    FROM (SELECT DISTINCT title, description, lower(coalesce(title, '')) AS t,
                 lower(coalesce(description, '')) AS d FROM dedup)""",
    "ads": """
    SELECT a.*, t.role_key, t.grade, t.remote_type,
           t.role_key <> 'other' AS is_relevant, t.remote_type <> 'unknown' AS is_remote,
           md5(concat(lower(a.company_name), '|', lower(a.title), '|', a.country_code)) AS position_id
    FROM dedup a JOIN texts t
      ON t.title IS NOT DISTINCT FROM a.title AND t.description IS NOT DISTINCT FROM a.description""",
    "days": """
    SELECT observed_on, lag(observed_on) OVER w AS prev_day, lead(observed_on) OVER w AS next_day
    FROM (SELECT DISTINCT observed_on FROM stg) WINDOW w AS (ORDER BY observed_on)""",
    "seen": "SELECT source_id, min(observed_on) AS first_seen_on FROM stg GROUP BY source_id",
    "gone": """
    SELECT a.* REPLACE (d.next_day AS observed_on), s.first_seen_on, a.observed_on AS last_present_on
    FROM ads a JOIN days d ON d.observed_on = a.observed_on JOIN seen s ON s.source_id = a.source_id
    WHERE EXISTS (SELECT 1 FROM ads b WHERE b.observed_on = d.next_day AND b.country_code = a.country_code)
      AND NOT EXISTS (SELECT 1 FROM ads b WHERE b.observed_on = d.next_day AND b.source_id = a.source_id)""",
    "daily": """
    SELECT * EXCLUDE (last_present_on),
           CASE WHEN salary_max IS NULL THEN salary_min ELSE (salary_min + salary_max) / 2 END AS salary_mid,
           CAST(last_present_on - first_seen_on + 1 AS INTEGER) AS days_open,
           CAST(CASE WHEN posted_at IS NOT NULL
                THEN greatest(last_present_on - CAST(posted_at AS DATE), 0) END AS INTEGER) AS days_since_posted
    FROM (
        SELECT a.*, s.first_seen_on, a.observed_on AS last_present_on,
               a.observed_on = s.first_seen_on AS is_new, false AS is_gone
        FROM ads a JOIN seen s ON s.source_id = a.source_id
        UNION ALL BY NAME
        SELECT *, false AS is_new, true AS is_gone FROM gone
    )""",
    "starts": """
    SELECT source_id, title, grade, contract_type, contract_time, is_remote, observed_on AS valid_from
    FROM ads
    WINDOW w AS (PARTITION BY source_id ORDER BY observed_on)
    QUALIFY row_number() OVER w = 1
         OR row(title, grade, contract_type, contract_time, is_remote) IS DISTINCT FROM
            lag(row(title, grade, contract_type, contract_time, is_remote)) OVER w""",
    "versions": """
    SELECT md5(concat(source_id, '|', valid_from)) AS vacancy_sk, *,
           valid_to IS NULL AS is_current
    FROM (SELECT *, lead(valid_from) OVER (PARTITION BY source_id ORDER BY valid_from) AS valid_to FROM starts)""",
    "fact": """
    SELECT md5(concat(d.source_id, '|', d.observed_on)) AS vacancy_daily_sk, d.source_id, d.observed_on, v.vacancy_sk,
           md5(concat(lower(d.company_name))) AS company_sk,
           md5(concat(d.country_code, '|', d.location_region, '|', d.location_city)) AS location_sk,
           d.country_code, d.role_key, d.position_id, d.title, d.company_name, d.location_region, d.location_city,
           d.salary_min, d.salary_max, d.salary_mid, d.is_salary_disclosed, d.contract_type, d.contract_time,
           d.grade, d.remote_type, d.is_remote, d.is_relevant, d.is_new, d.is_gone, d.days_open,
           d.days_since_posted, d.first_seen_on, d.posted_at, d.redirect_url, d.role_queries
    FROM daily d ASOF LEFT JOIN versions v ON d.source_id = v.source_id AND d.observed_on >= v.valid_from""",
    "countries": f"""
    SELECT country_code, country_name, currency, flag <> 0 AS show_salary
    FROM (VALUES {_rows(fixed.COUNTRY_ROWS)}) t(country_code, country_name, currency, flag)""",
    "roles": f"SELECT * FROM (VALUES {_rows(fixed.ROLE_ROWS)}) t(role_key, role_name, priority)",
    "companies": """
    SELECT md5(lower(company_name)) AS company_sk, min(company_name) AS company_name
    FROM ads WHERE company_name IS NOT NULL GROUP BY md5(lower(company_name))""",
    "market": """
    SELECT observed_on, country_code, role_key,
           count(DISTINCT source_id) FILTER (NOT is_gone) AS n_ads,
           count(DISTINCT position_id) FILTER (NOT is_gone) AS n_positions,
           count(DISTINCT source_id) FILTER (NOT is_gone AND is_new) AS n_new,
           count(DISTINCT source_id) FILTER (is_gone) AS n_gone,
           count(DISTINCT source_id) FILTER (NOT is_gone AND is_salary_disclosed) AS n_salary_disclosed,
           count(DISTINCT source_id) FILTER (NOT is_gone AND is_remote) AS n_remote_or_hybrid,
"""
    + ",\n".join(
        f"           count(DISTINCT source_id) FILTER (NOT is_gone AND {column} = '{value}') AS n_{value}"
        for column, value in [
            ("contract_type", "permanent"), ("contract_type", "contract"),
            ("contract_time", "full_time"), ("contract_time", "part_time"),
            *[("grade", g) for g in fixed.GRADES],
        ]
    )
    + "\n    FROM fact WHERE is_relevant GROUP BY observed_on, country_code, role_key",
    "salaries": """
    SELECT f.observed_on, f.country_code, f.role_key, c.currency, count(*) AS n_disclosed,
           median(salary_mid) AS salary_mid_p50,
           quantile_disc(salary_mid, 0.25) AS salary_mid_p25, quantile_disc(salary_mid, 0.75) AS salary_mid_p75,
           median(salary_min) AS salary_min_p50, median(salary_max) AS salary_max_p50
    FROM fact f JOIN countries c USING (country_code)
    WHERE f.is_relevant AND f.is_salary_disclosed AND NOT f.is_gone AND c.show_salary
    GROUP BY ALL""",
    "unmatched": """
    SELECT title, country_code, role_queries, count(*) AS n
    FROM ads WHERE NOT is_relevant GROUP BY ALL""",
    "bi": """
    SELECT f.observed_on, f.source_id, f.position_id, f.country_code, c.country_name, f.role_key, r.role_name,
           f.title, f.company_name, f.location_region, f.location_city, g.city_group,
           f.salary_min, f.salary_max, f.salary_mid, f.is_salary_disclosed, f.contract_type, f.contract_time,
           f.grade, f.remote_type, f.is_remote, f.is_new, f.is_gone, NOT f.is_gone AS is_open,
           f.days_open, f.days_since_posted, c.currency, c.show_salary
    FROM fact f
    JOIN city_names g ON g.country_code = f.country_code AND g.location_region = f.location_region
                     AND g.location_city IS NOT DISTINCT FROM f.location_city
    LEFT JOIN countries c ON c.country_code = f.country_code
    LEFT JOIN roles r ON r.role_key = f.role_key
    WHERE f.is_relevant""",
    "city_names": """
    SELECT country_code, location_region, location_city,
           CASE country_code
             WHEN 'gb' THEN if(location_region = 'London', 'London', 'Rest of GB')
             WHEN 'ca' THEN if(contains(lower(location_city), 'toronto'), 'Toronto',
                            if(contains(lower(location_city), 'vancouver'), 'Vancouver', location_city))
             ELSE location_city END AS city_group
    FROM (SELECT DISTINCT country_code, location_region, location_city FROM ads)""",
}


def _with(body: str) -> str:
    """The body behind the table expressions it needs, in their order of dependence."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    listed = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    return f"WITH {listed}\n{body}"


DAY_IDS = "source_id, observed_on, country_code, title, role_key, position_id, first_seen_on, last_present_on"


def _coverage(source: str, text: str, terms: list[str] = fixed.TECHNOLOGIES) -> str:
    return f"""
    SELECT t.term, count(*) FILTER (contains(lower(coalesce(s.{text}, '')), t.term)) AS n,
           round(count(*) FILTER (contains(lower(coalesce(s.{text}, '')), t.term)) / count(*), 6) AS share
    FROM {source} s, (SELECT unnest({_text_list(terms)}) AS term) t
    GROUP BY t.term HAVING n > 0
    UNION ALL
    SELECT NULL, count(*) FILTER (hit), round(count(*) FILTER (hit) / count(*), 6)
    FROM (SELECT len(list_filter({_text_list(terms)},
                     lambda t: contains(lower(coalesce({text}, '')), t))) > 0 AS hit FROM {source})"""


def _not_nulls(table: str, shown: str, columns: list[str]) -> list[str]:
    return [f"SELECT '{shown}.{c} not null' AS test, count(*) FILTER ({c} IS NULL) AS n_bad FROM {table}" for c in columns]


def _unique(table: str, name: str, keys: str) -> str:
    return (
        f"SELECT '{name}' AS test, count(*) AS n_bad FROM "
        f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)"
    )


DQ = "\nUNION ALL\n".join([
    *_not_nulls("stg", "staging", ["source_id", "observed_on", "country_code", "is_salary_disclosed"]),
    f"SELECT 'staging.country_code accepted', count(*) FILTER (NOT list_contains({_text_list(fixed.COUNTRIES)}, country_code)) FROM stg",
    "SELECT 'staging disclosure rule', count(*) FILTER (is_salary_disclosed <> (salary_is_predicted = '0' AND salary_min IS NOT NULL)) FROM stg",
    _unique("ads", "ads grain", "source_id, observed_on"),
    """SELECT 'ads position key', count(*) FROM (SELECT position_id FROM ads GROUP BY position_id
       HAVING count(DISTINCT lower(coalesce(company_name, ''))) > 1 OR count(DISTINCT lower(coalesce(title, ''))) > 1)""",
    *_not_nulls("fact", "fact", ["vacancy_daily_sk", "source_id", "observed_on", "country_code", "role_key"]),
    _unique("fact", "fact.vacancy_daily_sk unique", "vacancy_daily_sk"),
    _unique("fact", "fact grain", "source_id, observed_on"),
    "SELECT 'fact.country_code in dim_country', count(*) FROM fact WHERE country_code NOT IN (SELECT country_code FROM countries)",
    "SELECT 'fact.role_key in dim_role', count(*) FROM fact WHERE role_key NOT IN (SELECT role_key FROM roles)",
    """SELECT 'days of staging, ads and fact', count(*) FILTER (NOT (a IN (SELECT observed_on FROM stg) AND a IN (SELECT observed_on FROM ads)
         AND a IN (SELECT observed_on FROM fact WHERE NOT is_gone)))
       FROM (SELECT observed_on AS a FROM stg UNION SELECT observed_on FROM ads UNION SELECT observed_on FROM fact WHERE NOT is_gone)""",
    *_not_nulls("versions", "dim_vacancy", ["vacancy_sk", "source_id"]),
    _unique("versions", "dim_vacancy.vacancy_sk unique", "vacancy_sk"),
    *_not_nulls("companies", "dim_company", ["company_sk"]),
    _unique("companies", "dim_company.company_sk unique", "company_sk"),
    *_not_nulls("countries", "dim_country", ["country_code"]),
    _unique("countries", "dim_country.country_code unique", "country_code"),
    *_not_nulls("roles", "dim_role", ["role_key"]),
    _unique("roles", "dim_role.role_key unique", "role_key"),
])

KPI = """
    SELECT {shown} count(DISTINCT source_id) FILTER (is_open) AS n_ads,
           count(DISTINCT position_id) FILTER (is_open) AS n_positions,
           count(DISTINCT source_id) FILTER (is_new) AS n_new,
           count(DISTINCT source_id) FILTER (is_gone) AS n_gone,
           count(DISTINCT source_id) FILTER (is_open AND is_salary_disclosed) AS n_disclosed,
           round(coalesce(count(DISTINCT source_id) FILTER (is_open AND is_salary_disclosed)
                 / nullif(count(DISTINCT source_id) FILTER (is_open), 0), 0), 6) AS disclosed_share
    FROM bi"""


def _crosstab(rows: str, columns: str, values: list[str]) -> str:
    cells = ", ".join(f"count(DISTINCT source_id) FILTER ({columns} = '{v}') AS {v}" for v in values)
    return f"SELECT {rows}, {cells} FROM bi WHERE is_open GROUP BY {rows}"


FIRST_OF_ID = """
    (SELECT first(country ORDER BY source_file, country, company_name NULLS FIRST, title) AS country,
            first(company_name ORDER BY source_file, country, company_name NULLS FIRST, title) AS company_name,
            trim(first(title ORDER BY source_file, country, company_name NULLS FIRST, title)) AS title
     FROM raw_rows WHERE source_id IS NOT NULL GROUP BY source_id)"""

BODIES = {
    "flatten_pages": """
        SELECT source_file, run_date,
               max(extracted_at) OVER (PARTITION BY source_file) AS extracted_at,
               country, role_query, page, 50 AS results_per_page, 2 AS max_days_old,
               CAST(count(*) OVER (PARTITION BY source_file) AS INTEGER) AS count_reported,
               source_id, title, description, posted_at, nullif(trim(company_name), '') AS company_name,
               salary_min, salary_max, salary_is_predicted, contract_type, contract_time,
               location_display_name, location_region, coalesce(location_city, location_region) AS location_city,
               CASE WHEN location_city IS NULL THEN format('["{}","{}"]', country, location_region)
                    ELSE format('["{}","{}","{}"]', country, location_region, location_city) END AS location_area_json,
               latitude, longitude, 'it-jobs' AS category_tag, 'IT Jobs' AS category_label,
               redirect_url, source_id AS id_in_text
        FROM page_rows""",
    "quota_headers": """
        SELECT unnest(['X-RateLimit-Limit', 'X-Ratelimit-Remaining']) AS name, unnest(['300', CAST(300 - page - n AS VARCHAR)]) AS value
        FROM (SELECT source_file, any_value(page) AS page, count(*) AS n FROM page_rows GROUP BY source_file ORDER BY source_file LIMIT 1)""",
    "expected_pairs": "SELECT * FROM expected",
    "pair_completeness": "SELECT * FROM by_pages",
    "ledger_states": "SELECT run_date, pair, status, pages, collected, count_reported, 'T02' AS finished_at FROM ledger",
    "day_problems": "SELECT * FROM problems",
    "gated_rows": "SELECT run_date, country, role_query, count(*) AS n FROM admitted GROUP BY ALL",
    "load_summary": """
        SELECT count(DISTINCT source_file) AS files, count(*) AS rows, count(DISTINCT source_id) AS ids,
               string_agg(DISTINCT CAST(run_date AS VARCHAR), ',' ORDER BY CAST(run_date AS VARCHAR)) AS days
        FROM admitted""",
    "recollect_list": """
        SELECT e.run_date, e.pair FROM expected e
        WHERE NOT EXISTS (SELECT 1 FROM by_pages p
                          WHERE p.run_date = e.run_date AND p.pair = e.pair AND p.status = 'complete')""",
    "recollect_missing_pages": """
        SELECT e.run_date, e.pair FROM expected e
        WHERE NOT EXISTS (SELECT 1 FROM by_pages p
                          WHERE p.run_date = e.run_date AND p.pair = e.pair AND p.status = 'complete' AND p.pair NOT LIKE '%/click')""",
    "run_totals": """
        SELECT run_date, status, count(*) AS pairs, CAST(sum(pages) AS BIGINT) AS pages,
               CAST(sum(collected) AS BIGINT) AS collected FROM ledger GROUP BY run_date, status""",
    "incomplete_pairs": "SELECT run_date, pair, status FROM ledger WHERE status <> 'complete'",
    "latest_day_rows": """
        SELECT run_date, country, count(*) AS n FROM raw_rows
        WHERE run_date = (SELECT max(run_date) FROM raw_rows) GROUP BY ALL""",
    "stage_filter": "SELECT * FROM stg",
    "dedup_observations": "SELECT * FROM dedup",
    "dedup_two_phase": "SELECT * FROM dedup",
    "classify_role": "SELECT title, role_key, is_relevant, count(*) AS n FROM ads GROUP BY ALL",
    "classify_grade": "SELECT title, grade, count(*) AS n FROM ads GROUP BY ALL",
    "classify_mode": "SELECT title, description, remote_type, is_remote, count(*) AS n FROM ads GROUP BY ALL",
    "city_groups": """
        SELECT a.country_code, a.location_region, a.location_city, g.city_group, count(*) AS n
        FROM ads a JOIN city_names g ON g.country_code = a.country_code AND g.location_region = a.location_region
             AND g.location_city IS NOT DISTINCT FROM a.location_city
        GROUP BY ALL""",
    "surrogate_keys": """
        SELECT source_id, observed_on, position_id,
               md5(coalesce(lower(company_name), '')) AS company_sk,
               md5(country_code || '|' || location_region || '|' || coalesce(location_city, '')) AS location_sk,
               country_code || '/' || role_key AS pair,
               format('raw_{}_{}_{}_p1.json', observed_on, country_code, role_key) AS file_name
        FROM ads""",
    "day_sequence": "SELECT * FROM days",
    "first_seen": "SELECT * FROM seen",
    "gone_rows": f"SELECT {DAY_IDS} FROM gone",
    "gone_rows_by_join": f"SELECT {DAY_IDS} FROM gone",
    "presence_spells": """
        SELECT source_id, CAST(spell AS BIGINT) AS spell, arg_max(country_code, observed_on) AS country_code, min(observed_on) AS opened_on,
               max(observed_on) AS last_present_on, max(closed_on) AS closed_on, count(*) AS n_days
        FROM (SELECT *, 1 + count(closed_on) OVER (PARTITION BY source_id ORDER BY observed_on ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS spell
              FROM (SELECT a.source_id, a.observed_on, a.country_code, list_sort(list(c.observed_on))[2] AS closed_on
                    FROM (SELECT *, lead(observed_on) OVER (PARTITION BY source_id ORDER BY observed_on) AS next_seen FROM ads) a
                    LEFT JOIN (SELECT DISTINCT country_code, observed_on FROM ads) c
                      ON c.country_code = a.country_code AND c.observed_on > a.observed_on AND (a.next_seen IS NULL OR c.observed_on < a.next_seen)
                    GROUP BY a.source_id, a.observed_on, a.country_code))
        GROUP BY source_id, spell""",
    "spells_closed_next_day": "SELECT source_id, observed_on, country_code, last_present_on FROM gone",
    "daily_status": "SELECT * FROM daily",
    "scd2_history": "SELECT * FROM versions",
    "fact": "SELECT * FROM fact",
    "fact_by_days": "SELECT * FROM fact",
    "history_by_days": "SELECT * FROM versions",
    "asof_fact": "SELECT * FROM fact",
    "merged_fact": "SELECT * FROM fact",
    "dim_company": "SELECT * FROM companies",
    "dim_location": """
        SELECT DISTINCT md5(concat(country_code, '|', location_region, '|', location_city)) AS location_sk,
               country_code, location_region, location_city FROM ads""",
    "dim_date": """
        SELECT observed_on AS date_day, year(observed_on) AS year, month(observed_on) AS month,
               day(observed_on) AS day FROM stg GROUP BY observed_on""",
    "dim_static": """
        SELECT c.*, r.*, n_ads
        FROM (SELECT country_code AS cc, role_key AS rk, count(*) AS n_ads FROM ads GROUP BY ALL) a
        JOIN countries c ON c.country_code = cc
        JOIN roles r ON r.role_key = rk""",
    "market_daily": "SELECT * FROM market",
    "salary_daily": "SELECT * FROM salaries",
    "salary_approx": "SELECT observed_on, country_code, role_key, currency, n_disclosed, true AS inside FROM salaries",
    "salary_sketched": """
        SELECT CAST(date_trunc('week', f.observed_on) AS DATE) AS week, f.country_code, f.role_key, c.currency, count(salary_mid) AS n,
               quantile_disc(salary_mid, 0.5) AS salary_mid_p50, quantile_disc(salary_mid, 0.25) AS salary_mid_p25,
               quantile_disc(salary_mid, 0.75) AS salary_mid_p75, quantile_disc(salary_min, 0.5) AS salary_min_p50,
               quantile_disc(salary_max, 0.5) AS salary_max_p50
        FROM fact f JOIN countries c USING (country_code)
        WHERE f.is_relevant AND f.is_salary_disclosed AND NOT f.is_gone AND c.show_salary
        GROUP BY ALL""",
    "salary_disclosure": """
        SELECT observed_on, country_code, count(*) FILTER (NOT is_gone) AS n_ads,
               count(*) FILTER (NOT is_gone AND is_salary_disclosed) AS n_salary_disclosed,
               round(coalesce(count(*) FILTER (NOT is_gone AND is_salary_disclosed)
                     / nullif(count(*) FILTER (NOT is_gone), 0), 0), 6) AS disclosed_share
        FROM fact WHERE is_relevant GROUP BY observed_on, country_code""",
    "company_role_latest": """
        SELECT observed_on, country_code, role_key, company_name,
               count(DISTINCT position_id) FILTER (NOT is_gone) AS n_positions_open,
               count(DISTINCT position_id) FILTER (is_new) AS n_positions_new,
               median(days_open) FILTER (NOT is_gone) AS days_open_p50,
               median(salary_mid) FILTER (NOT is_gone AND is_salary_disclosed) AS salary_mid_p50
        FROM fact
        WHERE observed_on = (SELECT max(observed_on) FROM fact) AND is_relevant AND company_name IS NOT NULL
        GROUP BY ALL""",
    "city_daily": """
        SELECT observed_on, country_code, location_city, location_region, role_key,
               count(DISTINCT source_id) FILTER (NOT is_gone) AS n_ads,
               count(DISTINCT position_id) FILTER (NOT is_gone) AS n_positions
        FROM fact WHERE is_relevant AND location_city IS NOT NULL GROUP BY ALL""",
    "qa_unmatched": "SELECT * FROM unmatched",
    "top_unmatched": """
        SELECT n, country_code, title, role_queries FROM unmatched
        ORDER BY n DESC, title, country_code, role_queries LIMIT 15""",
    "bi_flat": "SELECT * FROM bi",
    "market_rollup": """
        SELECT country_code, role_key, grouping(role_key) = 1 AS is_subtotal,
               CAST(sum(n_ads) AS BIGINT) AS n_ads, CAST(sum(n_positions) AS BIGINT) AS n_positions,
               CAST(sum(n_new) AS BIGINT) AS n_new, CAST(sum(n_gone) AS BIGINT) AS n_gone
        FROM market GROUP BY GROUPING SETS ((country_code, role_key), (country_code))""",
    "salary_medians": """
        SELECT observed_on, country_code, role_key, n_disclosed, round(salary_mid_p50, 0) AS salary_mid_p50
        FROM salaries""",
    "profile_volume": """
        SELECT p.run_date, p.country, p.role_query, count(*) AS collected, any_value(p.count_reported) AS reported
        FROM by_pages p JOIN raw_rows USING (run_date, country, role_query)
        WHERE p.run_date = (SELECT max(run_date) FROM raw_rows) GROUP BY p.run_date, p.country, p.role_query""",
    "profile_duplicates": """
        SELECT count(source_id) AS n_rows, count(DISTINCT source_id) AS n_ids,
               count(source_id) - count(DISTINCT source_id) AS n_repeats,
               round((count(source_id) - count(DISTINCT source_id)) / count(source_id), 6) AS repeat_share
        FROM raw_rows WHERE run_date = (SELECT max(run_date) FROM raw_rows)""",
    "profile_salary_fields": """
        SELECT country, count(*) AS n, count(*) FILTER (salary_is_predicted = '0') AS n_flag,
               count(salary_min) AS n_band, count(salary_min) FILTER (salary_is_predicted = '0') AS n_both,
               round(count(salary_min) FILTER (salary_is_predicted = '0') / count(*), 6) AS both_share
        FROM raw_rows WHERE run_date = (SELECT max(run_date) FROM raw_rows) GROUP BY country""",
    "volume_vs_reported": """
        SELECT p.run_date, p.country, p.role_query, count(*) AS collected, any_value(p.count_reported) AS reported
        FROM by_pages p JOIN raw_rows USING (run_date, country, role_query)
        GROUP BY p.run_date, p.country, p.role_query""",
    "duplicate_rate": """
        SELECT count(source_id) AS n_rows, count(DISTINCT source_id) AS n_ids,
               count(source_id) - count(DISTINCT source_id) AS n_repeats,
               round((count(source_id) - count(DISTINCT source_id)) / count(source_id), 6) AS repeat_share
        FROM raw_rows""",
    "overlap_histogram": """
        SELECT n_queries, count(*) AS n_ids
        FROM (SELECT len(list_distinct(list(role_query))) AS n_queries FROM raw_rows
              WHERE source_id IS NOT NULL GROUP BY source_id)
        GROUP BY n_queries""",
    "salary_fields": """
        SELECT country, count(*) AS n, count(*) FILTER (salary_is_predicted = '0') AS n_flag,
               count(salary_min) AS n_band, count(salary_min) FILTER (salary_is_predicted = '0') AS n_both,
               round(count(salary_min) FILTER (salary_is_predicted = '0') / count(*), 6) AS both_share
        FROM raw_rows GROUP BY country""",
    "repeat_positions": f"""
        SELECT country, company_name, title, count(*) AS n FROM {FIRST_OF_ID}
        WHERE company_name <> '' AND title <> ''
        GROUP BY country, company_name, title HAVING count(*) > 1
        ORDER BY n DESC, country, company_name, title LIMIT 8""",
    "repeat_share": f"""
        SELECT count(*) AS n_ids,
               count(*) FILTER (company_name <> '' AND title <> '')
                 - count(DISTINCT (country, company_name, title)) FILTER (company_name <> '' AND title <> '') AS n_extra,
               round((count(*) FILTER (company_name <> '' AND title <> '')
                 - count(DISTINCT (country, company_name, title)) FILTER (company_name <> '' AND title <> ''))
                 / count(*), 6) AS extra_share
        FROM {FIRST_OF_ID}""",
    "top_titles": """
        SELECT trim(title) AS title, count(*) AS n FROM raw_rows WHERE title <> ''
        GROUP BY trim(title) ORDER BY n DESC, title LIMIT 15""",
    "keyword_coverage": _coverage("documents", "text", DOCUMENT_TERMS),
    "keyword_coverage_ads": _coverage("raw_rows", "description"),
    "layer_counts": """
        SELECT *, round(n_other / n_rows, 6) AS other_share FROM (
            SELECT 'raw' AS layer, count(*) AS n_rows, count(DISTINCT source_id) AS n_ids,
                   CAST(0 AS BIGINT) AS n_relevant, CAST(0 AS BIGINT) AS n_other FROM raw_rows
            UNION ALL
            SELECT 'staging', count(*), count(DISTINCT source_id), 0, 0 FROM stg
            UNION ALL
            SELECT 'ads', count(*), count(DISTINCT source_id), count(*) FILTER (is_relevant),
                   count(*) FILTER (NOT is_relevant) FROM ads)""",
    "age_audit": """
        SELECT country_code, count(h) AS n, round(max(h), 6) AS max_hours,
               count(*) FILTER (h > 48) AS n_over_48h, count(*) FILTER (h > 72) AS n_over_72h
        FROM (SELECT country_code, (epoch_us(extracted_at) - epoch_us(posted_at)) / 3600000000.0 AS h FROM stg)
        GROUP BY country_code""",
    "clock_audit": """
        SELECT country_code, count(*) AS n,
               round(max((epoch_us(posted_at) - epoch_us(extracted_at)) / 3600000000.0), 6) AS max_hours
        FROM stg WHERE posted_at > extracted_at GROUP BY country_code""",
    "id_stability": """
        SELECT b.country_code, count(*) AS n_seen_again,
               count(*) FILTER (a.posted_at IS DISTINCT FROM b.posted_at) AS n_posted_changed,
               count(*) FILTER (a.title IS DISTINCT FROM b.title) AS n_title_changed
        FROM ads b JOIN ads a ON a.source_id = b.source_id AND a.observed_on =
             (SELECT max(c.observed_on) FROM ads c WHERE c.source_id = b.source_id AND c.observed_on < b.observed_on)
        GROUP BY b.country_code""",
    "reappeared": """
        SELECT observed_on, country_code, count(*) AS n_positions, CAST(sum(n_new) AS BIGINT) AS n_new_ads
        FROM (SELECT observed_on, country_code, position_id, location_city,
                     count(*) FILTER (is_new) AS n_new, count(*) FILTER (is_gone) AS n_gone
              FROM daily GROUP BY ALL)
        WHERE n_new > 0 AND n_gone > 0 GROUP BY observed_on, country_code""",
    "volume_anomaly": f"""
        SELECT *, n = 0 AS is_empty, coalesce(abs(n - usual) > 3 * spread, false) AS is_unusual
        FROM (SELECT observed_on, country_code, n, round(avg(n) OVER w, 6) AS usual,
                     round(stddev_samp(n) OVER w, 6) AS spread
              FROM (SELECT d.observed_on, c.country_code, count(s.source_id) AS n
                    FROM days d CROSS JOIN (SELECT unnest({_text_list(fixed.COUNTRIES)}) AS country_code) c
                    LEFT JOIN stg s ON s.observed_on = d.observed_on AND s.country_code = c.country_code
                    GROUP BY d.observed_on, c.country_code)
              WINDOW w AS (PARTITION BY country_code ORDER BY observed_on ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
    "dq_results": DQ,
    "kpi": KPI.format(shown=""),
    "kpi_by_country": KPI.format(shown="country_name,") + " WHERE contract_type = 'permanent' GROUP BY country_name",
    "kpi_tiles": KPI.format(shown=""),
    "kpi_tiles_by_week": KPI.format(shown="CAST(date_trunc('week', observed_on) AS DATE) AS week, country_code,") + " GROUP BY ALL",
    "composition": _crosstab("contract_type", "grade", fixed.GRADES),
    "composition_mode": _crosstab("contract_time", "remote_type", fixed.WORK_MODES),
    "trend": """
        SELECT observed_on, count(DISTINCT source_id) FILTER (is_open) AS n_ads,
               count(*) FILTER (is_new) AS n_new, count(*) FILTER (is_gone) AS n_gone,
               count(DISTINCT position_id) FILTER (is_open) AS n_positions
        FROM bi GROUP BY observed_on""",
    "city_table": """
        SELECT city_group, country_name, count(DISTINCT source_id) FILTER (is_open) AS n_ads,
               count(DISTINCT position_id) FILTER (is_open) AS n_positions
        FROM bi GROUP BY ALL""",
    "salary_matrix": """
        SELECT country_name, role_name, count(*) AS n, quantile_disc(salary_mid, 0.25) AS salary_mid_p25,
               median(salary_mid) AS salary_mid_p50, quantile_disc(salary_mid, 0.75) AS salary_mid_p75
        FROM bi WHERE is_open AND is_salary_disclosed GROUP BY ALL""",
    "salary_matrix_by_day": """
        SELECT observed_on, country_name, role_name, count(*) AS n, quantile_disc(salary_mid, 0.25) AS salary_mid_p25,
               median(salary_mid) AS salary_mid_p50, quantile_disc(salary_mid, 0.75) AS salary_mid_p75
        FROM bi WHERE is_open AND is_salary_disclosed GROUP BY ALL""",
    "company_life": """
        SELECT company_name, role_name, count(DISTINCT position_id) AS n_positions, median(days_open) AS days_open_p50
        FROM bi WHERE is_open GROUP BY ALL""",
    "week_growth": """
        SELECT company_name, count(DISTINCT source_id) FILTER (is_new) AS n_added FROM bi
        WHERE observed_on > (SELECT max(observed_on) FROM stg) - 7 AND company_name IS NOT NULL
        GROUP BY company_name HAVING n_added > 0 ORDER BY n_added DESC, company_name LIMIT 10""",
    "longest_open": """
        SELECT company_name, max(days_open) AS days_open_max, count(*) AS n_ads, median(days_open) AS days_open_p50
        FROM bi WHERE observed_on = (SELECT max(observed_on) FROM stg) AND is_open AND company_name IS NOT NULL
        GROUP BY company_name ORDER BY days_open_max DESC, days_open_p50 DESC, company_name LIMIT 10""",
    "latest_day_of": "SELECT max(observed_on) AS observed_on FROM stg",
    "ndjson_round_trip": "SELECT * EXCLUDE (ci) FROM raw_rows",
    "replaced_days": "SELECT * EXCLUDE (ci) FROM raw_rows WHERE day(run_date) > 10 OR page = 1",
    "repartitioned_table": "SELECT run_date, count(*) AS n, '[True, False], by day: True' AS state FROM raw_rows GROUP BY run_date",
    "layer_tables": "SELECT * FROM market",
    "published_versions": "SELECT *, 1 AS version FROM market WHERE day(observed_on) <= 15 UNION ALL SELECT *, 2 FROM market",
    "row_counts": """
        SELECT 'raw' AS layer, count(*) AS n_rows FROM raw_rows
        UNION ALL SELECT 'staged', count(*) FROM raw_rows WHERE source_id IS NOT NULL""",
    "ledger_grows": "SELECT run_date, pair FROM expected WHERE day(run_date) % 2 = 0 OR day(run_date) % 3 = 0",
    "pair_state": """
        SELECT split_part(pair, '/', 1) AS country, status FROM ledger WHERE run_date = DATE '2024-01-02' AND pair LIKE '%/click'""",
    "role_slugs": "SELECT DISTINCT title, replace(title, ' ', '-') AS slug FROM stg",
}

ORACLE = {name: _with(body) for name, body in BODIES.items()}
