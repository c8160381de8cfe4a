"""Column expressions shared by all plans. Everything here stays JVM-side."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings import fixed


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def key_text(*parts: Column | str) -> Column:
    """Parts as text, NULL as empty, joined with ``|``."""
    texts = [F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts]
    return F.concat_ws("|", *texts)


def surrogate_key(*parts: Column | str) -> Column:
    """md5 of :func:`key_text`, as lower-case hex."""
    return F.md5(key_text(*parts))


def company_key(company: Column | str = "company_name") -> Column:
    return surrogate_key(folded(company))


def location_key() -> Column:
    return surrogate_key("country_code", "location_region", "location_city")


def position_key() -> Column:
    """Ads of one company, title and country are one position."""
    return surrogate_key(folded("company_name"), folded("title"), "country_code")


def folded(text: Column | str) -> Column:
    """Lower-case text, NULL as empty."""
    return F.lower(F.coalesce(as_col(text), F.lit("")))


def trimmed(text: Column | str) -> Column:
    """Without leading and trailing space separators (tabs stay)."""
    return F.btrim(as_col(text), F.lit(fixed.SPACE_SEPARATORS))


def stripped_or_null(text: Column | str) -> Column:
    """Without any surrounding white space; nothing left becomes NULL."""
    return F.nullif(F.btrim(as_col(text), F.lit(fixed.WHITE_SPACE)), F.lit(""))


def matches_any(text: Column, patterns: list[str]) -> Column:
    """LIKE any of the patterns; Catalyst turns these into plain substring tests."""
    return reduce(or_, [text.like(p) for p in patterns])


def classify(text: Column | str, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """Label of the first rule with a matching pattern, else ``default``."""
    text = as_col(text)
    (label, patterns), *rest = rules
    chain = F.when(matches_any(text, patterns), F.lit(label))
    for label, patterns in rest:
        chain = chain.when(matches_any(text, patterns), F.lit(label))
    return chain.otherwise(F.lit(default))


def role_of(title: Column | str = "title") -> Column:
    return classify(folded(title), fixed.ROLE_RULES, fixed.NO_ROLE)


def grade_of(title: Column | str = "title") -> Column:
    return classify(folded(title), fixed.GRADE_RULES, fixed.NO_GRADE)


def work_mode_of(title: Column | str = "title", description: Column | str = "description") -> Column:
    text = F.concat_ws(" ", folded(title), folded(description))
    return classify(text, fixed.WORK_MODE_RULES, fixed.NO_WORK_MODE)


def salary_disclosed() -> Column:
    """The employer's own band: flag ``'0'`` and a minimum. NULL flag with a minimum is NULL."""
    return (F.col("salary_is_predicted") == "0") & F.col("salary_min").isNotNull()


def salary_mid() -> Column:
    return F.coalesce((F.col("salary_min") + F.col("salary_max")) / 2, F.col("salary_min"))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(F.to_date(as_col(end)), F.to_date(as_col(start)))


def hours_between(start: Column | str, end: Column | str) -> Column:
    micros = F.unix_micros(as_col(end)) - F.unix_micros(as_col(start))
    return micros / F.lit(3_600_000_000.0)


def days_since(posted: Column | str, day: Column | str) -> Column:
    """Whole days since publication, never negative, NULL when unknown."""
    gap = days_between(posted, day)
    return F.when(gap.isNotNull(), F.greatest(gap, F.lit(0)))


def city_group() -> Column:
    """Cities folded for charts: London or the rest of gb, two metros of ca, else the city."""
    country, city = F.col("country_code"), folded("location_city")
    return (
        F.when((country == "gb") & (F.col("location_region") == "London"), F.lit("London"))
        .when(country == "gb", F.lit("Rest of GB"))
        .when((country == "ca") & city.contains("toronto"), F.lit("Toronto"))
        .when((country == "ca") & city.contains("vancouver"), F.lit("Vancouver"))
        .otherwise(F.col("location_city"))
    )


def region_of(area: Column | str) -> Column:
    """Second element of a country-to-city path."""
    return F.try_element_at(as_col(area), F.lit(2))


def city_of(area: Column | str) -> Column:
    """Last element of the path when it reaches below the country."""
    area = as_col(area)
    return F.when(F.size(area) > 1, F.try_element_at(area, F.lit(-1)))


def role_slug(query: Column | str) -> Column:
    return F.replace(as_col(query), F.lit(" "), F.lit("-"))


def pair_key(country: Column | str = "country", query: Column | str = "role_query") -> Column:
    return F.concat_ws("/", as_col(country), as_col(query))


def page_file_name(day: Column | str, country: Column | str, query: Column | str, page: Column | str) -> Column:
    name = F.concat_ws(
        "_", F.lit("raw"), as_col(day).cast("string"), as_col(country), role_slug(query),
        F.concat(F.lit("p"), as_col(page).cast("string")),
    )
    return F.concat(name, F.lit(".json"))


def share(part: Column | str, whole: Column | str) -> Column:
    """part / whole, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(as_col(part).cast("double"), as_col(whole).cast("double")), F.lit(0.0))


def terms_in(text: Column | str, terms: list[str] = fixed.TECHNOLOGIES) -> Column:
    """Array of the terms that occur in the text as substrings, case folded."""
    haystack = folded(text)
    listed = F.array(*[F.when(haystack.contains(t), F.lit(t)) for t in terms])
    return F.array_compact(listed)


def headers_with(headers: Column | str, words: list[str] = fixed.QUOTA_WORDS) -> Column:
    """Entries of a header map whose lower-case name contains one of the words."""
    return F.map_filter(
        as_col(headers),
        lambda name, _: reduce(or_, [F.lower(name).contains(w) for w in words]),
    )


def listed(values: Column | str, separator: str = ", ") -> Column:
    """Aggregate: the distinct values in order, joined. Bounded by the number of distinct values."""
    return F.array_join(F.array_sort(F.collect_set(as_col(values))), separator)


def first_known(value: Column | str, order: list[str]) -> Column:
    """Aggregate: the first non-NULL value by ``order``, ties to the smaller value.

    A minimum over (order, value): combined before any shuffle, the same on every run.
    """
    value = as_col(value)
    ranked = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], value.alias("value"))
    return F.min(F.when(value.isNotNull(), ranked)).getField("value")

