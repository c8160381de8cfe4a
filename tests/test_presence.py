import random
from datetime import date, timedelta

import pytest

from postings.operators import presence

SCHEMA = "source_id string, observed_on date, country_code string"


def d(n):
    return date(2026, 9, n)


GOLDEN = [("A", 1, "gb"), ("B", 1, "de"), ("C", 1, "de"), ("C", 3, "de"),
          ("K", 1, "de"), ("K", 2, "de"), ("K", 3, "de"), ("G", 3, "gb")]


def status(df, **more):
    from postings.functions import days_between

    found = presence.daily_status(df, "source_id", "observed_on", "country_code", **more)
    return found.withColumn("days_open", days_between("first_seen_on", "last_present_on") + 1)


def test_golden_scenario(table, rows):
    df = table(SCHEMA, *[(i, d(n), c) for i, n, c in GOLDEN])
    assert rows(status(df), "source_id", "observed_on", "is_new", "is_gone", "days_open") == sorted([
        ("A", d(1), True, False, 1),      # lost with the gb hole on day 2: never gone
        ("B", d(1), True, False, 1), ("B", d(2), False, True, 1),
        ("C", d(1), True, False, 1), ("C", d(2), False, True, 1), ("C", d(3), False, False, 3),
        ("K", d(1), True, False, 1), ("K", d(2), False, False, 2), ("K", d(3), False, False, 3),
        ("G", d(3), True, False, 1),
    ], key=repr)


def test_day_sequence(table, rows):
    df = table(SCHEMA, *[(i, d(n), c) for i, n, c in GOLDEN])
    assert rows(presence.day_sequence(df, "observed_on")) == [
        (d(1), None, d(2)), (d(2), d(1), d(3)), (d(3), d(2), None)]


def brute_force(observed):
    """Gone rows by the rule, one day pair at a time."""
    days = sorted({day for _, day, _ in observed})
    first = {}
    for key, day, _ in sorted(observed, key=lambda r: r[1]):
        first.setdefault(key, day)
    gone = []
    for before, day in zip(days, days[1:]):
        today = {key for key, on, _ in observed if on == day}
        countries = {c for _, on, c in observed if on == day}
        gone += [(key, day, c, first[key], before) for key, on, c in observed
                 if on == before and c in countries and key not in today]
    return sorted(gone, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_window_form_join_form_and_brute_force_agree(table, rows, seed):
    rng = random.Random(seed)
    holes = {(c, n) for c in "xyz" for n in range(12) if rng.random() < 0.3}
    observed = []
    for key in range(25):
        country = rng.choice("xyz")
        for n in range(12):
            # an id may move to another country now and then
            where = rng.choice("xyz") if rng.random() < 0.1 else country
            if rng.random() < 0.6 and (where, n) not in holes:
                observed.append((str(key), date(2026, 1, 1) + timedelta(days=2 * n), where))
    df = table(SCHEMA, *observed)
    names = ["source_id", "observed_on", "country_code", "first_seen_on", "last_present_on"]
    expected = brute_force(observed)
    args = (df, "source_id", "observed_on", "country_code")
    assert rows(presence.gone_rows(*args), *names) == expected
    assert rows(presence.gone_rows_by_join(*args), *names) == expected
    found = presence.daily_status(*args)
    assert rows(found.where("is_gone"), *names) == expected
    assert found.count() == len(observed) + len(expected)
    assert found.select("source_id", "observed_on").distinct().count() == found.count()


def test_beyond_the_broadcast_bound_nothing_changes(table, rows, monkeypatch):
    df = table(SCHEMA, *[(i, d(n), c) for i, n, c in GOLDEN])
    small = rows(status(df))
    monkeypatch.setattr(presence, "local_copy", lambda frame: None)
    monkeypatch.setattr(presence, "measured_small", lambda frame: frame)
    assert rows(status(df)) == small


def test_the_bound_is_checked(table):
    from postings.operators.sizing import local_copy, measured_small

    df = table("x int", *[(n,) for n in range(10)])
    assert local_copy(df, 9) is None
    assert local_copy(df, 10).count() == 10
    assert measured_small(df, 9) is df
