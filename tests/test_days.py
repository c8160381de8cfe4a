"""Days advanced one by one equal the one pass over all of them, whatever order they come in."""

import random
from datetime import date, timedelta

import pytest

from postings.operators import state
from postings.operators.history import scd2
from postings.plans import days, gold, silver
from postings.sources import warehouse
from postings.sources.warehouse import replace_days, save_table

ADS = "intermediate.ads_of_a_month"
START = date(2026, 9, 1)
TITLES = ["Data Engineer", "Senior Data Engineer", "Gardener", None]
SCHEMA = ("role_queries string, country_code string, title string, description string, posted_at timestamp, company_name string, "
          "salary_min double, salary_max double, is_salary_disclosed boolean, contract_type string, contract_time string, "
          "location_display_name string, location_region string, location_city string, latitude double, longitude double, redirect_url string, "
          "source_id string, observed_on date")


def month(draw, n_days=9, n_ids=24):
    """Ads that come, go, return and change, in countries with holes; some days are missing altogether."""
    ads = {}
    for k in range(n_days):
        day = START + timedelta(days=k)
        if draw.random() < 0.15:
            continue
        covered = {c for c in ("gb", "us", "de") if draw.random() < 0.8}
        rows = []
        for i in range(n_ids):
            country = ("gb", "us", "de")[i % 3] if draw.random() < 0.97 else "gb"
            if country in covered and draw.random() < 0.7:
                rows.append((
                    "q", country, draw.choice(TITLES[: 1 + i % 4]), None, None, draw.choice(["Co", None]), draw.choice([None, 1.0]), 3.0, True,
                    draw.choice([None, "", "permanent"]) if i % 5 == 0 else "contract", None, "x", "r", "c", 1.0, 2.0, "u", f"id{i}", day))
        if rows:
            ads[day] = rows
    return ads


def put(spark, ads, chosen):
    rows = [r for d in chosen for r in ads.get(d, [])]
    df = silver.enriched(spark.createDataFrame(rows, SCHEMA))
    if not spark.catalog.tableExists(ADS):
        save_table(df, ADS, silver.DAY)
    else:
        replace_days(df, ADS, silver.DAY)
        warehouse.drop_days(spark, ADS, [d for d in chosen if d not in ads])


def built(spark, ads, versions):
    return spark.createDataFrame([(d, str(versions.get(d, 0)), "rules") for d in sorted(ads)], "run_date date, state string, rules string")


def agrees(spark, rows):
    ads = spark.table(ADS)
    assert rows(spark.table(days.FACTS), *gold.FACT_COLUMNS) == rows(gold.fact(ads), *gold.FACT_COLUMNS)
    whole = gold.dim_vacancy(ads)
    assert rows(spark.table(days.HISTORY), *whole.columns) == rows(whole)
    assert rows(spark.table(days.STATES)) == rows(state.states(ads, *days.KEYS))


@pytest.fixture
def clean(spark):
    warehouse.ensure_layers(spark)
    for table in (ADS, days.FACTS, days.STATES, days.CLOSED, days.SNAPSHOTS, days.BUILT):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"DROP VIEW IF EXISTS {days.HISTORY}")
    yield
    spark.sql(f"DROP TABLE IF EXISTS {ADS}")
    spark.sql(f"DROP TABLE IF EXISTS {days.BUILT}")  # later builds start anew


def test_day_by_day_equals_one_pass(spark, clean, rows, monkeypatch):
    draw = random.Random(1)
    monkeypatch.setattr(days, "SNAPSHOT_EVERY", 3)
    ads = month(draw)
    order = sorted(ads)
    done = {}
    for k, day in enumerate(order):
        done[day] = ads[day]
        put(spark, ads, [day])
        assert days.refresh(spark, ADS, built(spark, done, {})) == (None if k == 0 else [day])
    agrees(spark, rows)
    assert len(warehouse.partition_days(spark, days.SNAPSHOTS)) >= 2

    # an old day is loaded again, another leaves, and one in a hole arrives late
    again, gone, late = order[3], order[-4], next(START + timedelta(days=k) for k in range(60) if START + timedelta(days=k) not in ads)
    other = {d: [(*r[:18], d) for r in rs] for d, rs in zip([again, late], month(draw).values())}
    ads = {**ads, **other}
    del ads[gone]
    put(spark, ads, [again, gone, late])
    found = days.refresh(spark, ADS, built(spark, ads, {again: 1}))
    assert found == sorted(d for d in {*ads, gone} if d >= min(again, late, gone))
    agrees(spark, rows)
    assert days.refresh(spark, ADS, built(spark, ads, {again: 1})) == []


def test_many_changed_days_are_made_in_one_pass(spark, clean, rows, monkeypatch):
    monkeypatch.setattr(days, "REPLAY_DAYS", 2)
    ads = month(random.Random(7), 8, 12)
    put(spark, ads, list(ads))
    assert days.refresh(spark, ADS, built(spark, ads, {})) is None
    assert days.refresh(spark, ADS, built(spark, ads, {sorted(ads)[-1]: 1})) == [sorted(ads)[-1]]
    assert days.refresh(spark, ADS, built(spark, ads, {sorted(ads)[0]: 1})) is None
    agrees(spark, rows)


def test_a_build_that_dies_is_done_again(spark, clean, rows, monkeypatch):
    ads = month(random.Random(5), 7, 12)
    order = sorted(ads)
    put(spark, ads, order)
    days.refresh(spark, ADS, built(spark, ads, {}))
    advance, calls = days.advance, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("killed")
        advance(*args)

    monkeypatch.setattr(days, "advance", dies)
    with pytest.raises(RuntimeError):
        days.refresh(spark, ADS, built(spark, ads, {order[1]: 1}))
    monkeypatch.setattr(days, "advance", advance)
    assert days.refresh(spark, ADS, built(spark, ads, {order[1]: 1})) == order[1:]
    agrees(spark, rows)


def test_a_day_reads_itself_its_predecessor_and_the_state(spark, clean, monkeypatch):
    monkeypatch.setattr(days, "SNAPSHOT_EVERY", 3)
    ads = month(random.Random(9), 7, 12)
    for day in sorted(ads):
        put(spark, ads, [day])
        days.refresh(spark, ADS, built(spark, {d: 0 for d in ads if d <= day}, {}))
    last = sorted(ads)[-1]
    known = days._known(spark, last)
    plan = known._jdf.queryExecution().executedPlan().toString()
    since = days._last_snapshot(spark, last)
    assert since is not None and f"observed_on" in plan and "PartitionFilters: [isnotnull(observed_on" in plan
    read = {f.split("observed_on=")[1][:10] for f in spark.table(days.STATES).where(f"observed_on < DATE'{last}' AND observed_on > DATE'{since}'").inputFiles()}
    assert len(read) < 3 and all(str(since) < d < str(last) for d in read)


def test_states_keep_first_known_attributes(table, rows):
    df = table("k string, day date, a string, b string", *[("x", START + timedelta(days=i), a, b) for i, (a, b) in enumerate([(None, "1"), ("", "1"), (None, "1"), ("z", "1"), ("z", None), ("z", "")])])
    all_at_once = state.states(df, "k", "day", ["a", "b"])
    known, found = None, []
    for r in rows(df.select("day").distinct()):
        one = state.advanced(df.where(df.day == r[0]), state.before(all_at_once, "k", "day", ["a", "b"], r[0]), "k", "day", ["a", "b"])
        found += rows(one)
    assert sorted(found, key=repr) == rows(all_at_once)
    whole = scd2(df, "k", "day", ["a", "b"], "sk")
    closed = state.closed_versions(all_at_once, "k", "day", ["a", "b"], "sk")
    still = state.open_versions(state.before(all_at_once, "k", "day", ["a", "b"]), "k", ["a", "b"], "sk")
    assert rows(closed.unionByName(still)) == rows(whole)
