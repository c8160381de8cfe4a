"""Every registered query beside its SQL twin, and layer invariants, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from postings.plans import gold, silver
from verification.compare import connect, difference
from verification.oracle import ORACLE
from verification.queries import QUERIES, Layers

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, con, name):
    assert difference(spark, con, SF, name) is None


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="needs the given tables")
def test_no_query_is_empty_or_only_zeros():
    con = connect(LARGER)
    for name, sql in ORACLE.items():
        frame = con.execute(sql).df()
        assert len(frame), name
        numbers = frame.select_dtypes("number")
        assert numbers.empty or name == "dq_results" or (numbers.fillna(0) != 0).any().any(), name
    # measures that some table once left at zero throughout
    for name, column in [("id_stability", "n_posted_changed"), ("overlap_histogram", "n_queries"), ("repeat_share", "n_extra")]:
        assert con.execute(f"SELECT max({column}) FROM ({ORACLE[name]})").fetchall()[0][0] > 0, name


def test_approximate_quantiles_lie_inside_at_the_gate_scale(spark):
    """A group without any maximum has none on either side."""
    found = QUERIES["salary_approx"](spark, LARGER).collect()
    assert found and all(r.inside is True for r in found)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_fused_and_joined_fact_agree(spark, rows):
    ads = Layers(spark, SF).stored_ads
    joined = gold.fact_by_join(silver.daily(ads), gold.dim_vacancy(ads))
    fused = gold.fact(ads)
    assert rows(fused) == rows(joined)
    assert fused.where("vacancy_sk IS NULL").count() == 0
    assert ads.count() + fused.where("is_gone").count() == fused.count()
