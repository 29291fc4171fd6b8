import pytest

import __spark_entry__ as entry
from kelpline.plans import catalogue
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_matches_its_sql(spark, sf, name):
    assert same(catalogue.QUERIES[name](spark, sf), catalogue.ORACLES[name], sf) > 0


@pytest.mark.parametrize("name", ["synth_variants", "group_split", "schema_audit", "preflight", "panel_predict"])
def test_query_without_sql_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_temporal_holdout_counts(spark, sf):
    """Mapped and novel queries add up, and the novel ones are those whose name came in the judged year."""
    got = catalogue.QUERIES["temporal_holdout"](spark, sf).first()
    assert got.n_queries == got.n_mapped + got.n_novel == got.auto_matches + got.reviews
    assert got.n_queries == catalogue.name_queries(spark, sf).count()
    novel = [r for r in catalogue.name_queries(spark, sf).collect() if r.target % 5 == 4]
    assert got.n_training < got.n_history and got.n_novel == len(novel) > 0
    assert got.baseline_mrr <= 1 and got.improved + got.worsened + got.unchanged == got.n_mapped


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
