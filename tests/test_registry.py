import pytest

from scenequill.plans import more, registry  # noqa: F401  more adds its queries to those of registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, sf_dir, same, name):
    same(registry.QUERIES[name](spark, sf_dir), registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
