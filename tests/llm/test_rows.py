"""Columns whose names clash with ours, repeated rows, and what is left of staged tables."""

import pytest

from scenequill.llm import common, exact_dedup, mixing, simhash, suffix_rules

NAMES = ["_id", "_rk", "row", "__id", "__rk", "__n", "__copy", "__copies", "node", "digest", "h", "copies", "key"]
SCHEMA = "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in NAMES)


@pytest.fixture(scope="module")
def clashing(spark):
    text = lambda i: " ".join(f"word{i * 100 + k}" for k in range(60))
    rows = [(i, text(i), "a", *[f"{n}{i}" for n in NAMES]) for i in range(1, 6)]
    rows += [(6, text(1), "a", *[f"{n}6" for n in NAMES]), rows[1], rows[1]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("step, ids", [(suffix_rules.quality_filter, None), (exact_dedup.exact_dedup, {2, 3, 4, 5, 6}), (simhash.near_dedup, {1, 2, 3, 4, 5})])
def test_clashing_columns_pass_untouched(clashing, step, ids):
    out = step(clashing)
    assert out.columns == clashing.columns
    rows = out.collect()
    assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in NAMES)
    if ids:
        assert sorted(r["doc_id"] for r in rows) == sorted(ids)


def test_mix_carries_clashing_columns(clashing):
    out = mixing.mix(clashing)
    assert out.columns == clashing.columns
    assert all(r[n] == f"{n}{r['doc_id']}" for r in out.collect() for n in NAMES)


def test_index_decides_in_the_second_batch(spark, tmp_path):
    index = exact_dedup.new_index(spark)
    first = spark.createDataFrame([(8, "Same"), (9, "same"), (7, "one")], "doc_id long, text string")
    then = spark.createDataFrame([(1, "SAME"), (2, "two"), (3, "two")], "doc_id long, text string")
    a = {r["_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.dedup_members(first, index).collect()}
    b = {r["_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.dedup_members(then, index).collect()}
    assert a == {8: (9, False), 9: (9, True), 7: (7, True)}
    assert b == {1: (9, False), 2: (3, False), 3: (3, True)}
    table = index.table
    index.close()
    assert not spark.catalog.tableExists(table)


def test_staged_tables_can_be_discarded(spark):
    df = common.stage(spark.range(5), "some")
    path = df.staged_at
    assert df.count() == 5
    common.discard(df)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
