"""Every registered query against its SQL, over whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import connect, difference


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, sf_dir, name, capsys):
    df = queries()[name](spark, sf_dir)
    df.explain()
    plan = capsys.readouterr().out
    assert not [bad for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if bad in plan]
    got = df.toPandas()
    if name in oracle_sql():
        assert difference(got, db.execute(oracle_sql()[name]).df()) is None
    else:
        assert len(got) > 0


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["user_id", "rank", "item_id", "score"]
