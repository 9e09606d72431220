"""Pages and lookups of clustered tables: the rows of the plain operators from a few files."""

import pytest
from pyspark.sql import functions as F

from reelframe.operators.paging import keyset_page
from reelframe.sinks.clustered import ClusteredTable


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    # A third of the rows share one key, some have none.
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 400 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    table = ClusteredTable(str(tmp_path_factory.mktemp("clustered") / "t"), "k")
    table.write(df, files=24)
    return df, table


def keys(df):
    return [r["k"] for r in df.collect()]


@pytest.mark.parametrize("after", [None, -5, 0, 3, 499, 500, 501, 3000, 5990, 5999, 9999])
@pytest.mark.parametrize("n", [1, 7, 300])
def test_a_page_reads_a_few_files(spark, tables, n, after):
    df, table = tables
    page = table.page(spark, n, after)
    assert keys(page) == keys(keyset_page(df, "k", n, after))
    assert len(page.inputFiles()) <= 4


def test_pages_in_a_row_give_all_keys(spark, tables):
    df, table = tables
    seen, after = [], 500
    while page := keys(table.page(spark, 700, after)):
        seen += page
        after = page[-1]
    assert seen == sorted(k for k in keys(df) if k is not None and k > 500)


def test_lookups_read_the_files_of_their_keys(spark, tables):
    df, table = tables
    for values in ([], [None], [4], [4, 4, 5999, 777777], [500]):
        found = table.select(spark, values)
        want = df.where(F.col("k").isin([v for v in values if v is not None] or [-1]))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
        assert len(found.inputFiles()) <= 2 * len(values) or values == [500]
    # The hot key lies in several files, each of a bounded size.
    assert len(table.select(spark, [500]).inputFiles()) > 4
    assert spark.read.parquet(table.bounds).agg(F.max("n_rows")).first()[0] < 1000


def test_empty_tables_and_text_keys(spark, tmp_path):
    table = ClusteredTable(str(tmp_path / "empty"), "k")
    table.write(spark.createDataFrame([], "k string, v long"))
    assert table.page(spark, 5).count() == 0 and table.select(spark, ["a"]).count() == 0
    table = ClusteredTable(str(tmp_path / "with a blank"), "k")
    table.write(spark.createDataFrame([("é",), ("b",), ("b",), (None,)], "k string"), files=3)
    assert keys(table.page(spark, 9)) == [None, "b", "b", "é"] and keys(table.page(spark, 9, "b")) == ["é"]
