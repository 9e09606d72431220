"""Queries over favourites, on small tables of their own."""

from datetime import date

from __spark_entry__ import queries
from reelframe.operators import similarity


def tables(spark, path):
    part = [(1, "red ring", "Brand#1", "LARGE", 3, 1.0), (2, "blue ring", "Brand#2", "SMALL", 25, 1.0),
            (3, "old bolt", "Brand#1", "PROMO", 26, 1.0), (4, "new bolt", "Brand#1", "LARGE", 40, 1.0)]
    orders = [(10, 5, date(2020, 1, 1)), (11, 6, date(2020, 1, 1)), (12, 9, date(2020, 1, 1))]
    lines = [(10, 1), (10, 3), (11, 1), (11, 2), (11, 4), (12, 2), (12, 3), (11, 4)]
    for name, rows, schema in (
            ("part", part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate date"),
            ("lineitem", lines, "l_orderkey long, l_partkey long")):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")


def test_union_of_film_and_series_ids(spark, tmp_path):
    tables(spark, tmp_path)
    got = queries()["union_ids"](spark, str(tmp_path))
    assert got.columns == ["item"]
    assert sorted(r["item"] for r in got.collect()) == ["1", "2", "3", "4"]


def test_recommend_for_all_does_not_compare_all_pairs(spark, tmp_path, monkeypatch):
    def grid(*args):
        raise AssertionError("every user was dealt to every item")

    tables(spark, tmp_path)
    monkeypatch.setattr(similarity, "_cells", grid)
    found = {}
    for r in queries()["recommend_for_all"](spark, str(tmp_path)).collect():
        found.setdefault((r["userId"].lstrip("0"), r["kind"]), []).append(r["ID"])
    assert {key: sorted(ids) for key, ids in found.items()} == {
        ("5-0", "movies"): ["3", "4", "tt2"], ("5-0", "series"): ["1", "4", "tt2"],
        ("6-0", "movies"): ["3", "4", "tt2"], ("6-0", "series"): ["1", "3", "tt2"]}
