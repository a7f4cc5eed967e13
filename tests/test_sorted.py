"""Row order: of the sorted queries, and of tables stored in order."""

import random

import pytest
from pyspark.sql import functions as F

from tarmac import catalog
from tarmac.sources import sorted_files as sf
from tarmac.verification import compare
from tarmac.verification.oracle import ORACLE_SQL

BOTTOM_UP = f"SELECT * FROM ({ORACLE_SQL['bottom_up_order']}) ORDER BY avg_duration_mins, route DESC"
SORTED = {"sort_single": None, "sort_multi": None, "topk": None, "bottom_up_order": BOTTOM_UP}


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


@pytest.mark.parametrize("name", sorted(SORTED))
def test_rows_come_in_order(spark, con, folder, name):
    assert compare.first_out_of_order(spark, con, folder, name, SORTED[name]) is None


@pytest.mark.parametrize("name", sorted(SORTED))
def test_other_orders_are_found(spark, con, folder, name, monkeypatch):
    """The comparison sees it when a query loses its order."""
    real = catalog.QUERIES[name]
    monkeypatch.setitem(catalog.QUERIES, name, lambda s, f: real(s, f).orderBy(F.rand(3)))
    assert compare.first_out_of_order(spark, con, folder, name, SORTED[name]) is not None


ORDER = [("a", False), ("b", True), ("id", False)]


def table(spark, n=400):
    random.seed(8)
    a, b = [None, "x", "y", "z"], [None, 0.5, 1.5, float("nan"), -2.0]
    made = [(random.choice(a), random.choice(b), i) for i in range(n)]
    return spark.createDataFrame(made, "a string, b double, id int").repartition(5)


def report(spark, path, block_rows=7):
    return tuple(sf.order_report(spark, path, ORDER, block_rows).first())


def test_stored_in_order_with_borders(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "t")
    # Several files: the small table would be merged into one otherwise.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        sf.write_sorted(df, path, ORDER)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    kept = sf.read_borders(spark, path).orderBy("_file").collect()
    assert len(kept) > 1 and sum(r["_rows"] for r in kept) == 400
    assert report(spark, path) == report(spark, path, 10**6) == (400, 0, 0, 0)
    wanted = [r["id"] for r in df.orderBy(*sf.sort_columns(ORDER)).collect()]
    placed = sf.positions(spark, path).orderBy("position").collect()
    assert [r["id"] for r in placed] == wanted
    assert [r["position"] for r in placed] == list(range(1, 401))


def test_unsorted_files_are_reported(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "t")
    df.write.parquet(path)
    sf.borders(sf.placed(spark, path), ORDER).write.parquet(sf.borders_path(path))
    total, in_files, between, changed = report(spark, path)
    assert (total, changed) == (400, 0) and in_files > 100 and between > 0
    # The size of the blocks makes no difference.
    assert report(spark, path, 1000) == report(spark, path, 1) == (total, in_files, between, changed)


def test_sorted_files_in_the_wrong_order(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "t")
    df.repartition(3, "id").sortWithinPartitions(*sf.sort_columns(ORDER)).write.parquet(path)
    sf.borders(sf.placed(spark, path), ORDER).write.parquet(sf.borders_path(path))
    total, in_files, between, changed = report(spark, path)
    assert (total, in_files, changed) == (400, 0, 0) and between > 0


def test_files_that_came_later_are_reported(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "t")
    sf.write_sorted(df, path, ORDER)
    df.filter("id < 3").coalesce(1).write.mode("append").parquet(path)
    assert report(spark, path)[3] == 1


def test_several_files_of_one_task(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "30")
    try:
        sf.write_sorted(table(spark), path, ORDER)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sf.read_borders(spark, path).count() >= 400 / 30
    assert report(spark, path) == (400, 0, 0, 0)
    assert [r["position"] for r in sf.positions(spark, path).orderBy("position").collect()] == list(range(1, 401))


def test_an_empty_table_is_in_order(spark, tmp_path):
    path = str(tmp_path / "t")
    sf.write_sorted(table(spark).limit(0), path, ORDER)
    assert report(spark, path) == (0, 0, 0, 0)
    assert sf.positions(spark, path).count() == 0


def test_repeated_rows_have_places_of_their_own(spark, tmp_path):
    path = str(tmp_path / "t")
    sf.write_sorted(spark.createDataFrame([("x", 1.0, 1)] * 9, "a string, b double, id int"), path, ORDER)
    assert report(spark, path, 2) == (9, 0, 0, 0)
    assert sorted(r["position"] for r in sf.positions(spark, path).collect()) == list(range(1, 10))
