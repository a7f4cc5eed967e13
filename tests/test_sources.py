"""Reading, writing and the checks around them."""

import pytest
from pyspark.sql import functions as F

from tables import rows
from tarmac import schemas
from tarmac.operators import dedup
from tarmac.session import cluster_settings, shared_dir
from tarmac.sources import readers, writers


def test_first_available(spark, folder, tmp_path):
    df = readers.first_available(spark, [str(tmp_path / "none"), f"{folder}/nation.parquet"])
    assert df.count() == 25
    with pytest.raises(FileNotFoundError):
        readers.first_available(spark, [str(tmp_path / "a"), str(tmp_path / "b")])


def test_required_tables(spark, folder):
    found = readers.read_tables(spark, folder, ["nation", "moon"], suffix=".parquet")
    assert list(found) == ["nation"]
    with pytest.raises(readers.MissingTableError, match="moon"):
        readers.require_tables(found, ["nation", "moon"])


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([("p1", "b1", "1.5", "UPI"), ("p2", "b,2", None, 'a "b"')], schemas.PAYMENTS)
    paths = writers.write_tables({"payments": df}, str(tmp_path), fmt)
    back = readers.read(spark, paths["payments"], fmt, schemas.PAYMENTS)
    assert rows(back) == rows(df)


def test_column_checks(spark):
    df = spark.createDataFrame([(1, 2, 3)], "flight_id int, duration int, `Unnamed: 3` int")
    clean = readers.drop_junk_columns(df)
    assert clean.columns == ["flight_id"]
    assert "airline" in readers.missing_columns(clean, schemas.FLIGHTS)
    assert readers.missing_columns(clean, ["flight_id"]) == []
    with pytest.raises(readers.ColumnCountError):
        readers.rename_by_position(df, ["a"])


def test_empty_report(spark):
    df = spark.range(3)
    got = readers.empty_report({"full": df, "none": df.filter("id > 5")})
    assert rows(got) == [("full", False), ("none", True)]


@pytest.mark.parametrize("block", ["128m", "200"])
def test_file_order(spark, tmp_path, block):
    """'First' follows the files, however they are cut into tasks."""
    for name, lines in (("a", range(0, 60)), ("b", range(60, 90))):
        (tmp_path / f"{name}.csv").write_text("k,v\n" + "".join(f"k{i % 4},v{i:03d}\n" for i in lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        df = readers.with_file_order(readers.read_csv(spark, str(tmp_path), "k string, v string"))
        got = rows(dedup.first_by_key(df, "k", ["_file_order"]).select("k", "v"))
        last = rows(df.groupBy("k").agg(F.max_by("v", "_file_order")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [("k0", "v000"), ("k1", "v001"), ("k2", "v002"), ("k3", "v003")]
    assert last == [("k0", "v088"), ("k1", "v089"), ("k2", "v086"), ("k3", "v087")]


def test_output_contract(spark, tmp_path):
    writers.write_tables({"good": spark.range(2), "empty": spark.range(0)}, str(tmp_path))
    got = writers.check_outputs(
        spark, str(tmp_path), {"good": ["id"], "empty": ["id"], "missing": ["id"], "good/": ["other"]}
    )
    assert rows(got) == [("empty", False, 0), ("good", True, 2), ("good/", False, 2), ("missing", False, 0)]


def test_export_types(spark):
    df = spark.createDataFrame([("b", 1.5, 40.0, None)], "booking_id string, amount double, age double, is_delayed int")
    assert writers.typed_for_export(df).dtypes == [
        ("booking_id", "string"), ("amount", "double"), ("age", "bigint"), ("is_delayed", "bigint"),
    ]
    assert dict(writers.typed_for_model(df).dtypes)["age"] == "bigint"


def test_shared_folder_is_kept(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_cluster_settings():
    got = cluster_settings(100 * 10**12, 4000)
    assert int(got["spark.sql.shuffle.partitions"]) > 400_000
    assert cluster_settings(10**9, 4000)["spark.sql.shuffle.partitions"] == "12000"
