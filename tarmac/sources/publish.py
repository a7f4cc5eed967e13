"""Runs that appear as a whole or not at all.

The tables of a run lie in a folder of their own. A run is published by one small file with the places of all its tables,
added to the manifests of the base folder when every table has been written. Readers follow the newest manifest, so
they never see tables of two runs, and a run that dies half-way is not seen at all.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources.readers import read

MANIFESTS = "manifests"
SCHEMA = "number bigint, run string, table_name string, path string"


def run_folder(base: str) -> str:
    """A new folder for the tables of one run."""
    return f"{base}/runs/{uuid.uuid4().hex}"


def manifests(spark: SparkSession, base: str) -> DataFrame:
    """A row for each table of each published run; empty where nothing was published."""
    try:
        return read(spark, f"{base}/{MANIFESTS}", "json", SCHEMA)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def publish(spark: SparkSession, base: str, folder: str, names: list[str]) -> None:
    """Make the tables in `folder` the newest run. One file is added by one rename, so there is no half of a manifest.

    Of two runs published at once both stay; readers follow the one with the greater number and then name.
    """
    last = manifests(spark, base).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    run = folder.rsplit("/", 1)[-1]
    rows = [(last + 1, run, name, f"{folder}/{name}") for name in names]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(f"{base}/{MANIFESTS}")


def published(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of the newest run; none where nothing was published."""
    rows = manifests(spark, base)
    newest = rows.agg(F.max(F.struct("number", "run")).alias("newest")).first()["newest"]
    if newest is None:
        return {}
    own = rows.filter((F.col("number") == newest["number"]) & (F.col("run") == newest["run"]))
    return {r["table_name"]: read(spark, r["path"]) for r in own.collect()}
