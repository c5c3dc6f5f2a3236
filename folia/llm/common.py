"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.session import checkpoint_dir, scratch_folder, ship_by_value

#: Words are maximal runs of characters other than space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def session(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on: UTC, AQE, small Arrow batches (rows
    hold whole texts) and the shared checkpoint folder."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    checkpoint_dir(spark)
    return spark


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there.

    Cuts the lineage: a lost executor re-reads files instead of repeating the
    stages before. Used for narrow frames that several branches read.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Like ``staged``, as Parquet: compressed, and read by column."""
    folder = scratch_folder(df.sparkSession, "written")
    df.write.option("compression", compression).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def own_columns(df: DataFrame) -> list[Column]:
    """All columns by their exact names, dots and backticks included."""
    return [df["`" + c.replace("`", "``") + "`"] for c in df.columns]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row. Catalyst would
    otherwise copy the expression into every lambda that uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def by_value(module_name: str) -> None:
    """Ship a module's functions with the job, so that executors need no copy
    of this package."""
    ship_by_value(sys.modules[module_name])
