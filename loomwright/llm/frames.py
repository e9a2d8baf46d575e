"""Input shapes the operators of this package share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def nonblank(text: str = "text"):
    """Texts with at least one visible sign (cheap test; the folds settle the rest)."""
    return F.col(text).isNotNull() & F.col(text).rlike(r"(?U)\S")


def collection(source_file: str = "source_file"):
    """``data/raw/<collection>/<file>`` -> collection; null stays null."""
    return F.regexp_extract(F.col(source_file), r"([^/]+)/[^/]*$", 1)
