"""Tables between the steps of an operator."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.session import delete_path, materialize


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder, read it back, and let go of what made it.

    The shuffle files behind a written table are of no more use; Spark deletes them once its driver has
    collected the plans that name them, which may otherwise be much later than the disk is needed.
    """
    spark = df.sparkSession
    out = materialize(df, label)
    del df
    for _ in range(2):  # what the first pass lets go of names the shuffles that the second one finds
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a settled table that no later step reads."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def fold(docs: DataFrame, *needed: str) -> DataFrame:
    """``needed`` columns as they are and all others inside one struct ``_row``, where their names clash with nothing."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*[F.col(c) for c in needed if c in docs.columns],
                       F.struct(F.lit(None).cast("int").alias("_none"), *rest).alias("_row"))


def unfold(df: DataFrame, columns: list[str], *needed: str) -> DataFrame:
    """The columns of the table before ``fold`` by ``needed``, in its order; what an operator added is left out."""
    return df.select(*[F.col(c) if c in needed else F.col("_row").getField(c).alias(c) for c in columns])
