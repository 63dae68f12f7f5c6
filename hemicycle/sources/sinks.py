"""Sinks on plain Parquet folders: overwrite, append and upsert."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from hemicycle.operators.updates import upsert


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save(df: DataFrame, path: str, key: str) -> None:
    """Upsert by key: the merged table is written beside the old one and swapped in by two renames. Between
    them no table exists, which a reader has to retry; if the second fails, the old table is put back."""
    spark = df.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        df.write.parquet(path)
        return
    draft, old = (f"{path}.{uuid.uuid4().hex}.{kind}" for kind in ("new", "old"))
    upsert(spark.read.parquet(path), df, key).write.parquet(draft)
    if not system.rename(target, jvm.Path(old)):
        raise OSError(f"{path} could not be moved")
    if not system.rename(jvm.Path(draft), target):
        system.rename(jvm.Path(old), target)
        raise OSError(f"{draft} could not be moved to {path}")
    system.delete(jvm.Path(old), True)
