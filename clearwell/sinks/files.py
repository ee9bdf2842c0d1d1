"""Sinks: one CSV file with a header, issue and table appends, the newest export as a copy."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clearwell import fixed

CSV = {"header": True, "escape": '"', "nullValue": "", "emptyValue": "", "lineSep": "\r\n"}


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def one_csv(df: DataFrame, path: str) -> str:
    """df as one CSV file at path, through a folder beside it that is renamed away; for reports of a bounded size."""
    spark, folder = df.sparkSession, f"{path}.{uuid.uuid4().hex}"
    df.coalesce(1).write.options(**CSV).csv(folder)
    fs, at = _hadoop(spark, folder)
    part = next(str(f.getPath()) for f in fs.listStatus(at) if f.getPath().getName().startswith("part-"))
    fs.delete(_hadoop(spark, path)[1], False)
    fs.rename(_hadoop(spark, part)[1], _hadoop(spark, path)[1])
    fs.delete(at, True)
    return path


def export_csv(exported: DataFrame, folder: str, stamp: str) -> str:
    """export_<stamp>.csv with the 15 columns in their order, sorted by file and sample."""
    return one_csv(exported.select(*fixed.EXPORT_COLUMNS).orderBy("source_file", "sample_id"), f"{folder}/export_{stamp}.csv")


def unmatched_csv(tally: DataFrame, path: str) -> str | None:
    """The unmatched schools; without any, an older file goes."""
    if tally.isEmpty():
        fs, at = _hadoop(tally.sparkSession, path)
        fs.delete(at, False)
        return None
    return one_csv(tally, path)


def lookup_csv(lookup: DataFrame, path: str) -> str:
    return one_csv(lookup.select(*fixed.LOOKUP_COLUMNS).orderBy("nces_id"), path)


def append(df: DataFrame, table: str) -> None:
    """Rows to a Parquet table; Spark's committer makes each batch appear as a whole."""
    df.write.mode("append").parquet(table)


def slim_csv(df: DataFrame, path: str) -> str:
    """A state's rows of the directory or the geocodes, as they were filtered and projected."""
    return one_csv(df, path)


def newest(spark: SparkSession, folder: str, n: int = 10) -> list[str]:
    """The newest exports of a folder by their modification time, then by name."""
    fs, at = _hadoop(spark, folder)
    found = [(f.getModificationTime(), f.getPath().getName()) for f in (fs.listStatus(at) if fs.exists(at) else []) if f.getPath().getName().startswith("export_")]
    return [name for _, name in sorted(found, reverse=True)[:n]]


def copy_newest(spark: SparkSession, folder: str, name: str = "master.csv") -> str | None:
    """The newest export of a folder copied to name in it; None without one."""
    own = newest(spark, folder, 1)
    if not own:
        return None
    fs, at = _hadoop(spark, f"{folder}/{own[0]}")
    to = _hadoop(spark, f"{folder}/{name}")[1]
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, fs, to, False, True, spark._jsc.hadoopConfiguration())
    return f"{folder}/{name}"
