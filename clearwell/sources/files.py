"""Sources: archived directory files, lookups, page extraction by a reader that is given."""

from __future__ import annotations

import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell import fixed

DIRECTORY = ("NCESSCH", "LEAID", "SCH_NAME", "LEA_NAME", "LSTREET1", "LSTREET2", "LCITY", "LSTATE", "LZIP")


def largest_member(archive: str, folder: str, ending: str = ".csv") -> str:
    """The largest file of an archive with the ending, unpacked to folder."""
    with zipfile.ZipFile(archive) as z:
        found = [x for x in z.infolist() if x.filename.lower().endswith(ending)]
        if not found:
            raise RuntimeError(f"no {ending} file in {archive}")
        return z.extract(max(found, key=lambda x: x.file_size), folder)


def directory(spark: SparkSession, path: str) -> DataFrame:
    """A school directory, all strings, with its nine required columns, NMCNTY (empty if it is missing) and the row number rec_idx."""
    d = spark.read.csv(path, header=True, encoding="UTF-8", escape='"')
    missing = [c for c in DIRECTORY if c not in d.columns]
    if missing:
        raise RuntimeError(f"columns missing: {missing}")
    return _numbered(d.withColumn("NMCNTY", F.col("NMCNTY") if "NMCNTY" in d.columns else F.lit("")).select(*DIRECTORY, "NMCNTY"))


def geocodes(spark: SparkSession, path: str) -> DataFrame:
    """Geocodes as CSV or Parquet; the state is STATE, else LSTATE; file_row is the place in the file."""
    g = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.csv(path, header=True, escape='"')
    state = "STATE" if "STATE" in g.columns else "LSTATE"
    return _numbered(g.select("NCESSCH", F.col("LAT").try_cast("double").alias("LAT"), F.col("LON").try_cast("double").alias("LON"), F.col(state).alias("STATE")), "file_row")


def lookup(spark: SparkSession, path: str) -> DataFrame:
    d = spark.read.csv(path, header=True, escape='"')
    if d.isEmpty():
        raise RuntimeError("the lookup is empty")
    return _numbered(d.select(*fixed.LOOKUP_COLUMNS))


def _numbered(df: DataFrame, name: str = "rec_idx") -> DataFrame:
    """With rising numbers in the order of the file; they need not be dense."""
    return df.withColumn(name, F.monotonically_increasing_id())


PAGES = "file_hash string, page_num int, raw_text string, error string"


def extracted(files: DataFrame, reader: Callable[[bytes], Iterator[str]]) -> DataFrame:
    """A row for each page of files (file_hash, content). A reader that fails gives one row with the error: the pages before it don't count."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for file_hash, content in zip(pdf["file_hash"], pdf["content"], strict=True):
                try:
                    rows += [(file_hash, i, t, None) for i, t in enumerate(reader(bytes(content)))]
                except Exception as e:  # noqa: BLE001  any fault of a file is that file's
                    rows = [r for r in rows if r[0] != file_hash] + [(file_hash, None, None, str(e))]
            yield pd.DataFrame(rows, columns=["file_hash", "page_num", "raw_text", "error"])

    return files.select("file_hash", "content").mapInPandas(read, PAGES)
