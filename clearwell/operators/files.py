"""Files: scan order, content hashes, what was seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scan(spark: SparkSession, folder: str, limit: int = 0, *, content: bool = False) -> DataFrame:
    """PDF files below folder, lower-case endings first, each kind by path; the first limit of them if that is over 0. path, scan_idx, length, modificationTime, file_hash,
    and with content the file's bytes.

    A file is hashed where it is read; only its path and hash are shuffled and numbered.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).where(F.col("path").rlike(r"\.(pdf|PDF)$"))
    found = files.select("path", "length", "modificationTime", F.sha2("content", 256).alias("file_hash"), F.col("path").endswith(".PDF").alias("late")).dropDuplicates(["path"])
    found = found.withColumn("scan_idx", F.row_number().over(Window.orderBy("late", "path"))).drop("late")  # one narrow row a file
    found = found.where(F.col("scan_idx") <= limit) if limit > 0 else found
    return files.select("path", "content").join(F.broadcast(found) if limit > 0 else found, "path") if content else found


def first_of_content(files: DataFrame, order: str = "scan_idx", key: str = "file_hash") -> DataFrame:
    """files with outcome: ingested for the first of each content, else skipped. A row's content groups by its hash; the first is an aggregate, not a window, so a hot content costs no large task."""
    first = files.groupBy(key).agg(F.min(order).alias("_first"))
    return files.join(first, key).withColumn("outcome", F.when(F.col(order) == F.col("_first"), "ingested").otherwise("skipped")).drop("_first")


def unseen(files: DataFrame, history: DataFrame, key: str = "file_hash", *, retry_failed: bool = False) -> DataFrame:
    """files whose content history does not hold. A failed document blocks its content too, unless retry_failed."""
    known = history.where("status <> 'failed'") if retry_failed else history
    return files.join(known.select(key).distinct(), key, "left_anti")


def unseen_names(remote: DataFrame, local: DataFrame, *, once: bool = False) -> DataFrame:
    """remote rows whose name, in lower case, local does not hold. Rows of one name are all new, unless once: then the first by id."""
    new = remote.withColumn("_k", F.lower("name")).join(local.select(F.lower("name").alias("_k")).distinct(), "_k", "left_anti")
    if once:
        new = new.join(new.groupBy("_k").agg(F.min("id").alias("_i")), "_k").where("id = _i").drop("_i")
    return new.drop("_k")


def outcomes(files: DataFrame) -> DataFrame:
    """files (outcome, failed) with what the run makes of each: skipped stays, and of the others those that could not be opened failed."""
    return files.withColumn("outcome", F.when((F.col("outcome") == "ingested") & F.coalesce("failed", F.lit(False)), "failed").otherwise(F.col("outcome")))


def counters(files: DataFrame) -> DataFrame:
    """One row: ingested, skipped, failed, total."""
    return files.agg(*(F.count_if(F.col("outcome") == x).alias(x) for x in ("ingested", "skipped", "failed")), F.count("*").alias("total"))
