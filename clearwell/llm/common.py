"""What the training-data operators share: stored tables, words, hashes and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes that end a word: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary folder, on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = kept.get() if kept.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="clearwell-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """df, written to the shared folder and read again: its lineage is cut and a lost executor takes nothing with it."""
    spark, path = df.sparkSession, new_path(df.sparkSession, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Deletes the files of tables of stored() that nothing will read again."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


_held: dict[str, object] = {}


def let_go() -> None:
    """Frees what held() keeps in this process and gives free memory back to the system: tasks of later stages run in the same workers."""
    _held.clear()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def held(key: str, make):
    """What make() gives, kept in this process under key until another key is asked for: the tasks of a worker share one model and what it has learned."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def values(column: pa.Array, n: int = 256):
    """The values of a column; n at a time are Python objects."""
    return (x for i in range(0, len(column), n) for x in column.slice(i, n).to_pylist())


def some(rows: list, n: int = 400):
    """Runs of n rows: a model learns the new words of a run at once."""
    return (rows[i : i + n] for i in range(0, len(rows), n))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 1 << 17)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            _powers[name] = np.multiply.accumulate(powers)
    return _powers["up"], _powers["down"]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of data, in order. A word is a run of bytes other than 0x20 and 0x09 to 0x0D."""
    if not data:
        return np.empty(0, np.uint64)
    a = np.frombuffer(data, np.uint8)
    up, down = _powers_to(len(a) + 1)
    inside = np.zeros(len(a) + 2, np.int8)
    inside[1:-1] = ~SPACE[a]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words; with fewer words, one of the whole sequence; of none, none."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(BASE) + words[i : n - k + 1 + i]
    return mixed(out)


def components(edges: DataFrame, a: str, b: str, *, rows: int = 200_000) -> DataFrame:
    """(node, component): each node of the undirected edges with the smallest node that it can reach.

    Alternating large and small stars; every round is written to the shared folder, the one before it goes, and only its size and checksum come to the
    driver. The edges are dealt by node over a task for each rows of them, the session's shuffle partitions at most, which serves a whole star.
    """
    spark = edges.sparkSession
    both = lambda e: e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    sign = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def star(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return pairs.join(least, "u")

    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    seen = sign(e)
    n = max(1, min(partitions(spark), -(-seen[0] // rows)))
    while seen[0]:
        large = star(both(e).repartition(n, "u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").repartition(n, "u").distinct()
        down = star(large)
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).where("u <> v").repartition(n, "u").distinct()
        before, e = e, stored(small, "edges")
        drop(before)
        now = sign(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
