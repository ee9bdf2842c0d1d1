"""Operator 10, sharding: extendible hashing; only buckets over the byte limit split on another bit of the hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearwell.llm.common import documents, new_path, stored

#: Bits of the hash, the first of the MD5 of the doc_id as text.
BITS = 56
#: Bits by which the directory grows at a time.
STEP = 8


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """(prefix, upto, depth, shard_bytes, shard_docs): the leaf of each group of documents.

    sizes: hash, bytes. Each round sums the bytes of all prefixes of the next STEP bits, in one aggregation, and ends the buckets
    that fit; only the documents of oversized ones go on. Documents with upto leading bits prefix are in the bucket of the first
    depth bits. A bucket that no bit splits (equal hashes, or one document over the limit) ends at the last bit.
    """
    leaves, left, base = None, sizes, 0
    while base < BITS:
        upto = base + STEP
        fine = stored(left.groupBy(F.shiftright("hash", BITS - upto).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"), F.countDistinct("hash").alias("ids")), "buckets")
        depths = fine.select("prefix", "bytes", "docs", "ids", F.explode(F.sequence(F.lit(base if base == 0 else base + 1), F.lit(upto))).alias("depth"))
        depths = depths.withColumn("own", F.expr(f"shiftright(prefix, {upto} - depth)"))
        sums = depths.groupBy("depth", "own").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"), F.sum("ids").alias("ids"))
        fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("ids") == 1) | (F.col("depth") == BITS))
        leaf = depths.select("prefix", "depth", "own").join(fits, ["depth", "own"]).groupBy("prefix").agg(F.min(F.struct("depth", "shard_bytes", "shard_docs")).alias("leaf"))
        leaf = stored(leaf.select("prefix", F.lit(upto).alias("upto"), "leaf.*"), "leaves")
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        rest = fine.join(leaf, "prefix", "left_anti").select(F.col("prefix").alias("_p"))
        if not rest.head(1):
            break
        left = stored(left.join(rest, F.shiftright("hash", BITS - upto) == F.col("_p"), "left_semi"), "oversized")
        base = upto
    return leaves


def shard(docs: DataFrame, *, limit: int = 4 << 20) -> DataFrame:
    """docs with bytes, shard (the bucket's bits; empty: the only one), depth, page, shard_bytes and oversized.

    bytes: of the text in UTF-8, 0 for null. A null doc_id hashes as an empty text. Every shard fits limit bytes, but for one document that is longer: its
    shard holds it alone and oversized says so. Documents of equal hash that exceed the limit together, as rows that repeat
    a doc_id can, are cut into pages of the bucket by the running sum of their bytes, but for those of over half the limit, which have a page below 0 each; page is 0 elsewhere. An empty table gives no row.
    """
    names = ("bytes", "shard", "depth", "page", "shard_bytes", "oversized")
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in names))
    hashed = docs.withColumn("_hash", F.expr(f"cast(conv(substring(md5(coalesce(cast(doc_id as string), '')), 1, {BITS // 4}), 16, 10) as bigint)")).withColumn("bytes", F.expr("coalesce(octet_length(text), 0)").cast("long"))
    leaves = directory(stored(hashed.select(F.col("_hash").alias("hash"), "bytes"), "sizes"), limit)
    places = None
    for upto in range(STEP, BITS + 1, STEP):
        own = leaves.where(F.col("upto") == upto).select(F.col("prefix").alias("_p"), F.col("upto").alias("_u"), "depth", "shard_bytes", "shard_docs")
        places = own if places is None else places.unionByName(own)
    uptos = [r[0] for r in leaves.select("upto").distinct().orderBy("upto").collect()]  # one for each STEP bits
    found = None
    for upto in uptos:
        part = hashed.withColumn("_p", F.shiftright("_hash", BITS - upto)).join(places.where(F.col("_u") == upto), "_p").drop("_p", "_u")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = hashed.withColumns({"depth": F.lit(0), "shard_bytes": F.lit(0).cast("long"), "shard_docs": F.lit(0).cast("long")})
    bits = F.expr(f"case when depth = 0 then '' else substring(lpad(bin(_hash), {BITS}, '0'), 1, depth) end")
    found = found.withColumn("shard", bits)
    fits = found.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)).withColumn("page", F.lit(0).cast("long"))
    crowded = found.where((F.col("shard_bytes") > limit) & (F.col("shard_docs") > 1))
    # documents of over half the limit are alone; the others' pages are half the limit by running sum, which one more document cannot overrun
    running = Window.partitionBy("shard", "_large").orderBy("doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    crowded = crowded.withColumn("_large", F.col("bytes") > limit // 2)
    crowded = crowded.withColumn("page", F.when(F.col("_large"), -F.count("*").over(running)).otherwise(F.floor((F.sum("bytes").over(running) - F.col("bytes")) / max(1, limit // 2)))).drop("_large")
    crowded = crowded.withColumn("shard_bytes", F.sum("bytes").over(Window.partitionBy("shard", "page")))
    every = fits.unionByName(crowded).withColumn("oversized", F.col("shard_bytes") > limit)
    return every.select(*(F.col(f"`{c}`") for c in docs.columns), *names)


def write(docs: DataFrame, folder: str, **options) -> DataFrame:
    """Writes docs as Parquet, a folder for each shard, and returns them read again."""
    sharded = shard(docs, **options).withColumn("shard", F.concat(F.lit("b"), "shard"))
    sharded.repartition(F.col("shard"), F.col("page")).write.partitionBy("shard", "page").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir)).select("doc_id", "bytes", "shard", "depth", "page", "shard_bytes", "oversized")


#: The bucket of the fewest leading bits that fits; no table of the driver has equal hashes, so there are no pages.
ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS bytes, substr(md5(coalesce(cast(doc_id AS varchar), '')), 1, 14) AS h FROM documents
), b AS (
  SELECT doc_id, bytes, array_to_string(list_transform(range(1, 15), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][instr('0123456789abcdef', h[i])]), '') AS bits FROM d
), p AS (SELECT doc_id, bytes, unnest(range(0, 57)) AS depth, bits FROM b),
s AS (
  SELECT doc_id, bytes, depth, substr(bits, 1, depth) AS shard, sum(bytes) OVER w AS shard_bytes, count(*) OVER w AS docs FROM p WINDOW w AS (PARTITION BY depth, substr(bits, 1, depth))
), f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS k FROM s WHERE shard_bytes <= 4194304 OR docs = 1 OR depth = 56)
SELECT doc_id, cast(bytes AS bigint) AS bytes, shard, cast(depth AS integer) AS depth, cast(0 AS bigint) AS page, cast(shard_bytes AS bigint) AS shard_bytes, shard_bytes > 4194304 AS oversized FROM f WHERE k = 1
"""

__all__ = ["directory", "new_path", "op10_sharding", "shard", "write"]
