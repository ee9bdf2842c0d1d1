"""Operator 8, mixing sources to target weights: a time-varying curriculum whose integrated schedules assign training positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearwell.llm.common import documents, drop, partitions, stored


def words_in(text: str) -> Column:
    return F.expr(f"coalesce(cast(regexp_count({text}, '[^\\\\x20\\\\x09-\\\\x0D]+') as bigint), 0L)")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """sizes (source, source_size) with target, slope: one row a source, all by window functions over the sources.

    The targets are min(most * source_size, level * weight); level is where they sum to share * all sizes. Filled in the order of
    most * source_size / weight, source i is full if the level at which it fills leaves at most the whole for all.
    """
    order = Window.orderBy(F.col("source").isNull(), F.expr("cast(source as binary)"))
    place = (F.row_number().over(order) - 1).alias("place")
    s = sizes.select("source", "source_size", place).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    s = s.withColumn("most", F.col("source_size") * F.lit(float(most))).withColumn("fill", F.col("most") / F.col("weight"))
    whole, up = Window.partitionBy(F.lit(1)), Window.orderBy("fill", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumn("all", F.sum("source_size").over(whole) * F.lit(float(share)))
    s = s.withColumn("rest", F.sum("weight").over(whole) - F.sum("weight").over(up) + F.col("weight")).withColumn("before", F.sum("most").over(up) - F.col("most"))
    s = s.withColumn("level", (F.col("all") - F.col("before")) / F.col("rest"))  # with all earlier sources full
    level = F.min(F.expr("case when fill >= level then struct(fill, place, level) end")).over(whole)["level"]
    s = s.withColumn("target", F.least("most", F.coalesce(level * F.col("weight"), F.col("most"))))
    #: The schedule of source k rises or falls in a line: w(t) = target * (1 + slope * (2 t - 1)).
    return s.select("source", "source_size", "target", ((F.col("place") % 3 - 1) * 0.5).alias("slope"))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, bucket_words: int = 2_000_000) -> DataFrame:
    """docs with size, source_size, target, taken and positions: when in training, from 0 to 1, each use of the document comes.

    A source's documents come in the order of their hash, again and again, as a stream of words; the mix takes the stream's first
    target words, by whole documents: a document is used if the first half of its words lies before the target. So a source's words
    differ from its target by half a document at most, and a document is used most times at most. A use that starts at word x of the stream comes at the time t
    at which the integral of the source's weight schedule, target * ((1 - slope) t + slope t^2), has reached x.

    The place in the stream is a prefix sum in two steps: over buckets of hash ranges, bucket_words words each on average, whose number so follows the source's size,
    and over the documents of a bucket. The tables of sources and buckets are stored, and sent out only if Spark finds them small. Size counts the words of
    the whole text (null: 0). Null sources are one source. A document of size 0 takes nothing and has no position. Rows that repeat a doc_id are rows of
    their own, in the order of size and text; wholly equal rows share out their places in any order. An empty table gives none. Columns that clash with the new names are replaced.
    """
    names = ("size", "source_size", "target", "taken", "positions")
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in names))
    sized = docs.withColumn("size", words_in("text")).withColumn("_at", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(8)))
    narrow = stored(sized.select("source", "size", "_at"), "sizes")
    plan = stored(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    named = plan.withColumnRenamed("source", "_source")
    bucket = F.expr(f"cast(floor((_at / 18446744073709551616D + 0.5D) * (ceil(source_size / {bucket_words}) + 1)) as int)").alias("_b")
    of = lambda rows: rows.join(named, F.col("source").eqNullSafe(F.col("_source")))
    sums = of(narrow).select("source", bucket, "size").groupBy("source", "_b").agg(F.sum("size").alias("_n"))
    before = stored(sums.select(F.col("source").alias("_s"), "_b", (F.sum("_n").over(Window.partitionBy("source").orderBy("_b")) - F.col("_n")).alias("_before")), "buckets")
    drop(narrow)
    joined = of(sized).drop("_source").withColumn("_bucket", bucket)
    at = joined.join(before, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))).drop("_s", "_b")
    inside = Window.partitionBy("source", "_bucket").orderBy("_at", "doc_id", "size", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = at.withColumn("_start", F.col("_before") + F.sum("size").over(inside) - F.col("size"))
    uses = F.expr(f"filter(transform(sequence(0, cast(ceil({float(most)}D) as int)), r -> _start + r * source_size), x -> size > 0 and 2 * x + size <= 2 * target)")
    time = F.expr("transform(_uses, x -> case when slope = 0 then x / target else (sqrt(pow(1 - slope, 2) + 4 * slope * x / target) - (1 - slope)) / (2 * slope) end)")
    at = at.withColumn("_uses", uses).withColumn("positions", time).withColumn("taken", F.col("size") * F.size("_uses"))
    return at.select(*(F.col(f"`{c}`") for c in docs.columns), *names)


def ordered(mixed: DataFrame) -> DataFrame:
    """One row for each use of a document, with its position, range-sorted by position."""
    rows = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return rows.repartitionByRange(partitions(mixed.sparkSession), "position", "doc_id").sortWithinPartitions("position", "doc_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents range-sorted by their first position, those that the mix doesn't take last."""
    rows = mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "positions", F.coalesce(F.get("positions", F.lit(0)), F.lit(1.0)).alias("position"))
    return rows.repartitionByRange(partitions(spark), "position", "doc_id").sortWithinPartitions("position", "doc_id")
