"""Operator 2, n-gram Jaccard join: vertical partitioning of the global n-gram order, partial overlaps summed per pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import components, documents, drop, gram_hashes, let_go, partitions, stored, word_hashes

SETS = "doc_id long, n_shingles long, cls long, first int, prefix array<long>, fragments array<array<long>>"


def shingles(text: bytes | None, k: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the runs of k words, A-Z lower-cased; with fewer words, of the whole sequence."""
    return np.unique(gram_hashes(word_hashes(text.lower()), k)) if text else np.empty(0, np.uint64)


def _planes(x: np.ndarray) -> bytes:
    """Rising integers as differences, byte by byte of all: most high bytes are zero, which the shuffle's compression removes."""
    return np.diff(x, prepend=x.dtype.type(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(x: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(x, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel().astype(np.int64))


#: Bits of the larger map at least and at most: 128 MB bound what is sent out.
FEWEST_BITS, MOST_BITS = 20, 30


def map_bits(docs: DataFrame) -> int:
    """The bits of a map with one for each 12 bytes of text, about two words."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_BITS, max(FEWEST_BITS, (size // 12).bit_length()))


def marks(docs: DataFrame, *, shared_bits: int, heavy_bits: int, heavy: int = 48, k: int = 5, buckets: int | None = None) -> tuple[bytes, bytes]:
    """Two bit maps over leading hash bits: shingles that two or more documents have, and those that heavy or more have.

    All documents count. Their sizes, 2**shared_bits and 2**heavy_bits bits, bound what is sent out. Distinct shingles may share a
    bit: that changes the order of shingles for all documents alike, so candidates grow, and no pair is lost.
    """
    spark = docs.sparkSession
    lead = max(4, (buckets or 4 * partitions(spark)).bit_length() - 1)  # 2**lead buckets, each a slice of either map

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(values, np.arange((1 << lead) + 1, dtype=np.uint64) << np.uint64(32))
            low, times = values.astype(np.uint32), np.minimum(times, 255).astype(np.uint8)
            own = [(b, _planes(low[i:j]), times[i:j].tobytes()) for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if i < j]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*own, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "low", "times"])

        let_go()
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                x = shingles(text, k) >> np.uint64(32 - lead)
                if len(x):
                    held.append(np.unique(x))
                    size += len(x)
                if size > 3_000_000:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
        held = []
        let_go()

    def join(pdf):
        import pandas as pd

        values = np.concatenate([_unplanes(x) for x in pdf["low"]])
        values, at = np.unique(values, return_inverse=True)
        times = np.bincount(at, np.concatenate([np.frombuffer(x, np.uint8) for x in pdf["times"]]))
        out = []
        for bits, least in ((shared_bits, 2), (heavy_bits, heavy)):
            bit = np.zeros(1 << (bits - lead), bool)
            bit[values[times >= least] >> (32 + lead - bits)] = True
            out.append(np.packbits(bit).tobytes())
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "shared": [out[0]], "heavy": [out[1]]})

    counted = docs.select(F.col("text").cast("binary")).mapInArrow(count, "bucket int, low binary, times binary")
    maps = bytearray(1 << (shared_bits - 3)), bytearray(1 << (heavy_bits - 3))
    for row in counted.groupBy("bucket").applyInPandas(join, "bucket int, shared binary, heavy binary").collect():
        for whole, part in zip(maps, (row.shared, row.heavy), strict=True):
            whole[row.bucket * len(part) : (row.bucket + 1) * len(part)] = part
    return bytes(maps[0]), bytes(maps[1])


def sets(docs: DataFrame, *, k: int = 5, fragments: int = 4, **bits) -> DataFrame:
    """Each document's set size and class (a hash of its set); for those that may have a partner, their prefix and their fragments.

    The global order: shingles that no other document has, then the rest by hash, then the heavy ones by hash. Sets that reach
    the threshold meet within the first n - ceil(3n / 4) + 1 shingles of either. Shingles without a partner fill places there
    but are not kept; first is the number of them. fragments: the rest of the set, cut where the global order is: fragments ranges of hashes, and last the heavy ones.
    The maps have a bit for each 12 bytes of text, unless bits says otherwise.
    """
    n = bits.get("shared_bits") or map_bits(docs)
    bits = {"shared_bits": n, "heavy_bits": n - 2} | bits
    maps = docs.sparkSession.sparkContext.broadcast(marks(docs, k=k, **bits))
    cuts = np.array([(i << 64) // fragments for i in range(1, fragments)], np.uint64)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        shared, heavy = (np.frombuffer(x, np.uint8) for x in maps.value)

        def of(bit_map: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
            i = x >> np.uint64(64 - n)
            return (bit_map[i >> np.uint64(3)] >> (7 - (i & np.uint64(7)).astype(np.uint8))) & 1 > 0

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = shingles(text, k)
                if not len(x):
                    rows.append((doc_id, 0, None, None, None, None))
                    continue
                known = x[of(shared, x, bits["shared_bits"])]
                first, keep = len(x) - len(known), len(x) // 4 + 1
                prefix = cut = None
                if first < keep:
                    often = of(heavy, known, bits["heavy_bits"])
                    rare, frequent = known[~often], known[often]
                    prefix = np.concatenate([rare, frequent])[: keep - first].view(np.int64)
                    cut = [y.view(np.int64) for y in (*np.split(rare, np.searchsorted(rare, cuts)), frequent)]
                rows.append((doc_id, len(x), np.uint64(xxhash.xxh3_64_intdigest(x.tobytes())).view(np.int64), None if prefix is None else first, prefix, cut))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SETS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(order, SETS)


def similar(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """Of pairs (a, b) of classes those with 100 * intersection >= 75 * union: overlaps are counted per fragment and summed per pair."""
    cut = kept.select("cls", "n_shingles", F.posexplode("fragments").alias("fragment", "part"))
    b = cut.select(F.col("cls").alias("b"), F.col("n_shingles").alias("nb"), "fragment", F.col("part").alias("pb"))
    a = cut.select(F.col("cls").alias("a"), F.col("n_shingles").alias("na"), "fragment", F.col("part").alias("pa"))
    both = pairs.join(b, "b").join(a, ["a", "fragment"])
    counts = both.groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("pa", "pb"))).alias("common"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return counts.where("7 * common >= 3 * (na + nb)").select("a", "b")


def _close(na: str, ra: str, nb: str, rb: str):
    """Whether two sets may reach the threshold if this shingle, of these ranks, is the first that both have: what comes before it in either is not in the other."""
    return 7 * F.least(F.col(na) - F.col(ra), F.col(nb) - F.col(rb)) >= 3 * (F.col(na) + F.col(nb))


def join(docs: DataFrame, *, k: int = 5, fragments: int = 4, cell: int = 256, **bits) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs; linked are sets of k-word shingles with a Jaccard similarity of 0.75.

    docs: doc_id, text; other columns are left out. Null, empty and blank texts have no shingle, link with nothing and are their own
    component. Equal sets are one class, compared once. Rows that repeat a doc_id with other text count for themselves; component_id
    is the smallest doc_id of all. Null doc_ids stay null and are passed over by that minimum where others are there.

    First every document of a posting list is compared with two hubs only: the class with the fewest shingles that no other document
    has, which is the likeliest to stand in the middle of its copies, and the last by hash. Then, in lists where more than one
    component is left, the pairs across components are compared too, but for those which the first pass had. Every pair that reaches
    the threshold is so either compared or in one component already: none is lost, and a group of copies costs no pairs of its own.
    """
    whole = stored(sets(docs, k=k, fragments=fragments, **bits), "sets")
    kept = stored(whole.where("prefix is not null").dropDuplicates(["cls"]).drop("doc_id"), "classes")
    every = stored(whole.select("doc_id", "n_shingles", "cls"), "named")
    drop(whole)
    rows = kept.select("cls", F.col("n_shingles").alias("n"), "first", F.posexplode("prefix").alias("i", "h")).select("cls", "n", "first", (F.col("first") + F.col("i")).alias("rank"), "h")
    ends = rows.groupBy("h").agg(F.min(F.struct("first", "cls", "n", "rank")).alias("lo"), F.max(F.struct("cls", "n", "rank")).alias("hi"), F.min("cls").alias("least"))
    ends = ends.where("least <> hi.cls").drop("least")
    lists = stored(rows.join(ends, "h"), "lists")
    near = [lists.where(F.col("cls") != F.col(f"{x}.cls")).where(_close("n", "rank", f"{x}.n", f"{x}.rank")).select(F.least(f"{x}.cls", "cls").alias("a"), F.greatest(f"{x}.cls", "cls").alias("b")) for x in ("lo", "hi")]
    first = stored(similar(near[0].union(near[1]).distinct(), kept), "links")
    found = components(first, "a", "b")
    placed = lists.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    several = placed.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("h")
    left = stored(placed.join(several, "h").where("cls <> lo.cls and cls <> hi.cls").select("h", "cls", "n", "rank", "component"), "open")
    drop(lists)
    # a list of n classes is cut into m cells of about cell classes by hash; every two cells meet on their own, so no list is one key
    sizes = left.groupBy("h").agg(F.ceil(F.count("*") / cell).cast("int").alias("m"))
    dealt = left.join(sizes, "h").withColumn("side", F.expr("cast(pmod(xxhash64(cls, 7), m) as int)")).withColumn("o", F.explode(F.expr("sequence(0, m - 1)")))
    dealt = dealt.select("h", F.least("side", "o").alias("x"), F.greatest("side", "o").alias("y"), "side", "cls", "n", "rank", "component")
    other = dealt.select("h", "x", "y", *(F.col(x).alias(f"{x}_b") for x in ("side", "cls", "n", "rank", "component")))
    across = dealt.join(other, ["h", "x", "y"]).where("cls < cls_b and component <> component_b and (x = y or side <> side_b)").where(_close("n", "rank", "n_b", "rank_b"))
    second = stored(similar(across.select(F.col("cls").alias("a"), F.col("cls_b").alias("b")).distinct(), kept), "links")
    drop(left)
    final = components(first.union(second), "a", "b").withColumnRenamed("node", "cls")
    of_class = every.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
    of_class = of_class.join(final, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of_class.select("cls", "component").join(least, "component").select("cls", "component_id")
    return every.select("doc_id", "n_shingles", "cls").join(named, "cls", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir))


#: Components by label propagation over the exact links of the distinct sets.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, len(g) AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS h FROM s),
shared AS (SELECT h FROM e GROUP BY h HAVING count(*) > 1),
f AS (SELECT doc_id, e.h FROM e JOIN shared ON e.h = shared.h),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM f a JOIN f b ON a.h = b.h AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 7 * count(*) >= 3 * (na.n + nb.n)
), reach AS (
  SELECT doc_id, doc_id AS r FROM n UNION SELECT links.x, reach.r FROM reach JOIN links ON links.y = reach.doc_id
)
SELECT n.doc_id, n.n AS n_shingles, min(r) AS component_id FROM n JOIN reach ON reach.doc_id = n.doc_id GROUP BY n.doc_id, n.n
"""
