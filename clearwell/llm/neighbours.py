"""Operator 6, embedding near-dedup: robust-pruned flat graphs over overlapping cluster shards, batched range-expanding greedy search, audited and verified."""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import components, stored

log = logging.getLogger(__name__)


def vectors_of(vectors: DataFrame) -> DataFrame:
    """vec_id, label, v: v is the embedding in doubles, or null where the row links with nothing: its label is null, or its vector is null, empty, zero
    or holds null or non-finite components."""
    good = "label is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)"
    own = vectors.select("vec_id", F.col("label").cast("int").alias("label"), F.expr("transform(embedding, x -> cast(x as double))").alias("v"))
    return own.select("vec_id", "label", F.expr(f"case when coalesce({good}, false) then v end").alias("v"))


def _unit(v) -> np.ndarray:
    x = np.stack([np.asarray(y, np.float64) for y in v])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most k unit centres of unit vectors."""
    random = np.random.default_rng(6)
    c = x[random.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(np.bincount(near, minlength=len(c))[:, None] > 0, sums, c)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def pruned(x: np.ndarray, *, pool: int, degree: int, slack: float) -> np.ndarray:
    """(from, to) of robust-pruned edges of a shard: of each vector's pool nearest, taken nearest first, those that no taken one is closer to by slack.

    All vectors of the shard take their next edge at once; the shard's size bounds the block product.
    """
    n = len(x)
    near = x @ x.T
    np.fill_diagonal(near, -2)
    k = min(pool, n - 1)
    if k < 1:
        return np.empty((0, 2), np.int64)
    own = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < n - 1 else np.argsort(-near, axis=1)[:, :k]
    value = np.take_along_axis(near, own, 1)
    far, alive, out, rows = 2 - 2 * value, np.ones(own.shape, bool), [], np.arange(n)
    for _ in range(degree):
        open_ = rows[alive.any(1)]
        if not len(open_):
            break
        j = np.where(alive[open_], value[open_], -3).argmax(1)
        to = own[open_, j]
        out.append(np.column_stack([open_, to]))
        between = 2 - 2 * np.take_along_axis(near[to], own[open_], 1)
        between[own[open_] == to[:, None]] = 0
        alive[open_] &= slack**2 * between > far[open_]
    return np.concatenate(out)


def build(x: np.ndarray, *, shard: int = 256, overlap: int = 2, pool: int = 48, degree: int = 16, slack: float = 1.2) -> tuple[np.ndarray, np.ndarray, int]:
    """The flat graph of unit vectors, as (starts, neighbours) with edges both ways, and its medoid.

    Every vector is in its overlap nearest of about n / shard clusters; each cluster is pruned on its own, and the adjacency lists are
    united. Clusters over four shards are cut at random, as near copies that no centre parts can fill one. Parts that are left unconnected
    are joined at their medoids, each to the nearest of an earlier part.
    """
    n = len(x)
    c = kmeans(x[np.random.default_rng(7).permutation(n)[: 64 * (n // shard + 1)]], n // shard + 1)
    near = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, : min(overlap, len(c))]
    edges = [np.empty((0, 2), np.int64)]
    for j in range(len(c)):
        own = np.flatnonzero((near == j).any(1))
        own = np.random.default_rng(j).permutation(own) if len(own) > 4 * shard else own
        cuts = np.array_split(own, -(-len(own) // (2 * shard))) if len(own) > 4 * shard else [own]
        for part in cuts:
            if len(part) > 1:
                edges.append(part[pruned(x[part], pool=pool, degree=degree, slack=slack)])
        for a, b in zip(cuts, cuts[1:], strict=False):  # the parts of a cut cluster hang together
            edges.append(np.column_stack([a[: len(b)], b[: len(a)]]))
    e = np.concatenate(edges)
    parts = components_of(n, e)
    medoid = int((x @ x.mean(0)).argmax())
    names, at = np.unique(parts, return_inverse=True)
    if len(names) > 1:
        sums = np.zeros((len(names), x.shape[1]))
        np.add.at(sums, at, x)
        closeness = (x * sums[at]).sum(1)
        order = np.lexsort((-closeness, at))
        heads = order[np.searchsorted(at[order], np.arange(len(names)))]
        sims = np.tril(x[heads] @ x[heads].T, -1) - np.triu(np.full((len(heads),) * 2, 4.0))
        e = np.concatenate([e, np.column_stack([heads[1:], heads[sims[1:].argmax(1)]])])
    key = np.unique(np.concatenate([e[:, 0] * n + e[:, 1], e[:, 1] * n + e[:, 0]]))
    a, b = key // n, key % n
    return np.searchsorted(a, np.arange(n + 1)), b, medoid


def components_of(n: int, edges: np.ndarray) -> np.ndarray:
    """By node the smallest node that undirected edges reach."""
    root = np.arange(n)
    if not len(edges):
        return root
    a, b = edges.T
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _spread(starts: np.ndarray, to: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in nodes, neighbour) of every edge that leaves one of nodes."""
    n = starts[nodes + 1] - starts[nodes]
    at = np.repeat(np.arange(len(nodes)), n)
    return at, to[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[nodes], n)]


def search(x: np.ndarray, graph: tuple[np.ndarray, np.ndarray, int], queries: np.ndarray, least: float, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in queries, node, cosine) of the nodes with a cosine of least to each query node, itself left out.

    All queries walk at once. Each goes greedily from the medoid to ever nearer neighbours; from where it ends, and from the query, the range
    is expanded: every neighbour of a node whose cosine is at least least - margin is looked at, once.
    """
    starts, to, medoid = graph
    at = np.full(len(queries), medoid)
    best, moving = (x[at] * x[queries]).sum(1), np.arange(len(queries))
    while len(moving):
        of, node = _spread(starts, to, at[moving])
        value = np.einsum("ij,ij->i", x[node], x[queries[moving[of]]])
        top = np.full(len(moving), -2.0)
        np.maximum.at(top, of, value)
        hit = value == top[of]
        at_new = at[moving].copy()
        at_new[of[hit]] = node[hit]
        better = top > best[moving]
        at[moving[better]], best[moving[better]] = at_new[better], top[better]
        moving = moving[better]
    seen = np.zeros((len(queries), len(x)), bool)
    rows = np.arange(len(queries))
    seen[rows, queries] = True
    found = [(rows, queries, np.ones(len(queries)))]
    reach = (best >= least - margin) & (at != queries)
    seen[rows[reach], at[reach]] = True
    found.append((rows[reach], at[reach], best[reach]))
    q, node = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    while len(q):
        of, new = _spread(starts, to, node)
        fresh = np.zeros_like(seen)
        fresh[q[of], new] = True
        fresh &= ~seen
        seen |= fresh
        q, node = np.nonzero(fresh)
        value = np.einsum("ij,ij->i", x[node], x[queries[q]])
        keep = value >= least - margin
        q, node, value = q[keep], node[keep], value[keep]
        found.append((q, node, value))
    q, node, value = (np.concatenate(f) for f in zip(*found, strict=True))
    keep = (value >= least) & (node != queries[q])
    return q[keep], node[keep], value[keep]


def brute(x: np.ndarray, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What search() looks for, by comparing with all."""
    near = x[queries] @ x.T
    near[np.arange(len(queries)), queries] = -2
    q, node = np.nonzero(near >= least)
    return q, node, near[q, node]


def verified(v: np.ndarray, a: np.ndarray, b: np.ndarray, value: np.ndarray, least: float) -> np.ndarray:
    """Whether each found pair has a cosine of least: where the unit vectors' product is within 1e-9, the cosine of the vectors themselves decides."""
    ok, close = value >= least, np.flatnonzero(np.abs(value - least) < 1e-9)
    if len(close):
        p, q = v[a[close]], v[b[close]]
        ok[close] = (p * q).sum(1) / (np.sqrt((p * p).sum(1)) * np.sqrt((q * q).sum(1))) >= least
    return ok


CENTRES = "cell long, centres array<array<double>>"
PLACED = "cls long, v array<double>, copies long, cell long, home boolean"
#: Bytes of centres that are sent out at once; with more, the rows are placed in several passes.
SENT = 64 << 20


def place(points: DataFrame, *, limit: int, overlap: int, margin: float, branch: int = 32, sample: int = 128) -> tuple[DataFrame, DataFrame | None]:
    """(rows in shards of at most limit, rows of shards that centres cannot part), each (cls, v, copies, cell, home).

    All vectors of a label start in one shard. Shards over limit are split level by level, by k-means on a sample by hash of about sample rows a
    centre, which is taken in the shard's own task; the number of shards follows the data. A vector's home is its nearest centre. It is a guest at the
    next ones too, overlap shards in all, where it lies within margin, the sine of an angle, of the plane between the two centres.
    """
    spark = points.sparkSession
    whole = points.select("cls", "v", "copies", F.xxhash64("label", F.size("v")).alias("cell"), F.lit(True).alias("home"))
    done, dense, left, before = [], [], stored(whole, "placed"), None
    while True:
        sizes = left.groupBy("cell").agg(F.count("*").alias("n"))
        if before is not None:  # children as large as their parent: near copies that no centre parts
            sizes = sizes.join(before, "cell", "left")
        else:
            sizes = sizes.withColumn("parent", F.lit(None).cast("long"))
        sizes = stored(sizes.withColumn("kind", F.expr(f"case when n <= {limit} then 'done' when n > 0.7 * parent then 'dense' else 'open' end")), "shards")
        kinds = {r.kind: r["count"] for r in sizes.groupBy("kind").count().collect()}
        marked = left.join(sizes.select("cell", "n", "kind"), "cell")
        done.append(marked.where("kind = 'done'").drop("n", "kind"))
        if "dense" in kinds:
            dense.append(marked.where("kind = 'dense'").drop("n", "kind"))
        if "open" not in kinds:
            break
        chosen = marked.where("kind = 'open'").withColumn("k", F.least(F.lit(branch), F.greatest(F.lit(8), F.ceil(4 * F.col("n") / limit))).cast("int"))
        chosen = chosen.where(F.expr(f"pmod(xxhash64(cls, 6), 1000000) < 1000000D * {sample} * k / n"))

        def centres(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"cell": pdf["cell"].iloc[:1], "centres": [list(kmeans(_unit(pdf["v"]), int(pdf["k"].iloc[0])))]})

        table = stored(chosen.groupBy("cell").applyInPandas(centres, CENTRES), "centres")
        size = table.agg(F.sum(F.size("centres") * F.size(F.col("centres")[0]) * 8)).first()[0] or 0
        passes = max(1, -(-size // SENT))
        parts = []
        for i in range(passes):
            own = spark.sparkContext.broadcast({r.cell: np.array(r.centres) for r in table.where(f"pmod(xxhash64(cell), {passes}) = {i}").collect()})

            def deal(batches, own=own):
                for pdf in batches:
                    out = []
                    for cell, g in pdf.groupby("cell"):
                        x, c = _unit(g["v"]), own.value.get(cell)
                        if c is None:  # no row of the sample: the shard stays one, and counts as dense
                            c = x[:1]
                        near = x @ c.T
                        order = np.argsort(-near, axis=1, kind="stable")[:, : min(overlap, len(c))]
                        best = np.take_along_axis(near, order, 1)
                        apart = np.linalg.norm(c[order[:, :1]] - c[order], axis=2)
                        row, j = np.nonzero((best[:, :1] - best <= margin * apart) | (np.arange(order.shape[1]) == 0))
                        part = g.iloc[row]
                        out.append(part.assign(child=order[row, j], home=part["home"].to_numpy() & (j == 0)))
                    yield pd.concat(out)[["cls", "v", "copies", "cell", "home", "child"]] if out else pd.DataFrame(columns=["cls", "v", "copies", "cell", "home", "child"])

            rows = marked.where(f"kind = 'open' and pmod(xxhash64(cell), {passes}) = {i}").select("cls", "v", "copies", "cell", "home")
            parts.append(rows.mapInPandas(deal, PLACED + ", child int"))
        placed = parts[0]
        for p in parts[1:]:
            placed = placed.unionByName(p)
        placed = stored(placed.withColumn("parent_cell", F.col("cell")).withColumn("cell", F.xxhash64("cell", "child")), "placed")
        before = placed.select("cell", "parent_cell").distinct().join(sizes.select(F.col("cell").alias("parent_cell"), F.col("n").alias("parent")), "parent_cell").select("cell", "parent")
        left = placed.select("cls", "v", "copies", "cell", "home")
    every = lambda xs: xs[0] if len(xs) == 1 else every([xs[0].unionByName(xs[1]), *xs[2:]])
    return every(done), every(dense) if dense else None


FOUND = "cls long, home boolean, n long, more long, rep long"


def link(points: DataFrame, *, least: float = 0.93, limit: int = 2048, overlap: int = 2, margin: float = 0.06, slack: float = 0.06, graph: bool = True, block: int = 256) -> DataFrame:
    """(cls, home, n, more, rep) of every class in every shard that it is in: the classes that link with it there and their copies, counted where it is at
    home, and the smallest class that links of the shard reach.

    Every pair is so counted for either class in its own home alone, and no pair leaves a task. Shards that centres cannot part are dealt over
    cells by hash, and every two cells meet in one task. graph=False compares all pairs of a label instead, by the same cells.
    """
    if graph:
        done, dense = place(points, limit=limit, overlap=overlap, margin=margin)
    else:
        done, dense = None, points.select("cls", "v", "copies", F.xxhash64("label", F.size("v")).alias("cell"), F.lit(True).alias("home"))
    zero = F.lit(0)
    groups = [] if done is None else [done.withColumns({"side": zero, "x": zero, "y": zero})]
    if dense is not None:
        m = dense.groupBy("cell").agg(F.ceil(2 * F.count("*") / limit).cast("int").alias("m"))
        cells = dense.join(m, "cell").withColumn("side", F.expr("cast(pmod(xxhash64(cls, 7), m) as int)"))
        cells = cells.withColumn("other", F.explode(F.expr("sequence(0, m - 1)"))).withColumn("x", F.least("side", "other")).withColumn("y", F.greatest("side", "other"))
        groups.append(cells.select("cls", "v", "copies", "cell", "home", "side", "x", "y"))

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cls")
        v = np.stack([np.asarray(y, np.float64) for y in pdf["v"]])
        x, cls, copies, home, side = _unit(v), pdf["cls"].to_numpy(), pdf["copies"].to_numpy(), pdf["home"].to_numpy(), pdf["side"].to_numpy()
        one = bool((pdf["x"] == pdf["y"]).iloc[0])
        n, more, own, edges = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), np.flatnonzero(home), [np.empty((0, 2), np.int64)]
        flat = build(x) if graph and len(own) else None
        for i in range(0, len(own), block):
            part = own[i : i + block]
            q, node, value = search(x, flat, part, least - 1e-9, slack) if graph else brute(x, part, least - 1e-9)
            ok = verified(v, part[q], node, value, least) & (one | (side[part[q]] != side[node]))
            q, node = part[q[ok]], node[ok]
            n += np.bincount(q, minlength=len(x))
            more += np.bincount(q, copies[node], len(x)).astype(np.int64)
            edges.append(np.column_stack([q, node]))
        rep = components_of(len(x), np.concatenate(edges))
        keep = home | (rep != np.arange(len(x)))
        return pd.DataFrame({"cls": cls, "home": home, "n": n, "more": more, "rep": cls[rep]})[keep]

    every = groups[0] if len(groups) == 1 else groups[0].unionByName(groups[1].select(groups[0].columns))
    return every.groupBy("cell", "x", "y").applyInPandas(near, FOUND)


def audit(points: DataFrame, counts: DataFrame, least: float, *, every: int = 100, block: int = 2000) -> tuple[int, int]:
    """(links that brute force finds, of them those in counts (cls, n)): of all classes whose id is divisible by every, in blocks of about block by hash,
    each against all rows. No link below least is ever counted, so the counts compare.

    Adds a row (links, found) to the table recall in the shared folder and logs it.
    """
    chosen = points.where(F.expr(f"pmod(cls, {every}) = 0")).select("cls", "label", "v")
    blocks = -(-chosen.count() // block)
    total, hit = 0, 0
    for i in range(blocks):
        rows = chosen.where(F.expr(f"pmod(xxhash64(cls, 6), {blocks}) = {i}")).collect()
        sent = points.sparkSession.sparkContext.broadcast([(r.cls, r.label, r.v) for r in rows])

        def compare(batches, sent=sent):
            by: dict = {}
            for cls, label, v in sent.value:
                by.setdefault((label, len(v)), []).append((cls, v))
            blocks = {k: (np.array([c for c, _ in own]), np.array([v for _, v in own]), _unit([v for _, v in own]), np.zeros(len(own), np.int64)) for k, own in by.items()}
            for pdf in batches:
                for (label, size), own in pdf.groupby([pdf["label"], pdf["v"].map(len)]):
                    if (label, size) in blocks:
                        ids, w, x, n = blocks[label, size]
                        v, other = np.stack([np.asarray(y, np.float64) for y in own["v"]]), own["cls"].to_numpy()
                        near = _unit(own["v"]) @ x.T
                        a, b = np.nonzero(near >= least - 1e-9)
                        both = np.concatenate([v, w])
                        ok = verified(both, a, len(v) + b, near[a, b], least) & (other[a] != ids[b])
                        n += np.bincount(b[ok], minlength=len(n))
            out = [(int(c), int(k)) for ids, _, _, n in blocks.values() for c, k in zip(ids, n, strict=True) if k]
            yield pd.DataFrame(out, columns=["cls", "truth"])

        truth = points.select("cls", "label", "v").mapInPandas(compare, "cls long, truth long").groupBy("cls").agg(F.sum("truth").alias("truth"))
        own = truth.join(counts, "cls", "left").agg(F.sum("truth"), F.sum(F.coalesce("n", F.lit(0)))).first()
        total, hit = total + (own[0] or 0), hit + (own[1] or 0)
    stored(points.sparkSession.createDataFrame([(total, hit)], "links long, found long"), "recall")
    log.warning("op6_embedding_dedup: recall %d of %d links of audited classes", hit, total)
    return total, hit


def dedup(vectors: DataFrame, *, least: float = 0.93, recall: float = 0.97, overlap: int = 2, margin: float = 0.06, slack: float = 0.06, **options) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding, label); other columns are left out.

    Linked are vectors of equal label with a cosine of least. Vectors that are null, empty, zero or hold null or non-finite components, and
    rows with a null label, link with nothing. Equal vectors of a label are one class, searched once; its members link with each other and with
    all members of linked classes. Rows that repeat a vec_id are rows of their own, each returned; an empty table gives none. If the audit finds less
    than recall, the search is repeated with twice the overlap, five times the margin and a wider range; if that is short too, all pairs of a label are compared.
    """
    named = stored(vectors_of(vectors.select("vec_id", "embedding", "label")), "vectors")
    good = named.where("v is not null")
    points = good.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    twice = points.where("least is not null").groupBy("least").count().where("count > 1").select("least", F.lit(True).alias("twice"))
    # a class is named by its smallest vec_id, unless that is null or names another class too, as repeated vec_ids can
    own = F.expr("case when least is not null and twice is null then least else -1 - pmod(xxhash64(label, v), 9223372036854775807) end")
    points = stored(points.join(twice, "least", "left").withColumn("cls", own).drop("twice"), "points")
    for turn in range(3):
        found = stored(link(points, least=least, overlap=overlap << turn, margin=margin * (1 + 4 * turn), slack=slack * (1 + turn), graph=turn < 2, **options), "links")
        counts = found.where("home").groupBy("cls").agg(F.sum("n").alias("n"), F.sum("more").alias("more"))
        total, hit = audit(points, counts.select("cls", "n"), least)
        if hit >= recall * total:
            break
    comp = components(found.where("cls <> rep"), "cls", "rep").withColumnRenamed("node", "cls")
    of = points.join(counts, "cls", "left").join(comp, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least_of = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(least_of, "component").select("label", "v", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id")
    rows = good.join(of, ["label", "v"]).select("vec_id", "n_links", "component_id")
    rest = named.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return rows.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, label, list_transform(embedding, lambda x: cast(x AS double)) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT links.x, reach.r FROM reach JOIN links ON links.y = reach.vec_id),
c AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id), n AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT c.vec_id, cast(coalesce(n.n, 0) AS bigint) AS n_links, c.component_id, c.vec_id = c.component_id AS kept FROM c LEFT JOIN n ON n.vec_id = c.vec_id
"""
