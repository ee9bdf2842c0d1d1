"""Operator 1, best-fit packing: a configuration linear program over the length histogram, priced by knapsack, then rounded."""

from __future__ import annotations

import logging
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearwell.llm import tokens
from clearwell.llm.common import documents, stored, values

log = logging.getLogger(__name__)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, *, size: int = 2048, tokenizer: str | None = None, end_id: int = 0, known: int = 1_200_000) -> DataFrame:
    """Each document's token ids and end_id, cut into pieces of size ids; a longer document's first piece takes what is left over.

    part and nth count the pieces of a length within a task. A null or empty text is end_id alone; a null doc_id stays null.
    """
    path = tokenizer or tokens.default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = tokens.encoder(path, known), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            for doc_id, own in zip(batch.column(0).to_pylist(), encode.runs(values(batch.column(1))), strict=True):
                ids = np.append(np.frombuffer(own, encode.kind).astype("<u4"), np.uint32(end_id))
                first = (len(ids) - 1) % size + 1
                for k, start in enumerate([0, *range(first, len(ids), size)]):
                    own = ids[start : first if k == 0 else start + size]
                    rows.append((doc_id, k, start, len(own), zlib.crc32(own.tobytes()), part, seen[len(own)]))
                    seen[len(own)] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
                names = [x.split()[0] for x in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def _knapsack(lengths: np.ndarray, worth: np.ndarray, size: int) -> tuple[np.ndarray, list[int]]:
    """Unbounded knapsack by dynamic programming over rising lengths: the greatest worth within each capacity, and the length that is taken last there, -1
    where the capacity's last token stays free."""
    best, choice = np.zeros(size + 1), [-1] * (size + 1)
    upto = np.searchsorted(lengths, np.arange(size + 1), side="right").tolist()
    for c in range(int(lengths[0]), size + 1):
        k = upto[c]
        got = worth[:k] + best[c - lengths[:k]]
        j = int(got.argmax())
        if got[j] > best[c - 1]:
            best[c], choice[c] = got[j], j
        else:
            best[c] = best[c - 1]
    return best, choice


def _configuration(lengths: list[int], choice: list[int], capacity: int) -> Counter:
    """The copies of each length that make up the greatest worth within capacity."""
    out: Counter = Counter()
    while capacity > 0:
        j = choice[capacity]
        if j < 0:
            capacity -= 1
        else:
            out[j] += 1
            capacity -= lengths[j]
    return out


def fractional(demand: dict[int, int], size: int, *, eta: float = 0.2, long: float = 0.3, stride: float = 0.5, columns: int = 128, near: float = 0.1, cover: float = 0.9) -> tuple[list[tuple[dict[int, int], float]], float]:
    """A solution of the configuration linear program: ({length: copies}, how many sequences of it) for each configuration, and a lower bound.

    The program covers each length's demand by fractions of configurations, with the fewest sequences. Multiplicative weights solve it: a length's
    weight is exp(-eta * covered share); its price is the weight times its length, the long ones' raised by up to the share long. The knapsack gives
    the configuration of the highest price and, for the columns lengths that are least covered, the best one that holds them, if it is within the share near of the highest. Each
    goes one step: stride times the demand of the length that allows least (one piece at least), or what is left of it. A covered length is out, so there are
    1 / stride steps a length at most. It ends when the share cover of all tokens is covered: what is left joins what rounding leaves. Any prices give a dual bound, the value of the demand over that of the best configuration; the greatest is returned.
    """
    every = np.array(sorted(demand))
    need = np.array([demand[k] for k in every.tolist()], np.float64)
    left, bound, out = need.copy(), float((every * need).sum()) / size, []
    while len(open_ := np.flatnonzero(left > 1e-9 * need)) and (every * left).sum() > (1 - cover) * (every * need).sum():
        lengths, share = every[open_], left[open_] / need[open_]
        price = lengths * (1 + long * lengths / size) * np.exp(-eta * (1 - share))
        best, choice = _knapsack(lengths, price, size)
        bound = max(bound, float((price * need[open_]).sum()) / best[size])
        ls = lengths.tolist()
        found = [_configuration(ls, choice, size)]
        for j in np.argsort(-share, kind="stable")[:columns].tolist():
            if price[j] + best[size - ls[j]] >= (1 - near) * best[size]:
                found.append(_configuration(ls, choice, size - ls[j]) + Counter([j]))
        for copies in found:
            step = min(min(left[open_[j]], max(stride * need[open_[j]], 1.0)) / n for j, n in copies.items())
            if step > 0:
                out.append(({ls[j]: n for j, n in copies.items()}, step))
                for j, n in copies.items():
                    left[open_[j]] -= step * n
    return out, bound


def dual(demand: dict[int, int], size: int, steps: int = 16) -> float:
    """A lower bound by the prices of threshold functions: of a length over size - t a whole sequence, of one below t nothing, else its own share."""
    lengths = np.array(sorted(demand))
    need, bound = np.array([demand[k] for k in lengths.tolist()], np.float64), 0.0
    for t in sorted({size * i // (2 * steps) for i in range(steps + 1)}):
        price = np.where(lengths > size - t, 1.0, np.where(lengths < t, 0.0, lengths / size))
        if price.any():
            bound = max(bound, float((price * need).sum()) / _knapsack(lengths, price, size)[0][size])
    return bound


def solve(histogram: dict[int, int], size: int, **options) -> tuple[list[tuple[int, list[tuple[int, int]]]], float]:
    """(groups (number of sequences, [(length, copies of it in each)]) that hold every piece of the histogram exactly, lower bound on the sequences).

    The linear program's fractions are rounded down to whole sequences. What is left is a smaller histogram, whose program is solved in its turn, until
    rounding down leaves more than half; the rest, which is of the order of a sequence for each configuration of the last program, goes by best fit decreasing into the gaps.
    """
    groups: list[tuple[int, int, list[tuple[int, int]]]] = []  # sequences, room, contents
    left = {k: v for k, v in histogram.items() if v > 0}
    bound = 0.0
    if size in left:
        groups.append((left.pop(size), 0, [(size, 1)]))
    first = True
    while left:
        found, least = fractional(left, size, **options)
        bound, first, rounded, total = (max(least, dual(left, size)) if first else bound), False, 0, sum(k * n for k, n in left.items())
        room = [size - sum(k * n for k, n in copies.items()) for copies, _ in found]
        for i in sorted(range(len(found)), key=lambda i: (room[i], -found[i][1])):
            copies, share = found[i]
            times = min(int(share + 1e-9), min(left.get(k, 0) // n for k, n in copies.items()))
            if times:
                groups.append((times, room[i], sorted(copies.items())))
                for k, n in copies.items():
                    left[k] -= times * n
                rounded += times
        left = {k: n for k, n in left.items() if n}
        if 2 * rounded * size < total:  # most is left
            break
    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            best = min((i for i, (_, room, _) in enumerate(groups) if room >= length), key=lambda i: groups[i][1], default=None)
            if best is None:
                groups.append((-(-count // (size // length)), size, []))
                best = len(groups) - 1
            n, room, inside = groups[best]
            each = min(room // length, count)
            take = min(n, count // each)
            groups[best] = (take, room - each * length, [*inside, (length, each)])
            if take < n:
                groups.append((n - take, room, inside))
            count -= take * each
    return [(n, inside) for n, _, inside in groups if inside], bound + histogram.get(size, 0)


def places(groups: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, copies in each sequence, first sequence, offset of the first copy), by rank."""
    out, ranks, base = {}, Counter(), 0
    for n, inside in groups:
        at = 0
        for length, each in inside:
            out.setdefault(length, []).append((ranks[length], each, base, at))
            ranks[length] += n * each
            at += length * each
        base += n
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(docs: DataFrame, *, size: int = 2048, tokenizer: str | None = None, end_id: int = 0, known: int = 1_200_000) -> DataFrame:
    """Each piece of docs with its sequence_id and offset; the sequences hold at most size tokens and have no gaps before their end.

    docs: doc_id, text; other columns are left out. Null text: an empty one. Rows that repeat a doc_id are packed as often as they come.
    An empty table gives none. To the driver come only the counts of the at most size lengths; what is sent out are the rows of
    places(), at most a few thousand groups of at most size lengths. Ranks within a length are the task's own counts plus the prefix
    sums of the earlier tasks' counts, so no length is gathered in one task. known: pieces of text whose ids a worker remembers at most.
    """
    cut = stored(pieces(docs, size=size, tokenizer=tokenizer, end_id=end_id, known=known), "pieces")
    counts = stored(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = {int(r.length): int(r.n) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    groups, bound = solve(histogram, size)
    log.warning("best-fit packing: %d sequences, at least %.1f needed", sum(n for n, _ in groups), bound)
    at = places(groups)
    before = counts.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = cut.join(before, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length).tolist():
                own, runs = np.flatnonzero(length == k), at[k]
                run = runs[np.searchsorted(runs[:, 0], rank[own], side="right") - 1]
                turn = rank[own] - run[:, 0]
                sequence[own], offset[own] = run[:, 2] + turn // run[:, 1], run[:, 3] + turn % run[:, 1] * k
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(put, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
