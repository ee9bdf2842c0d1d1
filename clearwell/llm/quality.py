"""Operator 9, quality rules: modified Kneser-Ney models of words after words and of their spelling in each language, in sorted arrays, and perplexity bands per language."""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.binary import _local
from clearwell.llm.common import SPACE, documents, drop, gram_hashes, held, new_path, some, stored, word_hashes

SYMBOLS = b"#*$%&|<>"
#: A word's edge in its spelling: a byte that no word holds.
EDGE = 0x20
#: The counts are cut by the leading bits of the hash into 2**BITS files.
BITS = 6
#: Words are numbered by kind: those of both halves first, then by the binary logarithm of their count, frequent ones first.
KINDS = 128
#: Words a range of word pairs, about, and word numbers a block of their sums.
RANGE, BLOCK = 4_000_000, 1 << 18
#: What is kept of a word, by half: distinct words before it, words after it, and the mass that they leave to the shorter model.
SUMS = np.dtype([("before", "<u4", 2), ("after", "<i8", 2), ("left", "<f4", 2)])
#: A text is scored by the counts of the other half of the texts.
HALF = "cast(pmod(xxhash64(text, 9), 2) as int)"
GROUP = "coalesce(lang, '')"


def spellings(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The code of every byte trigram of the words, each lower-cased between two leading edges and a final one, and the word that it is in."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a = np.frombuffer((b"  " + b"   ".join(words) + b" ").lower(), np.uint8).astype(np.int64)
    code = (a[:-2] << 16) + (a[1:-1] << 8) + a[2:]
    inside = (a[2:] != EDGE) | (a[1:-1] != EDGE)  # the last byte of a trigram is a letter, or the edge that ends a word
    inside &= ~((a[1:-1] == EDGE) & (a[2:] == EDGE))
    end = inside & (a[2:] == EDGE)
    of = np.cumsum(end) - end
    return code[inside], of[inside]


def _discounts(n: np.ndarray) -> np.ndarray:
    """The three discounts of modified Kneser-Ney smoothing, for counts of 0, 1, 2, 3 and more, from the numbers of counts of 1 to 4; never 0, so that unseen words keep a mass."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    return np.clip(np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]), [0, 0.05, 0.05, 0.05], [0, 0.95, 1.9, 2.9])


def _of_counts(n: np.ndarray) -> np.ndarray:
    return np.array([(n == i).sum() for i in (1, 2, 3, 4)])


def _smoothed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The discounted share of each gram in its context (code >> 8), the contexts, the mass that each leaves to the shorter grams, and each gram's context."""
    off = _discounts(_of_counts(n))[np.minimum(n, 3)]
    contexts, at = np.unique(code >> 8, return_inverse=True)
    total = np.bincount(at, n)
    return (n - off) / total[at], contexts, np.bincount(at, off) / total, at


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equally many integers that aren't negative, each as its planes of bytes, compressed."""
    head, planes = [len(columns[0]), len(columns)], []
    for x in columns:
        size = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 0
        planes += [pa.compress(plane.tobytes(), "zstd", asbytes=True) for plane in x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T]
        head += [size, *map(len, planes[len(planes) - size :])]
    return np.array([len(head), *head], "<u4").tobytes() + b"".join(planes)


def unpacked(data: bytes) -> list[np.ndarray]:
    head, view = np.frombuffer(data, "<u4", int(np.frombuffer(data, "<u4", 1)[0]), 4).tolist(), memoryview(data)
    n, many, i, at, out = head[0], head[1], 2, 4 * len(head) + 4, []
    for _ in range(many):
        x = np.zeros((n, 8), np.uint8)
        for j, length in enumerate(head[i + 1 : i + 1 + head[i]]):
            x[:, j] = np.frombuffer(pa.decompress(view[at : at + length], n, "zstd"), np.uint8)
            at += length
        i += 1 + head[i]
        out.append(x.view("<u8")[:, 0])
    return out


def packed_pairs(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending distinct pairs (first << 32 | second) and their counts: the first words' steps, and the second words, as steps where the first stays."""
    first, second = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
    step = np.diff(first, prepend=np.uint64(0))
    new = step > 0
    new[:1] = True
    return packed(step, np.where(new, second, np.diff(second, prepend=np.uint64(0))), n)


def unpacked_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    step, second, n = unpacked(data)
    new = step > 0
    new[:1] = True
    sums = np.cumsum(second)
    second = sums - (sums - second)[np.flatnonzero(new)][np.cumsum(new) - 1]
    return (np.cumsum(step) << np.uint64(32)) | second, n


def _summed(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sums of their counts."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    k, c = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(k, kind="stable")  # of sorted runs
    k, c = k[order], c[order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[at], np.add.reduceat(c, at)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(value, rows) of each run of equal values in the first column."""
    at, own = None, []
    for batch in batches:
        for value, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own and value != at:
                yield at, own
                own = []
            at = value
            own.append(row)
    if own:
        yield at, own


class Words:
    """The counts of words and their numbers, from files of ascending hashes that are read through memory maps.

    parts: (part, rows, words of each kind, how often they come) of each file. Numbers go up by kind, then by part, then by hash: frequent words have small ones.
    """

    def __init__(self, folder: str, parts: list[tuple[int, int, list[int], list[int]]]):
        self.files = {p: tuple(np.memmap(f"{folder}/{x}{p}", t, "r", shape=shape) for x, t, shape in (("h", np.int64, (n,)), ("n", np.uint32, (n, 2)), ("r", np.uint32, (n,)))) for p, n, *_ in parts}
        sizes = np.array([x for *_, x, _ in parts], np.int64).reshape(-1, KINDS)
        self.base = dict(zip((p for p, *_ in parts), (np.cumsum(sizes.T).reshape(KINDS, -1) - sizes.T).T, strict=True))
        self.of_kind, self.mass = sizes.sum(axis=0), np.array([x for *_, x in parts], np.int64).reshape(-1, KINDS).sum(axis=0)
        self.common = int(self.of_kind[: KINDS // 2].sum())  # numbers below are of words of both halves
        if self.of_kind.sum() >= 1 << 32:
            raise ValueError("a word's number has 32 bits")

    @staticmethod
    def kinds(n: np.ndarray) -> np.ndarray:
        return KINDS // 2 - np.frexp(n.sum(axis=1).astype(np.float64))[1] + KINDS // 2 * (n.min(axis=1) == 0)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two counts of each of the ascending hashes, and its number; -1 where it is unknown."""
        out, number, part = np.zeros((len(h), 2), np.int64), np.full(len(h), -1), h >> (64 - BITS)
        for p in np.unique(part).tolist():
            low, high = np.searchsorted(part, [p, p + 1])
            if p in self.files:
                keys, n, rank = self.files[p]
                i = np.minimum(np.searchsorted(keys, h[low:high]), len(keys) - 1)
                known = keys[i] == h[low:high]
                out[low:high] = np.where(known[:, None], n[i], 0)
                number[low:high][known] = self.base[p][self.kinds(out[low:high][known])] + rank[i[known]]
        return out, number

    def _at(self, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the word at each mass, if words of a kind come equally often, and how far into it."""
        kinds = np.flatnonzero(self.of_kind)
        ends, first = np.cumsum(self.mass[kinds]), np.cumsum(self.of_kind[kinds]) - self.of_kind[kinds]
        k = np.minimum(np.searchsorted(ends, mass, "right"), len(kinds) - 1)
        x = np.clip((mass - ends[k] + self.mass[kinds][k]) / (self.mass / np.maximum(self.of_kind, 1))[kinds][k], 0, self.of_kind[kinds][k] - 1e-9)
        return first[k] + x.astype(np.int64), x % 1

    def bounds(self, most: int) -> np.ndarray:
        """Pairs that cut all into ranges of about so many words at most; the pairs of a frequent first word are cut by the second."""
        total = self.mass.sum()
        first, within = self._at(np.arange(1, -(-total // most)) * (total / -(-total // most)))
        return np.unique((first.astype(np.uint64) << np.uint64(32)) | self._at(within * total)[0].astype(np.uint64))


class Spelling:
    """Log probabilities of words by their spelling: modified Kneser-Ney over byte trigrams within words, from (trigram, count) of one language."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        order = np.argsort(code)
        tri, n3 = code[order], n[order].astype(np.int64)
        bi, n2 = np.unique(tri & 0xFFFF, return_counts=True)  # continuation counts: distinct left neighbours
        uni, n1 = np.unique(bi & 0xFF, return_counts=True)
        self.p1 = np.full(256, 1 / 256)
        if len(tri):
            off = _discounts(_of_counts(n1))[np.minimum(n1, 3)]
            self.p1 *= off.sum() / n1.sum()
            self.p1[uni] += (n1 - off) / n1.sum()
        share2, self.c2, self.back2, at = _smoothed(bi, n2)
        self.bi, self.p2 = bi, share2 + self.back2[at] * self.p1[bi & 0xFF]
        share3, self.c3, self.back3, at = _smoothed(tri, n3)
        self.tri, self.p3 = tri, share3 + self.back3[at] * self.shorter(tri & 0xFFFF)

    @staticmethod
    def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        i = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
        return i, keys[i] == x

    def shorter(self, bi: np.ndarray) -> np.ndarray:
        i, known = self._find(self.bi, bi)
        j, context = self._find(self.c2, bi >> 8)
        p = self.p1[bi & 0xFF]
        if len(self.c2):
            p = np.where(context, self.back2[j], 1.0) * p
        return np.where(known, self.p2[i], p) if len(self.bi) else p

    def probabilities(self, tri: np.ndarray) -> np.ndarray:
        i, known = self._find(self.tri, tri)
        j, context = self._find(self.c3, tri >> 8)
        p = self.shorter(tri & 0xFFFF)
        if len(self.tri):
            p = np.where(known, self.p3[i], np.where(context, self.back3[j], 1.0) * p)
        return p

    def logs(self, words: list[bytes]) -> np.ndarray:
        """Of each word the sum over its trigrams; each distinct one is looked up once."""
        code, of = spellings(words)
        own, at = np.unique(code, return_inverse=True)
        return np.bincount(of, np.log(np.maximum(self.probabilities(own), 1e-12))[at], len(words))


def count(docs: DataFrame, *, most: int = RANGE) -> tuple:
    """Spark's counts over every whole text of docs (group, half, text as bytes).

    (folder, the files of words as Words has them, in either half the numbers of words, of distinct words and of those that come 1 to 4 times, by group its
    byte trigrams and how often words have them, what pairs() gives). The words are counted in either half of the texts into files of hashes, each sorted; they grow with the corpus, stay in
    the shared folder, and only the sizes of their parts come to the driver. So do the trigrams, of which a language has 256^3 at most and in practice some ten thousand.
    """
    folder = _local(new_path(docs.sparkSession, "words"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def words_of(own: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
            h, at = np.unique(np.concatenate([h for h, _ in own]), return_inverse=True)
            half = np.repeat([half for _, half in own], [len(h) for h, _ in own])
            return rows(None, h.view(np.int64), *(np.bincount(at[half == i], minlength=len(h)) for i in (0, 1)))

        def grams_of(group: str, distinct: dict[bytes, int]) -> pa.RecordBatch:
            code, of = spellings(list(distinct))
            spelled, back = np.unique(code, return_inverse=True)
            many = np.bincount(back, np.fromiter(distinct.values(), np.float64, len(distinct))[of], len(spelled))
            return rows(group, spelled, many, np.zeros(len(spelled)))

        def rows(group: str | None, *columns: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([group] * len(columns[0]), pa.string()), *(pa.array(c.astype(np.int64)) for c in columns)], names=["group", "h", "n0", "n1"])

        own, distinct, size = [], {}, 0
        for batch in batches:
            for group, half, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if text.is_valid and len(found := word_hashes(data := text.as_py())):
                    own.append((found, half))
                    distinct.setdefault(group, Counter()).update(data.split())
                    size += len(found)
                if size > 2_000_000:
                    yield words_of(own)
                    yield from (grams_of(*x) for x in distinct.items())
                    own, distinct, size = [], {}, 0
        if own:
            yield words_of(own)
            yield from (grams_of(*x) for x in distinct.items())

    # a null group: words; else trigrams
    counted = stored(docs.mapInArrow(words, "group string, h long, n0 long, n1 long").groupBy("group", "h").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "counts")
    own = counted.where("group is null")
    tell = own.agg(*(F.expr(x.format(i)) for i in (0, 1) for x in ("sum(n{})", "count_if(n{} > 0)", *(f"count_if(n{{}} = {k})" for k in (1, 2, 3, 4))))).first()
    totals = np.array([x or 0 for x in tell], np.float64).reshape(2, 6)
    grams: dict[str, tuple[list, list]] = {}
    for r in counted.where("group is not null").select("group", "h", "n0").toLocalIterator():
        code, n = grams.setdefault(r.group, ([], []))
        code.append(r.h)
        n.append(r.n0)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        sizes, mark = {}, f"{os.getpid()}-{TaskContext.get().taskAttemptId()}"  # by part the words of each kind, and how often they come
        for batch in batches:
            part, h, *n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for p in np.unique(part).tolist():
                own = np.column_stack(n)[part == p]
                kinds, (size, mass) = Words.kinds(own), sizes.setdefault(p, np.zeros((2, KINDS), np.int64))
                order, many = np.argsort(kinds, kind="stable"), np.bincount(kinds, minlength=KINDS)
                rank = np.empty(len(own), np.int64)
                rank[order] = np.arange(len(own)) + (size - np.cumsum(many) + many)[kinds[order]]
                for kind, x in (("h", h[part == p]), ("n", own.astype(np.uint32)), ("r", rank.astype(np.uint32))):
                    with open(f"{folder}/.{kind}{p}.{mark}", "ab") as f:
                        f.write(np.ascontiguousarray(x).tobytes())
                size += many
                mass += np.bincount(kinds, own.sum(axis=1), KINDS).astype(np.int64)
        for p in sizes:
            for kind in "hnr":
                os.replace(f"{folder}/.{kind}{p}.{mark}", f"{folder}/{kind}{p}")
        if sizes:
            yield pa.RecordBatch.from_arrays([pa.array(list(sizes), pa.int64()), *(pa.array([x[i].tolist() for x in sizes.values()], pa.list_(pa.int64())) for i in (0, 1))], names=["part", "words", "mass"])

    dealt = own.select(F.shiftright("h", 64 - BITS).cast("int").alias("part"), "h", "n0", "n1").repartition("part").sortWithinPartitions("part", "h")
    found = [(r.part, sum(r.words), r.words, r.mass) for r in dealt.mapInArrow(write, "part long, words array<long>, mass array<long>").collect()]
    drop(counted)
    return folder, found, totals, {g: (np.array(c, np.int64), np.array(n, np.int64)) for g, (c, n) in grams.items()}, pairs(docs, folder, found, most)


def pairs(docs: DataFrame, folder: str, parts: list[tuple], most: int) -> tuple:
    """Spark's counts of each word after each word of a text, in either half; files of them in folder.

    (bounds of the ranges of pairs, (range, rows) of each file, the discounts of either half, (block, rows) of each file of SUMS, in either half the numbers of
    distinct pairs, of words that have one before them, and of those that have 1 to 4). Pairs are sent as packed runs of word numbers, one a range, and summed range by range;
    all are counted, but only those of both halves are written: another is never found from the other half. From each range go its sums by first word and by second.
    """
    words = Words(folder, parts)
    bounds, common = words.bounds(most) if parts else np.empty(0, np.uint64), words.common

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(own: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
            h, at = np.unique(np.concatenate([h for h, _ in own]).view(np.int64), return_inverse=True)
            number, size, out = known.find(h)[1].astype(np.uint64)[at], [len(h) for h, _ in own], []
            keys, inside = (number[:-1] << np.uint64(32)) | number[1:], np.repeat([half for _, half in own], size)[:-1]
            inside[np.cumsum(size)[:-1] - 1] = -1  # the last word of a text and the first of the next
            for half in (0, 1):
                k, n = np.unique(keys[inside == half], return_counts=True)
                cuts = [0, *np.searchsorted(k, bounds).tolist(), len(k)]
                out += [(i, half, packed_pairs(k[a:b], n[a:b])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["range", "half", "data"])

        known, own, size = Words(folder, parts), [], 0
        for batch in batches:
            for half, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text.is_valid and len(found := word_hashes(text.as_py())) > 1:
                    own.append((found, half))
                    size += len(found)
                if size > 2_000_000:
                    yield rows(own)
                    own, size = [], 0
        if own:
            yield rows(own)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, own in _runs(batches):
            out, tally, found = [], [], []
            for half in (0, 1):
                k, n = _summed(*([x[j] for x in runs] for runs in [[unpacked_pairs(data) for at, data in own if at == half]] for j in (0, 1)))
                found.append((k, n))
                tally += [int((n == c).sum()) for c in (1, 2, 3, 4)]
                if len(k):
                    first = k >> np.uint64(32)
                    at = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
                    sums = first[at], *(np.add.reduceat(x, at) for x in (n, *((n == c).astype(np.uint64) for c in (1, 2)), (n > 2).astype(np.uint64)))
                    for kind, (x, *rest) in ((half, sums), (2 + half, np.unique(k & np.uint64(0xFFFFFFFF), return_counts=True))):
                        cuts = np.flatnonzero(np.diff(x // BLOCK, prepend=-1.0)).tolist()
                        out += [(int(x[a]) // BLOCK, kind, packed(np.diff(x[a:b], prepend=x[a] // BLOCK * BLOCK), *(y[a:b] for y in rest))) for a, b in zip(cuts, [*cuts[1:], len(x)], strict=True)]
            (k, n), (other, m) = found
            j = np.minimum(np.searchsorted(other, k), max(0, len(other) - 1))
            both = other[j] == k if len(other) else np.zeros(len(k), bool)
            n, size = np.column_stack([n[both], m[j[both]] if len(m) else n[both]]), int(both.sum())
            width = 1 if not size or n.max() < 1 << 8 else 2 if n.max() < 1 << 16 else 8
            for name, x in (("k", k[both]), ("c", n.astype(f"<u{width}"))):
                with open(own_name := f"{folder}/.{name}{i}.{os.getpid()}-{TaskContext.get().taskAttemptId()}", "wb") as f:
                    f.write(x.tobytes())
                os.replace(own_name, f"{folder}/{name}{i}")
            out.append((i, 4, np.array([size, width, *tally], "<i8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["block", "kind", "data"])

    dealt = docs.select("half", "text").mapInArrow(deal, "range int, half int, data binary").repartition("range").sortWithinPartitions("range")
    merged = stored(dealt.mapInArrow(merge, "block long, kind int, data binary"), "pairs")
    told = [(r.block, np.frombuffer(r.data, "<i8").tolist()) for r in merged.where("kind = 4").select("block", "data").collect()]  # one row a range
    off = np.array([_discounts(np.sum([x[2 + 4 * i : 6 + 4 * i] for _, x in told] or [[0] * 4], axis=0)) for i in (0, 1)])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, own in _runs(batches):
            before, after = np.zeros((2, BLOCK), np.int64), np.zeros((2, 4, BLOCK), np.int64)
            for kind, data in own:
                step, *rest = unpacked(data)
                at = np.cumsum(step).astype(np.int64)
                (before if kind > 1 else after)[kind % 2][..., at] += rest[0].astype(np.int64) if kind > 1 else np.array(rest).astype(np.int64)
            sums = np.zeros(min(BLOCK, max(0, common - block * BLOCK)), SUMS)
            sums["before"], sums["after"] = before.T[: len(sums)], after[:, 0].T[: len(sums)]
            sums["left"] = np.einsum("ijk,ij->ki", after[:, 1:], off[:, 1:])[: len(sums)]
            with open(own_name := f"{folder}/.s{block}.{os.getpid()}-{TaskContext.get().taskAttemptId()}", "wb") as f:
                f.write(sums.tobytes())
            os.replace(own_name, f"{folder}/s{block}")
            tally = [int(x) for own in before for x in (own.sum(), (own > 0).sum(), *((own == c).sum() for c in (1, 2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([len(sums)], pa.int64()), pa.array([tally], pa.list_(pa.int64()))], names=["block", "rows", "tally"])

    summed = merged.where("kind < 4").repartition("block").sortWithinPartitions("block").mapInArrow(total, "block long, rows long, tally array<long>").collect()  # one row a block
    drop(merged)
    followed = np.sum([r.tally for r in summed] or [[0] * 12], axis=0).astype(np.float64).reshape(2, 6)
    return bounds, [(i, size, width) for i, (size, width, *_) in told], off, [(r.block, r.rows) for r in summed], followed


class Model:
    """Mean negative log probabilities, the logarithms of perplexities, of a text's words after the words before them, of its words alone and of their spelling.

    All counts are read through memory maps. A pair of words has its count in the half of the texts that its text isn't in, less its discount; the discounts' mass
    goes to the second word by the number of distinct words before it, less its discount, and that mass is spread evenly over unseen words. A word alone, as the
    first of a text is, has its own count. The texts must be among those counted: what one half alone has is not in the files of pairs. A word's spelling is that of the language that spells it best, so that texts that change their language are as likely as others.
    most: distinct words whose spelling is kept.
    """

    def __init__(self, folder: str, parts: list[tuple], totals: np.ndarray, grams: dict[str, tuple[np.ndarray, np.ndarray]], joined: tuple, most: int = 600_000):
        self.words, self.totals, self.spelling, self.most = Words(folder, parts), totals, [Spelling(*x) for x in grams.values()], most
        self.bounds, ranges, self.off, blocks, self.followed = joined
        self.ranges = {i: (np.memmap(f"{folder}/k{i}", np.uint64, "r", shape=(n,)), np.memmap(f"{folder}/c{i}", f"<u{width}", "r", shape=(n, 2))) for i, n, width in ranges if n}
        self.blocks = {i: np.memmap(f"{folder}/s{i}", SUMS, "r", shape=(n,)) for i, n in blocks if n}
        self.keys, self.values = np.empty(0, np.int64), np.empty((0, 2))

    def counts(self, h: np.ndarray) -> np.ndarray:
        """The two counts of each of the ascending hashes."""
        return self.words.find(h)[0]

    def _spread(self, n: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Probabilities in a text of either half, by counts in the other."""
        out = np.empty((len(n), 2))
        for half in (0, 1):
            c, (total, types, *few) = n[:, 1 - half], totals[1 - half]
            off = _discounts(np.array(few))
            left = off[1] * few[0] + off[2] * few[1] + off[3] * max(0.0, types - few[0] - few[1])
            out[:, half] = (np.maximum(c - off[np.minimum(c, 3)], 0) + (left + 1) / (2 * self.totals[:, 1].sum() + 1)) / (total + 1)
        return out

    def logs(self, h: np.ndarray) -> np.ndarray:
        """Log probabilities of the words with the ascending hashes h, alone, in a text of either half."""
        return np.log(self._spread(self.counts(h), self.totals))

    def sums(self, number: np.ndarray) -> np.ndarray:
        """SUMS of the words of these numbers; 0 where a half has none."""
        out, block = np.zeros(len(number), SUMS), np.where(number < self.words.common, number // BLOCK, -1)
        for b in np.unique(block).tolist():
            if b in self.blocks:
                out[block == b] = self.blocks[b][number[block == b] - b * BLOCK]
        return out

    def together(self, keys: np.ndarray) -> np.ndarray:
        """The two counts of ascending pairs (first << 32 | second); 0 for those that one half alone has."""
        out, cuts = np.zeros((len(keys), 2), np.int64), [0, *np.searchsorted(keys, self.bounds).tolist(), len(keys)]
        for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if low < high and i in self.ranges:
                own, n = self.ranges[i]
                at = np.minimum(np.searchsorted(own, keys[low:high]), len(own) - 1)
                out[low:high] = np.where((own[at] == keys[low:high])[:, None], n[at], 0)
        return out

    def after(self, number: np.ndarray, at: np.ndarray, half: np.ndarray, first: np.ndarray, alone: np.ndarray) -> np.ndarray:
        """Log probabilities of the running words number[at] of texts of these halves, each after the one before it; of the first of a text, alone."""
        out, second = alone.copy(), np.flatnonzero(~first)
        sums, v, w, other = self.sums(number), at[second - 1], at[second], 1 - half[second]
        lower = self._spread(sums["before"].astype(np.int64), self.followed)[w, half[second]]
        known = np.flatnonzero((np.minimum(number[v], number[w]) >= 0) & (np.maximum(number[v], number[w]) < self.words.common))
        keys, back = np.unique((number[v[known]].astype(np.uint64) << np.uint64(32)) | number[w[known]].astype(np.uint64), return_inverse=True)
        c = np.zeros(len(second), np.int64)
        c[known] = self.together(keys)[back, other[known]]
        total = sums["after"][v, other]
        out[second] = np.log(np.where(total > 0, (np.maximum(c - self.off[other, np.minimum(c, 3)], 0) + sums["left"][v, other] * lower) / np.maximum(total, 1), lower))
        return out

    def spelled(self, h: np.ndarray, words: list[bytes]) -> np.ndarray:
        """(log probability, trigrams) of the spelling of distinct words with the ascending hashes h; those that came before are remembered."""
        i = np.minimum(np.searchsorted(self.keys, h), max(0, len(self.keys) - 1))
        known = self.keys[i] == h if len(self.keys) else np.zeros(len(h), bool)
        out, new = np.zeros((len(h), 2)), np.flatnonzero(~known)
        out[known] = self.values[i[known]]
        if len(new):
            code, of = spellings([words[j] for j in new.tolist()])
            own, at = np.unique(code, return_inverse=True)
            logs = [np.bincount(of, np.log(np.maximum(x.probabilities(own), 1e-12))[at], len(new)) for x in self.spelling or [Spelling(*[np.empty(0, np.int64)] * 2)]]
            out[new] = np.column_stack([np.max(logs, axis=0), np.bincount(of, minlength=len(new))])
            if len(self.keys) + len(new) > self.most:
                self.keys, self.values = np.empty(0, np.int64), np.empty((0, 2))
            at = np.searchsorted(self.keys, h[new])
            self.keys, self.values = np.insert(self.keys, at, h[new]), np.insert(self.values, at, out[new], axis=0)
        return out

    def surprises(self, texts: list[bytes | None], words: list[list[bytes]], halves: list[int]) -> list[tuple[tuple[float, float] | None, float | None]]:
        """Of each text those of its words (after one another, alone) and that of their spelling; None without words."""
        hashes = [word_hashes(x or b"").view(np.int64) for x in texts]
        size = np.array([len(h) for h in hashes])
        if not size.sum():
            return [(None, None)] * len(texts)
        h, first, at = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        every, of = [w for own in words for w in own], np.repeat(np.arange(len(texts)), size)
        spelled = self.spelled(h, [every[i] for i in first.tolist()])[at]
        (n, number), half = self.words.find(h), np.array(halves)[of]
        alone = np.log(self._spread(n, self.totals))[at, half]
        after = self.after(number, at, half, np.diff(of, prepend=-1) > 0, alone)
        sums = [np.bincount(of, x, len(texts)) for x in (after, alone, spelled[:, 0], spelled[:, 1])]
        return [((float(-x / k), float(-y / k)), float(-z / n)) if k else (None, None) for x, y, z, n, k in zip(*sums, size, strict=True)]


def base(text: bytes | None) -> tuple[list[bytes], int, int, int, int]:
    """The words; their characters; symbols; duplicate lines; words in repeated 3-word windows."""
    if not text:
        return [], 0, 0, 0, 0
    words, a = text.split(), np.frombuffer(text, np.uint8)
    chars = int(((a & 0xC0) != 0x80).sum() - SPACE[a].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = 0
    if len(words) > 3:
        grams = gram_hashes(word_hashes(text), 3)
        _, at, n = np.unique(grams, return_inverse=True, return_counts=True)
        often = np.flatnonzero(n[at] > 1)
        covered = np.zeros(len(words), bool)
        covered[often] = covered[often + 1] = covered[often + 2] = True
        repeats = int(covered.sum())
    return words, chars, sum(text.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS))), len(lines) - len(set(lines)), repeats


MEASURES = "doc_id long, group string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, surprise double, alone double, spelled double"


def measure(docs: DataFrame, model) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kinds, key = (pa.int64(), pa.string(), *[pa.int64()] * 5, *[pa.float64()] * 3), f"quality-{uuid.uuid4()}"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(key, lambda: Model(*sent.value))
        for batch in batches:
            out = []
            for part in some(list(zip(*(c.to_pylist() for c in batch.columns), strict=True))):
                counted = [base(text) for *_, text in part]
                found = own.surprises([text for *_, text in part], [words for words, *_ in counted], [half for _, _, half, _ in part])
                out += [(doc_id, group, len(words), *rest, *(own_words or (None, None)), spelled) for (doc_id, group, *_), (words, *rest), (own_words, spelled) in zip(part, counted, found, strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in MEASURES.split(", ")])

    return docs.select("doc_id", "group", "half", "text").mapInArrow(rows, MEASURES)


def rules(docs: DataFrame, *, least_words: int = 50, most_repeats: int = 50, width: float = 2.0, spelled_width: float = 4.0, order_width: float = 1.5) -> DataFrame:
    """Each row of docs with its counts, perplexities, base_failed and kept.

    docs: doc_id, text, lang; other columns are left out, clashing names too. Null, empty and blank texts have no words, no perplexity (null) and fail the base rules. Rows
    that repeat are each judged, equal texts of a language alike. An empty table gives none. Null languages, and an empty one, are one group.
    kept: the base rules hold, and the perplexities of the words alone and of their spelling lie in their language's bands: from the first quartile less width (spelled_width)
    times the interquartile distance to the third plus as much, in logarithms, over all documents of the language that pass the base rules. So does the perplexity of the
    words after one another (perplexity), and its ratio to that of the words alone, with order_width, which words in no order raise; these two have no lower edge, as
    texts of which the other half has a near copy are foreseen nearly word for word. The words' counts are those of the other half of the table, so never the text's own.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(GROUP).alias("group"), F.expr(HALF).alias("half"), F.col("text").cast("binary").alias("text"))
    found = stored(measure(named, count(named.select("group", "half", "text"))), "measured").withColumn("base_failed", F.expr(f"n_words < {least_words} or 100 * n_repeat_words > {most_repeats} * n_words"))
    tests = {"surprise": (None, width), "alone": (width, width), "spelled": (spelled_width, spelled_width), "gained": (None, order_width)}
    found = found.withColumn("gained", F.expr("surprise - alone"))
    q = found.where("not base_failed").groupBy("group").agg(*(F.percentile_approx(c, [0.25, 0.75], 10_000).alias(c) for c in tests))
    apart = "greatest(_.{0}[1] - _.{0}[0], 0.02)"
    within = [f"_.{c} is not null and {c} <= _.{c}[1] + {high} * {apart.format(c)}" + (f" and {c} >= _.{c}[0] - {low} * {apart.format(c)}" if low is not None else "") for c, (low, high) in tests.items()]
    bands = stored(q.select(F.col("group").alias("_group"), F.struct(*tests).alias("_")), "bands")  # sent out if Spark finds it small
    kept = F.expr(f"not base_failed and coalesce({' and '.join(within)}, false)").alias("kept")
    judged = found.join(bands, F.col("group") == F.col("_group"), "left")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept, F.exp("surprise").alias("perplexity"), F.exp("spelled").alias("spelling_perplexity"), F.exp("alone").alias("word_perplexity"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(documents(spark, sf_dir))
