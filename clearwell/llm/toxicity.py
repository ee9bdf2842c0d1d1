"""Operator 5, toxicity: a support vector machine on a gapped-subsequence string kernel, approximated by Nyström landmarks."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import documents, held, some, stored

#: Character classes of the kernel: 0 none, 1 the start of a word, 2 to 27 the letters a to z, the others by code point.
CLASSES = 48
#: Digits and signs that stand for letters, if letters are on both sides.
STANDS = str.maketrans("014357@$!", "oiaestasi")
SENTENCE = re.compile(r"[.!?\n]+(?:\s+|$)")
#: Single letters with blanks, dots or dashes between them are one word.
SPACED = re.compile(r"(?<!\w)(?:\w[ .\-_*]+){3,}\w(?!\w)")


def letters(word: str) -> str:
    """The letters of a word, with signs inside that stand for some; other characters count as inserted and go."""
    start, end = 0, len(word)
    while start < end and not word[start].isalpha():
        start += 1
    while end > start and not word[end - 1].isalpha():
        end -= 1
    word = word[start:end].lower()
    return word if word.isalpha() else "".join(filter(str.isalpha, word.translate(STANDS)))


def codes(word: str) -> list[int]:
    return [1, *(ord(c) - 95 if "a" <= c <= "z" else 28 + ord(c) % (CLASSES - 28) for c in letters(word))]


def triples(own: list[list[int]], decay: float, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, triple, weight): each subsequence of three letters within span letters of the coded words, weighing decay to the letters between."""
    length = max([3, *map(len, own)])
    a = np.zeros((len(own), length), np.int32)
    for i, c in enumerate(own):
        a[i, : len(c)] = c
    parts = []
    for j in range(1, span - 1):
        for k in range(j + 1, min(span, length)):
            z = a[:, k:]
            code = (a[:, : length - k] * CLASSES + a[:, j : length - k + j]) * CLASSES + z
            word, at = np.nonzero(z)
            parts.append((word, code[word, at], np.full(len(word), decay ** (k - 2))))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def normed(own: list[list[int]], decay: float, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with each triple of a word once, and weights of norm 1: inner products are the gap-weighted subsequence kernel."""
    word, triple, weight = triples(own, decay, span)
    key, at = np.unique(word * CLASSES**3 + triple, return_inverse=True)
    weight = np.bincount(at, weight)
    word, triple = key // CLASSES**3, key % CLASSES**3
    norm = np.sqrt(np.bincount(word, weight**2, len(own)))
    return word, triple, weight / norm[word]


def words_of(text: str, joined: bool = False) -> list[str]:
    """The blank-separated words of the whole text; spaced-out letters are joined, unless they are already; runs of over 60 characters are cut with an overlap."""
    if not joined and SPACED.search(text):
        text = SPACED.sub(lambda m: re.sub(r"[ .\-_*]+", "", m[0]), text)
    out = text.lower().split()
    if any(len(x) > 60 for x in out):
        out = [x[i : i + 60] for x in out for i in range(0, max(1, len(x) - 20), 40)]
    return out


class Kernel:
    """Kernel values of words with the landmarks. heard: those of words that reach floor with one, or with a line their products with it; the others known count as nothing. most: words kept at most."""

    def __init__(self, landmarks: list[str], decay: float = 0.6, span: int = 5, floor: float = 0.2, most: int = 600_000):
        self.landmarks, self.decay, self.span, self.floor, self.most = landmarks, decay, span, floor, most
        self.parts = normed([codes(x) for x in landmarks], decay, span)
        self.table = np.zeros((CLASSES**3, len(landmarks)), np.float32)
        self.table[self.parts[1], self.parts[0]] = self.parts[2]
        self.peak = self.table.max(1)
        self.known: set[str] = set()
        self.heard: dict[str, np.ndarray | float] = {}
        self.line: np.ndarray | None = None

    def between(self) -> np.ndarray:
        word, triple, weight = self.parts
        out = np.zeros((len(self.landmarks),) * 2)
        np.add.at(out, word, weight[:, None] * self.table[triple])
        return out

    def values(self, own: list[list[int]]) -> np.ndarray:
        word, triple, weight = normed(own, self.decay, self.span)
        some = self.peak[triple] > 0
        word, triple, weight = word[some], triple[some], weight[some].astype(np.float32)
        k = np.zeros((len(own), len(self.landmarks)), np.float32)
        if len(word):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            k[word[starts]] = np.add.reduceat(weight[:, None] * self.table[triple], starts, axis=0)
        return k

    def learn(self, words: list[str]) -> None:
        """Most words are passed over by a bound: their triples' greatest weights in any landmark, over the least norm that they can have."""
        self.known.update(words)
        coded = sorted(((c, w) for w in words if len(c := codes(w)) > 3), key=lambda x: len(x[0]))
        for i in range(0, len(coded), 4000):
            part = coded[i : i + 4000]
            word, triple, weight = triples([c for c, _ in part], self.decay, self.span)
            bound = np.bincount(word, weight * self.peak[triple], len(part)) / np.sqrt(np.bincount(word, weight**2, len(part)))
            part = [part[j] for j in np.flatnonzero(bound >= self.floor)]
            if part:
                for (_, w), k in zip(part, self.values([c for c, _ in part]), strict=True):
                    if k.max() >= self.floor:
                        self.heard[w] = k if self.line is None else float(k @ self.line)

    def learn_new(self, words) -> None:
        missing = sorted(set(words).difference(self.known))
        for i in range(0, len(missing), 20_000):
            self.learn(missing[i : i + 20_000])

    def forget(self) -> None:
        self.known.clear()
        self.heard.clear()


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence of the whole text; a sentence of over 40 words counts as several."""
    if SPACED.search(text):
        text = SPACED.sub(lambda m: re.sub(r"[ .\-_*]+", "", m[0]), text)
    out = []
    for part in SENTENCE.split(text):
        words = words_of(part, joined=True)
        out += [words[i : i + 40] for i in range(0, len(words), 40)]
    return out


def strings(text: str) -> set[str]:
    """The words of a text and their first 5, 6 and 7 letters."""
    words = {x for w in set(words_of(text)) if len(x := letters(w)) > 2}
    return words | {w[:k] for w in words for k in (5, 6, 7)}


def _logistic(x: np.ndarray, labels: np.ndarray, weight: np.ndarray, rounds: int = 4000) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    middle, spread = x.mean(0), x.std(0) + 1e-6
    z, w, b = (x - middle) / spread, np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        g = weight * (1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30))) - labels)
        w, b = w - 1.0 * (z.T @ g + 1e-4 * w), b - 1.0 * g.sum()
    return w, b, middle, spread


def landmarks_of(rows: list[tuple[str, int]], *, landmarks: int, least: float, ratio: float, alike: float) -> list[str]:
    """The strings that most favour toxic documents by log-likelihood ratio (at least least: under one in a million by chance), ratio times as frequent
    there, and not alike to an earlier one."""
    seen, n = (Counter(), Counter()), [0, 0]
    for text, toxic in rows:
        seen[toxic].update(strings(text))
        n[toxic] += 1

    def gain(w: str) -> float:
        """The log-likelihood ratio against no tie to the label; 0 where it doesn't favour toxic documents ratio times."""
        k, rate = (seen[0][w], seen[1][w]), n[1] / sum(n)
        expected = (sum(k) * (1 - rate), sum(k) * rate)
        return 2 * sum(x * np.log(x / e) for x, e in zip(k, expected, strict=True) if x) if k[1] / n[1] > ratio * k[0] / n[0] else 0.0

    found = {w: g for w, k in seen[1].items() if k >= 3 and (g := gain(w)) >= least}
    chosen: list[str] = []
    ranked = sorted(found, key=lambda w: (-found[w], -len(w), w))[: 20 * landmarks]
    if ranked:
        near, at = Kernel(ranked).between(), {w: i for i, w in enumerate(ranked)}
        for i, w in enumerate(ranked):
            if len(chosen) < landmarks and all(near[i, at[c]] < alike for c in chosen):
                chosen.append(w)
    return chosen


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int, penalty: float) -> tuple[np.ndarray, float]:
    w, b = np.zeros(x.shape[1]), 0.0
    for t in range(rounds):
        late = weight * (y * (x @ w + b) < 1) * y
        step = 1 / (penalty * (t + 1000))
        w, b = (1 - step * penalty) * w + step * (late @ x), b + step * late.sum() * 0.1
    return w, b


def fit(rows: list[tuple[str, int]], *, landmarks: int = 48, least: float = 25.0, ratio: float = 4.0, alike: float = 0.8, rounds: int = 1200, loud: float = 0.75, penalty: float = 1e-3) -> dict:
    """Learns from (text, toxic).

    The examples are sentences. The machine is linear on the Nyström features of a word, K^(-1/2) times its kernel values with the landmarks, and
    trained by hinge-loss subgradients; a sentence has the margin of its most toxic word. So every word of a clean document's sentences is an
    example of 0, as often as it comes. Which sentences of a toxic document make it so, and by which word, is not labelled: those stand for it in which a
    landmark is heard at a kernel value of loud, each by its loudest word, as an example of 1.
    A logistic curve over the greatest margin of a document's sentences and over the numbers and shares of words with a high one gives
    probabilities. Without both labels, or without landmarks, all texts get the rate of toxic rows, at most 0.49.
    """
    n = [sum(v == k for _, v in rows) for k in (0, 1)]
    chosen = landmarks_of(rows, landmarks=landmarks, least=least, ratio=ratio, alike=alike) if all(n) else []
    if not chosen:
        return {"landmarks": [], "rate": n[1] / max(1, sum(n))}
    kernel = Kernel(chosen)
    values, vectors = np.linalg.eigh(kernel.between() + 1e-3 * np.eye(len(chosen)))
    root = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T
    bags, clean = [], Counter()  # a toxic document's sentences, each by its heard words
    for text, toxic in rows:
        kernel.learn_new(words_of(text))
        own = [found for s in sentences(text) if (found := [w for w in s if w in kernel.heard])]
        if toxic:
            bags.append(own)
        else:
            clean.update(w for s in own for w in s)
    names = sorted(clean.keys() | {w for own in bags for s in own for w in s})
    at = {w: i for i, w in enumerate(names)}
    heard = np.array([kernel.heard[w] for w in names], np.float64).reshape(-1, len(chosen))
    x = np.concatenate([heard @ root, np.zeros((1, len(chosen)))])  # the last: words that no landmark hears
    weight = np.append(np.array([clean[w] for w in names], np.float64), 1 + clean.total())

    loudest, toxic = heard.max(1, initial=0), np.zeros(len(names))
    for own in bags:
        for sentence in own:
            i = max((at[w] for w in sentence), key=loudest.__getitem__)
            toxic[i] += loudest[i] >= loud
    if not toxic.any():
        return {"landmarks": [], "rate": n[1] / sum(n)}
    both, y = np.concatenate([x[:-1], x]), np.concatenate([np.ones(len(names)), -np.ones(len(x))])
    share = np.concatenate([0.4 * toxic / toxic.sum(), 0.6 * weight / weight.sum()])
    own = share > 0
    w, b = _hinge(both[own], y[own], share[own], rounds, penalty)
    model = {"landmarks": chosen, "root": root, "w": w, "b": b, "rate": n[1] / sum(n)}
    scorer = Scorer(model)
    x, labels = np.array([scorer.measures(t) for t, _ in rows]), np.array([v for _, v in rows], float)
    sides = np.where(labels > 0, 0.3 / labels.sum(), 0.7 / (1 - labels).sum())  # a toxic document is rarer than a clean one
    return model | {"last": _logistic(x, labels, sides)}


class Scorer:
    def __init__(self, model: dict):
        self.model, self.kernel = model, Kernel(model["landmarks"]) if model["landmarks"] else None
        if self.kernel:
            self.kernel.line = model["root"] @ model["w"]

    def prepare(self, texts: list[str | None]) -> None:
        """Learns the new words of texts at once; what was learned before goes when it is too much."""
        if self.kernel:
            if len(self.kernel.known) > self.kernel.most:
                self.kernel.forget()
            self.kernel.learn_new(set().union(*(words_of(x) for x in texts if x)))

    def measures(self, text: str) -> list[float]:
        """The greatest margin of a sentence, which is that of its most toxic word; the numbers of words over 0 and over 0.8 and their shares, in logarithms."""
        words, heard = words_of(text), self.kernel.heard
        self.kernel.learn_new(words)
        margins = np.array([heard[x] for x in words if x in heard]) + self.model["b"]
        over = [(margins > 0).sum(), (margins > 0.8).sum()]
        return [max([self.model["b"], *margins.tolist()]), *(f for n in over for f in (math.log1p(n), math.log1p(1000 * n / (len(words) + 20))))]

    def score(self, text: str | None) -> float:
        if not self.kernel:
            return min(0.49, self.model["rate"])
        w, b, middle, spread = self.model["last"]
        return float(1 / (1 + np.exp(-np.clip((np.array(self.measures(text or "")) - middle) / spread @ w + b, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, *, rows: int = 2500, longest: int = 20_000) -> dict:
    """Fits on labelled rows whose crc32(doc_id as text) mod 5 is not 0: about rows of each label by hash, with texts of longest characters at most.

    Only this bounded sample reaches the driver: the chosen ids are counted, never more than 4 * rows, and sent to where the texts are. A label other
    than 0 and 1 or a null, and a null or longer text is no example; a doc_id that has both labels is one of each.
    """
    own = labels.where("toxic in (0, 1) and doc_id is not null and crc32(cast(doc_id as string)) % 5 <> 0").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    sizes = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}
    fate = F.when(F.col("toxic") == 1, F.lit(rows / max(1, sizes.get(1, 0)))).otherwise(F.lit(rows / max(1, sizes.get(0, 0))))
    chosen = stored(own.where(F.expr("pmod(xxhash64(doc_id, 5), 1000000)") < fate * 1_000_000).orderBy(F.xxhash64("doc_id"), "toxic").limit(4 * rows), "chosen")
    texts = docs.where(f"text is not null and length(text) <= {longest}").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").limit(4 * rows)
    return fit([(r.text, r.toxic) for r in sorted(texts.collect(), key=lambda r: (r.doc_id, r.toxic, r.text))])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5) for each row of docs; a null or empty text has the score of a text without any word.

    The whole text counts, however long. Equal texts have equal scores; rows that repeat are each scored, an empty table gives none, and other columns are left out.
    """
    sent, key = docs.sparkSession.sparkContext.broadcast(model), f"toxicity-{uuid.uuid4()}"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(key, lambda: Scorer(sent.value))
        for batch in batches:
            found = []
            for texts in some(batch.column(1).to_pylist()):
                own.prepare(texts)
                found += map(own.score, texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), pa.array([int(x >= 0.5) for x in found], pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, score double, predicted int")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", F.expr("coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)").alias("held_out"), "score", "predicted")
