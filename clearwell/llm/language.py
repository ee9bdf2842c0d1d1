"""Operator 7, language ID: unigram models over a fixed public vocabulary, summed over all segmentations by a forward algorithm."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import BASE, documents, held, let_go, mixed, some, stored

#: Letters, and the marks on them: numerals and digits are none.
RUN = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Starts a word in the vocabulary.
MARK = "▁"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """The letter pieces of a sentencepiece vocabulary, as sorted hashes; a single character that is not among them is unknown."""

    def __init__(self, path: str, cut: int = 48):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
        self.pieces = sorted(x for x in found if x and RUN.fullmatch(x.replace(MARK, "", 1) or "a"))
        self.pieces.sort(key=len)
        longest = len(self.pieces[-1])
        by_length = [[x for x in self.pieces if len(x) == k] for k in range(1, longest + 1)]
        hashes = np.concatenate([self._hashes(own, k + 1)[k + 1][:, 0] for k, own in enumerate(by_length) if own])
        order = np.argsort(hashes)
        self.hashes, self.ids, self.longest, self.cut, self.unknown = hashes[order], order, longest, cut, len(self.pieces)

    def _hashes(self, words: list[str], length: int) -> dict[int, np.ndarray]:
        """By piece length k: the hashes of the pieces [i, i + k) of words, which all have length characters."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64)
        out, h = {}, np.zeros((len(words), length), np.uint64)
        for k in range(1, min(self.longest if hasattr(self, "longest") else length, length) + 1):
            h = h[:, : length - k + 1] * np.uint64(BASE) + codes[:, k - 1 :] + np.uint64(1)
            out[k] = mixed(h + np.uint64(k))
        return out

    def lattice(self, words: list[str], length: int) -> dict[int, np.ndarray]:
        """By piece length: piece ids (words x starts), -1 where there is none."""
        out = {}
        for k, h in self._hashes(words, length).items():
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            out[k] = np.where(self.hashes[at] == h, self.ids[at], self.unknown if k == 1 else -1)
        return out

    def words(self, token: str) -> list[str]:
        """The letter runs of a token, marked as word starts, cut after so many characters: pieces don't cross the cuts."""
        out = []
        for run in RUN.findall(token):
            run = MARK + run
            out += [run[i : i + self.cut] for i in range(0, len(run), self.cut)]
        return out


def forward(lattice: dict[int, np.ndarray], table: np.ndarray) -> list[np.ndarray]:
    """At each position, the summed probability of all segmentations up to there: (words, languages). table: (pieces + 2, languages), last row 0."""
    n, length = lattice[1].shape
    out = [np.ones((n, table.shape[1]))]
    for i in range(1, length + 1):
        out.append(sum(out[i - k] * table[ids[:, i - k]] for k, ids in lattice.items() if k <= i))
    return out


def fit(counts: list[tuple[str, str, int]], path: str, *, rounds: int = 4, prior: float = 0.01) -> tuple[list[str], np.ndarray]:
    """Languages and (pieces + 2, languages) piece probabilities: expectation maximisation over (language, word, count), by forward and backward sums."""
    vocabulary, langs = Vocabulary(path), sorted({lang for lang, _, _ in counts})
    table = np.zeros((vocabulary.unknown + 2, len(langs)))
    table[:-1] = 1 / (vocabulary.unknown + 1)
    table[-2] *= 0.01
    groups: dict[int, list] = defaultdict(list)
    words: dict[str, np.ndarray] = {}
    for lang, token, n in counts:
        for w in vocabulary.words(token):
            words.setdefault(w, np.zeros(len(langs)))[langs.index(lang)] += n
    for w, n in words.items():
        groups[len(w)].append((w, n))
    parts = []
    for length, own in groups.items():
        for run in some(own, 5000):  # the sums of a run at a time are in memory
            parts.append(({k: ids.astype(np.int32) for k, ids in vocabulary.lattice([w for w, _ in run], length).items()}, np.array([n for _, n in run])))
    for _ in range(rounds):
        seen = np.full_like(table, prior)
        seen[-1] = 0
        for lattice, n in parts:
            length = lattice[1].shape[1]
            ahead = forward(lattice, table)
            behind = [np.ones_like(n)] * (length + 1)
            for i in range(length - 1, -1, -1):
                behind[i] = sum(behind[i + k] * table[ids[:, i]] for k, ids in lattice.items() if i + k <= length)
            share = n / np.maximum(ahead[length], 1e-300)
            for k, ids in lattice.items():
                for i in range(length - k + 1):
                    np.add.at(seen, ids[:, i], ahead[i] * table[ids[:, i]] * behind[i + k] * share)
        seen[-1] = 0
        table = seen / seen.sum(0)
    return langs, table


class Scorer:
    """Log probability per language and letters of a text, each distinct blank-separated token scored once. most: tokens kept at most."""

    def __init__(self, langs: list[str], table: np.ndarray, path: str, most: int = 600_000):
        self.vocabulary, self.langs, self.table, self.most = Vocabulary(path), langs, table, most
        self.forget()

    def forget(self) -> None:
        self.known, self.rows, self.used = {}, np.zeros((4096, len(self.langs) + 1)), 0

    def learn(self, tokens: list[bytes]) -> None:
        texts = [self.vocabulary.words(x.decode().lower()) for x in tokens]
        groups: dict[int, list] = defaultdict(list)
        for i, ws in enumerate(texts):
            for w in ws:
                groups[len(w)].append((i, w))
        values = np.zeros((len(tokens), len(self.langs) + 1))
        for length, own in groups.items():
            at = np.array([i for i, _ in own])
            total = forward(self.vocabulary.lattice([w for _, w in own], length), self.table)[-1]
            np.add.at(values, at, np.column_stack([np.log(np.maximum(total, 1e-300)), np.full(len(at), length)]))
        if self.used + len(tokens) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(len(self.rows), len(tokens)), self.rows.shape[1]))])
        self.rows[self.used : self.used + len(tokens)] = values
        self.known.update(zip(tokens, range(self.used, self.used + len(tokens)), strict=True))
        self.used += len(tokens)

    def prepare(self, texts: list[bytes | None]) -> None:
        """Learns the new tokens of texts at once; what was learned before goes when it is too much."""
        if self.used > self.most:
            self.forget()
        new = set().union(*(x.split() for x in texts if x)).difference(self.known)
        if new:
            self.learn(sorted(new))

    def score(self, text: bytes | None) -> tuple[str, float]:
        """The likeliest language, and its posterior probability under equal priors; und and 0 where there is no letter. After prepare()."""
        at = [self.known[x] for x in (text or b"").split()]
        total = self.rows[at].sum(0) if at else np.zeros(1)
        if not total[-1] or not self.langs:
            return "und", 0.0
        odds = total[:-1] - total[:-1].max()
        best = int(odds.argmax())
        return self.langs[best], float(1 / np.exp(odds).sum())


def train(docs: DataFrame, *, per_language: int = 300, longest: int = 20_000, path: str | None = None) -> tuple[list[str], np.ndarray]:
    """Fits on labelled rows whose crc32(doc_id as text) mod 3 is not 1: about per_language of each language, chosen by hash, of those whose text has longest characters at most.

    Every language that is a label is learned, from all words of its sample. Word counts come from Spark; only these counts of a bounded sample reach the driver.
    A null doc_id, text or lang is no example; rows that repeat count as often; an empty table gives a model of no language.
    """
    rows = docs.where(f"lang is not null and text is not null and doc_id is not null and length(text) <= {longest} and crc32(cast(doc_id as string)) % 3 <> 1").select("doc_id", "lang", "text")
    sizes = stored(rows.groupBy("lang").count(), "languages")  # sent out if Spark finds it small: no text is shuffled
    chosen = rows.join(sizes, "lang").where(F.expr(f"pmod(xxhash64(doc_id), 1000000) * count < {per_language} * 1000000D"))
    tokens = chosen.select("lang", F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")
    counts = tokens.groupBy("lang", "word").count().toPandas()
    model = fit(sorted(zip(counts["lang"], counts["word"], counts["count"].tolist(), strict=True)), path or default_path())
    let_go()
    return model


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], *, path: str | None = None) -> DataFrame:
    """docs with lang_pred and score (0 to 1), columns of these names replaced. Null texts and texts without a letter: und and 0.

    The whole text counts, however long; equal texts have equal results; the first language by name wins a tie; rows that repeat are each scored, an empty table gives none. A token's score is the forward algorithm's sum over all segmentations of its letter runs.
    """
    path, sent = path or default_path(), docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")))
    column, key = docs.columns.index("text"), f"language-{uuid.uuid4()}"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(key, lambda: Scorer(*sent.value, path))
        for batch in batches:
            found = []
            for texts in some(batch.column(column).cast(pa.binary()).to_pylist()):
                own.prepare(texts)
                found += map(own.score, texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    from pyspark.sql.types import StructType

    schema = StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(score, schema)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.expr("coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)").alias("held_out")
    return identify(docs.select("doc_id", "text"), train(docs)).select("doc_id", held_out, "lang_pred", "score")

