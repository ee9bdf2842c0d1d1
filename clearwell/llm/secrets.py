"""Operator 3, secret scans: fixed patterns, and a linear-chain conditional random field that adds spans, decoded by Viterbi."""

from __future__ import annotations

import hashlib
import math
import random
import re
import uuid
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import documents, held, let_go, values

#: The base kinds as the contract lists them, with the length that their last group or match must have.
KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 16),
    ("hex", re.compile(r"[0-9a-f]+"), 32),
)
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
#: Tokens of the field: runs that a secret can consist of, or any other single character that is not white space.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+|[^\sA-Za-z0-9+/_=-]")
OUTSIDE, BEGIN, INSIDE = range(3)
HEX = frozenset("0123456789abcdef")
FEATURES = 1 << 13
#: Places of the neighbours that a token's features name.
PLACES = (-3, -2, -1, 1)
#: Tokens of a training window.
WINDOW = 11

#: What planted examples consist of: keywords that announce a secret, beside those of the fixed patterns, and ways to write it.
KEYWORDS = ("pwd", "passphrase", "credential", "credentials", "auth", "private_key", "client_secret", "access_key", "bearer", "auth_token", "license_key", "signing_key", "session_key", "pass", "password", "passwd", "secret", "token", "api_key", "apikey")
FORMS = ('{k} = "{s}"', "{k}: {s}", "{k}={s}", '"{k}": "{s}"', "Authorization: Bearer {s}", "export {K}={s}", "--{k} {s}", "{k} is {s}", "{k} {s}", "user:{s}@host", "{s}")
#: Like a secret's surroundings or shape, and none.
HARMLESS = ('{w} = "{w}"', "{w}: {n}", "{w}={n}", "{w}: {w}", "version = {d}.{d}.{d}", "id: {n}", "call {d}{d}{d}-{n}", "{n}", "on 20{d}{d}-0{d}-1{d}", "{k} of {w}", "the {k} was {w}", "{k}: {w}", "https://{w}.org/{w}/{n}", "{w}_{w}", "{w}-{w}-{w}", "{W}{w}", "{W}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), in code points, by start, then kind as listed: leftmost matches of each kind that do not overlap."""
    found = []
    for k, (kind, pattern, least) in enumerate(KINDS):
        if kind == "access" and "AKIA" not in text:
            continue
        # a maximal run of hex digits is a match whether or not shorter ones come before it
        for m in (LONG_HEX if kind == "hex" else pattern).finditer(text):
            if kind == "hex" or len(m[m.lastindex or 0]) >= least:
                found.append((m.start(), m.end(), kind, k))
    return [(a, b, kind) for a, b, kind, _ in sorted(found, key=lambda x: (x[0], x[3]))]


def _hashed(x: str) -> int:
    return zlib.crc32(x.encode()) % FEATURES


def wordlike(token: str) -> bool:
    """Letters in lower case but for the first, or two (as a capital of ß gives)."""
    return token.isalpha() and (token.islower() or token[1:].islower() or token[2:].islower())


def shape(token: str) -> tuple[int, ...]:
    """Features of a token by itself, hashed."""
    if wordlike(token):
        return word_shape(min(len(token), 64), token.islower(), HEX.issuperset(token))
    return mixed_shape(token)


@lru_cache(1000)
def word_shape(n: int, lower: bool, hexes: bool) -> tuple[int, ...]:
    """Of one that is written like a word, its length, case and whether it could be a hexadecimal number."""
    return tuple(map(_hashed, ["b", f"wn{min(n, 48) // 2}", f"wl{lower}", f"wx{hexes}", f"w{min(n, 48) // 4}{lower}{hexes}"]))


@lru_cache(100_000)
def mixed_shape(token: str) -> tuple[int, ...]:
    """Of others their length, characters, entropy and changes between letters and digits; of a short one, what it is."""
    n = len(token)
    digits, upper, lower = (sum(f(c) for c in token) for f in (str.isdigit, str.isupper, str.islower))
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(token).values())
    changes = sum(a.isdigit() != b.isdigit() or a.isupper() and b.islower() for a, b in zip(token, token[1:], strict=False))
    kinds = "".join(sorted({"d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else c if c.isascii() else "?" for c in token}))[:6]
    vowels = sum(c in "aeiouAEIOU" for c in token)
    out = [f"n{min(n, 48) // 4}", f"d{round(4 * digits / n)}", f"u{round(4 * upper / n)}", f"l{round(4 * lower / n)}", f"e{round(2 * entropy)}", f"c{min(8, round(20 * changes / n))}", f"s{kinds}",
           f"x{HEX.issuperset(token)}", f"v{round(5 * vowels / max(1, upper + lower))}", f"k{kinds}{min(n, 32) // 8}"]
    return tuple(map(_hashed, ["b", *out, *([f"w{token.lower()}"] if n < 6 else [])]))


def near(tokens: list[str], i: int, cues: frozenset[str]) -> list[int]:
    """Features of token i's neighbours: which cue stands there, if one does."""
    out = []
    for d in PLACES:
        x = tokens[i + d].lower() if 0 <= i + d < len(tokens) else ""
        out.append(_hashed(f"{d}:{x if x in cues else 'other'}"))
    return out


def file_features(text: str) -> list[int]:
    """Of the whole text: equals signs, colons, braces and semicolons a line, and the share of digits."""
    lines = text.count("\n") + 1
    marks = {c: min(4, 8 * text.count(c) // lines) for c in "=:{;"}
    digits = sum(map(text.count, "0123456789"))
    return [_hashed(f"f{c}{n}") for c, n in marks.items()] + [_hashed(f"fd{min(4, 40 * digits // (len(text) + 1))}")]


def viterbi(emit: np.ndarray, move: np.ndarray) -> list[int]:
    best, back = emit[0] + (0, 0, -1e9), []
    for row in emit[1:]:
        got = best[:, None] + move
        back.append(got.argmax(0))
        best = got.max(0) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def gradient(emit: np.ndarray, move: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of the mean log likelihood of windows (windows, tokens, states), by forward and backward sums: by emission scores, by moves; and itself."""
    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)

    m, n, _ = emit.shape
    first, rows = np.array([0, 0, -1e9]), np.arange(m)
    ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
    ahead[:, 0] = emit[:, 0] + first
    for i in range(1, n):
        ahead[:, i] = total(ahead[:, i - 1, :, None] + move, 1) + emit[:, i]
    for i in range(n - 2, -1, -1):
        behind[:, i] = total(move + (emit[:, i + 1] + behind[:, i + 1])[:, None], 2)
    z = total(ahead[:, -1], 1)
    node, edge, score = -np.exp(ahead + behind - z[:, None, None]), np.zeros((3, 3)), emit[rows, 0, gold[:, 0]] + first[gold[:, 0]] - z
    for i in range(n):
        node[rows, i, gold[:, i]] += 1
        if i:
            edge -= np.exp(ahead[:, i - 1, :, None] + move + (emit[:, i] + behind[:, i])[:, None] - z[:, None, None]).sum(0)
            np.add.at(edge, (gold[:, i - 1], gold[:, i]), 1)
            score += move[gold[:, i - 1], gold[:, i]] + emit[rows, i, gold[:, i]]
    return node / m, edge / m, float(score.mean())


def synthetic(random_: random.Random) -> str:
    """A made-up secret of one of several shapes, from 8 characters."""
    hexes, upper, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    draw = lambda letters, low, high: "".join(random_.choice(letters) for _ in range(random_.randint(low, high)))
    kind = random_.randrange(8)
    if kind < 4:
        return (draw(hexes, 16, 64), draw(upper, 12, 32), draw(mixed + "+/", 20, 48) + random_.choice(["", "=", "=="]), draw(mixed, 10, 40))[kind]
    if kind == 4:
        return random_.choice(["sk_live_", "pk_", "key-", "tok_"]) + draw(mixed, 16, 36)
    if kind == 5:
        return ".".join(draw(mixed + "_-", 12, 30) for _ in range(3))
    return draw(mixed + "_-", 8, 14) if kind == 6 else draw(mixed[:52], 8, 12)


def planted(text: str, random_: random.Random) -> tuple[str, list[tuple[int, int]]]:
    """text with something planted between two of its words: a synthetic secret in one of FORMS or, once in two, something harmless; and the secret's span."""
    words = text.split(" ")
    at = random_.randrange(len(words) + 1)
    word = lambda: next((w for w in (random_.choice(words).strip(".,;:!?|*#$%&\"'") for _ in range(4)) if w.isalpha()), "word")
    key, one = random_.choice(KEYWORDS), synthetic(random_)
    if random_.random() < 0.5:
        form = random_.choice(HARMLESS)
        text = form.format(w=word().lower(), W=word().capitalize(), k=key, n=random_.randrange(10**random_.randint(3, 16)), d=random_.randrange(1, 10))
        return " ".join([*words[:at], text, *words[at:]]), []
    before, _, after = random_.choice(FORMS).partition("{s}")
    before, after = (x.format(k=key, K=key.upper()) for x in (before, after))
    start = len(" ".join(words[:at])) + (at > 0) + len(before)
    return " ".join([*words[:at], before + one + after, *words[at:]]), [(start, start + len(one))]


def fit(texts: list[str], *, rounds: int = 100, step: float = 0.5, seed: int = 7, plants: int = 3, plain: int = 3, cue: int = 5, lift: float = 20.0) -> dict:
    """Trains on texts by gradient ascent on the likelihood of windows of WINDOW tokens.

    Begin and inside are the tokens of what the base patterns find and of synthetic secrets, plants of them in each text, whose keywords and shapes go beyond the
    patterns'; all else is outside. plain: windows at random places of each text. Cues are the short neighbours that stand at the same place before or
    after cue secrets and more, lift times as often as anywhere; a planted secret's window comes once more without them, so that the shape alone can tell a secret that no keyword announces.
    """
    random_, found = random.Random(seed), []
    for text in texts:
        for k in range(plants + 1):
            own, spans = planted(text, random_) if k else (text, [])
            spans = spans + [(a, b) for a, b, _ in base_spans(own)]
            matches = list(TOKEN.finditer(own))
            tokens, gold = [m[0] for m in matches], np.zeros(len(matches), np.int64)
            starts = [m.start() for m in matches]
            for a, b in sorted(spans):
                low, high = bisect_left(starts, a), bisect_left(starts, b)
                inner = [i for i in range(max(0, low - 1), high) if matches[i].end() > a and not gold[i] and (matches[i].end() - matches[i].start() >= 4 or high - low < 4)]
                # of an assignment, only the value is the secret
                inner = [i for i in inner if i >= inner[-1] - 4 and (tokens[i][:1].isalnum() or tokens[i] == ".")][-5:] if inner else []
                inner = inner[max((j + 1 for j, i in enumerate(inner) if tokens[i].lower() in KEYWORDS or i + 1 < len(tokens) and tokens[i + 1] in (":", "=", '"')), default=0) if len(inner) > 1 else 0 :]
                for j, i in enumerate(inner):
                    gold[i] = INSIDE if j and inner[j - 1] == i - 1 else BEGIN
            if len(tokens):
                centres = {int(x) for x in np.flatnonzero(gold == BEGIN)} | ({random_.randrange(len(tokens)) for _ in range(plain)} if not k else set())
                centres |= {i for i in range(len(tokens)) if any(c.isdigit() for c in tokens[i])} if len(tokens) < 4000 and not k else set()
                if k and not spans:
                    centres |= {random_.randrange(len(tokens))} | {i for i, x in enumerate(tokens) if x.lower() in KEYWORDS or x in ("=", ":")}
                found.append((tokens, gold, file_features(own), sorted(centres)[:40]))
    counts, usual = Counter(), Counter()
    for tokens, gold, _, _ in found:
        usual.update(x.lower() for x in tokens if len(x) <= 14)
        for i in np.flatnonzero(gold == BEGIN).tolist():
            counts.update((d, tokens[i + d].lower()) for d in PLACES if 0 <= i + d < len(tokens) and len(tokens[i + d]) <= 14)
    often, whole = sum((gold == BEGIN).sum() for _, gold, _, _ in found), usual.total()
    cues = frozenset(x for (_, x), n in counts.items() if n >= max(cue, often // 500) and n * whole >= lift * usual[x] * often)
    ids, labels, width = [], [], 1 + 12 + len(PLACES) + 5
    other = [_hashed(f"{d}:other") for d in PLACES]
    for tokens, gold, file, centres in found:
        for c in centres:
            span = range(c - WINDOW // 2, c + WINDOW // 2 + 1)
            for blind in (False, True)[: 1 + (gold[c] == BEGIN)]:
                rows = [[*shape(tokens[i]), *(other if blind else near(tokens, i, cues)), *file] if 0 <= i < len(tokens) else [] for i in span]
                ids.append([r + [FEATURES] * (width - len(r)) for r in rows])
                labels.append([gold[i] if 0 <= i < len(tokens) else OUTSIDE for i in span])
    emit, move = np.zeros((FEATURES + 1, 3)), np.zeros((3, 3))
    move[OUTSIDE, INSIDE] = -1e9
    if ids and any(map(any, labels)):
        x, gold = np.array(ids, np.int64), np.array(labels, np.int64)
        gold[:, 0] = np.where(gold[:, 0] == INSIDE, BEGIN, gold[:, 0])  # a window may start within a secret
        first, moved = np.full_like(emit, 1e-6), np.full_like(move, 1e-6)
        outside = (x == FEATURES).all(2)
        for _ in range(rounds):
            scores = emit[x].sum(2)
            scores[outside] = (0, -1e9, -1e9)
            node, edge, _ = gradient(scores, move, gold)
            node[outside] = 0
            flat = np.stack([np.bincount(x.ravel(), np.repeat(node[:, :, s].ravel(), width), FEATURES + 1) for s in range(3)], 1) - 1e-5 * emit
            flat[FEATURES] = 0
            edge[OUTSIDE, INSIDE] = 0
            first += flat**2
            moved += edge**2
            emit += step * flat / np.sqrt(first)
            move += step * edge / np.sqrt(moved)
    else:
        cues = None
    return {"emit": emit, "move": move, "cues": cues}


class Field:
    """Spans by the field. A token whose emission scores favour outside by more than slack, even with the best cues where a cue stands, is fixed to
    outside, which cuts the chain; the others' runs are decoded by Viterbi. doubt is what outside gets besides, so that few
    finds are false. Words without a candidate or cue are remembered, most of them at most."""

    def __init__(self, model: dict, slack: float = 4.0, doubt: float = 2.0, most: int = 600_000):
        self.model, self.slack, self.doubt, self.most = model, slack, doubt, most
        self.plain: set[str] = set()
        if model["cues"] is None:
            return
        emit = self.emit = model["emit"]
        self.gain = np.maximum(emit[:, BEGIN], emit[:, INSIDE]) - emit[:, OUTSIDE]
        self.other = sum(self.gain[_hashed(f"{d}:other")] for d in PLACES)
        self.cued = {x: [float(self.gain[_hashed(f"{d}:{x}")] - self.gain[_hashed(f"{d}:other")]) for d in PLACES] for x in model["cues"]}
        self.files = float(sum(max(self.gain[_hashed(f"f{c}{n}")] for n in range(5)) for c in "=:{;d"))
        self.margins: dict[str, float] = {}
        self.word_margin = lru_cache(1000)(lambda *x: float(self.gain[list(word_shape(*x))].sum()) + self.other)
        self.soft = "".join(x for x in ",.;!?" if x not in self.cued and self.margin(x) + self.files + self.slack <= 0)

    def margin(self, token: str) -> float:
        if wordlike(token):
            return self.word_margin(min(len(token), 64), token.islower(), HEX.issuperset(token))
        if token not in self.margins:
            if len(self.margins) > self.most:
                self.margins.clear()
            self.margins[token] = float(self.gain[list(shape(token))].sum()) + self.other
        return self.margins[token]

    def calm(self, word: str) -> bool:
        """Whether no token of a word is a cue or may be a secret without one."""
        own = word.strip(self.soft)
        tokens = [own] if own.isascii() and own.isalpha() else TOKEN.findall(word)
        return not any(x.lower() in self.cued or self.margin(x) + self.files + self.slack > 0 for x in tokens)

    def spans(self, text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """The spans that the field finds beside those taken: none that overlaps one."""
        if self.model["cues"] is None:
            return []
        new = set(text.split()).difference(self.plain)
        calm = set(filter(self.calm, new))
        if len(calm) == len(new):
            self._remember(calm)
            return []
        self._remember(calm)
        matches = list(TOKEN.finditer(text))
        tokens, file = [m[0] for m in matches], file_features(text)
        bonus = np.array([self.margin(x) for x in tokens]) + float(self.gain[file].sum()) + self.slack
        for i, x in enumerate(tokens):
            if (own := self.cued.get(x.lower())) is not None:
                for d, v in zip(PLACES, own, strict=True):
                    if v > 0 and 0 <= i - d < len(tokens):
                        bonus[i - d] += v
        may, out = np.flatnonzero(bonus > 0), []
        for run in np.split(may, np.flatnonzero(np.diff(may) > 1) + 1) if len(may) else []:
            scores = np.array([self.emit[[*shape(tokens[i]), *near(tokens, i, self.model["cues"]), *file]].sum(0) for i in run.tolist()]) + (self.doubt, 0, 0)
            start = None
            for i, state in zip([*run.tolist(), int(run[-1]) + 1], [*viterbi(np.concatenate([scores, [[0, -1e9, -1e9]]]), self.model["move"])], strict=True):
                if start is not None and state != INSIDE:
                    out.append((matches[start].start(), matches[i - 1].end(), "field"))
                    start = None
                if state == BEGIN:
                    start = i
        return [x for x in out if not any(a < x[1] and x[0] < b for a, b, _ in taken)]

    def _remember(self, words: set[str]) -> None:
        if len(self.plain) > self.most:
            self.plain.clear()
        self.plain |= words


def train(docs: DataFrame, *, rows: int = 500, longest: int = 10_000) -> dict:
    """Fits on about rows documents by hash, 4 * rows at most, whose text has longest characters at most. Only this bounded sample reaches the driver."""
    texts = docs.where(f"text is not null and length(text) between 1 and {longest}").select("text", F.xxhash64("doc_id", "text").alias("h"))
    n = texts.count()
    chosen = texts.where(F.expr(f"pmod(xxhash64(h, 3), 1000000) < {1_000_000 * rows / max(1, n)}")).limit(4 * rows).collect()
    model = fit([r.text for r in sorted(chosen, key=lambda r: (r.h, r.text))])
    let_go()
    return model


SPANS = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_field long"


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame, model: dict) -> DataFrame:
    """The spans of every whole text, as (doc_id, counts of the base kinds, hash of the base spans, all spans, count of the field's).

    spans: kind:start:end by start, then kind as listed (field last), comma-joined; in code points, the end exclusive. Null and empty
    texts have none; long ones are scanned whole. An assignment's span is its whole match. Rows that repeat are each scanned, equal texts alike; an empty table gives none; other
    columns, clashing names too, are left out.
    """
    sent, key = docs.sparkSession.sparkContext.broadcast(model), f"secrets-{uuid.uuid4()}"
    kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = held(key, lambda: Field(sent.value))
        for batch in batches:
            out = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans = base_spans(text or "")
                more = field.spans(text or "", spans)
                n = Counter(kind for _, _, kind in spans)
                every = sorted([*spans, *more], key=lambda x: x[0])
                out.append((doc_id, n["assign"], n["access"], n["hex"], hashlib.sha256(joined(spans).encode()).hexdigest(), joined(every), len(more)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SPANS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, SPANS)


def redact(docs: DataFrame, model: dict, *, mark: str = "[SECRET]") -> DataFrame:
    """docs with mark in place of every span; of overlapping spans the whole is replaced once. Other columns stay; nulls stay null."""
    sent, column, key = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text"), f"secrets-{uuid.uuid4()}"

    def one(text: str | None, field: Field) -> str | None:
        if not text:
            return text
        spans = base_spans(text)
        out, at = [], 0
        for a, b, _ in sorted([*spans, *field.spans(text, spans)]):
            if b <= at:
                continue
            if a >= at:
                out += [text[at:a], mark]
            at = b
        return "".join([*out, text[at:]])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = held(key, lambda: Field(sent.value))
        for batch in batches:
            columns = list(batch.columns)
            columns[column] = pa.array([one(x, field) for x in values(columns[column])], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(rows, docs.schema)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scan(docs, train(docs))
