"""Token ids by the tokenizers library, each distinct piece of text encoded once per worker."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

from clearwell.llm.common import held


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Cut off where they end a piece after a letter. None occurs in a special token's text.
SIGNS = ".,;:!?$*#&%"


class Encoder:
    """Ids of texts by a byte-level BPE of the tokenizers library, without special tokens.

    Byte-level BPE never merges across the cuts of its pre-tokenizer, and that always cuts before a blank between two other
    characters, on both sides of a lone line end, and between a letter and a sign. So a text is cut there, the new pieces of a
    run of texts are encoded at once, and the ids of each piece are kept for later texts. The ids equal those of the whole text
    (tested). held: pieces kept at most; with more, all are forgotten.
    """

    def __init__(self, path: str, held: int = 1_200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.held, self.known = Tokenizer.from_file(path), held, {}
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")

    def encode(self, text: str) -> bytes:
        """The ids, as little-endian integers of self.kind."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        cut = [self._cut(x) for x in texts]
        if len(self.known) > self.held:
            self.known.clear()
        new = set().union(*cut).difference(self.known)
        if new:
            self._learn(new)
        of = self.known.__getitem__
        out = [b"".join(map(of, x)) for x in cut]
        for x in new:
            if len(x) >= 200:
                del self.known[x]
        return out

    def runs(self, texts: Iterable[str | None], characters: int = 1_000_000) -> Iterator[bytes]:
        """The ids of each text, a run of about so many characters at a time; null: an empty text."""
        own, size = [], 0
        for text in texts:
            own.append(text or "")
            size += len(own[-1])
            if size > characters:
                yield from self.encode_all(own)
                own, size = [], 0
        yield from self.encode_all(own)

    def _cut(self, text: str) -> list[str]:
        if not text:
            return []
        if len(text.split()) != text.count(" ") + text.count("\n") + 1 or "\0" in text:
            return self._regular(text)  # white space other than single blanks and line ends between words, or the mark used for cutting
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def _learn(self, new: set[str]) -> None:
        stems = {x: stem for x in new if x[-1:] in SIGNS and (last := (stem := x.rstrip(SIGNS))[-1:]).isalpha() and last < "\u0250"}
        whole = new.difference(stems).union(stems.values(), {x[len(stem) :] for x, stem in stems.items()})
        whole = list(whole.difference(self.known))
        found = self._encode(whole)
        ids = dict(zip(whole, found, strict=True))
        self.known.update((x, y) for x, y in ids.items() if len(x) < 200 or x in new)
        of = lambda x: ids[x] if x in ids else self.known[x]
        self.known.update([(x, of(stem) + of(x[len(stem) :])) for x, stem in stems.items()])

    def _encode(self, pieces: list[str], run: int = 64) -> list[bytes]:
        """The ids of each piece. Those without white space but a blank before them are encoded in runs with line ends between them, whose id parts them again."""
        out: list[bytes | None] = [None] * len(pieces)
        plain = [i for i, x in enumerate(pieces) if len(own := x.split()) == 1 and (x == own[0] or x == " " + own[0]) and "<|" not in x] if len(self.line) == 1 else []
        size, runs = self.kind.itemsize, [plain[i : i + run] for i in range(0, len(plain), run)]
        for own, found in zip(runs, self.tokenizer.encode_batch_fast(["\n".join([pieces[j] for j in own]) for own in runs], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, self.kind)
            ends = np.flatnonzero(ids == self.line[0])
            if len(ends) == len(own) - 1:
                whole, at = ids.tobytes(), [0, *((ends + 1) * size).tolist()]
                for j, start, end in zip(own, at, [*(ends * size).tolist(), len(whole)], strict=True):
                    out[j] = whole[start:end]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(x.ids, self.kind).tobytes()
        return out

    @staticmethod
    def _regular(text: str) -> list[str]:
        """Cut only before a blank that stands between two characters that are not white space."""
        return re.split(r"(?<=[^\s\x1c-\x1f\x00])(?= [^\s\x1c-\x1f\x00])", text)


def encoder(path: str, pieces: int = 1_200_000) -> Encoder:
    """The encoder of this process, which keeps so many pieces at most."""
    return held(f"encoder-{path}-{pieces}", lambda: Encoder(path, pieces))
