"""Byte-level BPE by whole tokens: most pre-tokens are one vocabulary string.

A text is split into pre-tokens. A vocabulary string that the tokenizer,
given this string alone, turns into exactly one pre-token and one id needs no
merging wherever it occurs as a pre-token, because merges never look past a
pre-token. ``prove_whole`` checks that for every string of the vocabulary,
once, on the driver. Tasks look pre-tokens up in that table and merge the
rest with the tokenizer's own model, each distinct one once while it stays in
a bounded cache.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

from tokenizers import Tokenizer

# --- fixed values: the classes of the pattern within Latin-1 -----------------
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\t-\r \x85\xa0"
# -----------------------------------------------------------------------------
LATIN1 = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
#: Learned pre-tokens in a generation of a worker's cache, and the longest one that is kept, in characters.
CACHE_ENTRIES, CACHED_CHARS = 350_000, 64


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """Byte -> the character that stands for it in a byte-level vocabulary.

    Printable bytes stand for themselves, the others take the code points
    from 256 on, in order.
    """
    plain = {b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}


def prove_whole(spec: str) -> dict[str, int]:
    """Vocabulary strings that encode alone as one token, with its id."""
    tok = Tokenizer.from_str(spec)
    back = {c: b for b, c in byte_letters().items()}
    texts = []
    for piece in tok.get_vocab(with_added_tokens=False):
        try:
            texts.append(bytes(back[c] for c in piece).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):
            continue  # no text of its own: part of a character
    whole = {}
    for t, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        if len(e.ids) == 1 and len(tok.pre_tokenizer.pre_tokenize_str(t)) == 1:
            whole[t] = e.ids[0]
    return whole


class _Cache(dict):
    """Pre-token -> value; unknown ones are merged and kept, up to the bound, for two generations after their last use."""

    def __init__(self, whole: dict, merge):
        super().__init__(whole)
        self.whole, self.merge, self.limit = whole, merge, len(whole) + CACHE_ENTRIES
        self.older: dict = {}

    def __missing__(self, pre: str):
        v = self.older.get(pre)
        if v is None:
            v = self.merge(pre)
        if len(self) >= self.limit:
            self.older = {p: v for p, v in self.items() if p not in self.whole}
            self.clear()
            self.update(self.whole)
        if len(pre) <= CACHED_CHARS:
            self[pre] = v
        return v


class WholeTokenBpe:
    """Token counts and ids of texts, equal to the library's.

    ``spec`` is the tokenizer's JSON text, ``whole`` the proved table. Added
    tokens inside a text are found first, as the library does by default; a
    tokenizer whose added tokens strip or need word bounds, or that
    normalises, is refused.
    """

    def __init__(self, spec: str, whole: dict[str, int]):
        d = json.loads(spec)
        if d.get("normalizer") or d["pre_tokenizer"].get("type") != "ByteLevel" or d["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("only byte-level tokenizers without normalizer and prefix space")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in d["added_tokens"]):
            raise ValueError("added tokens that strip or need word bounds are not supported")
        self.tok = Tokenizer.from_str(spec)
        self.letters = byte_letters()
        self.added = {a["content"]: a["id"] for a in d["added_tokens"]}
        alternatives = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        self.special = re.compile(f"({alternatives})") if self.added else None
        self.lengths = _Cache(dict.fromkeys(whole, 1), lambda p: len(self._merge(p)))
        self.id_bytes = _Cache(
            {t: struct.pack("<I", i) for t, i in whole.items()}, lambda p: struct.pack(f"<{len(m := self._merge(p))}I", *m)
        )

    def _merge(self, pre: str) -> list[int]:
        return [t.id for t in self.tok.model.tokenize(pre.encode("utf-8").decode("latin-1").translate(self.letters))]

    def pre_tokens(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:  # the library's own tables decide beyond Latin-1
            return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        return LATIN1.findall(text)

    def _parts(self, text: str) -> list[str]:
        return self.special.split(text) if self.special and any(a in text for a in self.added) else [text]

    def count(self, text: str) -> int:
        n = 0
        for part in self._parts(text):
            n += 1 if part in self.added else sum(map(self.lengths.__getitem__, self.pre_tokens(part)))
        return n

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(
            struct.pack("<I", self.added[part])
            if part in self.added
            else b"".join(map(self.id_bytes.__getitem__, self.pre_tokens(part)))
            for part in self._parts(text)
        )


_WORKER: dict[int, WholeTokenBpe] = {}


class SharedBpe:
    """Spec and whole-token table as one broadcast (bounded by the vocabulary).

    A Python worker builds its encoder once and keeps it for later tasks.
    """

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            spec = f.read()
        self.data = spark.sparkContext.broadcast((spec, prove_whole(spec)))

    def encoder(self) -> WholeTokenBpe:
        spec, whole = self.data.value
        key = hash(spec)
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = WholeTokenBpe(spec, whole)
        return _WORKER[key]
