"""Token ids of whole texts, in tasks."""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Up to U+024F, all characters have the same class in every Unicode version.
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
# The faster library's pattern matching can't get over a run much longer than this.
_LONG_SPACE = re.compile(r"\s{100000}")
# Any other space begins a part of the pattern, so ids never reach across it.
_OPEN_SPACE = r" ([\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"
STEP = 1 << 16  # words whose ids are put together at a time


class _Settled(dict):
    """Character -> whether its class (letter, number, space, other) has been
    the same since an early Unicode version, so that two libraries with
    different Unicode tables split a text at the same places."""

    def __missing__(self, c: str) -> bool:
        early, now = unicodedata.ucd_3_2_0.category(c)[0], unicodedata.category(c)[0]
        self[c] = early == now != "C"
        return self[c]


class TextEncoder:
    """``ids(text)``: little-endian 32-bit ids as bytes, those that the JSON
    tokenizer gives as loaded, with no special tokens added: where a text
    holds an added token's string, that token's id.

    ``vocabulary`` is the JSON file of the tokenizer. ``ranks`` and
    ``pattern``, if given, are the same vocabulary as byte ranks: a faster
    library gives the same ids with them, and works out texts of settled
    characters, that is nearly all. ``pattern`` must split at every space that
    something other than white space follows, whatever stands around it.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.fast, self.settled = None, _Settled()
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merged = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merged, special_tokens={})
            self.sizes = np.zeros(max(merged.values()) + 1, np.int64)  # bytes of each id
            self.sizes[list(merged.values())] = list(map(len, merged))

    def _plain(self, text: str) -> bool:
        """Whether the faster library gives the same ids."""
        settled = text.isascii() or not _BEYOND_LATIN.search(text) or all(map(self.settled.__getitem__, set(text)))
        plain = settled and not (self.added and self.added.search(text))
        return bool(self.fast and plain and not (len(text) > 100_000 and _LONG_SPACE.search(text)))

    def _encode(self, text: str) -> list[int]:
        return self._encode_as(text, self._plain(text))

    def _encode_as(self, text: str, plain: bool) -> list[int]:
        return self.fast.encode_ordinary(text) if plain else self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        out = array("I", self._encode(text))
        if array("I", [1]).tobytes() != b"\1\0\0\0":
            out.byteswap()
        return out.tobytes()

    def stream(self, texts: list[str], end_id: int) -> Iterator[np.ndarray]:
        """The ids of all texts in turn, ``end_id`` after each text."""
        codes, bounds, ids = self._by_words(texts, end_id)
        for at in range(0, len(codes), STEP):
            own = codes[at:at + STEP]
            n = bounds[own + 1] - bounds[own]
            to = np.cumsum(n)
            yield ids[np.repeat(bounds[own] - (to - n), n) + np.arange(to[-1])]

    def stream_length(self, texts: list[str]) -> int:
        """How many ids ``stream`` gives."""
        codes, bounds, _ = self._by_words(texts, 0)
        return int(np.diff(bounds)[codes].sum())

    def _by_words(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``codes, bounds, ids``: the texts as codes, where a code c stands
        for ``ids[bounds[c]:bounds[c + 1]]``.

        A text is its head, then its words, each with the space before it,
        then the end. A word that the texts hold several times is worked out
        once. Texts that can't be split at their spaces are heads as a whole.
        """
        body = pa.array(texts, pa.string())
        plain = np.array(list(map(self._plain, texts)), bool)
        split = plain & ~pc.match_substring_regex(body, _OPEN_SPACE).to_numpy(zero_copy_only=False).astype(bool)
        parts = pc.split_pattern(body.filter(pa.array(split)), " ")
        offsets, flat = parts.offsets.to_numpy(), parts.values
        inner = np.ones(len(flat), bool)
        inner[offsets[:-1]] = False
        found = flat.filter(pa.array(inner)).dictionary_encode()
        ids, to = self._words(found.dictionary)
        first = iter(flat.take(pa.array(offsets[:-1])).to_pylist())
        heads = [self._encode_as(next(first) if s else x, p) for x, s, p in zip(texts, split, plain, strict=True)]
        bounds = np.concatenate([[0], to, len(ids) + np.cumsum([*map(len, heads), 1])])

        sizes = np.full(len(texts), 2)
        sizes[split] += np.diff(offsets) - 1
        ends = np.cumsum(sizes)
        codes = np.full(sizes.sum(), -1)
        codes[ends - sizes] = len(to) + np.arange(len(texts))
        codes[ends - 1] = len(to) + len(texts)
        codes[codes < 0] = found.indices.to_numpy()
        return codes, bounds, np.concatenate([ids, *[np.array(array("I", x)) for x in heads], np.array([end_id], "u4")])

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with a space before it, and where each
        word's ids end: where its bytes do."""
        if not len(words):
            return np.empty(0, "u4"), np.empty(0, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py()
        ids = np.array(array("I", self.fast.encode_ordinary(" " + joined)))
        reached, ends = np.cumsum(self.sizes[ids]), np.cumsum(pc.binary_length(words).to_numpy() + 1, dtype=np.int64)
        to = np.searchsorted(reached, ends)
        if (reached[to] != ends).any():
            raise RuntimeError("an id reaches across a space that begins a word")
        return ids, to + 1


@lru_cache(maxsize=2)
def byte_bpe(vocabulary: str | None = None) -> TextEncoder:
    """The public 50k byte-level vocabulary, or one at a given path. One
    encoder for each Python worker."""
    import public_tokenizers as P

    own = P.path("byte_bpe_50k.json")
    if vocabulary and vocabulary != own:
        return TextEncoder(vocabulary)
    return TextEncoder(own, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
