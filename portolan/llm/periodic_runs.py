"""Periodic runs of words, by online dyadic square catching.

A square is a stretch of words followed by itself; squares of one period that
touch make a run. The catcher reads a text's words as they are appended. For
every power of two ``b`` the completed blocks of ``b`` words wait for a copy
of themselves: a square whose period is from ``2b - 1`` to ``4b - 2`` holds
such a block in its first half, so each new window of ``b`` words has just two
blocks to be compared with, and all sizes together cost each word a
logarithm of comparisons. Where a window equals a block, comparisons of the
words one period apart go back as far as they agree, and on with each word
that is appended; once they span a period there is a square.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import text_or_empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAST, EXPONENT = 6, 4  # words and periods of a run, at least
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_CHUNK = 4096  # agreeing windows that are looked at before covered ones are left out again
_BATCH = 8 << 20  # code points of texts in a batch that goes back to Spark, about


class _Numbers(dict):
    """Word -> its number, by first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class _Level:
    """Hashes of the windows of one size, from the ones that still matter on."""

    def __init__(self) -> None:
        self.base, self.names = 0, np.empty(0, np.uint64)

    @property
    def done(self) -> int:
        return self.base + len(self.names)


class SquareCatcher:
    """The runs of a sequence of non-negative integers that grows.

    ``append`` takes any number of words at a time; the runs are the same
    however the words are dealt. Memory is a small multiple of the sequence.
    """

    def __init__(self) -> None:
        self.n = 0
        self._words = np.empty(64, np.int64)
        self._levels: list[_Level] = []
        self._open: dict[int, int] = {}  # period -> where the agreement that reaches the end began
        self._closed: list[tuple[int, int, int]] = []  # start, length, period

    def append(self, words: np.ndarray) -> None:
        """Take more words."""
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self._words):
            grown = np.empty(max(self.n, 2 * old), np.int64)
            grown[:old] = self._words[:old]
            self._words = grown
        self._words[old:self.n] = words
        last: dict[int, tuple[int, int]] = {}  # period -> its latest agreement
        runs: list[tuple[int, int, int]] = []  # start, end, period of the runs that reach a new word
        for period, begin in self._open.items():
            last[period] = begin, self._forward(old, period)
            if last[period][1] - begin >= period:
                runs.append((begin - period, last[period][1], period))
        b, below = 1, None
        while 3 * b - 1 <= self.n:
            k = b.bit_length() - 1
            if k == len(self._levels):
                self._levels.append(_Level())
            self._catch(b, self._levels[k], below, last, runs)
            below, b = self._levels[k], 2 * b
        self._open = {q: begin for q, (begin, end) in last.items() if end == self.n}
        self._closed += [(s, e - s, q) for s, e, q in runs if e < self.n]
        b = 1
        for level in self._levels:
            spare = max(0, level.done - 6 * b - level.base)  # a next level may still begin at 0
            level.base, level.names = level.base + spare, level.names[spare:].copy()
            b *= 2

    def runs(self, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
        """``(start, length, period)`` by start, then period: maximal
        stretches with this smallest period, of at least ``least`` words and
        ``exponent`` (2 or more) periods."""
        here = [(begin - q, self.n - begin + q, q) for q, begin in self._open.items() if self.n - begin >= q]
        return sorted((s, n, q) for s, n, q in self._closed + here if n >= max(least, exponent * q))

    def _catch(self, b: int, level: _Level, below: _Level | None, last: dict, runs: list) -> None:
        """Compare the new windows of ``b`` words with the blocks that wait
        for them."""
        done, upto = level.done, self.n - b + 1
        if below is None:
            x = self._words[done:upto].astype(np.uint64) + np.uint64(1)
            new = x * _MIX
        else:
            half, i = b // 2, done - below.base
            new = below.names[i:i + upto - done] * _MIX + below.names[i + half:i + half + upto - done] * _MIX2
        new ^= new >> np.uint64(29)
        level.names = np.concatenate([level.names, new]) if len(level.names) else new
        names, base = level.names, level.base
        first = max(done, 2 * b - 1)
        if first >= upto:
            return
        at = np.arange(first, upto)
        block = (at - (2 * b - 1)) // b * b
        now = names[first - base:upto - base]
        near = np.flatnonzero(names[block - base] == now)
        skip = max(0, 3 * b - 1 - first)  # windows that have one block before them only
        far = np.flatnonzero(names[block[skip:] - b - base] == now[skip:]) + skip
        if not len(near) and not len(far):
            return
        windows = np.concatenate([at[near], at[far]])
        periods = np.concatenate([at[near] - block[near], at[far] - block[far] + b])
        order = np.lexsort((periods, windows))
        windows, periods = windows[order], periods[order]
        live = np.ones(len(windows), bool)

        def cover(start: int, end: int, period: int) -> None:
            """Windows in a run agree at multiples of its period: no news."""
            lo, hi = np.searchsorted(windows, (start + 2 * b - 1, end - b + 1))
            q = periods[lo:hi]
            live[lo:hi] &= (q % period != 0) | (windows[lo:hi] - q < start)

        for start, end, period in runs:
            if end - start >= 3 * b - 1:
                cover(start, end, period)
        for chunk in range(0, len(windows), _CHUNK):
            for i in np.flatnonzero(live[chunk:chunk + _CHUNK]) + chunk:
                if not live[i]:
                    continue
                j, q = int(windows[i]), int(periods[i])
                if q in last and j < last[q][1]:
                    continue
                if self._words[j] != self._words[j - q]:  # the hashes met, the words don't
                    continue
                begin, end = self._back(j, q), self._forward(j, q)
                last[q] = begin, end
                if end - begin >= q:
                    runs.append((begin - q, end, q))
                    cover(begin - q, end, q)

    def _back(self, j: int, q: int) -> int:
        """Where the agreement at distance ``q`` that reaches ``j`` begins."""
        w, step = self._words, 4
        while j > q:
            lo = max(q, j - step)
            off = np.flatnonzero(w[lo:j] != w[lo - q:j - q])
            if len(off):
                return lo + int(off[-1]) + 1
            j, step = lo, 4 * step
        return j

    def _forward(self, j: int, q: int) -> int:
        """Where the agreement at distance ``q`` from ``j`` on ends."""
        w, step = self._words, 4
        while j < self.n:
            hi = min(self.n, j + step)
            off = np.flatnonzero(w[j:hi] != w[j - q:hi - q])
            if len(off):
                return j + int(off[0])
            j, step = hi, 4 * step
        return j


def text_runs(words: list[str], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """The runs of a list of words."""
    catcher = SquareCatcher()
    catcher.append(np.fromiter(map(_Numbers().__getitem__, words), np.int64, len(words)))
    return catcher.runs(least, exponent)


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    kept, at = [], 0
    for start, end in sorted((s + q, s + n) for s, n, q in runs):
        kept += words[at:start]
        at = max(at, end)
    return kept + words[at:]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST,
         exponent: int = EXPONENT) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row: runs is an array of
    ``start, length, period`` in words, by start and then period; collapsed is
    the words, without those in a run after its first period, with one space
    between.

    Words are runs of other than ASCII white space; case counts. Whole texts
    are read in tasks, in time and memory that grow with a text's length and
    its logarithm; no row moves. A null text counts as empty: no words, no
    runs, an empty collapsed text. Null ids and repeated rows come back as
    they are; an empty table gives no rows. Other columns are not read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), _RUNS, pa.string()), strict=True)],
                names=["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            out, held = ([], [], [], []), 0
            for doc, body in zip(batch.column(0), batch.column(1), strict=True):
                words = WORD.findall(body.as_py())
                runs = text_runs(words, least, exponent)
                found = [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
                for column, value in zip(out, (doc.as_py(), len(words), found, " ".join(collapse(words, runs))), strict=True):
                    column.append(value)
                held += len(out[3][-1])
                if held > _BATCH:
                    yield packed()
                    out, held = ([], [], [], []), 0
            if out[0]:
                yield packed()

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(
        work, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
