import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from portolan.llm import periodic_runs
from portolan.llm.periodic_runs import SquareCatcher, collapse, text_runs
from portolan.llm.registry import _runs_digest, _with_periodic_ends

from .helpers import awkward_rows, documents, words


def plain(seq, least=6, exponent=4):
    """Every period in turn, by its definition."""
    out, n = [], len(seq)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            begin = i
            while i < n and seq[i] == seq[i - q]:
                i += 1
            run = seq[begin - q:i]
            if i - begin >= q and len(run) >= max(least, exponent * q) and not any(
                    run[p:] == run[:-p] for p in range(1, q)):
                out.append((begin - q, len(run), q))
            i += 1
    return sorted(out)


def sequences(seed, rounds):
    rng = random.Random(seed)
    for _ in range(rounds):
        seq = [rng.randrange(rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randrange(90))]
        if len(seq) > 5 and rng.random() < 0.6:
            a = rng.randrange(len(seq))
            p = 1 + (len(seq) - a) // rng.randrange(2, 9)
            seq = [x if i < a else seq[a + (i - a) % p] for i, x in enumerate(seq)]
        yield seq


@pytest.mark.parametrize("least, exponent", [(1, 2), (6, 4), (9, 3)])
def test_against_plain_version(least, exponent):
    for seq in sequences(least, 300):
        assert text_runs([str(x) for x in seq], least, exponent) == plain(seq, least, exponent)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120), st.lists(st.integers(1, 9), min_size=1, max_size=30))
def test_any_dealing_of_the_words_gives_the_same_runs(seq, steps):
    catcher, at, i = SquareCatcher(), 0, 0
    while at < len(seq):
        step = steps[i % len(steps)]
        catcher.append(np.array(seq[at:at + step]))
        at, i = at + step, i + 1
        assert catcher.runs(1, 2) == plain(seq[:at], 1, 2)


def test_a_square_is_reported_when_its_last_word_comes():
    catcher = SquareCatcher()
    for i, x in enumerate([7, 1, 2, 3, 1, 2, 3, 1, 9]):
        catcher.append(np.array([x]))
        assert catcher.runs(1, 2) == ([] if i < 6 else [(1, min(i, 7), 3)])


def test_long_runs_take_time_in_proportion():
    began = time.monotonic()
    assert text_runs(["a"] * 400_000) == [(0, 400_000, 1)]
    assert text_runs([str(i % 700) for i in range(200_000)]) == [(0, 200_000, 700)]
    rng = random.Random(1)
    assert text_runs([str(rng.randrange(400)) for _ in range(300_000)]) == []
    assert time.monotonic() - began < 30


def test_collapse_keeps_the_first_period():
    seq = "x a b a b a b a b y c c c c c c z".split()
    runs = text_runs(seq)
    assert runs == [(1, 8, 2), (10, 6, 1)]
    assert collapse(seq, runs) == "x a b y c z".split()
    assert collapse(seq, [(1, 8, 2), (4, 3, 1)]) == [w for i, w in enumerate(seq) if not 3 <= i < 9]


def digest(rows):
    """The query's columns by the contract."""
    out = []
    for doc, text, *_ in rows:
        seq = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        g, n = h // 10, len(seq)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            seq = seq[:a] + [seq[a + i % p] for i in range(n - a)]
        runs = plain(seq) if n < 2_000 else text_runs(seq)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        out.append((doc, len(runs), *best, best[1] and 1000 * best[1] // best[2],
                    hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
                    hashlib.sha256(" ".join(w for i, w in enumerate(seq) if i not in gone).encode()).hexdigest(), n))
    return sorted(out, key=str)


def test_query_against_plain_version(spark):
    rng = random.Random(3)
    rows = awkward_rows() + [(1000 + i, words(rng, rng.randrange(200)), "en", "s", 1) for i in range(60)]
    rows += [(2000, "la " * 50 + "x", "en", "s", 1), (2001, "  a b a b a b a b a b a b", "en", "s", 1)]
    got = _runs_digest(periodic_runs.find(_with_periodic_ends(documents(spark, rows, extra=True)))).collect()
    assert sorted(map(tuple, got), key=str) == digest(rows)
    assert sum(r.n_runs for r in got) > 5


def test_empty_table_and_schema(spark):
    got = periodic_runs.find(documents(spark, []))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"] and got.collect() == []
