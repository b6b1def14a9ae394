import math
from collections import Counter, defaultdict

import pytest

from portolan.llm import mixing

from .helpers import awkward_rows, documents, words


def corpus(seed=1):
    import random

    rng = random.Random(seed)
    sizes = {"big": 300, "mid": 90, "small": 25, "tiny": 4}
    return [(i, words(rng, rng.randrange(1, 40)), "en", s, 1) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]


def tokens(row):
    return -(-len((row[1] or "").encode()) // mixing.TOKEN_BYTES) + 1


def weights(rows, exponent):
    t = Counter()
    for r in rows:
        t[r[3]] += tokens(r)
    total = sum(t.values())
    up = {s: (x / total) ** exponent for s, x in t.items()}
    z = sum(up.values())
    return {s: u / z for s, u in up.items()}, {s: x / total for s, x in t.items()}, t


@pytest.mark.parametrize("repeats", [1.0, 2.0, 4.0, 1e6])
def test_exponent_meets_the_repetition_limit(spark, repeats):
    rows = corpus()
    shares = mixing.source_shares(spark.createDataFrame([(r[3], tokens(r)) for r in rows], "source string, n_tokens long"))
    a = mixing.fit_exponent(shares, repeats)
    _, p, _ = weights(rows, 1.0)
    want = max(0.0, 1 - math.log(repeats) / math.log(max(p.values()) / min(p.values())))
    assert a == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize("entropy", [0.9, 1.2, 5.0, 0.0])
def test_exponent_meets_the_entropy(spark, entropy):
    rows = corpus()
    shares = mixing.source_shares(spark.createDataFrame([(r[3], tokens(r)) for r in rows], "source string, n_tokens long"))
    a = mixing.fit_exponent(shares, None, entropy)
    h = lambda x: -sum(q * math.log(q) for q in weights(rows, x)[0].values())
    if entropy == 5.0:
        assert a == 0.0
    elif entropy == 0.0:
        assert a == 1.0
    else:
        assert h(a) >= entropy - 1e-6 and h(min(1.0, a + 1e-6)) < entropy + 1e-6


@pytest.mark.parametrize("block_rows", [5, 10_000])
def test_realised_tokens(spark, block_rows):
    rows = corpus()
    got = mixing.mix(documents(spark, rows), 3.0, block_rows=block_rows).collect()
    assert len(got) == len(rows) and all(r.copies >= 1 for r in got)
    _, p, t = weights(rows, 1.0)
    a = max(0.0, 1 - math.log(3.0) / math.log(max(p.values()) / min(p.values())))
    q, _, _ = weights(rows, a)
    least = min(q[s] / p[s] for s in p)
    spent = defaultdict(int)
    for r in got:
        assert r.weight == pytest.approx(q[r.source])
        spent[r.source] += r.copies * r.n_tokens
    biggest = max(map(tokens, rows))
    for s in p:
        due = q[s] / p[s] / least * t[s]
        assert due - biggest <= spent[s] <= due + 1
    # A reading takes whole blocks but for one.
    for s in p:
        blocks = defaultdict(set)
        for r in got:
            if r.source == s:
                blocks[r.block].add(r.copies)
        assert sum(len(v) > 1 for v in blocks.values()) <= 1


def test_same_result_on_other_partitions(spark):
    docs = documents(spark, corpus())
    a = sorted(map(tuple, mixing.readings(mixing.mix(docs.repartition(9))).collect()))
    assert a == sorted(map(tuple, mixing.readings(mixing.mix(docs.coalesce(1))).collect()))


@pytest.mark.parametrize("extra", [False, True])
def test_repeat_rows(spark, extra):
    rows = awkward_rows()
    docs = documents(spark, rows, extra)
    mixed = mixing.mix(docs, 2.0).collect()
    assert len(mixed) == len(rows)
    out = mixing.repeat_rows(docs, 2.0)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert set(got) == {(r[0], r[1]) for r in rows}
    assert max(got.values()) <= 2 * max(Counter((r[0], r[1]) for r in rows).values())


def test_empty_and_single_source(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert {r.copies for r in mixing.mix(documents(spark, [(1, "a b", "en", None, 1), (2, "c", "en", None, 1)])).collect()} == {1}


def test_texts_without_spaces_count_by_their_length(spark):
    rows = [(1, "日本語の文章です" * 30, "ja", "a", 1), (2, "plain words " * 60, "en", "b", 1)]
    got = {r.source: r.n_tokens for r in mixing.mix(documents(spark, rows)).collect()}
    assert got == {"a": 181, "b": 181}
