import hashlib
import random

import pytest
from pyspark.sql import functions as F

from portolan.llm import common, order_minhash
from portolan.llm.neighbours import with_next
from portolan.llm.registry import QUERIES

from .helpers import awkward_rows, documents, words


def plain(spark, texts):
    """The fingerprints worked out in Python over Spark's own hash values."""
    kmers = {}
    for t in texts:
        w = (t or "").split()
        kmers[t] = [(a, b) for a, b in zip(w, [*w[1:], None])]
    flat = sorted({k for ks in kmers.values() for k in ks}, key=str)
    if not flat:
        return {t: [] for t in texts}
    low = (1 << 36) - 1
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(flat)], "i long, a string, b string")
    base = {flat[r.i]: r.h & low for r in df.select("i", F.xxhash64("a", "b").alias("h")).collect()}
    again = {(base[k], n) for ks in kmers.values() for k in set(ks) for n in range(1, ks.count(k))}
    numbered = {}
    if again:
        df = spark.createDataFrame(sorted(again), "h long, n int")
        numbered = {(r.h, r.n): r.x & low for r in df.select("h", "n", F.xxhash64("h", "n").alias("x")).collect()}
    tuples, out = [], {}
    for t, ks in kmers.items():
        seen, bins = {}, {}
        for pos, k in enumerate(ks):
            n = seen[k] = seen.get(k, -1) + 1
            h = numbered[base[k], n] if n else base[k]
            bins.setdefault(h >> 30, []).append((h, pos))
        out[t] = {b: [h for h, _ in sorted(sorted(v)[:2], key=lambda x: x[1])] for b, v in bins.items()}
        tuples += [tuple(v) for v in out[t].values()]
    tuples = sorted(set(tuples))
    df = spark.createDataFrame([(i, v[0], v[1] if len(v) > 1 else None) for i, v in enumerate(tuples)], "i long, a long, b long")
    hashed = {tuples[r.i]: r.x & 0xFFFFFFFF for r in df.select("i", F.xxhash64("a", "b").alias("x")).collect()}
    return {t: sorted((b << 32) | hashed[tuple(v)] for b, v in bins.items()) for t, bins in out.items()}


def test_against_plain_version(spark):
    rng = random.Random(3)
    texts = ["", "a", "a a a a a a", "to be or not to be " * 7, words(rng, 400), words(rng, 900, 4), None, "  x  y "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.fp for r in order_minhash.add_fingerprint(df, "t", "fp").collect()}
    want = plain(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == want[t], t


def test_follows_edits_and_order(spark):
    rng = random.Random(4)
    w = words(rng, 600, 5000).split()
    edited = list(w)
    for i in rng.sample(range(600), 20):
        edited[i] = "changed"
    blocks = [w[i:i + 10] for i in range(0, 600, 10)]
    rng.shuffle(blocks)
    texts = [w, edited, [x for b in blocks for x in b], words(rng, 600, 5000).split()]
    df = spark.createDataFrame([(" ".join(w), " ".join(t)) for t in texts], "a string, b string")
    df = order_minhash.add_fingerprint(order_minhash.add_fingerprint(df, "a", "fa"), "b", "fb")
    same, few, moved, other = [r[0] for r in df.select(order_minhash.likeness("fa", "fb")).collect()]
    assert same == 1.0 and few > 0.6 and moved < few and other < 0.05


@pytest.mark.parametrize("rows", ["awkward", "one", "none"])
def test_query(spark, tmp_path, rows):
    rows = {"awkward": [r for r in awkward_rows() if r[0] is not None][:-2], "one": [(7, "a b c d", "en", "s", 7)], "none": []}[rows]
    documents(spark, rows, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op2_order_minhash"](spark, str(tmp_path)).collect()}
    by = {r[0]: r[1] or "" for r in rows}
    order = sorted(by, reverse=True)
    assert len(got) == len(rows)
    for i, doc in enumerate(order):
        text, after = by[doc], by[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if after == text:
            assert r.near_next == 1.0
    prints = {}
    for doc, r in got.items():
        prints.setdefault(by[doc], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values())


def test_null_and_repeated_ids(spark, tmp_path):
    rows = awkward_rows()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op2_order_minhash"](spark, str(tmp_path)).count() == len(rows)


@pytest.mark.parametrize("n", [10, 20, 40, 100])
def test_moved_halves_of_short_texts(spark, n):
    rng = random.Random(n)
    texts = [words(rng, n, 5000).split() for _ in range(40)]
    df = spark.createDataFrame([(" ".join(w), " ".join(w[n // 2:] + w[:n // 2])) for w in texts], "a string, b string")
    df = order_minhash.add_fingerprint(order_minhash.add_fingerprint(df, "a", "fa", fill=True), "b", "fb", fill=True)
    got = df.select(order_minhash.likeness("fa", "fb").alias("x"), F.size("fa").alias("n")).collect()
    assert {r.n for r in got} == {order_minhash.BINS}
    # Independent permutations: both k-mers of a pair are common, and from the same half.
    want = (n - 2) / (n + 2) * (n - 3) / (n + 1) * (n // 2 - 2) / (n - 3)
    assert abs(sum(r.x for r in got) / len(got) - want) < 0.1


def test_filled_bins(spark):
    rng = random.Random(5)
    texts = ["", None, "a", "b a", "a a a a a", words(rng, 30), words(rng, 100), words(rng, 3000)]
    want = plain(spark, texts)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.fp for r in order_minhash.add_fingerprint(df, "t", "fp", fill=True).collect()}
    assert [[x >> 32 for x in got[i]] for i in range(len(texts))] == [list(range(64)) if t else [] for t in texts]
    # Full bins as without filling; a lone k-mer is the tuple of every bin, and one pair where a text has no other.
    assert got[7] == want[texts[7]]
    assert {x & 0xFFFFFFFF for x in got[2]} == {x & 0xFFFFFFFF for x in want["a"]}
    assert len({x & 0xFFFFFFFF for x in got[3]}) == 1
    # A bin that is empty without filling has the tuple of the next one round the ring.
    used = {x >> 32 for x in want[texts[5]]}
    tuples = [x & 0xFFFFFFFF for x in got[5]]
    assert len(used) < 64 and all(tuples[b] == tuples[(b + 1) % 64] for b in range(64) if b not in used)


@pytest.mark.parametrize("fill", [True, False])
def test_columns_named_as_the_working_ones_stay(spark, fill):
    docs = documents(spark, awkward_rows()).withColumns({f"fp_{c}": F.lit(c) for c in "wstm"})
    got = order_minhash.add_fingerprint(docs, "text", "fp", fill=fill)
    assert got.columns == [*docs.columns, "fp"]
    assert {(r.fp_w, r.fp_s, r.fp_t, r.fp_m) for r in got.collect()} == {("w", "s", "t", "m")}


def test_successors_keep_every_column(spark):
    rows = [r for r in awkward_rows() if r[0] is not None][:-2]
    docs = documents(spark, rows, extra=True).withColumn("tie_break", F.lit(0).cast("long"))
    got = with_next(docs, "doc_id", "tie_break", {"text": "after"})
    assert got.columns == [*docs.columns, "after"]
    order = sorted((r[0] for r in rows), reverse=True)
    by = {r[0]: r[1] for r in rows}
    found = {r.doc_id: r for r in got.collect()}
    for i, doc in enumerate(order):
        assert found[doc].after == by[order[(i + 1) % len(order)]] and found[doc]._range == "extra _range"


def test_ranges_are_bounded_however_many_are_asked_for(spark, monkeypatch):
    ids = [(i * 37 % 5000 if i % 9 else None,) for i in range(6000)] + [(7,)] * 500
    df = spark.createDataFrame(ids, "id long").repartition(5)
    for coarse, fine, ranges in [(1000, 1000, 50), (1000, 1000, 800_000), (10, 8, 60), (10, 8, 10**9)]:
        monkeypatch.setattr(common, "COARSE", coarse)
        monkeypatch.setattr(common, "FINE", fine)
        got = common.with_ranges(df, "id", "range", ranges).groupBy("range").agg(
            F.min("id"), F.max("id"), F.count("*"), F.max(F.col("id").isNull())).orderBy("range").collect()
        assert sum(r[3] for r in got) == len(ids) and len(got) <= min(ranges, coarse * fine)
        assert all(a[2] < b[1] for a, b in zip(got, got[1:]) if a[2] is not None)  # ascending and disjoint
        assert [r[0] for r in got if r[4]] == [0]  # nulls
        if ranges == 50:
            assert 40 < len(got) <= 50  # the id that repeats fills some
        if ranges == 800_000:
            assert len(got) > 2000
        if coarse == 10:
            assert 40 <= len(got) <= 81
