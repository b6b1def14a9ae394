import hashlib
import random

import pytest
from pyspark.sql import functions as F

from portolan.llm import exact_dedup

from .helpers import awkward_rows, documents, words


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for r in rows:
        ids = [x for x in groups[r[1] or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((r[0], keep, len(groups[r[1] or ""]), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=str)


# Few hash bits make chunks collide, so that ordinals decide.
@pytest.mark.parametrize("bits", [64, 3, 0])
@pytest.mark.parametrize("extra", [False, True])
def test_groups(spark, bits, extra):
    rng = random.Random(6)
    base = ". ".join(words(rng, 12) for _ in range(60))
    near = [base, base[:-1] + "q", "q" + base[1:], base[:2000] + "!" + base[2001:], base + " ", base]
    rows = awkward_rows() + [(500 + i, t, "en", "s", 1) for i, t in enumerate(near)]
    got = exact_dedup.exact_groups(documents(spark, rows, extra), hash_bits=bits).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_chunks_join_to_the_text_and_follow_its_content(spark):
    rng = random.Random(7)
    base = ". ".join(words(rng, 12) for _ in range(200))
    texts = ["", "x", "🎉" * 9000, "a" * 5000, "\n\n\n", base, "new start " + base, base + "!\r\n" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.c for r in df.select("i", exact_dedup.chunks(F.col("t")).alias("c")).orderBy("i").collect()]
    for t, c in zip(texts, got, strict=True):
        assert "".join(c) == t and all(0 < len(x) <= exact_dedup.MAX_CHUNK for x in c)
    assert len(set(got[5]) & set(got[6])) > 0.5 * len(got[5])  # cuts meet again after an insertion


def test_keep_one(spark):
    rows = awkward_rows()
    docs = documents(spark, rows, extra=True)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    want = {(r[0], r[1]) for r, k in zip(rows, rows, strict=True)
            if r[0] == max((x[0] for x in rows if (x[1] or "") == (r[1] or "") and x[0] is not None), default=None)}
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert exact_dedup.exact_groups(documents(spark, [])).collect() == []


@pytest.mark.parametrize("kind", ["words", "letters", "hex", "ideographs", "lines"])
def test_cuts_follow_content_without_sentence_ends(spark, kind):
    rng = random.Random(8)
    base = {"words": words(rng, 6000, 5000),
            "letters": "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(40000)),
            "hex": "".join(rng.choice("0123456789abcdef") for _ in range(40000)),
            "ideographs": "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(40000)),
            "lines": "\n".join(words(rng, 4) for _ in range(2000))}[kind]
    df = spark.createDataFrame([(0, base), (1, "x y" + base), (2, base[:9000] + "inserted" + base[9000:])], "i int, t string")
    got = {r.i: r.c for r in df.select("i", exact_dedup.chunks(F.col("t")).alias("c")).collect()}
    assert all("".join(got[r.i]) == r.t for r in df.collect())
    assert len(got[0]) > 30
    for i in (1, 2):
        assert len(set(got[0]) & set(got[i])) > 0.6 * len(got[0])


def test_texts_that_stay_do_not_move(spark):
    base = [(i, f"text {i}. " * 50, "en", "s", 1) for i in range(50)]
    docs = documents(spark, base + [(100 + i, r[1], *r[2:]) for i, r in enumerate(base[:9])])
    kept = exact_dedup.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*range(9, 50), *range(100, 109)])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
