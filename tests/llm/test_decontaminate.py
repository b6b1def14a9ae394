import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from portolan.llm import decontaminate
from portolan.llm.registry import ORACLE

from .helpers import awkward_rows, documents, words

ITEMS = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items):
    """Every window at every place: spans and items of each row."""
    windows = [(w[i:i + 10], "" if item is None else str(item)) for item, text in items
               for w in [split(text)] if w for i in range(max(1, len(w) - 9))]
    out = []
    for doc, text, *_ in rows:
        w = split(text)
        hit, ids = set(), set()
        for window, item in windows:
            for at in range(len(w) - len(window) + 1):
                if w[at:at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    ids.add(item)
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((doc, len(w), [tuple(s) for s in spans], sorted(ids)))
    return sorted(out, key=str)


def mixed(seed):
    rng = random.Random(seed)
    rows = [r for r in awkward_rows(seed) if r[0] != 205]
    items = [(i, words(rng, rng.choice([12, 20, 35]))) for i in range(12)]
    items += [(50, "Short One, here"), (51, "one"), (52, "日本語"), (53, ""), (54, None), (55, "--- ..."), (None, words(rng, 15)),
              (3, words(rng, 11)), items[0], (60, items[0][1].upper()), (61, "a b a b a b a b a b a b a b")]
    for i in range(60):
        _, text = rng.choice(items)
        w = (text or "").split()
        cut = rng.randrange(0, 6)
        piece = w[cut:cut + rng.choice([8, 9, 10, 11, 30])]
        rows.append((300 + i, words(rng, rng.randrange(20)) + " " + ", ".join(piece) + "! " + words(rng, rng.randrange(20)), "en", "s", 1))
    return rows + [(400, "A b a b a b a b a b a b a b a b a", "en", "s", 1), (401, items[1][1], "en", "s", 1), (401, items[2][1], "en", "s", 1)], items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_version_and_sql(spark, seed):
    rows, items = mixed(seed)
    docs, bench = documents(spark, rows, extra=True), spark.createDataFrame(items, ITEMS)
    found = decontaminate.contaminated_words(docs, bench).collect()
    got = sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.spans], r.item_ids) for r in found), key=str)
    assert got == plain(rows, items)
    assert any(r.item_ids for r in found) and any(not r.item_ids for r in found)
    digest = sorted(((d, n, sum(b - a for a, b in spans), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(spans))
                     for d, n, spans, ids in got), key=str)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", bench.toPandas().astype({"item_id": "Int64"}))
    assert sorted(con.sql(ORACLE["op12_decontamination"]).fetchall(), key=str) == digest


@pytest.mark.parametrize("shingle, window", [(1, 10), (5, 4), (10, 10)])
def test_any_shingle_gives_the_same(spark, shingle, window):
    rows, items = mixed(4)
    docs, bench = documents(spark, rows), spark.createDataFrame(items, ITEMS)
    a = decontaminate.contaminated_words(docs, bench, window=window, shingle=shingle).collect()
    b = decontaminate.contaminated_words(docs, bench, window=window).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_shingles_of_a_full_bitmap_are_still_told_apart(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "_LEAST_BITS", 6)
    monkeypatch.setattr(decontaminate, "_MOST_BITS", 6)
    monkeypatch.setattr(decontaminate, "maybe_broadcast", lambda df: df)
    rows, items = mixed(5)
    found = decontaminate.contaminated_words(documents(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.spans], r.item_ids) for r in found), key=str) == plain(rows, items)


def test_a_frequent_passage_is_joined_by_its_rarest_shingle(spark):
    common = "the quick brown fox jumps over the lazy"
    rows = [(i, f"{common} n{i}", "en", "s", 1) for i in range(50)] + [(99, f"{common} dog today", "en", "s", 1)]
    bench = spark.createDataFrame([(1, f"{common} dog today")], ITEMS)
    found = {r.doc_id: r for r in decontaminate.contaminated_words(documents(spark, rows), bench).collect()}
    assert [d for d, r in found.items() if r.spans] == [99]
    assert found[99].spans[0].asDict() == {"start": 0, "end": 10}


def test_empty_tables(spark):
    docs = documents(spark, awkward_rows())
    none = spark.createDataFrame([], ITEMS)
    clean = decontaminate.contaminated_words(docs, none).collect()
    assert len(clean) == docs.count() and not any(r.spans or r.item_ids for r in clean)
    assert decontaminate.contaminated_words(documents(spark, []), none).collect() == []
    some = spark.createDataFrame([(1, "one two")], ITEMS)
    assert decontaminate.contaminated_words(documents(spark, []), some).collect() == []
    assert decontaminate.contaminated_words(docs.where(F.col("doc_id") == 203), some).first().n_words == 1
