import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
import corpus_pipeline
from portolan.llm import language_id
from portolan.llm.common import BATCH_BYTES
from portolan.llm.tokens import byte_bpe

from .helpers import SCHEMA, awkward_rows, documents
from .test_language_id import WORDS, text_in
from .test_simhash import plain_components, plain_fingerprint


def corpus():
    rng = random.Random(21)
    rows = [(1000 + i, text_in(rng, lang, rng.randrange(20, 200)), lang, f"src{i % 4 if i % 3 else 0}", 1)
            for i, lang in enumerate(list(WORDS) * 30)]
    long = text_in(rng, "en", 900).split()
    rows += [(2000 + i, " ".join([*long[:40 * i], "swap", *long[40 * i + 1:]]), "en", "src0", 1) for i in range(12)]
    return rows + [r for r in awkward_rows() if r[1] is None or len(r[1]) < 30] + [(3000 + i, rows[i][1], "en", "src9", 1) for i in range(9)]


def plain_known(rows, model):
    """The posterior in plain Python; keeps what isn't und."""
    names = [*model.languages, "und"]
    logs = []
    for r in rows:
        s = model.score(r[1] or "")
        n = min(s[-1], language_id.EFFECTIVE)
        logs.append([*(x * n for x in s[:-1]), -21 * math.log(2) * n] if n else [*[-60.0] * len(model.languages), 0.0])
    best = [max(range(len(names)), key=lambda k: (v[k], -k)) for v in logs]
    of = lambda pairs: {k: [sum(b == c for x, b in pairs if x == k) for c in range(len(names))]
                        for k in {x for x, _ in pairs if x is not None}}
    hosts = of([((r[3] or "").lower() or None, b) for r, b in zip(rows, best, strict=True)])
    said = of([((r[2] or "").lower() or None, b) for r, b in zip(rows, best, strict=True)])
    every = [sum(b == c for b in best) + 1.0 for c in range(len(names))]
    whole = [x / sum(every) for x in every]
    kept = []
    for r, v in zip(rows, logs, strict=True):
        total = list(v)
        if r[3] is None:
            prior = whole
        else:
            n = hosts[r[3].lower()]
            prior = [(x + 8 * p) / (sum(n) + 8) for x, p in zip(n, whole, strict=True)]
        for c in range(len(names)):
            total[c] += math.log(prior[c])
            if r[2] is not None:
                total[c] += math.log((said[r[2].lower()][c] + 0.5) / (every[c] + 1.0))
        if names[max(range(len(names)), key=lambda k: (total[k], -k))] != "und":
            kept.append(r)
    return kept


def plain_exact(rows):
    best = {}
    for r in rows:
        t = r[1] or ""
        if t not in best or (r[0] is not None and (best[t] is None or r[0] > best[t])):
            best[t] = r[0]
    return sorted({(r[0], r[1]) for r in rows if r[0] == best[r[1] or ""]}, key=str)


def plain_near(rows):
    fps = [plain_fingerprint(t or "") for _, t in rows]
    top = plain_components(fps)
    least = {}
    for (doc, _), f in zip(rows, fps, strict=True):
        if doc is not None:
            least[top[f]] = min(doc, least.get(top[f], doc))
    return [r for r, f in zip(rows, fps, strict=True) if r[0] is None or r[0] == least.get(top[f])]


def test_run_equals_plain_versions(spark, tmp_path):
    rows = corpus()
    documents(spark, rows, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, results = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        results[name] = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert results[name].columns == columns
        results[name].write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    stored = {name: [(r.doc_id, r.text) for r in spark.read.parquet(f"{tmp_path}/{name}").collect()] for name in results if name != "packing"}

    known = plain_known(rows, language_id.fit(spark.read.parquet(f"{tmp_path}/documents.parquet")))
    assert sorted(stored["language_id"], key=str) == sorted([r[:2] for r in known], key=str)
    assert {r[0] for r in rows if r[0] is not None and (1000 <= r[0] < 3100)} <= {r[0] for r in known}
    exact = plain_exact(known)
    assert sorted(stored["exact_dedup"], key=str) == exact
    near = plain_near(exact)
    assert sorted(stored["near_dedup"], key=str) == sorted(near, key=str)
    assert len([r for r in near if r[0] and 2000 <= r[0] < 2012]) < 12

    # The mixture drops nothing and reads each source as often as its weight asks.
    mixed = Counter(stored["mixing"])
    assert set(mixed) == set(near) and max(mixed.values()) <= corpus_pipeline.REPEATS
    source = {(r[0], r[1]): r[3] for r in known}
    tokens = lambda r: len((r[1] or "").split()) + 1
    there, spent = defaultdict(int), defaultdict(int)
    for r in near:
        there[source[r]] += tokens(r)
        spent[source[r]] += tokens(r) * mixed[r]
    most, least = max(there.values()), min(there.values())
    a = max(0.0, 1 - math.log(corpus_pipeline.REPEATS) / math.log(most / least))
    for s, n in there.items():
        due = n * (n / most) ** (a - 1)
        assert due - max(map(tokens, near)) <= spent[s] <= due + 1

    want = Counter()
    for (doc, text), n in mixed.items():
        ids = byte_bpe().tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        at, to, piece = 0, len(ids) % 1024 or 1024, 0
        while at < len(ids):
            want[doc, piece, at, to - at, zlib.crc32(np.array(ids[at:to], "<u4").tobytes())] += n
            at, to, piece = to, to + 1024, piece + 1
    for got in (results["packing"].collect(), corpus_pipeline.run(spark, str(tmp_path)).collect()):
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        sequences = defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 1024
        assert len(sequences) <= -(-sum(k[3] * n for k, n in want.items()) // 1024) + 3


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)]])
def test_empty_table_and_all_nulls(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_a_failed_run_goes_on_from_its_folder(spark, tmp_path, monkeypatch):
    import os

    documents(spark, [(i, f"text {i}", "en", "s", 1) for i in range(5)]).write.parquet(f"{tmp_path}/documents.parquet")
    folder, calls, lost = f"{tmp_path}/run", [], ["second"]

    def stage(name, keep):
        def work(spark, docs, sf_dir):
            calls.append(name)
            if name in lost:
                raise OSError("the driver is gone")
            return docs.where(keep)
        return name, work

    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage("first", "doc_id > 0"), stage("second", "doc_id < 4"), stage("third", "doc_id <> 2")])
    with pytest.raises(OSError, match="is gone"):
        corpus_pipeline.run(spark, str(tmp_path), folder)
    lost.clear()
    for _ in range(2):  # the second time everything is there
        got = corpus_pipeline.run(spark, str(tmp_path), folder)
        assert sorted(r.doc_id for r in got.collect()) == [1, 3]
    assert calls == ["first", "second", "second", "third"]
    assert [n for n in sorted(os.listdir(folder)) if not n.startswith(".")] == ["third"]


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and "pipeline" not in __spark_entry__.oracle_sql()
    assert sorted({int(n[2:].split("_")[0]) for n in names if n.startswith("op")}) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]


@pytest.mark.parametrize("stage, module, operator", [
    ("language_id", "language_id", "keep_known"), ("near_dedup", "simhash", "keep_one"), ("packing", "packing", "pack")])
def test_texts_go_to_python_in_batches_of_bounded_bytes(spark, monkeypatch, stage, module, operator):
    rows = [(i, f"{i} of the pages " * 2000, "en", "src0", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    seen = []

    def operate(*_):
        seen.extend(docs.mapInArrow(sizes, "n long, bytes long").collect())
        return docs

    monkeypatch.setattr(getattr(corpus_pipeline, module), operator, operate)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
    longest = max(len(r[1]) for r in rows)
    assert sum(r["n"] for r in seen) == len(rows)
    assert max(r["bytes"] for r in seen) <= BATCH_BYTES + 2 * longest
    assert len(seen) > 1 and spark.conf.get(key) == before
