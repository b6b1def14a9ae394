import zlib

import pytest

from portolan.llm import sharding

from .helpers import awkward_rows, documents


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards_are_contiguous_even_and_gapless(spark, shards):
    rows = awkward_rows()
    got = [r.asDict() for r in sharding.byte_shards(documents(spark, rows, extra=True), shards).collect()]
    want = sorted([(r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows], key=str)
    assert sorted([(r["doc_id"], r["size"], r["text_crc32"]) for r in got], key=str) == want
    got.sort(key=lambda r: (r["shard"], r["slot"]))
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)
    sizes = {}
    for r in got:
        mine = sizes.setdefault(r["shard"], [])
        assert r["slot"] == len(mine)
        mine.append(r["size"])
    total, most = sum(w[1] for w in want), max(w[1] for w in want)
    assert all(abs(sum(s) - total / shards) <= most for s in sizes.values())
    assert set(sizes) <= set(range(shards))


def test_many_ranges_agree_with_one(spark):
    rows = [(i * i, "x" * (i % 37), "en", "s", 1) for i in range(500)]
    docs = documents(spark, rows).repartition(7)
    many = sorted(map(tuple, sharding.byte_shards(docs, 9).collect()))
    at = total = 0
    size = [len(r[1]) + 16 for r in rows]
    want, slots = [], {}
    total = sum(size)
    for r, s in zip(rows, size, strict=True):
        k = min(8, (2 * at + s) * 9 // (2 * total))
        slots[k] = slots.get(k, -1) + 1
        want.append((r[0], s, zlib.crc32(r[1].encode()), k, slots[k]))
        at += s
    assert many == sorted(want)


def test_empty_table(spark):
    assert sharding.byte_shards(documents(spark, []), 40).collect() == []


def test_written_shards(spark, tmp_path):
    rows = awkward_rows()
    docs = documents(spark, rows)
    sharding.write_shards(docs, 5, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(str, back.drop("shard").collect())) == sorted(map(str, docs.collect()))
    assert len(list((tmp_path / "out").glob("shard=*/*.parquet"))) == back.select("shard").distinct().count()


def test_the_number_of_partitions_does_not_change_the_shards(spark, monkeypatch):
    docs = documents(spark, awkward_rows())
    want = sorted(map(str, sharding.byte_shards(docs, 7).collect()))
    # Ranges as with 400,000 shuffle partitions, without that many tasks.
    monkeypatch.setattr(sharding, "shuffle_partitions", lambda spark: 400_000)
    assert sorted(map(str, sharding.byte_shards(docs, 7).collect())) == want


def test_null_and_minus_one_are_two_ids(spark, tmp_path):
    rows = [(None, "same", "en", "null", 1), (-1, "same", "en", "minus", 1), (0, "z", "en", "s", 1)]
    sharding.write_shards(documents(spark, rows), 3, f"{tmp_path}/out")
    back = {r.source: r.shard for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {r.doc_id: r.shard for r in sharding.byte_shards(documents(spark, rows), 3).collect()}
    assert (back["null"], back["minus"], back["s"]) == (want[None], want[-1], want[0]) and back["null"] != back["minus"]
