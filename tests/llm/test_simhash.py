import random

import numpy as np
import pytest
import xxhash

from portolan.llm import components, simhash

from .helpers import awkward_rows, documents, words


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    w = [x for x in lower.split(" ") if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, distance=3):
    fps = sorted(set(fps))
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def grouping(pairs):
    out = {}
    for node, root in pairs:
        out.setdefault(root, set()).add(node)
    return sorted(map(sorted, out.values()))


def clustered(seed, n, centres, flips):
    rng = random.Random(seed)
    roots = [rng.getrandbits(64) for _ in range(centres)]
    return sorted({rng.choice(roots) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(flips + 1))) for _ in range(n)})


@pytest.mark.parametrize("text", ["", " \t", "One", "one TWO", "a b c", "Ünï A b c\x0bd\x0ce", "x " * 5000, "É B C d E f g"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_long_random_text():
    text = words(random.Random(1), 20_000)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


# The last groups are so small that keys go on to longer chains, to the full ring.
@pytest.mark.parametrize("distance,group", [(3, 10_000), (3, 3), (3, 1), (2, 2), (1, 10_000), (0, 1), (5, 2)])
def test_links_connect_what_all_pairs_connect(spark, distance, group):
    fps = clustered(distance, 300, 6, 6)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    edges = [(np.int64(r.a).view(np.uint64).item(), np.int64(r.b).view(np.uint64).item())
             for r in simhash.links(df, distance, group).collect()]
    assert all((a ^ b).bit_count() <= 2 * distance for a, b in edges)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    want = plain_components(fps, distance)
    assert grouping((f, find(f)) for f in fps) == grouping(want.items())


def test_roots_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, x) for x in range(101, 200)]
    edges = [*chain, *star, (5, 5), (300, 301), (301, 300)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.root for r in components.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys(range(100, 200), 100), 300: 300, 301: 300}
    assert got == want


@pytest.mark.parametrize("extra", [False, True])
def test_groups_against_all_pairs(spark, extra):
    rng = random.Random(9)
    long = words(rng, 800)
    rows = awkward_rows() + [(400 + i, " ".join([*long.split()[:i], "swap", *long.split()[i + 1:]]), "en", "s", 1) for i in range(0, 60, 3)]
    got = simhash.near_groups(documents(spark, rows, extra)).collect()
    assert len(got) == len(rows)
    top = plain_components([plain_fingerprint(r[1] or "") for r in rows])
    least = {}
    for r in rows:
        if r[0] is not None:
            k = top[plain_fingerprint(r[1] or "")]
            least[k] = min(least.get(k, r[0]), r[0])
    want = sorted([(r[0], plain_fingerprint(r[1] or ""), least[top[plain_fingerprint(r[1] or "")]]) for r in rows], key=str)
    assert sorted([(r.doc_id, int(np.int64(r.fp).view(np.uint64)), r.component_id) for r in got], key=str) == want


def test_keep_one(spark):
    rows = awkward_rows()
    docs = documents(spark, rows, extra=True)
    groups = {(r.doc_id, r.component_id) for r in simhash.near_groups(docs).collect()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {x for x in ids if x is not None} == {c for _, c in groups if c is not None}


def test_empty_table(spark):
    assert simhash.near_groups(documents(spark, [])).collect() == []


def test_keep_one_tells_texts_of_an_id_apart(spark):
    rng = random.Random(21)
    a, b, c, d = (words(rng, 80) for _ in range(4))
    rows = [(1, a, "en", "s", 1), (5, a, "en", "s", 1), (5, b, "en", "s", 1), (7, b, "en", "s", 1),
            (None, a, "en", "s", 1), (None, c, "en", "s", 1), (8, d, "en", "s", 1), (None, d, "en", "s", 1)]
    kept = simhash.keep_one(documents(spark, rows, extra=True))
    assert kept.columns == documents(spark, rows, extra=True).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (5, b), (None, c), (8, d)], key=str)
