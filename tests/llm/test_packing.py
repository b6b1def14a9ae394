import itertools
import random
import zlib

import numpy as np
import pytest

from portolan.llm import packing
from portolan.llm.tokens import byte_bpe

from .helpers import awkward_rows, documents


def optimum(lengths, capacity):
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in sorted({r: j for j, r in enumerate(rooms)}.values()):
            if rooms[j] >= lengths[i]:
                go(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1:]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_bins_are_as_few_as_can_be_on_small_cases(seed):
    rng = random.Random(seed)
    lengths = [rng.randrange(1, 101) for _ in range(rng.randrange(1, 11))]
    counts = {x: lengths.count(x) for x in lengths}
    patterns = packing.complete_bins(counts, 100)
    used = [x for copies, filling in patterns for _ in range(copies) for x, each in filling for _ in range(each)]
    assert sorted(used) == sorted(lengths)
    assert all(sum(x * each for x, each in filling) <= 100 for _, filling in patterns)
    assert sum(copies for copies, _ in patterns) == optimum(lengths, 100)


def test_bin_completion_beats_best_fit():
    counts = {x: 1 for x in (49, 47, 46, 44, 41, 39, 34, 33, 32, 31)}  # some set where best fit decreasing wastes a bin
    fewer = [sum(c for c, _ in packing.complete_bins(k, 100)) - sum(c for c, _ in packing.best_fit(k, 100))
             for k in [counts, *({x: 1 for x in random.Random(s).sample(range(15, 60), 12)} for s in range(60))]]
    assert max(fewer) <= 0 and min(fewer) < 0


def test_undominated_fillings():
    found = packing.fillings({60: 1, 40: 1, 30: 1, 10: 2, 5: 1}, 100, 10)
    assert ((60, 1), (40, 1)) in found
    assert ((60, 1), (30, 1), (10, 1)) not in found  # 40 takes the place of 30 and 10


def test_large_counts_stay_small():
    counts = {x: 1000 * x for x in range(1, 1025)}
    patterns = packing.complete_bins(counts, 1024)
    total = sum(x * n for x, n in counts.items())
    assert sum(c for c, _ in patterns) <= -(-(total + packing.least_waste(counts, 1024)) // 1024) * 1.001 + 1
    assert len(patterns) < 20_000


@pytest.mark.parametrize("extra", [False, True])
def test_pack_covers_every_piece(spark, as_loaded, extra):
    rows = [*awkward_rows(), (300, "a <|endoftext|> b", "en", "s", 1)]
    got = packing.pack(packing.pieces(documents(spark, rows, extra), capacity=64), capacity=64).collect()
    want = []
    for doc, text, *_ in rows:
        ids = as_loaded.encode(text or "", add_special_tokens=False).ids + [2]
        at, to = 0, len(ids) % 64 or 64
        for piece in itertools.count():
            if at >= len(ids):
                break
            want.append((doc, piece, at, to - at, zlib.crc32(np.array(ids[at:to], "<u4").tobytes())))
            at, to = to, to + 64
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=str) == sorted(want, key=str)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= -(-sum(w[3] for w in want) // 64) + 2


def test_empty_table(spark):
    assert packing.pack(packing.pieces(documents(spark, []))).collect() == []


@pytest.mark.parametrize("text", [
    "", " ", "a", " a b", "a  b", "a\n\nb", "a\n\n\n b\n", "tab\tand\r\nmore", "it's we'll I'M", "x y z", "\n", "日本 語 ok",
    "<|endoftext|> in text", "a b c", "naïve café  œuvre\n\tx", "1 234,5 ++ -- ==", "é́ combining ́ ", "ǅ ǆ ɐ ʰ x²"])
def test_ids_equal_the_tokenizers(as_loaded, text):
    ids = np.frombuffer(byte_bpe().ids(text), "<u4").tolist()
    assert ids == as_loaded.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def as_loaded():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> <|endoftext|>\nx", "<|endoftext|", "é<|endoftext|>é日"])
def test_added_tokens_strings_give_their_ids(as_loaded, text):
    assert np.frombuffer(byte_bpe().ids(text), "<u4").tolist() == as_loaded.encode(text, add_special_tokens=False).ids


def test_added_token_in_the_middle():
    assert np.frombuffer(byte_bpe().ids("a<|endoftext|>b"), "<u4").tolist() == [64, 50256, 65]


def test_pieces_of_a_text_with_an_added_tokens_string(spark, as_loaded):
    text = "one two <|endoftext|> three " * 9
    ids = as_loaded.encode(text, add_special_tokens=False).ids + [2]
    got = sorted(packing.pieces(documents(spark, [(1, text, None, None, 0)]), capacity=16).collect(), key=lambda r: r.piece)
    assert [(r.length, r.ids_crc32) for r in got] == [
        (len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
        for part in [ids[:len(ids) % 16 or 16], *[ids[i:i + 16] for i in range(len(ids) % 16 or 16, len(ids), 16)]]]


def test_ids_of_random_texts(as_loaded):
    rng = random.Random(5)
    alphabet = "ab cé\n \t.,'s19  日ß" * 2 + "\x1c\x85\r"
    encoder = byte_bpe()
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40)))
        ids = np.frombuffer(encoder.ids(text), "<u4").tolist()
        assert ids == as_loaded.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_of_every_script(as_loaded):
    rng = random.Random(6)
    encoder = byte_bpe()
    for _ in range(1500):
        text = "".join(chr(rng.choice((rng.randrange(32, 0x3000), rng.randrange(0xE000, 0x110000), 32))) for _ in range(12))
        ids = np.frombuffer(encoder.ids(text), "<u4").tolist()
        assert ids == as_loaded.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_of_very_long_runs(as_loaded):
    encoder = byte_bpe()
    for text in (" " * 1_000_000, "a" + "\n" * 600_000 + "b", "ab" * 300_000):
        ids = np.frombuffer(encoder.ids(text), "<u4").tolist()
        assert ids == as_loaded.encode(text, add_special_tokens=False).ids


def test_best_fit_is_beaten_at_the_default_settings():
    counts = {44: 1, 24: 2, 22: 1, 21: 1, 17: 1, 8: 2, 6: 2}
    assert sum(n for n, _ in packing.best_fit(counts, 60)) == 4
    assert sum(n for n, _ in packing.complete_bins(counts, 60)) == 3
    many = {length: 50 * n for length, n in counts.items()}
    assert sum(n for n, _ in packing.complete_bins(many, 60)) == 150 < sum(n for n, _ in packing.best_fit(many, 60))
