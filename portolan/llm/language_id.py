"""Language ID by Bayesian fusion of evidence.

A text's likelihood under each language comes from its letter trigrams,
fitted on labelled rows. It is tempered, since neighbouring trigrams are not
independent, and added up with what was declared beside the text (the markup
language), the address suffix, and a prior for the host. How often a language
goes with a declaration or suffix, and the hosts' priors, are counted over
all rows by grouped aggregation; a host's prior leans on its domain's, and
that on the whole corpus. A class ``und`` spreads its likelihood evenly over
all trigrams: text in no known language, or without letters, falls to it.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import cut, fresh, text_or_empty
from portolan.operators.joins import maybe_broadcast

SAMPLE_ROWS = 8_000  # rows of each label that the trigram model is fitted on, about; all of a rarer one's
MOST_CLASSES = 400  # labels of a model, at most
UNSEEN = 0.02  # share of a language's likelihood that is spread evenly over all trigrams, whatever its sample
EFFECTIVE = 300.0  # trigrams of evidence a text counts for, at most
LEAN = 8.0  # rows that a group's parent counts for in its prior
UNKNOWN = "und"
_BITS = 21  # of a trigram's number
_PLANES = 0x40000  # letters lie below
_LETTER, _SIGN, _MARK = 1, 2, 3
# Scripts of thousands of signs, whose trigrams hardly repeat: ideographs, Yi and Hangul syllables.
_SIGNS = ((0x3400, 0x4DC0), (0x4E00, 0xA4D0), (0xAC00, 0xD7A4), (0xF900, 0xFB00), (0x17000, 0x18D80), (0x20000, _PLANES))
_ANY_SIGN = _PLANES  # stands for a sign beside a letter or space


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Code point -> its kind, 0 for what isn't in words, and its lower case."""
    kinds, lows = np.zeros(_PLANES, np.uint8), np.arange(_PLANES, dtype=np.uint32)
    for code in range(_PLANES):
        char = chr(code)
        if char.isalpha():
            kinds[code] = _LETTER
            lows[code] = ord(char.lower()[0])
        elif unicodedata.category(char) in ("Mn", "Mc") and not 0xFE00 <= code < 0xFE10:  # variation selectors
            kinds[code] = _MARK
    for start, end in _SIGNS:
        kinds[start:end][kinds[start:end] == _LETTER] = _SIGN
    return kinds, lows


def _mixed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A hash of three code points, of ``_BITS`` bits."""
    x = (a.astype(np.uint64) << np.uint64(42)) | (b.astype(np.uint64) << np.uint64(21)) | c
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - _BITS)).astype(np.uint32)


def trigrams(text: str) -> np.ndarray:
    """Numbers of a text's letter trigrams, hashes of their lower-case code
    points; runs of anything else are one space. Marks on letters, as vowel
    signs, count as letters. A sign of a script of thousands counts alone,
    and all such signs are one to the letters beside them."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.uint32(_PLANES - 1))
    kinds, lows = _tables()
    kind = kinds[codes]
    if not ((kind == _LETTER) | (kind == _SIGN)).any():
        return np.zeros(0, np.uint32)
    marks = np.concatenate([[0], np.where(kind != 0, lows[codes], 0), [0]]).astype(np.uint32)
    kind = np.concatenate([[0], kind, [0]])
    there = np.concatenate([[True], (marks[1:] != 0) | (marks[:-1] != 0)])
    marks, sign = marks[there], kind[there] == _SIGN
    if not sign.any():
        return _mixed(marks[:-2], marks[1:-1], marks[2:])
    around = np.where(sign, np.uint32(_ANY_SIGN), marks)
    alone = sign[1:-1]
    return _mixed(np.where(alone, 0, around[:-2]), marks[1:-1], np.where(alone, 0, around[2:]))


class Model:
    """Trigram log-likelihoods: ``ids`` with a row of ``values`` each, and
    ``rest`` for trigrams that weren't seen; a column for each language."""

    def __init__(self, languages: list[str], ids: np.ndarray, values: np.ndarray, rest: np.ndarray):
        self.languages, self.ids, self.values, self.rest = languages, ids, values, rest
        self.dense = None

    def __getstate__(self):
        return {**self.__dict__, "dense": None}

    def score(self, text: str) -> np.ndarray:
        """Log-likelihood per trigram under each language, and their number."""
        found = trigrams(text)
        if self.dense is None:
            places = np.full(1 << _BITS, len(self.ids), np.int32)
            places[self.ids] = np.arange(len(self.ids), dtype=np.int32)
            self.dense = places, np.vstack([self.values, self.rest.astype(np.float32)])
        places, values = self.dense
        if not len(found):
            return np.zeros(len(self.languages) + 1)
        total = np.zeros(len(self.languages))
        for at in range(0, len(found), 65536):
            total += values[places[found[at:at + 65536]]].sum(axis=0, dtype=np.float64)
        return np.concatenate([total / len(found), [len(found)]])


def fit(labelled: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "lang",
        sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> Model:
    """Fit on about ``sample_rows`` of each label's rows with a text (all of
    them, if there are no more), chosen by a hash of id and text at a rate
    worked out from the label's own number of rows; the row that is first by
    hash is always in, so every label whose texts have letters is a class at
    any size of input. Labels count by their language: lower-case, without a
    region or script after ``-`` or ``_``; blank ones are none. Counts are
    combined in Spark; the driver gets one row for each trigram of the sample
    and language. More than ``MOST_CLASSES`` labels are an error that names
    some of them, as the driver's memory follows their number. Without
    labelled rows the model knows no language."""
    named = F.split(F.lower(F.trim(F.col(label))), "[-_]")[0]
    rows = labelled.where((named != "") & (F.length(text) > 0)).select(
        named.alias("label"), F.col(text).alias("text"), F.xxhash64(F.lit(seed), id_column, text).alias("turn"))
    there = cut(rows.groupBy("label").agg(F.count(F.lit(1)).alias("there"), F.min("turn").alias("first")))
    classes = there.count()
    if classes > MOST_CLASSES:
        rare = [r["label"] for r in there.orderBy("there", "label").limit(10).collect()]
        raise ValueError(f"{classes} labels, of which a model takes at most {MOST_CLASSES}; rare ones: {rare}")
    # The whole hash as a fraction from 0 to 1 against the label's rate.
    drawn = F.col("turn").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5) < F.lit(float(sample_rows)) / F.col("there")
    rows = rows.join(F.broadcast(there), "label").where(
        (F.col("there") <= sample_rows) | drawn | (F.col("turn") == F.col("first"))).select("label", "text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, part in frame.groupby("label"):
                total = np.zeros(1 << _BITS, np.int64)
                for x in part["text"]:
                    ids, n = np.unique(trigrams(x), return_counts=True)
                    total[ids] += n
                ids = np.flatnonzero(total)
                yield pd.DataFrame({"label": name, "id": ids.astype(np.int64), "n": total[ids]})

    got = (rows.mapInPandas(count, "label string, id long, n long").groupBy("label", "id").agg(F.sum("n").alias("n"))
           .toPandas())
    languages = sorted(got["label"].unique())
    ids = np.unique(got["id"].to_numpy(np.int64))
    counts = np.zeros((len(ids), len(languages)))
    for k, name in enumerate(languages):
        part = got[got["label"] == name]
        counts[np.searchsorted(ids, part["id"].to_numpy(np.int64)), k] = part["n"]
    # Mixed with an even spread, so that an unseen trigram costs the same in
    # each language, however many rows its sample has.
    even = UNSEEN / (1 << _BITS)
    values = np.log((1.0 - UNSEEN) * counts / counts.sum(axis=0) + even)
    return Model(languages, ids, values.astype(np.float32), np.full(len(languages), math.log(even)))


def with_scores(rows: DataFrame, model: Model, text: str, out: str) -> DataFrame:
    """Add ``out``: an array of log-likelihoods per trigram, one for each
    language, then the number of trigrams."""
    @F.pandas_udf("array<double>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([model.score(x) for x in series])

    return rows.withColumn(out, score(text_or_empty(text)))


def identify(rows: DataFrame, model: Model, key: list[str], text: str = "text", declared: Column | None = None,
             suffix: Column | None = None, host: Column | None = None, domain: Column | None = None,
             lean: float = LEAN, effective: float = EFFECTIVE) -> DataFrame:
    """The key columns with ``declared, suffix, host, text_lang, lang,
    probability``: the most probable class and its posterior, a row for each
    row. ``text_lang`` is the choice on the text alone.

    Evidence that is null or not given counts as absent. A null or empty text
    and one without letters are ``und``, whatever was declared. Ties go to
    the language that is first by name. Repeated rows come back repeated;
    null keys are kept; an empty table gives no rows.
    """
    classes = [*model.languages, UNKNOWN]
    n = len(classes)
    none = F.lit(None).cast("string")
    read = rows.select(*key, text_or_empty(text).alias("body"), *[
        F.lower(c if c is not None else none).alias(name)
        for c, name in ((declared, "declared"), (suffix, "suffix"), (host, "host"), (domain, "domain"))])
    ll = with_scores(read, model, "body", "ll").drop("body")
    even = F.lit(-_BITS * math.log(2.0))
    count = F.element_at("ll", n)
    text_ll = F.when(count == 0, F.array(*[F.lit(-60.0)] * (n - 1), F.lit(0.0))).otherwise(F.transform(
        F.concat(F.slice("ll", 1, n - 1), F.array(even)), lambda x: x * F.least(count, F.lit(effective))))
    slim = cut(ll.withColumn("text_ll", text_ll).withColumn("best", _first_best("text_ll")).drop("ll"))

    def counts(by: str) -> DataFrame:
        return slim.where(F.col(by).isNotNull()).groupBy(by).agg(F.array(*[
            F.sum((F.col("best") == i).cast("double")) for i in range(n)]).alias(f"{by}_counts"))

    # One number for each class.
    every = slim.agg(*[F.sum((F.col("best") == i).cast("double")) for i in range(n)]).first()
    every = [(x or 0.0) + 1.0 for x in every]
    whole = [x / sum(every) for x in every]

    def leaning(c: str, on: Column) -> Column:
        size = F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(F.col(c), on, lambda x, p: (x + F.lit(lean) * p) / (size + F.lit(lean)))

    whole_array = F.array(*map(F.lit, whole))
    domains = counts("domain").select("domain", leaning("domain_counts", whole_array).alias("domain_prior"))
    inside = slim.where("host IS NOT NULL").groupBy("host").agg(
        F.min("domain").alias("domain"),
        F.array(*[F.sum((F.col("best") == i).cast("double")) for i in range(n)]).alias("host_counts"))
    hosts = inside.join(domains, "domain", "left").select("host", leaning(
        "host_counts", F.coalesce("domain_prior", whole_array)).alias("host_prior"))

    def given(by: str) -> DataFrame:
        """log P(value | class), each class's counts over all values."""
        return counts(by).select(by, F.zip_with(f"{by}_counts", F.array(*map(F.lit, every)), lambda x, all_: F.log(
            (x + F.lit(0.5)) / (all_ + F.lit(1.0)))).alias(f"{by}_log"))

    zeros = F.array(*[F.lit(0.0)] * n)
    fused = slim
    for by, table in (("declared", given("declared")), ("suffix", given("suffix")), ("host", hosts)):
        fused = fused.join(table, by, "left")
    prior = F.transform(F.coalesce("host_prior", whole_array), lambda p: F.log(p))
    parts = [F.col("text_ll"), prior, F.coalesce("declared_log", zeros), F.coalesce("suffix_log", zeros)]
    total = parts[0]
    for part in parts[1:]:
        total = F.zip_with(total, part, lambda a, b: a + b)
    fused = fused.withColumn("total", total).withColumn("class", _first_best("total"))
    names = F.array(*map(F.lit, classes))
    top = F.array_max("total")
    return fused.select(
        *key, "declared", "suffix", "host", F.get(names, F.col("best")).alias("text_lang"),
        F.get(names, F.col("class")).alias("lang"),
        (F.lit(1.0) / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - top))).alias("probability"))


def _first_best(scores: str) -> Column:
    return (F.array_position(F.col(scores), F.array_max(scores)) - 1).cast("int")


def host_of(url: Column) -> Column:
    """The host of an address, lower-case, without user and port; null where
    there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def host_parts(host: Column) -> dict[str, Column]:
    """``identify``'s evidence from a host: suffix and domain are its last
    label and its last two, null where it has no dot."""
    labels = F.split(host, r"\.")
    dotted = F.contains(host, F.lit("."))
    return {"host": host, "suffix": F.when(dotted, F.element_at(labels, -1)),
            "domain": F.when(dotted, F.array_join(F.slice(labels, -2, 2), "."))}


def page_text(html: Column) -> Column:
    """Visible text of a page, nearly: comments, scripts, styles and tags go."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&#?\w{1,10};", " ")


def keep_known(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text",
               declared: str = "lang", host: str = "source") -> DataFrame:
    """``docs`` without those that are in no known language. Rows that repeat
    both id and text are judged alike."""
    names = [fresh(docs, c) for c in ("rejected_id", "rejected_hash", "own_hash")]
    marked = docs.withColumn(names[2], F.xxhash64(text_or_empty(text)))
    judged = identify(marked.select(F.col(id_column).alias("id"), F.col(names[2]).alias("hash"), F.col(text).alias("text"),
                                    F.col(declared).alias("said"), F.col(host).alias("place")),
                      model, ["id", "hash"], "text", declared=F.col("said"), **host_parts(F.col("place")))
    gone = cut(judged.where(F.col("lang") == UNKNOWN).select(
        F.col("id").alias(names[0]), F.col("hash").alias(names[1])).distinct())
    same = F.col(id_column).eqNullSafe(F.col(names[0])) & (F.col(names[2]) == F.col(names[1]))
    return marked.join(maybe_broadcast(gone), same, "left_anti").drop(names[2])
