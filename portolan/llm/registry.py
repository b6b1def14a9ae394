"""The thin queries over the given tables, one for each operator, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm import (
    decontaminate,
    exact_dedup,
    filter_audit,
    language_id,
    line_dedup,
    mixing,
    neighbours,
    order_minhash,
    packing,
    periodic_runs,
    secret_scan,
    sharding,
    simhash,
    token_shards,
)
from portolan.llm.common import table, text_or_empty
from portolan.session import scratch_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids; a row for each piece."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and that of
    the next document in descending order of doc_id."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id"), text_or_empty().alias("text"))
    rows = neighbours.with_next(
        docs.withColumn("tie", F.xxhash64("text")), "doc_id", "tie", {"text": "next_text", "fp": "next_fp"},
        prepare=lambda df: order_minhash.add_fingerprint(df, "text", "fp", fill=True))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.expr(
        "concat(substring(text, 1, int(n_chars - n_chars DIV 2)), substring(next_text, 1, int(n_chars DIV 2)))"))
    rows = order_minhash.add_fingerprint(rows, "edited", "edited_fp", fill=True)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        order_minhash.as_text("fp").alias("fingerprint"),
        order_minhash.as_text("edited_fp").alias("edited_fingerprint"),
        order_minhash.likeness("fp", "edited_fp").alias("near_edited"),
        order_minhash.likeness("fp", "next_fp").alias("near_next"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component that its links reach."""
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sequences of 1024 ids, written in training order; a
    row for each record as read back from the shards."""
    path = scratch_path(spark, "token-shards", uuid.uuid4().hex)
    total = token_shards.write_sequences(table(spark, sf_dir, "documents"), path)
    rows = token_shards.read_sequences(spark, path, total)
    return rows.select("sequence", "slot", "shard", "byte_offset", F.crc32("record").alias("record_crc32"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of the secrets in every document."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("long")

    def said(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    text = F.array_join(F.transform("spans", said), ",")
    base = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] != F.lit("literal")), said), ",")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"), text.alias("spans"),
                        count("literal").alias("n_literal"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the lines of repeated windows."""
    return line_dedup.drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id of the document that stays for its text."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, from its text, its declared language and its
    source, taken as a host; ``lang`` is und for those that are rejected."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs), ["doc_id"], declared=F.col("lang"),
                                **language_id.host_parts(F.col("source")))


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language, from its text, markup, address and host; the
    trigram model is fitted on the labelled documents."""
    model = language_id.fit(table(spark, sf_dir, "documents"))
    return language_id.identify(
        table(spark, sf_dir, "pages").withColumn("text", language_id.page_text(F.col("html"))), model, ["page_id"],
        declared=F.nullif(F.regexp_extract("html", r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1), F.lit("")),
        **language_id.host_parts(language_id.host_of(F.col("url"))))


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 contiguous shards of near-equal bytes."""
    placed = sharding.byte_shards(table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of every document in a mixture that repeats no source
    more than four times."""
    return mixing.readings(mixing.mix(table(spark, sf_dir, "documents")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs; a tenth of the documents get a
    periodic end first."""
    return _runs_digest(periodic_runs.find(_with_periodic_ends(table(spark, sf_dir, "documents"))))


def _with_periodic_ends(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: where the id's checksum ends in 0, the words from a
    place on repeat the first few of them."""
    split = F.array_remove(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", F.expr("crc32(string(doc_id)) DIV 10").alias("g"),
                       F.when(h % 10 == 0, split).alias("words"))
    rows = rows.select("*", F.when(F.size("words") > 0, F.size("words").cast("long")).alias("n"))
    rows = rows.select("*", (F.col("g") % F.col("n")).alias("a"))
    rows = rows.select("*", F.expr("1 + (n - a) DIV (3 + g % 8)").alias("p"))
    repeated = F.array_join(F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get(F.col("words"), (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))), " ")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def _runs_digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``periodic_runs.find``."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    said = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.before")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.shorter")).alias("period"),
        F.expr("(1000 * longest.length) DIV (-longest.shorter)").alias("exponent_milli"),
        F.sha2(said.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in windows of benchmark items, and
    the items."""
    found = decontaminate.contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in each source, for every order."""
    return filter_audit.audit_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_order_minhash": op2_order_minhash,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_token_shards": op4_token_shards,
    "op5_secret_scan": op5_secret_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language_id": op8_language_id,
    "page_language_id": page_language_id,
    "op9_byte_shards": op9_byte_shards,
    "op10_temperature_mixing": op10_temperature_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_decontamination": op12_decontamination,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE: dict[str, str] = {
    "op6_line_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines
                   FROM documents),
        l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS pos FROM d),
        f AS (SELECT r, doc_id, pos, trim(line) AS line FROM l WHERE trim(line) <> ''),
        w AS (SELECT r, doc_id, pos, lead(pos, 2) OVER o AS last,
                     line || chr(10) || lead(line) OVER o || chr(10) || lead(line, 2) OVER o AS body
              FROM f WINDOW o AS (PARTITION BY r ORDER BY pos)),
        n AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) AS nth FROM w WHERE body IS NOT NULL),
        gone AS (SELECT DISTINCT r, unnest(generate_series(pos, last)) AS pos FROM n WHERE nth > 1),
        kept AS (SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.pos) AS body
                 FROM l LEFT JOIN gone ON l.r = gone.r AND l.pos = gone.pos WHERE gone.r IS NULL GROUP BY l.r),
        lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.body, '') END AS text,
               CASE WHEN d.text IS NULL THEN 0 ELSE len(d.lines) END AS n_lines, coalesce(lost.n, 0) AS n_removed
        FROM d LEFT JOIN kept ON d.r = kept.r LEFT JOIN lost ON d.r = lost.r
    """,
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
        SELECT d.doc_id, g.keep_id, g.group_size,
               d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.body) AS text_sha256
        FROM d JOIN g ON d.body = g.body
    """,
    "op12_decontamination": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        s AS (SELECT *, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS pos FROM b WHERE len(w) > 0),
        v AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[pos:pos + least(len(w), 10) - 1], ' ') AS body
              FROM s),
        sizes AS (SELECT DISTINCT m FROM v),
        p AS (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS pos FROM d, sizes WHERE len(w) >= m),
        x AS (SELECT r, pos, m, array_to_string(w[pos:pos + m - 1], ' ') AS body FROM p),
        hit AS (SELECT x.r, x.pos, x.m, v.item_id FROM x JOIN v ON x.m = v.m AND x.body = v.body),
        words AS (SELECT DISTINCT r, unnest(generate_series(pos, pos + m - 1)) AS pos FROM hit),
        n AS (SELECT r, count(*) AS n_hit FROM words GROUP BY r),
        i AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
               sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN i ON d.r = i.r
    """,
    "op13_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        l AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good,
                     max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        m AS (SELECT part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
                     100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) AS c,
                     regexp_matches(body, '[#$%&*|]') AS d,
                     t.doc_id IS DISTINCT FROM min(t.doc_id) OVER (PARTITION BY body) AS e,
                     coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
              FROM t LEFT JOIN l ON t.doc_id = l.doc_id),
        g AS (SELECT part, a, b, c, d, e, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS fails,
                     count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
        f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM f a, f b, f c, f d, f e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        r AS (SELECT g.*, o, least(CASE WHEN a THEN strpos(o, 'A') ELSE 6 END, CASE WHEN b THEN strpos(o, 'B') ELSE 6 END,
                     CASE WHEN c THEN strpos(o, 'C') ELSE 6 END, CASE WHEN d THEN strpos(o, 'D') ELSE 6 END,
                     CASE WHEN e THEN strpos(o, 'E') ELSE 6 END) AS gone FROM g, o),
        q AS (SELECT part, o, step, o[step] AS letter,
                     sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept,
                     sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
                     sum(CASE WHEN gone < step AND (CASE o[step] WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c
                                                   WHEN 'D' THEN d ELSE e END) THEN n ELSE 0 END) AS redundant,
                     sum(CASE WHEN fails = 1 AND (CASE o[step] WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c
                                                 WHEN 'D' THEN d ELSE e END) THEN n ELSE 0 END) AS unique_fails,
                     sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost,
                     sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
              FROM r, (SELECT unnest([1, 2, 3, 4, 5]) AS step) GROUP BY part, o, step)
        SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM q
    """,
}
