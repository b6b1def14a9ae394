"""Code lists (catalog text of ``value name  key = 'label' ... ;`` statements).

The text is read with ``;`` as the record separator, so every statement is
one record and statements are parsed in parallel; a list never needs the
whole file in one task. Comments are removed, the list name is taken from
the ``value`` keyword and all ``key = 'label'`` pairs of the statement are
extracted with two regex passes and zipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The catalog syntax.
COMMENT = r"(?s)/\*.*?\*/"
LIST_NAME = r"(?i)\bvalue\s+\$?([A-Za-z_][A-Za-z0-9_]*)"
ENTRY = r"('[^']*'|-?\d+)\s*=\s*'([^']*)'"
PORT_SUFFIXES = r"\s+(\(BPS\)|#ARPT)$"


def parse_code_lists(statements: DataFrame, column: str = "value") -> DataFrame:
    """(list_name, code, label) from a frame of one statement per row.

    Keys lose their quotes and trailing blanks ('CP ' -> 'CP'); labels lose
    surrounding blanks. Statements without ``value`` (headers, ``run``)
    yield nothing.
    """
    s = statements.select(F.regexp_replace(F.col(column), COMMENT, " ").alias("stmt"))
    s = s.select(F.regexp_extract("stmt", LIST_NAME, 1).alias("list_name"),
                 F.regexp_replace("stmt", LIST_NAME, " ").alias("body")).filter("list_name <> ''")
    pairs = s.select(
        "list_name",
        F.inline(F.arrays_zip(F.regexp_extract_all("body", F.lit(ENTRY), 1).alias("k"),
                              F.regexp_extract_all("body", F.lit(ENTRY), 2).alias("v"))))
    return pairs.select(
        F.lower("list_name").alias("list_name"),
        F.rtrim(F.regexp_replace("k", "^'|'$", "")).alias("code"),
        F.trim("v").alias("label"),
    )


def read_code_lists(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parse catalog file(s): one record per ``;``-terminated statement."""
    return parse_code_lists(spark.read.option("lineSep", ";").text(path))


def label_status(label_col: str = "label") -> F.Column:
    """'invalid', 'collapsed', 'no_code' or 'valid' for a catalog label."""
    lab = F.col(label_col)
    return (F.when(lab.startswith("INVALID:"), "invalid")
            .when(lab.contains("Collapsed") | lab.contains("should not show"), "collapsed")
            .when(lab.rlike(r"^No .*Code"), "no_code")
            .otherwise("valid"))


def port_places(lists: DataFrame, list_name: str = "i94prtl") -> DataFrame:
    """Port list entries split into place and state: 'SALINAS, CA (BPS)' ->
    ('SALINAS', 'CA'). The state is the text after the last comma; labels
    without a comma have no state."""
    p = lists.filter(F.col("list_name") == list_name)
    lab = F.regexp_replace("label", PORT_SUFFIXES, "")
    has_comma = lab.contains(",")
    state = F.when(has_comma, F.trim(F.substring_index(lab, ",", -1)))
    place = F.when(has_comma, F.trim(F.regexp_replace(lab, ",[^,]*$", ""))).otherwise(F.trim(lab))
    return p.select("code", "label", place.alias("place"), state.alias("state"),
                    label_status().alias("status"))


def write_catalog(lists: dict[str, DataFrame], path: str, chunk: int = 500) -> None:
    """Write (code, label, quoted) frames as catalog text, one statement per
    chunk of at most ``chunk`` consecutive rows of a partition."""
    parts = []
    for name, df in lists.items():
        key = F.when(F.col("quoted"), F.concat(F.lit("'"), F.col("code"), F.lit("'"))).otherwise(F.col("code"))
        line = F.concat(F.lit("   "), key, F.lit(" = '"), F.col("label"), F.lit("'"))
        grouped = (df.select(line.alias("line"),
                             F.floor(F.monotonically_increasing_id() / chunk).alias("_chunk"))
                   .groupBy("_chunk").agg(F.concat_ws("\n", F.collect_list("line")).alias("lines")))
        parts.append(grouped.select(
            F.concat(F.lit(f"value {name}\n"), F.col("lines"), F.lit("\n;")).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out.write.mode("overwrite").text(path)
