"""A star that is published as a whole, one version at a time.

Every load writes into a folder of its own, ``versions/<id>`` below the
star's path. A version is a small file, ``_published/<number>.json``, that
names the folder of each table and, for the monthly fact, of each month; the
file with the highest number is the star. It is written last and by one
rename, so readers see all tables of the old version or all of the new one,
whatever fails in between, and no row is copied: months that a load doesn't
touch stay where an earlier load wrote them. The counts of a month
(``plans.monthly_counts``) lie beside its rows and come and go with them.

The last ``KEEP`` versions stay readable for readers under way; what only
older ones name is removed. One load at a time may publish to a path: a
second one that took the same number fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from portolan.schemas import STAR_TABLES
from portolan.session import remove_path

KEEP = 2
FACT = "fact_immigrations"
COUNTS = "fact_counts"  # of each month of the fact, beside it
_MANIFESTS = "_published"


def new_folder(out: str) -> str:
    """A folder for a load that may become a version."""
    return f"{out.rstrip('/')}/versions/{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, ascending; none if there is no such folder."""
    fs, path = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def months_in(spark: SparkSession, folder: str, column: str = "month") -> dict[str, str]:
    """Month -> its partition folder in a monthly table's folder."""
    mark = f"{column}="
    return {name[len(mark):]: f"{folder}/{name}" for name in names_in(spark, folder) if name.startswith(mark)}


def _numbers(spark: SparkSession, out: str) -> list[int]:
    return [int(n[:-5]) for n in names_in(spark, f"{out}/{_MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit()]


def _path(out: str, number: int) -> str:
    return f"{out}/{_MANIFESTS}/{number:012d}.json"


def _manifest(spark: SparkSession, out: str, number: int) -> dict:
    return json.loads(spark.read.text(_path(out, number), wholetext=True).first()[0])


def current(spark: SparkSession, out: str) -> dict | None:
    """``{"tables": name -> folder, "months": month -> folder of the fact}``
    of the version that is read now, folders being relative to ``out``; None
    before the first one."""
    numbers = _numbers(spark, out)
    return _manifest(spark, out, numbers[-1]) if numbers else None


def months_after(spark: SparkSession, out: str, folder: str, loaded: set[str]) -> dict[str, str]:
    """Month -> full folder of the fact once ``folder``'s load is published:
    the months it wrote, and the stored ones that it didn't load. A loaded
    month without rows is in neither."""
    stored = (current(spark, out) or {"months": {}})["months"]
    kept = {m: f"{out}/{f}" for m, f in stored.items() if m not in loaded}
    return kept | months_in(spark, f"{folder}/{FACT}")


def read_fact_months(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """The fact's months as one scan; empty without months."""
    schema = STAR_TABLES[FACT][0]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders.values())


def publish(spark: SparkSession, out: str, folder: str, months: Mapping[str, str]) -> int:
    """Make the tables in ``folder`` (one of ``new_folder``), with these
    months of the fact, the star at ``out``; returns the version's number."""
    relative = lambda p: p.removeprefix(f"{out}/")
    manifest = {"tables": {name: relative(f"{folder}/{name}") for name in STAR_TABLES if name != FACT},
                "months": {m: relative(p) for m, p in sorted(months.items())}}
    numbers = _numbers(spark, out)
    number = numbers[-1] + 1 if numbers else 1
    _write_once(spark, _path(out, number), json.dumps(manifest, indent=1))
    _remove_old(spark, out)
    return number


def _write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a file beside its place and move it there in one step, which
    fails if there is one already."""
    jvm = spark.sparkContext._jvm
    fs, target = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(f"{path}: another load published this version")


def counts_folder(month_folder: str) -> str:
    """Where the counts of a fact's month lie, if its load wrote any."""
    load, _, month = month_folder.rpartition(f"/{FACT}/")
    return f"{load}/{COUNTS}/{month}"


def _folders(manifest: dict) -> set[str]:
    months = manifest["months"].values()
    return {*manifest["tables"].values(), *months, *map(counts_folder, months)}


def _remove_old(spark: SparkSession, out: str) -> None:
    """Remove all but the last versions, and the folders that only they
    name. Folders that no version names, of loads under way or refused, stay."""
    numbers = _numbers(spark, out)
    old = {n: _manifest(spark, out, n) for n in numbers[:-KEEP]}
    kept = set().union(*(_folders(_manifest(spark, out, n)) for n in numbers[-KEEP:]))
    for number, manifest in old.items():
        for folder in _folders(manifest) - kept:
            remove_path(spark, f"{out}/{folder}")
        remove_path(spark, _path(out, number))
    in_use = {f.split("/")[1] for f in kept}
    for version in {f.split("/")[1] for m in old.values() for f in _folders(m)} - in_use:
        remove_path(spark, f"{out}/versions/{version}")


def read(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The published star: name -> table, all of one version."""
    out = out.rstrip("/")
    manifest = current(spark, out)
    if manifest is None:
        raise FileNotFoundError(f"{out}: no star is published here")
    tables = {name: spark.read.schema(STAR_TABLES[name][0]).parquet(f"{out}/{folder}")
              for name, folder in manifest["tables"].items()}
    tables[FACT] = read_fact_months(spark, {m: f"{out}/{f}" for m, f in manifest["months"].items()})
    return {name: tables[name] for name in STAR_TABLES}
