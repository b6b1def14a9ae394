"""Build the star schema from the four sources.

``build_star`` returns the five tables as lazy frames (one plan each).
``load_star`` materialises them table by table into a warehouse folder;
each written table is read back before it feeds the next, so lineage is
cut at every table and a lost executor only recomputes from the last
written table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.functions.dates import month_key
from portolan.operators import clean, dims, fact
from portolan.schemas import STAR_TABLES
from portolan.session import run_concurrently
from portolan.sources import files


@dataclass
class Sources:
    arrivals: DataFrame
    cities: DataFrame
    ports: DataFrame
    temperatures: DataFrame


def clean_sources(src: Sources, carry: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    return {
        "arrivals": clean.clean_arrivals(src.arrivals, carry),
        "cities": clean.clean_cities(src.cities),
        "ports": clean.clean_ports(src.ports),
        "temperatures": clean.clean_temperatures(src.temperatures),
    }


class LazyTables(Mapping):
    """Name -> frame, each frame built on first access.

    Building a plan can run a small job (the port dimension's size check
    before the fact join), so a query that needs one table does not pay
    for the others.
    """

    def __init__(self, builders: dict[str, Callable[["LazyTables"], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def build_star(src: Sources) -> LazyTables:
    """The five tables as lazy frames over the sources."""
    c = LazyTables({
        "cities": lambda t: clean.clean_cities(src.cities),
        "ports": lambda t: clean.clean_ports(src.ports),
        "temperatures": lambda t: clean.clean_temperatures(src.temperatures),
    })
    return LazyTables({
        "fact_immigrations": lambda t: fact.fact_from_raw(src.arrivals, t["dim_ports"]),
        # Days don't change when copies of a row stay in: no wide distinct.
        "dim_time": lambda t: dims.dim_time(fact_with_copies(src, t["dim_ports"])),
        "dim_cities": lambda t: dims.dim_cities(c["cities"], c["ports"]),
        "dim_ports": lambda t: dims.dim_ports(c["ports"], c["cities"]),
        "dim_temperatures": lambda t: dims.dim_temperatures(c["temperatures"]),
    })


def fact_with_copies(src: Sources, ports: DataFrame) -> DataFrame:
    """The fact without the full-row distinct, for questions to which copies
    of a row make no difference."""
    return fact.fact_from_raw(src.arrivals, ports, distinct=False)


def load_star(spark: SparkSession, src: Sources, base: str) -> dict[str, DataFrame]:
    """Write the five tables under ``base`` and return them read back.

    Re-running replaces the tables (the fact is partitioned by arrival
    month and overwritten per month), so a second run changes nothing.
    """
    return load_star_observed(spark, src, base)[0]


def load_star_observed(spark: SparkSession, src: Sources, base: str
                       ) -> tuple[dict[str, DataFrame], dict[str, dict]]:
    """``load_star`` that also returns, per table, the row count and the
    null-key count of the rows written. Both are measured by the write jobs
    themselves, so checking a load costs no further pass over the data.

    The chain ports -> fact -> time depends on its own written tables; the
    city and temperature dimensions do not, so they are written at the same
    time as the chain instead of after it (their small jobs fill executors
    the chain leaves idle).
    """
    c = {"cities": clean.clean_cities(src.cities), "ports": clean.clean_ports(src.ports),
         "temperatures": clean.clean_temperatures(src.temperatures)}

    def write(name: str, df: DataFrame, partition_by: list[str] | None = None):
        key = STAR_TABLES[name][1]
        return files.write_observed(df, f"{base}/{name}", {
            "row_count": F.count(F.lit(1)),
            "null_key": F.count_if(F.col(key).isNull()),
        }, partition_by)

    def ports_fact_time() -> dict[str, tuple[DataFrame, dict]]:
        ports = write("dim_ports", dims.dim_ports(c["ports"], c["cities"]))
        facts = fact.fact_from_raw(src.arrivals.withColumn("month", month_key("arrdate")), ports[0], carry=("month",))
        written, fact_metrics = write("fact_immigrations", facts, ["month"])
        fact_t = written.select(*fact.FACT_COLUMNS)
        time = write("dim_time", dims.dim_time(fact_t))
        return {"dim_ports": ports, "fact_immigrations": (fact_t, fact_metrics), "dim_time": time}

    done = run_concurrently({
        "chain": ports_fact_time,
        "dim_cities": lambda: write("dim_cities", dims.dim_cities(c["cities"], c["ports"])),
        "dim_temperatures": lambda: write("dim_temperatures", dims.dim_temperatures(c["temperatures"])),
    })
    written = {**done.pop("chain"), **done}
    order = ["dim_ports", "dim_cities", "dim_temperatures", "fact_immigrations", "dim_time"]
    return ({n: written[n][0] for n in order}, {n: written[n][1] for n in order})
