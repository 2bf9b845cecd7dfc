"""Twin binding: the reference's shapes on the driver's commerce tables.

* contact (entity)        customer ⋈ nation ⋈ region
* cohort cell             (n_name, c_mktsegment, band)
* contact × term          orders (one order = one term row of a customer)
* session facts           lineitem (→ orders for the customer and term)
* survey responses        events (one event = one response of ``user_id``)
* site attribute          MAX(s_acctbal) per nation (supplier)

``band`` plays the nullable gender column: customers with a negative
balance get NULL, so cells with a NULL dimension exist.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.cohort import CohortSpec
from kpiloom.sources.catalog import ParquetCatalog

COHORT = CohortSpec(("n_name", "c_mktsegment", "band"), hierarchy=("r_name", "n_name"))
KEYS = list(COHORT.dims)

# Fixed values of the twin (order priorities and statuses of the tables).
URGENT, HIGH, MEDIUM, NOT_SPECIFIED, LOW = "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"


def band_expr(balance: Column) -> Column:
    return F.when(balance >= 5000, "HIGH").when(balance >= 0, "LOW")


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def in_year(col: str, year: int) -> Column:
    """Year test as a range, so Parquet row groups are skipped (PushedFilters)."""
    return (F.col(col) >= ts(f"{year}-01-01")) & (F.col(col) < ts(f"{year + 1}-01-01"))


def quarter_bounds(gterm: int) -> tuple[str, str]:
    year, q = divmod(gterm, 10)
    start = dt.date(year, 3 * (q - 1) + 1, 1)
    end = dt.date(year + (q == 4), 1 if q == 4 else 3 * q + 1, 1)
    return start.isoformat(), end.isoformat()


def in_quarters(col: str, gterms) -> Column:
    out = F.lit(False)
    for g in gterms:
        s, e = quarter_bounds(g)
        out = out | ((F.col(col) >= ts(s)) & (F.col(col) < ts(e)))
    return out


def gterm_of(d: dt.date) -> int:
    return d.year * 10 + (d.month - 1) // 3 + 1


def prev_gterm(g: int) -> int:
    year, q = divmod(g, 10)
    return (year - 1) * 10 + 4 if q == 1 else year * 10 + q - 1


class Commerce:
    """Lazy base relations of the twin; every method returns a DataFrame."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.cat = ParquetCatalog(spark, root)
        self._memo: dict = {}

    def memo(self, key, build):
        """Build a derived relation once per instance and reuse the object."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def contacts(self, region: bool = False) -> DataFrame:
        """Contacts with their cell; ``region=True`` adds ``r_name`` (the
        roll-up level).  A left join cannot be pruned by the optimizer (it
        does not know the key is unique), so it is only added when used."""
        return self.memo(("contacts", region), lambda: self._contacts(region))

    def _contacts(self, region: bool) -> DataFrame:
        c = self.cat("customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        n = self.cat("nation").select("n_nationkey", "n_name", "n_regionkey")
        # nation/region are fixed-size dimensions (25 and 5 rows); Spark's
        # size-checked auto-broadcast picks them up from the file statistics.
        j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
        extra = []
        if region:
            r = self.cat("region").select("r_regionkey", "r_name")
            j = j.join(r, n["n_regionkey"] == r["r_regionkey"], "left")
            extra = ["r_name"]
        return j.select(F.col("c_custkey").alias("contact_id"), "c_nationkey", *extra, "n_name",
                        "c_mktsegment", band_expr(F.col("c_acctbal")).alias("band"), "c_acctbal")

    def orders(self) -> DataFrame:
        return self.memo("orders", self._orders)

    def _orders(self) -> DataFrame:
        o = self.cat("orders")
        d = F.col("o_orderdate")
        return o.select("o_orderkey", F.col("o_custkey").alias("contact_id"), "o_orderstatus",
                        "o_orderpriority", "o_totalprice", "o_orderdate",
                        F.year(d).alias("yr"),
                        (F.year(d) * 10 + F.quarter(d)).alias("gterm"))

    def lineitem(self) -> DataFrame:
        return self.cat("lineitem")

    def part(self) -> DataFrame:
        return self.cat("part")

    def events(self) -> DataFrame:
        return self.cat("events")

    def supplier(self) -> DataFrame:
        return self.cat("supplier")
