"""Operational tables derived from the TPC-H-style test tables.

``snapshot`` 1 is the state at the full load, 2 at the incremental run.
"""

from __future__ import annotations

from dataclasses import dataclass
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronostar.operators.traffic import KEY
from chronostar.schemas import SOURCE
from chronostar.session import COMPACT, stage, stage_path
from chronostar.sources.extracts import with_sequence
from chronostar.sources.tables import conform


#: Room for the repeats of a line number in the id of an order line; more of them fail.
LINE_REPEATS = 100_000

#: Where the numbered lines of a session's data folder are written, and their schema.
_LINES: dict[tuple[str, str], tuple] = {}
_LOCK = Lock()


def _day(base: str, offset: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), offset.cast("int")).cast("timestamp_ntz")


@dataclass
class FixtureSource:
    """Same interface as the other sources, plus the referral extract."""

    spark: SparkSession
    sf_dir: str
    snapshot: int

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return conform(getattr(self, f"_{name}")(), SOURCE[name].schema)

    @property
    def _second(self) -> bool:
        return self.snapshot == 2

    # Category, subcategory and traffic-source names are closed vocabularies
    # (part types and brands, event types), so numbering them is tiny.

    def _categories(self) -> DataFrame:
        types = self._read("part").select("p_type").distinct()
        number = F.row_number().over(W.orderBy("p_type")).alias("category_id")
        return types.select(number, F.col("p_type").alias("name"))

    def _subcategories(self) -> DataFrame:
        pairs = self._read("part").select("p_type", "p_brand").distinct()
        numbered = pairs.withColumn("subcategory_id", F.row_number().over(W.orderBy("p_type", "p_brand")))
        return numbered.join(self._categories().withColumnRenamed("name", "p_type"), "p_type").select(
            "subcategory_id", "category_id", F.col("p_brand").alias("name")
        )

    def _users(self) -> DataFrame:
        key = F.col("c_custkey")
        phone = F.concat(F.lit("555-"), (key % 10000).cast("string"))
        country = F.col("n_name")
        present = key % 20 != 19
        if self._second:
            phone = F.when(key % 30 == 6, "555-9999").otherwise(phone)
            country = F.when(key % 10 == 3, F.concat("n_name", F.lit(" (moved)"))).otherwise(country)
            present = key % 25 != 7
        nation = self._read("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self._read("customer")
            .filter(present)
            .join(nation, "c_nationkey")
            .select(
                key.alias("user_id"),
                F.col("c_mktsegment").alias("first_name"),
                F.expr("substr(c_name, 10)").alias("last_name"),
                F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
                F.when(key % 5 == 0, F.lit(None)).otherwise(phone).alias("phone"),
                country.alias("country"),
                _day("1995-01-01", key % 1500).alias("registered_at"),
            )
        )

    def _sales_managers(self) -> DataFrame:
        key = F.col("s_suppkey")
        prefix = F.when(key % 7 == 2, "new.").otherwise("") if self._second else F.lit("")
        return self._read("supplier").select(
            key.alias("manager_id"),
            F.lit("Supplier").alias("first_name"),
            F.expr("substr(s_name, 10)").alias("last_name"),
            F.concat(prefix, F.lower("s_name"), F.lit("@example.com")).alias("email"),
            _day("1994-01-01", key % 365).alias("hired_at"),
        )

    def _courses(self) -> DataFrame:
        key = F.col("p_partkey")
        price = F.floor("p_retailprice").cast("int")
        if self._second:
            price = price + F.when(key % 9 == 4, 10).otherwise(0)
        blank = F.lit("") if self._second else F.lit(None).cast("string")
        subs = self._subcategories().select("category_id", "subcategory_id", F.col("name").alias("p_brand"))
        return (
            self._read("part")
            .join(self._categories().withColumnRenamed("name", "p_type"), "p_type")
            .join(subs, ["category_id", "p_brand"])
            .select(
                key.alias("course_id"),
                F.col("p_name").alias("title"),
                F.col("p_type").alias("subject"),
                F.when(key % 9 == 5, blank)
                .otherwise(F.concat(F.lit("size "), F.col("p_size").cast("string")))
                .alias("description"),
                price.alias("price_in_rubbles"),
                _day("1994-06-01", key % 300).alias("created_at"),
                "category_id",
                "subcategory_id",
            )
        )

    def _numbered_lines(self) -> DataFrame:
        """All order lines with the orders of their key; a line number that repeats in its order is counted on in
        the id's last digits. The rows are dealt by order once, for the join and for counting."""
        rest = ("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
        repeat = F.row_number().over(W.partitionBy("l_orderkey", "l_linenumber").orderBy(*rest)) - 1
        full = F.raise_error(F.concat(F.lit(f"over {LINE_REPEATS} repeats of a line of order "), F.col("l_orderkey")))
        repeat = F.when(repeat < LINE_REPEATS, repeat).otherwise(full.cast("int"))
        number = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * LINE_REPEATS + repeat
        order = F.struct("o_custkey", "o_orderdate", "o_orderstatus")
        orders = self._read("orders").groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(F.collect_list(order).alias("orders"))
        lines = self._read("lineitem").select("l_orderkey", "l_linenumber", *rest).join(orders, "l_orderkey", "left")
        return lines.select(number.alias("id"), "l_orderkey", *rest[:-1], "orders")

    def _lines(self) -> DataFrame:
        """The numbered lines, written once for both snapshots and both tables that are made of them."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        with _LOCK:
            if key not in _LINES:
                path = stage_path(self.spark, "lines")
                _LINES[key] = path, stage(self._numbered_lines(), "lines", path, **COMPACT).schema
        path, schema = _LINES[key]
        return self.spark.read.schema(schema).parquet(path)

    def _kept(self, orderkey: str) -> Column:
        return F.lit(True) if self._second else F.col(orderkey) % 50 != 49

    def _enrollments(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "cancelled")
        if self._second:
            status = status.when(F.col("o_orderkey") % 8 == 1, "completed")
        lines = self._lines().filter(self._kept("l_orderkey"))
        return (
            lines.select("id", F.col("l_orderkey").alias("o_orderkey"), "l_partkey", F.inline("orders"))
            .select(
                F.col("id").alias("enrollment_id"),
                F.col("o_custkey").alias("user_id"),
                F.col("l_partkey").alias("course_id"),
                F.col("o_orderdate").alias("enrolled_at"),
                status.otherwise("active").alias("status"),
            )
        )

    def _sales(self) -> DataFrame:
        cost = F.floor("l_extendedprice").cast("int")
        if self._second:
            cost = cost * F.when(F.col("l_orderkey") % 12 == 6, 2).otherwise(1)
        return (
            self._lines()
            .filter(self._kept("l_orderkey"))
            .select(
                F.col("id").alias("sale_id"),
                F.col("id").alias("enrollment_id"),
                F.col("l_suppkey").alias("manager_id"),
                F.col("l_shipdate").alias("sale_date"),
                cost.alias("cost_in_rubbles"),
            )
        )

    def _traffic_sources(self) -> DataFrame:
        name = F.col("event_type")
        channel = F.when(name.isin("error", "signup"), "messaging") if self._second else F.when(F.lit(False), "")
        channel = channel.when(name.isin("click", "view"), "web").when(name == "purchase", "referral").otherwise("ads")
        return (
            self._read("events")
            .select("event_type")
            .distinct()
            .select(
                F.row_number().over(W.orderBy("event_type")).alias("source_id"),
                name.alias("name"),
                channel.alias("channel"),
                F.when(name == "view", F.lit(None)).otherwise(f"Weight={self.snapshot}").alias("details"),
            )
        )

    def _referrals(self) -> DataFrame:
        ids = self._traffic_sources().select("source_id", F.col("name").alias("event_type"))
        return self._read("events").join(ids, "event_type").withColumnRenamed("ts", "referred_at")

    def _year(self, renewed: Column) -> Column:
        return F.when(renewed, "-2026").otherwise("-2025") if self._second else F.lit("-2025")

    def _user_traffic(self) -> DataFrame:
        event = F.col("event_id")
        present = (event % 4 != 3) & (F.lit(self._second) | (event % 20 != 0))
        code = F.concat(F.lit("C"), (event % 97).cast("string"), self._year(event % 13 == 4))
        return (
            self._referrals()
            .filter(present)
            .select(*KEY, F.when(event % 11 == 0, F.lit(None)).otherwise(code).alias("campaign_code"))
        )

    def extract(self) -> DataFrame:
        """The referral extract of this snapshot; its keys are distinct, so they give the order."""
        event = F.col("event_id")
        present = ((event % 4 == 3) | (event % 50 == 2)) & (F.lit(self._second) | (event % 16 != 15))
        code = F.concat(F.lit("CSV"), (event % 89).cast("string"), self._year(event % 12 == 7))
        rows = (
            self._referrals()
            .filter(present)
            .select(*KEY, F.when(event % 33 == 2, "").otherwise(code).alias("campaign_code"))
        )
        return with_sequence(conform(rows, SOURCE["user_traffic"].schema), *KEY)
