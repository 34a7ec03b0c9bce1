"""The four account tables, derived from an order warehouse.

Customers are the accounts, orders the tickets, shipped lines the usage, and
returned first lines the survey answers. Every view is lazy; Catalyst prunes the
columns and tables a query does not touch.

The region and nation tables are joined without a hint: Spark reads their sizes
and broadcasts them while they are below its threshold.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.scalars import numpy_round, ratio
from stayline.sources.schemas import WAREHOUSE_TABLES
from stayline.sources.tables import read_table

SNAPSHOT = dt.date(2000, 7, 31)
LABEL_DAYS = 365
#: Lines per task of the join with the orders (some 220 MB to sort and group).
LINES_PER_TASK = 1_000_000
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def hundredths(amount: Column) -> Column:
    """A two-decimal double as an exact whole number of hundredths."""
    return F.rint(amount * 100).cast("bigint")


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = read_table(
                self.spark, f"{self.folder}/{name}.parquet", WAREHOUSE_TABLES[name], "parquet"
            )
        return self._opened[name]

    @cached_property
    def account_base(self) -> DataFrame:
        """Account attributes that need no facts."""
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        balance = F.col("c_acctbal")
        mrr = F.abs(balance).cast("decimal(12,2)")
        return (
            self.table("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("account_id"),
                F.col("c_name").alias("company_name"),
                F.when(balance < 3850, "starter")
                .when(balance < 7950, "professional")
                .otherwise("enterprise")
                .alias("plan_tier"),
                mrr.alias("mrr"),
                (mrr * 12).cast("decimal(14,2)").alias("arr"),
                (F.col("c_custkey") % 50).cast("int").alias("seats_licensed"),
                (F.col("c_custkey") % 997).cast("int").alias("employee_count"),
                F.when(F.col("c_custkey") % 10 < 7, 12).otherwise(24).alias("renewal_months"),
                F.col("c_mktsegment").alias("industry"),
                F.col("r_name").alias("region"),
                F.col("n_name").alias("csm_assigned"),
            )
        )

    def order_figures(self, more: dict[str, Column] | None = None) -> DataFrame:
        """First order, last order up to the snapshot, and whether one follows it; ``more``
        aggregates of the tickets in the same grouping."""
        day = F.col("created_date")
        until = F.lit(SNAPSHOT)
        renewed = (day > until) & (day <= F.date_add(until, LABEL_DAYS))
        return self.tickets.groupBy("account_id").agg(
            F.min(day).alias("contract_start_date"),
            F.max(F.when(day <= until, day)).alias("last_order_date"),
            F.max(renewed.cast("int")).alias("renewed"),
            *[column.alias(name) for name, column in (more or {}).items()],
        )

    @cached_property
    def order_span(self) -> DataFrame:
        return self.order_figures()

    @cached_property
    def labels(self) -> DataFrame:
        """account_id, churned: no order in the year after the snapshot."""
        return self.accounts.select("account_id", "churned")

    @cached_property
    def accounts(self) -> DataFrame:
        return self.accounts_with(self.order_span)

    def accounts_with(self, orders: DataFrame) -> DataFrame:
        """The accounts with what their orders say, and whatever else ``orders`` holds per account."""
        churned = 1 - F.coalesce("renewed", F.lit(0))
        return (
            self.account_base.join(orders, "account_id", "left")
            .withColumns(
                {
                    "contract_end_date": F.date_add(
                        "contract_start_date", F.col("renewal_months") * 30
                    ),
                    "churned": churned,
                    "churn_date": F.when(churned == 1, F.col("last_order_date")),
                }
            )
            .drop("last_order_date", "renewed")
        )

    def _lines(self, wanted: Column | None = None) -> DataFrame:
        """Lines with their order. Both sides grow with the data, so neither is to be
        broadcast; a sort-merge join also lets the adaptive planner split hot keys. It makes
        a task per core or two, so the tasks of large tables are counted by their lines: an
        order has few."""
        lines, orders = self.table("lineitem"), self.table("orders")
        if wanted is not None:
            lines = lines.where(wanted)
        if self._line_tasks > self.spark.sparkContext.defaultParallelism:
            lines, orders = lines.repartition(self._line_tasks, "l_orderkey"), orders.repartition(self._line_tasks, "o_orderkey")
        return lines.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def _line_tasks(self) -> int:
        return -(-self.table("lineitem").count() // LINES_PER_TASK)

    @cached_property
    def usage(self) -> DataFrame:
        """One row per account and month; the grouping is combined before the shuffle."""
        return self._by_month(self._lines())

    def usage_until(self, last: dt.date, more: dict[str, Column] | None = None) -> DataFrame:
        """Usage of the months that begin by a day. The bound stands on the stored
        column, so the scan of the lines can skip by it. ``more`` aggregates of the lines
        go along."""
        following = (last.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        return self._by_month(self._lines(F.col("l_shipdate") < F.lit(following).cast("timestamp_ntz")), more)

    def _by_month(self, lines: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
        discount = hundredths(F.col("l_discount"))
        tax = hundredths(F.col("l_tax"))
        price = hundredths(F.col("l_extendedprice"))
        rows = F.count(F.lit(1))
        return (
            lines.groupBy(
                F.col("o_custkey").alias("account_id"),
                F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"),
            )
            .agg(
                F.sum(F.col("l_quantity").cast("bigint")).alias("logins"),
                numpy_round(ratio(F.sum(discount), rows * 10), 3)
                .cast("decimal(8,3)")
                .alias("active_user_ratio"),
                numpy_round(ratio(F.sum(tax), rows * 100), 3)
                .cast("decimal(8,3)")
                .alias("feature_adoption_pct"),
                numpy_round(ratio(F.sum(price), F.lit(100000)), 2)
                .cast("decimal(14,2)")
                .alias("data_processed_gb"),
                rows.alias("api_calls"),
                F.max((tax >= 7).cast("int")).alias("has_api_integration"),
                *[column.alias(name) for name, column in (more or {}).items()],
            )
        )

    @cached_property
    def tickets(self) -> DataFrame:
        key = F.col("o_orderkey")
        priority = F.col("o_orderpriority")
        return self.table("orders").select(
            key.alias("ticket_id"),
            F.col("o_custkey").alias("account_id"),
            F.col("o_orderdate").cast("date").alias("created_date"),
            F.col("o_orderstatus").alias("category"),
            F.when(priority == "1-URGENT", "critical")
            .when(priority == "2-HIGH", "high")
            .when(priority == "3-MEDIUM", "medium")
            .otherwise("low")
            .alias("priority"),
            (1 + key % 72).cast("int").alias("resolution_hours"),
            F.when(F.col("o_orderstatus") != "P", (1 + key % 5).cast("int")).alias("csat_score"),
        )

    @staticmethod
    def survey() -> tuple[Column, Column, Column]:
        """Which lines are survey answers, their day and their score."""
        asked = (F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "R")
        return asked, F.col("l_shipdate").cast("date"), hundredths(F.col("l_discount")).cast("int")

    @cached_property
    def nps(self) -> DataFrame:
        asked, shipped, score = self.survey()
        return (
            self._lines()
            .where(asked)
            .select(
                F.col("o_custkey").alias("account_id"),
                shipped.alias("survey_date"),
                F.concat(
                    F.lit("Q"), F.quarter(shipped).cast("string"), F.lit("_"), F.year(shipped).cast("string")
                ).alias("quarter"),
                score.alias("nps_score"),
            )
        )
