"""Binding of the driver's TPC-H-ish tables to the six SaaS datasets.

The test tables have no SaaS schema, so each dataset is derived from them
with a fixed rule (the same rules are written in DuckDB SQL in
``growlytics.plans.oracle``):

users          customer x nation; user_id = c_custkey; signup_date = first
               order date (customers without orders are not users);
               country = n_name; channel by n_regionkey (0, 1 Google, 2 Meta,
               3 Organic, else Referral); plan by c_mktsegment (AUTOMOBILE
               Enterprise, BUILDING / MACHINERY Pro, else Free)
sessions       orders; session_end = start + (2 + o_orderkey % 74) minutes;
               device by o_orderkey % 5 (0, 1 Desktop; 2, 3 Mobile; 4 Tablet)
payments       orders of paid users; amount = o_totalprice rounded to cents
subscriptions  one per user; start = signup; if the last order (latest date,
               then highest key) has status 'F' the subscription is cancelled
               on that order's date, else active and open
experiments    EXP_3ARM: every user, variant by c_custkey % 3 (Control,
               Variant A, Variant B); EXP_2ARM: users with c_acctbal > 0,
               variant by c_custkey % 2 (Control, Variant)
events         events (event_id, user_id, ts -> event_time, event_type)
experiment log orders as exposures: group by o_orderkey parity, landing page
               consistent with the group except when o_orderkey % 11 = 0,
               converted = (o_orderstatus = 'F')

Every dataset is a lazy DataFrame; nothing is collected.  The two per-customer
facts (first order, last order) come from one partial aggregation over
orders, which is skew-safe: a customer with a third of all orders is
combined map-side before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growlytics.sources.files import read_table


def _channel(regionkey):
    return (
        F.when(regionkey.isin(0, 1), "Google")
        .when(regionkey == 2, "Meta")
        .when(regionkey == 3, "Organic")
        .otherwise("Referral")
    )


def _plan(segment):
    return (
        F.when(segment == "AUTOMOBILE", "Enterprise")
        .when(segment.isin("BUILDING", "MACHINERY"), "Pro")
        .otherwise("Free")
    )


def _device(key):
    m = key % 5
    return F.when(m <= 1, "Desktop").when(m <= 3, "Mobile").otherwise("Tablet")


@dataclass
class Binding:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def customer_orders(self) -> DataFrame:
        """Per customer: first order time, last order time and whether the
        last order (latest date, then highest key) has status 'F'.

        The last order is the maximum in two steps, each with fixed-width
        buffers (hash aggregates with map-side combine): per customer and
        date the order with the highest key, then the latest date."""
        o = self.table("orders").groupBy(F.col("o_custkey").alias("user_id"), "o_orderdate").agg(
            F.max_by((F.col("o_orderstatus") == "F").cast("int"), F.col("o_orderkey")).alias("is_f"))
        return o.groupBy("user_id").agg(
            F.min("o_orderdate").alias("first_ts"),
            F.max("o_orderdate").alias("last_ts"),
            F.max_by("is_f", "o_orderdate").alias("last_is_f"),
        )

    @cached_property
    def users(self) -> DataFrame:
        c = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        n = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        first = self.customer_orders.select("user_id", "first_ts")
        return (
            c.join(n, c.c_nationkey == n.n_nationkey)
            .join(first, c.c_custkey == first.user_id)
            .select(
                F.col("user_id"),
                F.to_date("first_ts").alias("signup_date"),
                F.col("n_name").alias("country"),
                _channel(F.col("n_regionkey")).alias("acquisition_channel"),
                _plan(F.col("c_mktsegment")).alias("plan_type"),
            )
        )

    @cached_property
    def sessions(self) -> DataFrame:
        o = self.table("orders")
        k = F.col("o_orderkey")
        return o.select(
            k.alias("session_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("session_start"),
            F.timestamp_add("MINUTE", 2 + k % 74, F.col("o_orderdate")).alias("session_end"),
            _device(k).alias("device_type"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        paid = self.users.where(F.col("plan_type").isin("Pro", "Enterprise")).select("user_id")
        cents = F.floor(F.col("o_totalprice") * 100 + 0.5)
        return o.join(paid, o.o_custkey == paid.user_id, "left_semi").select(
            F.col("o_orderkey").alias("payment_id"),
            F.col("o_custkey").alias("user_id"),
            (cents / 100).cast("decimal(18,2)").alias("amount"),
            F.to_date("o_orderdate").alias("payment_date"),
        )

    @cached_property
    def subscriptions(self) -> DataFrame:
        last = self.customer_orders.select("user_id", "last_ts", "last_is_f")
        cancelled = F.col("last_is_f") == 1
        return self.users.join(last, "user_id").select(
            F.col("user_id").alias("subscription_id"),
            F.col("user_id"),
            F.col("plan_type").alias("plan"),
            F.col("signup_date").alias("start_date"),
            F.when(cancelled, F.to_date("last_ts")).alias("end_date"),
            F.when(cancelled, "cancelled").otherwise("active").alias("status"),
        )

    @cached_property
    def experiments(self) -> DataFrame:
        c = self.table("customer").select("c_custkey", "c_acctbal")
        u = self.users.select("user_id", "signup_date")
        base = u.join(c, u.user_id == c.c_custkey)
        assigned = F.to_timestamp(F.col("signup_date"))
        def arm(experiment: str, variant):
            return F.struct(F.lit(experiment).alias("experiment_id"), variant.alias("variant"))

        u3, u2 = F.col("user_id") % 3, F.col("user_id") % 2
        three = arm("EXP_3ARM", F.when(u3 == 0, "Control").when(u3 == 1, "Variant A").otherwise("Variant B"))
        two = arm("EXP_2ARM", F.when(u2 == 0, "Control").otherwise("Variant"))
        arms = F.when(F.col("c_acctbal") > 0, F.array(three, two)).otherwise(F.array(three))
        return base.select("user_id", assigned.alias("assigned_date"), F.explode(arms).alias("arm")).select(
            "arm.experiment_id", "arm.variant", "user_id", "assigned_date")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").select(
            "event_id", "user_id", F.col("ts").alias("event_time"), "event_type"
        )

    @cached_property
    def experiment_log(self) -> DataFrame:
        o = self.table("orders")
        k = F.col("o_orderkey")
        control = k % 2 == 0
        consistent = k % 11 != 0
        return o.select(
            F.col("o_custkey").alias("user_id"),
            F.timestamp_add("SECOND", k % 86400, F.col("o_orderdate")).alias("timestamp"),
            F.when(control, "control").otherwise("treatment").alias("group"),
            F.when(control == consistent, "old_page").otherwise("new_page").alias("landing_page"),
            (F.col("o_orderstatus") == "F").cast("int").alias("converted"),
            k.alias("exposure_id"),
        )

    def raw(self, dataset: str) -> DataFrame:
        return getattr(self, dataset)


def bind(spark: SparkSession, sf_dir: str) -> Binding:
    return Binding(spark, sf_dir)
