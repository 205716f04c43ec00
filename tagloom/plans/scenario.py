"""The tagging scenario over the driver's tables (all derived by Spark).

Mapping of the warehouse extracts onto the test tables:

* users  <- ``customer``: ``id = c_custkey``, ``job = c_mktsegment``,
  ``gender = '1'`` for even keys else ``'2'``, ``birthday`` = 1940-01-01
  plus ``(c_custkey * 7919) mod 21915`` days (a fixed spread over 60 years),
  and the null marker ``\\N`` for every 13th key.
* orders <- ``orders``: ``memberId = o_custkey``, ``finishTime`` = epoch
  seconds (UTC) of ``o_orderdate``, ``orderstatus = o_orderstatus``,
  ``orderamount = o_totalprice``.
* goods  <- ``lineitem``: ``orderid``, ``productid``, ``price``.
* logs   <- ``events``: ``id = event_id``, ``global_user_id = user_id``,
  ``loc_url = event_type``, ``log_time = ts`` to the second, and the null
  marker ``\\N`` for every 17th event.

The tag taxonomy is a fixed classification head (ids below 100) plus the job
values, which are the distinct market segments found in ``customer`` (ids
``1,000,000 + the segment's smallest customer key``).  The catalog taxonomy adds classification paths from
``part`` (type / adjective / noun / brand).  The stored tags ("yesterday's
store") are derived from ``customer`` with a mix of clean and messy lists.
Every piece is a lazy DataFrame over the parquet tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.dates import timestamp_to_epoch
from tagloom.schemas import TAXONOMY_SCHEMA
from tagloom.sources.extracts import NULL_MARK
from tagloom.sources.taxonomy import models_frame, taxonomy_frame

AS_OF_ORDERS = "2001-08-01"
AS_OF_EVENTS = "2024-01-20"
LOOKBACK_DAYS = 7  # begins after the first event, so the lookback removes some
TABLES = ("customer", "orders", "lineitem", "events", "part")

# The classification head of the tag taxonomy and the
# level-5 values of the models whose values are not data-driven.
# (id, name, rule, level, pid)
_USERS = "inType=table##hbaseTable=tbl_users##family=detail##selectFields="
_ORDERS = "inType=table##hbaseTable=tbl_orders##family=detail##selectFields="
_LOGS = "inType=table##hbaseTable=tbl_logs##family=detail##selectFields="
HEAD_TAGS = [
    (1, "commerce", None, 1, -1),
    (2, "mall", None, 2, 1),
    (3, "business attributes", None, 3, 2),
    (4, "gender", _USERS + "id,gender", 4, 3),
    (5, "male", "1", 5, 4),
    (6, "female", "2", 5, 4),
    (7, "job", _USERS + "id,job", 4, 3),
    (14, "age", _USERS + "id,birthday", 4, 3),
    (15, "under 18", "0-17", 5, 14),
    (16, "18 to 24", "18-24", 5, 14),
    (17, "25 to 34", "25-34", 5, 14),
    (18, "35 to 44", "35-44", 5, 14),
    (19, "45 to 54", "45-54", 5, 14),
    (20, "55 to 64", "55-64", 5, 14),
    (21, "65 and over", "65-150", 5, 14),
    (23, "purchase cycle", _ORDERS + "memberId,finishTime", 4, 3),
    (24, "0 to 30 days", "0-30", 5, 23),
    (25, "31 to 90 days", "31-90", 5, 23),
    (26, "91 to 365 days", "91-365", 5, 23),
    (27, "366 to 3000 days", "366-3000", 5, 23),
    (30, "order status", _ORDERS + "memberId,orderstatus", 4, 3),
    (31, "finished", "F", 5, 30),
    (32, "open", "O", 5, 30),
    (45, "activity", _LOGS + "global_user_id,loc_url,log_time", 4, 3),
    (46, "very active", "0", 5, 45),
    (47, "active", "1", 5, 45),
    (48, "quiet", "2", 5, 45),
    (49, "dormant", "3", 5, 45),
]
JOB_TAG_BASE = 1_000_000
# level-4 tags whose level-5 values are derived from the data (the rest are in HEAD_TAGS)
DATA_DERIVED_TAGS = frozenset({7})

# Model registry rows of the head models.
# (id, tag_id, model_name, state, model_main, sche_time)
HEAD_MODELS = [
    (1, 4, "gender", 3, "tagloom.plans.models.ExactMatchModel", "1,2019-12-01 00:00,2029-12-01 00:00"),
    (2, 7, "job", 3, "tagloom.plans.models.ExactMatchModel", "1,2019-12-01 00:00,2029-12-01 00:00"),
    (3, 14, "age", 1, "tagloom.plans.models.AgeRangeModel", "1,2019-12-01 00:00,2029-12-01 00:00"),
    (4, 23, "purchase_cycle", 3, "tagloom.plans.models.RecencyRangeModel", "1,2019-12-01 00:00,2029-12-01 00:00"),
    (5, 30, "order_status", 3, "tagloom.plans.models.ExactMatchModel", "1,2019-12-01 00:00,2029-12-01 00:00"),
    (6, 45, "activity", 2, "tagloom.plans.models.ActivityModel", "1,2019-12-01 00:00,2029-12-01 00:00"),
]


class Tables(dict):
    """Parquet tables of one sf dir, each read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=TABLES):
        super().__init__()
        self._spark, self._dir, self._names = spark, sf_dir.rstrip("/"), tuple(names)

    def __missing__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        df = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        self[name] = df
        return df

    def __contains__(self, name) -> bool:
        return name in self._names


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return Tables(spark, sf_dir, names)


# --- wide-row sources (all strings) -------------------------------------------------

def users_source(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    birthday = F.date_add(F.lit("1940-01-01").cast("date"), ((k * F.lit(7919)) % F.lit(21915)).cast("int"))
    return customer.select(
        k.cast("string").alias("id"),
        F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("2")).alias("gender"),
        F.col("c_mktsegment").cast("string").alias("job"),
        F.when(k % 13 == 0, F.lit(NULL_MARK)).otherwise(F.date_format(birthday, "yyyy-MM-dd")).alias("birthday"),
    )


def orders_source(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("memberId"),
        timestamp_to_epoch(F.col("o_orderdate")).cast("string").alias("finishTime"),
        F.col("o_orderstatus").cast("string").alias("orderstatus"),
        F.col("o_totalprice").cast("string").alias("orderamount"),
    )


def goods_source(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_orderkey").cast("string").alias("orderid"),
        F.col("l_partkey").cast("string").alias("productid"),
        F.col("l_extendedprice").cast("string").alias("price"),
    )


def logs_source(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("global_user_id"),
        F.col("event_type").cast("string").alias("loc_url"),
        F.when(F.col("event_id") % 17 == 0, F.lit(NULL_MARK))
        .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss"))
        .alias("log_time"),
    )


SOURCES = {
    "tbl_users": ("customer", users_source),
    "tbl_orders": ("orders", orders_source),
    "tbl_logs": ("events", logs_source),
    "tbl_goods": ("lineitem", goods_source),
}


def source_readers(t: dict[str, DataFrame]) -> dict:
    """Readers for ``inType=table``: the table a rule names, built on demand
    from the test tables (only the one a model reads is ever scanned)."""
    from tagloom.functions.rules import SourceMeta

    def table(spark: SparkSession, meta: SourceMeta) -> DataFrame:
        if meta.hbaseTable in SOURCES:
            base, build = SOURCES[meta.hbaseTable]
            return build(t[base])
        return spark.table(meta.hbaseTable)

    return {"table": table, "view": table}


# --- taxonomy, models, store -----------------------------------------------------------

def job_tags(customer: DataFrame) -> DataFrame:
    """Level-5 job values: one per distinct market segment.

    Id = ``JOB_TAG_BASE`` + the smallest customer key of the segment: unique
    per segment, deterministic, and one partial + final aggregate — no
    ordering of the distinct set is needed.
    """
    return (
        customer.where(F.col("c_mktsegment").isNotNull())
        .groupBy(F.col("c_mktsegment").alias("name"))
        .agg(F.min("c_custkey").alias("__k"))
        .select(
            (F.lit(JOB_TAG_BASE) + F.col("__k")).cast("bigint").alias("id"),
            F.col("name"),
            F.col("name").alias("rule"),
            F.lit(5).alias("level"),
            F.lit(7).cast("bigint").alias("pid"),
        )
    )


def head_taxonomy(spark: SparkSession) -> DataFrame:
    """The fixed classification head with its fixed level-5 values."""
    return taxonomy_frame(spark, HEAD_TAGS)


def base_taxonomy(spark: SparkSession, customer: DataFrame) -> DataFrame:
    head = head_taxonomy(spark)
    jobs = job_tags(customer).select(
        *[F.col(c) for c in ("id", "name", "rule", "level", "pid")],
        F.lit("2019-12-01 00:00:00").cast("timestamp").alias("ctime"),
        F.lit("2019-12-01 00:00:00").cast("timestamp").alias("utime"),
    )
    return head.unionByName(jobs.select(*[F.col(f.name).cast(f.dataType) for f in TAXONOMY_SCHEMA.fields]))


def catalog_paths(part: DataFrame) -> DataFrame:
    """One path per part row: type / first word / second word of the name / brand."""
    words = F.split(F.col("p_name"), " ")
    return part.select(
        F.col("p_type").alias("l1"),
        words.getItem(0).alias("l2"),
        F.when(F.size(words) >= 2, words.getItem(1)).alias("l3"),
        F.col("p_brand").alias("l4"),
    )


def brand_rule(name: F.Column, pid: F.Column) -> F.Column:
    """Rule of a catalog level-4 tag: a goods source, the brand, the path id.

    ``selectFields`` appears twice (the later one wins) and ``note`` carries
    an ``=`` in its value (only the part before it counts).
    """
    return F.concat(
        F.lit("inType=table##hbaseTable=tbl_goods##family=detail##selectFields=productid##brand="),
        name,
        F.lit("##pathId="),
        pid.cast("string"),
        F.lit("##note=a=b##selectFields=productid,price"),
    )


def catalog_taxonomy(spark: SparkSession, base: DataFrame, part: DataFrame) -> DataFrame:
    """The base taxonomy plus the classification paths found in ``part``."""
    from tagloom.operators.taxonomy import load_paths

    tax = load_paths(base, catalog_paths(part), cols=("l1", "l2", "l3", "l4"))
    # every head level-4 tag has a rule; the loaded level-4 tags are the brands
    is_brand = (F.col("level") == 4) & F.col("rule").isNull()
    return tax.withColumn("rule", F.when(is_brand, brand_rule(F.col("name"), F.col("pid"))).otherwise(F.col("rule")))


def models_registry(spark: SparkSession, taxonomy: DataFrame) -> DataFrame:
    """Head models plus one model per catalog brand tag of the ``Brand#1…`` family."""
    head = models_frame(spark, HEAD_MODELS)
    brand = taxonomy.where((F.col("level") == 4) & F.col("name").startswith("Brand#1")).select(
        (F.col("id") + F.lit(100000)).cast("bigint").alias("id"),
        F.col("id").cast("bigint").alias("tag_id"),
        F.concat(F.lit("brand_"), F.col("id").cast("string")).alias("model_name"),
        F.lit(1).alias("state"),
        F.lit(None).cast("string").alias("model_path"),
        F.lit("tagloom.plans.models.ExactMatchModel").alias("model_main"),
        F.lit("1,2019-12-01 00:00,2029-12-01 00:00").alias("sche_time"),
        F.lit(None).cast("string").alias("args"),
        F.lit("2019-12-01 00:00:00").cast("timestamp").alias("ctime"),
        F.lit("2019-12-01 00:00:00").cast("timestamp").alias("utime"),
    )
    return head.unionByName(brand.select(*[F.col(c).cast(head.schema[c].dataType) for c in head.columns]))


def stored_tags(customer: DataFrame, taxonomy: DataFrame | None = None) -> DataFrame:
    """Yesterday's store: customers with a non-negative balance, lists by nation band.

    nation 0-2: ``job,gender``; 3-4: ``0gender, gender,job,x9`` (one tag written
    in two ways, and text that is no tag); 5-9: ``job,job,,`` (repeat, trailing
    empties); 10-14: one space (blank); 15-19: null; 20-24: ``,gender,,job,``
    (leading, inner and trailing empties).
    """
    k = F.col("c_custkey")
    gender_tag = F.when(k % 2 == 0, F.lit("5")).otherwise(F.lit("6"))
    jobs = job_tags(customer) if taxonomy is None else taxonomy.where(F.col("pid") == 7)
    ranks = jobs.select(F.col("name").alias("c_mktsegment"), F.col("id").cast("string").alias("__job"))
    from tagloom.operators.broadcast import maybe_broadcast

    ranks, _ = maybe_broadcast(ranks)
    c = customer.where(F.col("c_acctbal") >= 0).join(ranks, "c_mktsegment", "left")
    n = F.col("c_nationkey")
    job = F.col("__job")
    tags = (
        F.when(n < 3, F.concat_ws(",", job, gender_tag))
        .when(n < 5, F.concat(F.lit("0"), gender_tag, F.lit(", "), gender_tag, F.lit(","), job, F.lit(",x9")))
        .when(n < 10, F.concat(job, F.lit(","), job, F.lit(",,")))
        .when(n < 15, F.lit(" "))
        .when(n < 20, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(","), gender_tag, F.lit(",,"), job, F.lit(",")))
    )
    return c.select(k.cast("string").alias("userId"), tags.alias("tagsId"))


def status_lists(customer: DataFrame) -> DataFrame:
    """New tag lists that overlap each other and the order-status tags: two rows per even customer."""
    even = customer.where(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").cast("string").alias("userId"))
    lists = F.explode(F.array(F.lit("31,5"), F.lit("5,32,,"), F.lit(" "), F.lit(None).cast("string")))
    return even.select("userId", lists.alias("tagsId"))
