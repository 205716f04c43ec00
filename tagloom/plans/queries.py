"""Registered queries over the driver tables: one per operator group of the survey.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose work grows
with the tables (the taxonomy and rules are small dimensions joined to
them, or are themselves derived from the tables).
"""

from __future__ import annotations

import dataclasses
import datetime as dt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.sql import register_sql_functions
from tagloom.functions.tags import canonical_tags
from tagloom.functions.user import SumAggregate
from tagloom.operators.aggregate import last_per_key, tag_coverage
from tagloom.operators.audience import audience_sets, merge_sets, users_per_audience, users_per_tag
from tagloom.operators.broadcast import maybe_broadcast
from tagloom.operators.cluster import assign, centres, fit_segments, read_segments, write_segments
from tagloom.operators.match import exact_rules
from tagloom.operators.merge import merge_tags, upsert_tags
from tagloom.operators.rolling import advance, day_partials, first_state, state_measures, write_days
from tagloom.operators.taxonomy import by_level, rule_options, tags_with_models, tree_paths, users_per_category
from tagloom.plans import scenario as S
from tagloom.plans.models import ActivityModel, AgeRangeModel, ExactMatchModel, RecencyRangeModel, UserFunctionModel
from tagloom.plans.runner import model_inputs, run_model, run_models
from tagloom.schemas import EXTRACT_COLUMNS, EXTRACT_SEP, GOODS_COLUMNS, LOGS_COLUMNS, ORDERS_COLUMNS, USERS_COLUMNS
from tagloom.session import materialize, scratch_path
from tagloom.sources.extracts import (
    NULL_MARK,
    ZSTD_CODEC,
    ingest,
    ingest_observed,
    published_positions,
    read_extract,
    typed_view,
    write_sorted_by_key,
)
from tagloom.sources.rowsource import register_wide_rows
from tagloom.sources.slices import publish, publish_more, sliced_positions
from tagloom.sources.store import read_store, update_store, write_store
from tagloom.sources.taxonomy import read_models, read_taxonomy


class Ctx:
    """Tables, source readers and the taxonomy for one sf dir.

    The fixed classification head is a literal frame.  The full taxonomy adds
    the data-derived job values; it scans ``customer``, so it is built only
    when a step needs it (the job model, stored tags, coverage names) and
    is then materialised once, as a job reading it over JDBC would.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = S.load_tables(spark, sf_dir)
        self.readers = S.source_readers(self.t)
        self.head = S.head_taxonomy(spark)
        self._tax = None

    @property
    def tax(self) -> DataFrame:
        if self._tax is None:
            self._tax = materialize(S.base_taxonomy(self.spark, self.t["customer"]))
        return self._tax

    def taxonomy_for(self, model) -> DataFrame:
        """The head alone serves every model whose values are not data-derived."""
        return self.tax if model.tag_id in S.DATA_DERIVED_TAGS else self.head

    def inputs(self, model):
        return model_inputs(self.spark, model, self.taxonomy_for(model), self.readers)

    def stored(self) -> DataFrame:
        return S.stored_tags(self.t["customer"], self.tax)

    def catalog(self) -> DataFrame:
        return S.catalog_taxonomy(self.spark, self.tax, self.t["part"])


def cycle_model() -> RecencyRangeModel:
    return RecencyRangeModel(23, key_field="memberId", time_field="finishTime", shift_days=30, as_of=S.AS_OF_ORDERS)


# --- purchase cycle (D1, F4–F8, C2, H4) ----------------------------------------------

def cycle_tags(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    m = cycle_model()
    _, rules, src = c.inputs(m)
    return m.compute_detail(rules, src)


def last_purchase(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    _, _, src = c.inputs(cycle_model())
    return last_per_key(src, "memberId", "finishTime")


def recency_days(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    _, _, src = c.inputs(cycle_model())
    return cycle_model().days(src)


# --- exact match (B1 B2 C3 G1 G2 B8, H2 H3) ------------------------------------------

def _exact(spark, sf_dir, model):
    c = Ctx(spark, sf_dir)
    _, rules, src = c.inputs(model)
    return model.compute(rules, src)


def gender_tags(spark, sf_dir):
    return _exact(spark, sf_dir, ExactMatchModel(4, mode="replace", key_field="id", value_field="gender"))


def job_tags(spark, sf_dir):
    return _exact(spark, sf_dir, ExactMatchModel(7, key_field="id", value_field="job"))


def job_tags_sql(spark, sf_dir):
    """The job match as SQL text over temp views (source view + rule view)."""
    c = Ctx(spark, sf_dir)
    _, rules, src = c.inputs(ExactMatchModel(7))
    src.createOrReplaceTempView("t_job_source")
    side, small = maybe_broadcast(exact_rules(rules))
    side.createOrReplaceTempView("t_job_rules")
    hint = "/*+ BROADCAST(r) */ " if small else ""
    return spark.sql(
        f"""
        SELECT {hint}s.id AS userId,
               CASE WHEN r.__tag IS NULL
                    THEN CAST(raise_error(concat('no rule matches value ', coalesce(s.job, 'null'))) AS STRING)
                    ELSE CAST(r.__tag AS STRING) END AS tagsId
        FROM t_job_source s LEFT JOIN t_job_rules r ON s.job = r.__rule
        """
    )


def job_tags_sql_fn(spark, sf_dir):
    """The job lookup as the reference's SQL surface: a function call in SQL text."""
    c = Ctx(spark, sf_dir)
    register_sql_functions(spark, c.tax)
    _, _, src = c.inputs(ExactMatchModel(7))
    src.createOrReplaceTempView("t_users_sql")
    return spark.sql("SELECT id AS userId, CAST(tag_of(7, job) AS STRING) AS tagsId FROM t_users_sql")


def merge_tags_sql(spark, sf_dir):
    """The tag merge in SQL text (new ⟕ stored) with the registered ``tag_merge``."""
    c = Ctx(spark, sf_dir)
    register_sql_functions(spark)
    m = cycle_model()
    _, rules, src = c.inputs(m)
    m.compute(rules, src).createOrReplaceTempView("t_new_tags")
    c.stored().createOrReplaceTempView("t_stored_tags")
    return spark.sql(
        """SELECT n.userId, tag_merge(n.tagsId, o.tagsId) AS tagsId
           FROM t_new_tags n LEFT JOIN t_stored_tags o ON n.userId = o.userId"""
    )


def status_model(policy: str) -> ExactMatchModel:
    return ExactMatchModel(30, key_field="memberId", value_field="orderstatus", on_unmatched=policy)


def status_tags_null(spark, sf_dir):
    return _exact(spark, sf_dir, status_model("null"))


def status_tags_drop(spark, sf_dir):
    return _exact(spark, sf_dir, status_model("drop"))


def distinct_user_tags(spark, sf_dir):
    return status_tags_drop(spark, sf_dir).distinct()


# --- merge, replace, upsert, model run (C1 C4 D2 F9–F15 H1 H7 A4 A5) -------------------

def merge_tags_q(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    m = cycle_model()
    _, rules, src = c.inputs(m)
    return merge_tags(m.compute(rules, src), c.stored())


def replace_tags(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    m = ExactMatchModel(4, mode="replace", key_field="id", value_field="gender")
    _, rules, src = c.inputs(m)
    return upsert_tags(c.stored(), m.compute(rules, src), mode="replace")


def upsert_store(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    m = status_model("drop")
    _, rules, src = c.inputs(m)
    new = m.compute(rules, src).unionByName(S.status_lists(c.t["customer"]))
    return upsert_tags(c.stored(), new, mode="merge")


def store_round_trip(spark, sf_dir):
    """The store written, updated in the partitions of new tags (merge, replace, merge), and read again."""
    c = Ctx(spark, sf_dir)
    root = scratch_path(spark, "store")
    write_store(c.stored(), root)
    m = status_model("drop")
    _, rules, src = c.inputs(m)
    update_store(m.compute(rules, src), root, "merge")
    new = S.status_lists(c.t["customer"])
    update_store(new, root, "replace")
    update_store(new, root, "merge")
    return read_store(spark, root)


def model_run_job_merge(spark, sf_dir):
    """The job model end to end: taxonomy read as a table, stored tags read, merged, saved, read back."""
    c = Ctx(spark, sf_dir)
    path, root = scratch_path(spark, "taxonomy"), scratch_path(spark, "store")
    c.tax.write.parquet(path)
    write_store(c.stored(), root)
    model = ExactMatchModel(7, key_field="id", value_field="job")
    run = run_model(spark, model, read_taxonomy(spark, "parquet", path=path), store_root=root, readers=c.readers, write=True)
    return run.store


def model_run_cycle_merge(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    m = cycle_model()
    return run_model(spark, m, c.taxonomy_for(m), store=c.stored(), readers=c.readers).store


def model_run_multi(spark, sf_dir):
    """Purchase-cycle and order-status models in one slot: one store upsert.
    Lists in canonical form (the combined run orders tags differently from
    one-by-one runs; the sets are equal)."""
    c = Ctx(spark, sf_dir)
    run = run_models(spark, [cycle_model(), status_model("drop")], c.head, store=c.stored(), readers=c.readers)
    return run.store.select("userId", canonical_tags("tagsId").alias("tagsId"))


def tag_coverage_q(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    m = cycle_model()
    store = run_model(spark, m, c.taxonomy_for(m), store=c.stored(), readers=c.readers).store
    return tag_coverage(store, c.tax)


# --- sources (A2 A3) -------------------------------------------------------------------

def source_select(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    _, _, src = c.inputs(ExactMatchModel(7))
    return src


# --- taxonomy (F1 B3 B5 B9–B11 C5 C6 D4) --------------------------------------------------

def rule_map(spark, sf_dir):
    return rule_options(Ctx(spark, sf_dir).catalog())


def taxonomy_path_load(spark, sf_dir):
    return Ctx(spark, sf_dir).catalog().select("id", "name", "level", "pid")


def taxonomy_by_level(spark, sf_dir):
    return by_level(Ctx(spark, sf_dir).catalog(), 3).select("id", "name", "pid")


def taxonomy_children(spark, sf_dir):
    """Children of the root tag named ECONOMY, found by a predicate given as SQL text."""
    cat = Ctx(spark, sf_dir).catalog()
    parent = cat.where("name = 'ECONOMY' AND level = 1 AND pid = -1").select(F.col("id").alias("pid"))
    return cat.join(parent, "pid", "left_semi").select("id", "name", "level", "pid")


def tag_model_join(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    cat = c.catalog()
    path = scratch_path(spark, "models")
    S.models_registry(spark, cat).write.parquet(path)
    models = read_models(spark, "parquet", path=path)
    return tags_with_models(by_level(cat, 4), models).select("id", "name", "model_id", "model_name", "state")


# --- ingest (A6–A9 E1 H8) ----------------------------------------------------------------

def unmapped(column: str, key: F.Column) -> F.Column:
    """Value of a field without a source column: made from its name and the row key, so that a
    field that lands in another column shows; every third column is the warehouse's null."""
    return F.lit(NULL_MARK) if len(column) % 3 == 0 else F.concat(F.lit(f"{column}:"), key)


def logs_lines(events: DataFrame, arity_cases: bool = False) -> DataFrame:
    """``\\x01`` lines in the logs extract layout, one per event.

    With ``arity_cases`` each event's line takes one of eight width cases
    chosen by ``event_id mod 8`` — every event is kept as a line; the
    parser decides which lines survive.
    """
    sep = EXTRACT_SEP
    mapped = {
        "id": F.col("event_id").cast("string"),
        "log_id": F.col("event_id").cast("string"),
        "remote_ip": F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit(".1")),
        "global_user_id": F.col("user_id").cast("string"),
        "cookie_text": F.coalesce(F.col("props"), F.lit("")),
        "loc_url": F.col("event_type"),
        "log_time": F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss"),
    }
    f = [mapped.get(c, F.lit("")) for c in LOGS_COLUMNS]
    full = F.concat_ws(sep, *f)
    if not arity_cases:
        return events.select(full.alias("value"))
    short, shorter = F.concat_ws(sep, *f[:-1]), F.concat_ws(sep, *f[:-2])
    case = F.col("event_id") % 8
    line = (
        F.when(case == 0, full)
        .when(case == 1, short)                                           # one field short
        .when(case == 2, F.concat(short, F.lit(sep)))                     # last field empty
        .when(case == 3, F.concat(shorter, F.lit(sep + sep)))             # last two empty
        .when(case == 4, shorter)                                         # two fields short
        .when(case == 5, F.concat(full, F.lit(sep + "extra")))            # one field more
        .when(case == 6, F.concat(full, F.lit(sep + sep)))                # extra trailing empties
        .otherwise(F.lit(""))                                             # empty line
    )
    return events.select(line.alias("value"))


# Lines of one file of an extract: a compressed file is read by one task, so files are small.
EXTRACT_FILE_LINES = 25_000


def write_extract(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """Publish derived lines as a text extract in the shared scratch folder.

    The ingest queries then read it back with ``spark.read.text`` — the
    real scan path, in parallel over many files — instead of parsing an
    in-memory expression that the optimizer would inline into every field.
    The files are zstd: wide lines repeat much, and plain or gzip ones fill
    the disk.
    """
    path = scratch_path(spark, f"extract-{name}")
    lines.write.option("compression", ZSTD_CODEC).option("maxRecordsPerFile", EXTRACT_FILE_LINES).text(path)
    return path


def ingest_logs(spark, sf_dir):
    t = S.load_tables(spark, sf_dir, ("events",))
    return read_extract(spark, write_extract(spark, logs_lines(t["events"]), "logs"), LOGS_COLUMNS)


def ingest_arity(spark, sf_dir):
    t = S.load_tables(spark, sf_dir, ("events",))
    path = write_extract(spark, logs_lines(t["events"], arity_cases=True), "logs-arity")
    return read_extract(spark, path, LOGS_COLUMNS)


def extract_lines(df: DataFrame, columns: list[str], mapped: dict) -> DataFrame:
    """Lines in an extract layout.  The last field is never empty: a trailing run of empty
    fields would be dropped by the split and the line would fail the width test."""
    key = mapped[columns[0]]
    fields = [F.coalesce(mapped[c], F.lit("")) if c in mapped else unmapped(c, key) for c in columns]
    return df.select(F.concat_ws(EXTRACT_SEP, *fields).alias("value"))


def orders_lines(orders: DataFrame) -> DataFrame:
    """Lines in the 112-field orders extract layout."""
    return extract_lines(orders, ORDERS_COLUMNS, {
        "id": F.col("o_orderkey").cast("string"),
        "memberid": F.col("o_custkey").cast("string"),
        "orderstatus": F.col("o_orderstatus"),
        "orderamount": F.col("o_totalprice").cast("string"),
        "finishtime": F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string"),
        "remark": F.col("o_orderpriority"),
    })


def users_lines(customer: DataFrame) -> DataFrame:
    """Lines in the 38-field users extract layout."""
    key = F.col("c_custkey")
    return extract_lines(customer, USERS_COLUMNS, {
        "id": key.cast("string"),
        "username": F.col("c_name"),
        "gender": F.when(key % 2 == 0, F.lit("1")).otherwise(F.lit("2")),
        "job": F.col("c_mktsegment"),
        "birthday": F.when(key % 13 == 0, F.lit(NULL_MARK)).otherwise(F.date_format(
            F.date_add(F.lit("1940-01-01").cast("date"), ((key * F.lit(7919)) % F.lit(21915)).cast("int")), "yyyy-MM-dd"
        )),
        "money": F.col("c_acctbal").cast("string"),
        "nationality": F.col("c_nationkey").cast("string"),
    })


def goods_lines(lineitem: DataFrame) -> DataFrame:
    """Lines in the 97-field goods extract layout."""
    return extract_lines(lineitem, GOODS_COLUMNS, {
        "id": F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        "orderid": F.col("l_orderkey").cast("string"),
        "productid": F.col("l_partkey").cast("string"),
        "price": F.col("l_extendedprice").cast("string"),
        "number": F.col("l_quantity").cast("string"),
        "status": F.col("l_linestatus"),
    })


EXTRACTS = {
    "logs": ("events", logs_lines),
    "users": ("customer", users_lines),
    "orders": ("orders", orders_lines),
    "goods": ("lineitem", goods_lines),
}


def extract_rows(spark, sf_dir, kind: str) -> DataFrame:
    """All columns of one extract, written as text lines and read back."""
    table, lines = EXTRACTS[kind]
    t = S.load_tables(spark, sf_dir, (table,))
    return read_extract(spark, write_extract(spark, lines(t[table]), kind), kind)


def ingest_orders(spark, sf_dir):
    return extract_rows(spark, sf_dir, "orders")


def ingest_users(spark, sf_dir):
    return extract_rows(spark, sf_dir, "users")


def ingest_goods(spark, sf_dir):
    return extract_rows(spark, sf_dir, "goods")


def typed_users(spark, sf_dir):
    """The users extract with nulls for the warehouse's null marker and cast columns."""
    rows = extract_rows(spark, sf_dir, "users")
    return typed_view(rows, {"id": "bigint", "birthday": "date", "money": "double", "nationality": "int"})


def _published(spark, sf_dir, kind: str) -> tuple[str, str]:
    """An extract's lines, written as text and published sorted by key."""
    table, lines = EXTRACTS[kind]
    t = S.load_tables(spark, sf_dir, (table,))
    path = scratch_path(spark, f"bulk-{kind}")
    ingest(spark, write_extract(spark, lines(t[table]), kind), kind, path)
    return path, EXTRACT_COLUMNS[kind][0]


def bulk_sorted_by_key(spark, sf_dir):
    """The logs extract published sorted by key into the shared scratch folder; read back."""
    return spark.read.parquet(_published(spark, sf_dir, "logs")[0])


def _positions(kind: str):
    def query(spark, sf_dir):
        return published_positions(spark, *_published(spark, sf_dir, kind))

    query.__name__ = f"publish_{kind}"
    query.__doc__ = f"Key and file-order position of every row of the published {kind} extract."
    return query


publish_logs, publish_users, publish_orders, publish_goods = map(_positions, ("logs", "users", "orders", "goods"))


def publish_two_loads(spark, sf_dir):
    """Two loads of the logs published into one set of key ranges; every key with its file-order position.

    The first load holds all events but the purchases.  The second holds the
    purchases, and all sign-ups again with another location.
    """
    logs = S.logs_source(S.load_tables(spark, sf_dir, ("events",))["events"])
    path = scratch_path(spark, "two-loads")
    action = F.col("loc_url")
    publish(logs.where(action != "purchase"), path)
    moved = F.when(action == "signup", F.lit("signup/again")).otherwise(action)
    publish_more(logs.where(action.isin("purchase", "signup")).withColumn("loc_url", moved), path)
    return sliced_positions(spark, path, "id", "loc_url")


def wide_row_range(spark, sf_dir):
    """A key range of the published orders through the named wide-row source."""
    orders = S.orders_source(S.load_tables(spark, sf_dir, ("orders",))["orders"])
    path = scratch_path(spark, "wide-rows")
    write_sorted_by_key(orders, path)
    register_wide_rows(spark)
    rows = spark.read.format("widerow").option("path", path).option("selectFields", "id,memberId,finishTime,nope")
    rows = rows.option("keyPushdown", "true").load()  # for this query's condition alone
    return rows.where((F.col("id") >= "25") & (F.col("id") < "6") & ~F.col("memberId").startswith("7"))


# --- activity and age (D5–D7 H5 H6) ----------------------------------------------------

def activity_model() -> ActivityModel:
    return ActivityModel(45, key_field="global_user_id", time_field="log_time", action_field="loc_url", as_of=S.AS_OF_EVENTS, lookback_days=S.LOOKBACK_DAYS)


def activity_rfe(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    m = activity_model()
    _, _, src = c.inputs(m)
    return m.measures(src)


def activity_clusters(spark, sf_dir):
    """What SQL can state of the clusters of all users: each measured user has one of the ranked
    tags, and a more active rank has the higher mean activity score (in standard units)."""
    c = Ctx(spark, sf_dir)
    m = activity_model()
    _, rules, src = c.inputs(m)
    tags = m.compute(rules, src).groupBy("userId").agg(F.count("tagsId").alias("n_tags"), F.max("tagsId").alias("tag"))
    rank = F.col("tag").cast("bigint") - F.lit(m.tag_id + 1)
    zero = {"engagement": 0.0}
    scored = m.measures(src).na.fill(zero).join(tags, "userId", "left").withColumn("rank", rank)
    stats = scored.agg(*[f(x).alias(f"{n}_{x}") for x in ("recency", "frequency", "engagement") for n, f in (("m", F.avg), ("s", F.stddev))])

    def z(x):
        return (F.col(x) - F.col(f"m_{x}")) / F.when(F.col(f"s_{x}") > 0, F.col(f"s_{x}")).otherwise(F.lit(1.0))

    means = scored.join(F.broadcast(stats)).groupBy("rank").agg(F.avg(z("frequency") + z("engagement") - z("recency")).alias("score"))
    by_rank = means.agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("r"))  # one row per rank
    ordered = F.size(F.filter(F.col("r"), lambda x, i: (i > 0) & (x["score"] > F.col("r")[F.greatest(i - 1, F.lit(0))]["score"]))) == 0
    return scored.join(F.broadcast(by_rank.select(ordered.alias("ranks_ordered")))).select(
        "userId", F.coalesce("n_tags", F.lit(0)).cast("bigint").alias("n_tags"), F.col("rank").between(0, m.k - 1).alias("ranked"), "ranks_ordered"
    )


SLOTS = 7  # consecutive dates of the incremental measures, the last one that of the others


def activity_rfe_incremental(spark, sf_dir):
    """R/F/E of seven dates in sequence: each from the state before, the entering and the leaving day."""
    m = activity_model()
    _, _, src = Ctx(spark, sf_dir).inputs(m)
    days = write_days(day_partials(src, m.key_field, m.time_field, m.action_field), scratch_path(spark, "days"))
    partials = spark.read.parquet(days)
    dates = [dt.date.fromisoformat(S.AS_OF_EVENTS) - dt.timedelta(days=k) for k in reversed(range(SLOTS))]
    state, out = None, None
    for date in dates:
        state = first_state(partials, date, m.lookback_days) if state is None else advance(state, partials, date, m.lookback_days)
        path = scratch_path(spark, "rfe-state")
        state.write.parquet(path)  # what the next slot reads
        state = spark.read.parquet(path)
        measured = state_measures(state, date).select(F.lit(date).alias("as_of"), "*")
        out = measured if out is None else out.unionByName(measured)
    return out


HOUR_RULES = [(91, "0-5"), (92, "6-11"), (93, "12-17"), (94, "18-23")]  # fixed values: bands of the day


def _angle(t: pa.Array) -> np.ndarray:
    """Angle of the time of day of ``yyyy-MM-dd HH:mm:ss`` texts; others are no time."""
    ts = pc.strptime(t, format="%Y-%m-%d %H:%M:%S", unit="s", error_is_null=True)
    seconds = pc.fill_null(ts.cast(pa.int64()).cast(pa.float64()), np.nan)
    return np.asarray(seconds) % 86_400 * (2 * np.pi / 86_400)


def _hour_x(t: pa.Array) -> pa.Array:
    return pa.array(np.cos(_angle(t)), from_pandas=True)


def _hour_y(t: pa.Array) -> pa.Array:
    return pa.array(np.sin(_angle(t)), from_pandas=True)


def _hour_of(x: pa.Array, y: pa.Array) -> pa.Array:
    x, y = (np.asarray(a.cast(pa.float64()).to_numpy(zero_copy_only=False)) for a in (x, y))
    hours = np.round(np.arctan2(y, x) * (12 / np.pi) % 24, 6) % 24
    return pa.array(np.floor(hours), from_pandas=True).cast(pa.int64())


def typical_hour() -> SumAggregate:
    """The hour of the circular mean of a user's times of day."""
    return SumAggregate({"x": _hour_x, "y": _hour_y}, _hour_of, "bigint", ["log_time"])


def visit_hour_tags(spark, sf_dir):
    """A tag model with a user's own aggregate: the typical hour of a user's visits, by bands of the day."""
    _, _, src = Ctx(spark, sf_dir).inputs(activity_model())
    rules = spark.createDataFrame(HOUR_RULES, "id long, rule string")
    m = UserFunctionModel(90, key_field="global_user_id", aggregate=typical_hour())
    return m.compute_detail(rules, src)


def activity_segments(spark, sf_dir):
    """Every user's segment by a stored model: fitted a week before, read back, refined, with the centre it is nearest to."""
    m = activity_model()
    _, _, src = Ctx(spark, sf_dir).inputs(m)
    before = (dt.date.fromisoformat(S.AS_OF_EVENTS) - dt.timedelta(days=7)).isoformat()
    first = fit_segments(dataclasses.replace(m, as_of=before).measures(src), m.k)
    stored = read_segments(spark, write_segments(spark, first, scratch_path(spark, "segments")))
    now = m.measures(src)
    model = fit_segments(now, start=stored)
    return assign(now, model).join(F.broadcast(centres(spark, model)), "rank").select(
        "userId", "rank", "c_recency", "c_frequency", "c_engagement"
    )


def audience_sets_q(spark, sf_dir):
    """Users per tag and per pair of tags from sets of two days: the stored tags, and a day's status tags."""
    c = Ctx(spark, sf_dir)
    m = status_model("drop")
    _, rules, src = c.inputs(m)
    root = scratch_path(spark, "audience")
    for day, store in (("1", c.stored()), ("2", m.compute(rules, src))):
        audience_sets(store).write.parquet(f"{root}/day={day}")
    sets = materialize(merge_sets(spark.read.parquet(root)))
    single = users_per_tag(sets).select(F.col("tag").cast("string").alias("audience"), "users")
    others = c.tax.where(F.col("pid").isin(7, 30)).select(F.col("id").alias("b"))  # jobs and states
    pairs = others.select("b", F.explode(F.array(F.lit(5), F.lit(6))).alias("a"))  # with each gender
    named = pairs.select(F.concat_ws("+", "a", "b").alias("audience"), F.explode(F.array(F.col("a").cast("bigint"), "b")).alias("tag"))
    return single.unionByName(users_per_audience(sets, named))


def category_users(spark, sf_dir):
    """Buyers of every tag of the catalog taxonomy, those of all its descendants included."""
    c = Ctx(spark, sf_dir)
    catalog = materialize(c.catalog())
    paths = tree_paths(catalog)
    of_part = c.t["part"].select("p_partkey", "p_type", "p_name", "p_brand")
    words = F.split("p_name", " ")
    names = F.array("p_type", F.get(words, F.lit(0)), F.get(words, F.lit(1)), "p_brand")
    # a path ends before a blank
    end = F.array_position(F.transform(names, lambda x: F.coalesce(x == "", F.lit(True))), True)
    path = F.when(end > 0, F.slice(names, F.lit(1), end - 1)).otherwise(names)
    tagged = of_part.select("p_partkey", path.alias("path")).join(paths.select("path", F.col("id").alias("tag")), "path")
    side, _ = maybe_broadcast(tagged.select(F.col("p_partkey").alias("l_partkey"), "tag"))
    bought = c.t["lineitem"].select("l_orderkey", "l_partkey").join(side, "l_partkey").select("l_orderkey", "tag").distinct()
    buyers = c.t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("userId"))
    users = users_per_category(bought.join(buyers, "l_orderkey"), paths)
    return users.join(catalog.select("id", "name", "level"), "id").select("id", "name", "level", "users")


def ingest_outcomes(spark, sf_dir):
    """Lines of a logs extract by what becomes of them: observed while they were written, and as written."""
    t = S.load_tables(spark, sf_dir, ("events",))
    dest = scratch_path(spark, "observed")
    seen = ingest_observed(spark, write_extract(spark, logs_lines(t["events"], arity_cases=True), "logs-observed"), "logs", dest)
    observed = spark.createDataFrame(sorted(seen.items()), "outcome string, observed long")
    written = spark.read.parquet(dest).groupBy("outcome").agg(F.count(F.lit(1)).alias("written"))
    return observed.join(written, "outcome", "left").select("outcome", "observed", F.coalesce("written", F.lit(0)).cast("bigint").alias("written"))


def age_band_tags(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    m = AgeRangeModel(14, key_field="id", birthday_field="birthday", as_of=S.AS_OF_ORDERS)
    _, rules, src = c.inputs(m)
    return m.compute_detail(rules, src)


QUERIES = {
    "cycle_tags": cycle_tags,
    "last_purchase": last_purchase,
    "recency_days": recency_days,
    "gender_tags": gender_tags,
    "job_tags": job_tags,
    "job_tags_sql": job_tags_sql,
    "job_tags_sql_fn": job_tags_sql_fn,
    "merge_tags_sql": merge_tags_sql,
    "status_tags_null": status_tags_null,
    "status_tags_drop": status_tags_drop,
    "distinct_user_tags": distinct_user_tags,
    "merge_tags": merge_tags_q,
    "replace_tags": replace_tags,
    "upsert_store": upsert_store,
    "store_round_trip": store_round_trip,
    "model_run_job_merge": model_run_job_merge,
    "model_run_cycle_merge": model_run_cycle_merge,
    "model_run_multi": model_run_multi,
    "tag_coverage": tag_coverage_q,
    "source_select": source_select,
    "rule_map": rule_map,
    "taxonomy_path_load": taxonomy_path_load,
    "taxonomy_by_level": taxonomy_by_level,
    "taxonomy_children": taxonomy_children,
    "tag_model_join": tag_model_join,
    "ingest_logs": ingest_logs,
    "ingest_arity": ingest_arity,
    "ingest_orders": ingest_orders,
    "ingest_users": ingest_users,
    "ingest_goods": ingest_goods,
    "typed_users": typed_users,
    "bulk_sorted_by_key": bulk_sorted_by_key,
    "publish_logs": publish_logs,
    "publish_users": publish_users,
    "publish_orders": publish_orders,
    "publish_goods": publish_goods,
    "publish_two_loads": publish_two_loads,
    "wide_row_range": wide_row_range,
    "ingest_outcomes": ingest_outcomes,
    "category_users": category_users,
    "audience_sets": audience_sets_q,
    "activity_rfe": activity_rfe,
    "activity_segments": activity_segments,
    "activity_rfe_incremental": activity_rfe_incremental,
    "visit_hour_tags": visit_hour_tags,
    "age_band_tags": age_band_tags,
    "activity_clusters": activity_clusters,
}
