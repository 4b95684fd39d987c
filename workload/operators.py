"""Queries for projections, joins, aggregation, reshaping, spines and functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import (
    completion_rate,
    date_prefix,
    int_from_text,
    json_value,
    last_char_as_int,
    safe_cast,
    snake_key,
    surrogate_key,
    trunc_date,
)
from tidemark.operators import (
    child_counts,
    empty_relation,
    gap_fill,
    gap_fill_by,
    interval_overlaps,
    json_array_rows,
    latest_per_key,
    frequent_keys,
    left_join_hot_right,
    spread_join,
    union_all,
    union_by_name,
    unpivot_flags,
)
from tidemark.operators.measures import (
    Dimension,
    Entity,
    Measure,
    SemanticModel,
    distinct_sketches,
    measure,
    rolled_up,
)
from tidemark.operators.spine import spine_between
from workload.registry import query
from workload.standins import given

# --- projections and filters -------------------------------------------------


@query(
    "stage_projection",
    """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
           CAST(o_orderdate AS DATE) AS ordered_on, o_orderpriority AS priority
    FROM orders
    """,
)
def stage_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("ordered_on"),
        F.col("o_orderpriority").alias("priority"),
    )


@query(
    "filter_predicates",
    """
    SELECT event_id, event_type, user_id FROM events
    WHERE nullif(user_id, 3) IS NOT NULL AND value > 10
      AND event_type NOT IN ('error', 'signup')
    """,
)
def filter_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events").withColumn("is_large", F.col("value") > 10)
    kept = events.filter(
        F.nullif(F.col("user_id"), F.lit(3)).isNotNull()
        & F.col("is_large")
        & ~F.col("event_type").isin("error", "signup")
    )
    return kept.select("event_id", "event_type", "user_id")


@query(
    "flag_in_list",
    "SELECT event_id, event_type IN ('purchase', 'signup') AS is_conversion FROM events",
)
def flag_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("event_type").isin("purchase", "signup")
    return given(spark, sf_dir, "events").select("event_id", flag.alias("is_conversion"))


@query(
    "threshold_flags",
    """
    SELECT event_id, coalesce(v, 0) >= 50 AS reached, v <= 80 AS below
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events)
    """,
)
def threshold_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing value counts as 0 for one flag and stays unknown for the other."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return given(spark, sf_dir, "events").select(
        "event_id",
        (F.coalesce(value, F.lit(0)) >= 50).alias("reached"),
        (value <= 80).alias("below"),
    )


# --- unions ------------------------------------------------------------------


@query(
    "tagged_union",
    """
    SELECT o_orderkey AS id, 'ORDER' AS kind, o_orderdate AS at FROM orders
    UNION ALL SELECT l_orderkey, 'LINE', l_shipdate FROM lineitem
    UNION ALL SELECT event_id, 'EVENT', ts FROM events
    """,
)
def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def branch(table: str, key: str, kind: str, at: str) -> DataFrame:
        return given(spark, sf_dir, table).select(
            F.col(key).alias("id"), F.lit(kind).alias("kind"), F.col(at).alias("at")
        )

    return union_all(
        branch("orders", "o_orderkey", "ORDER", "o_orderdate"),
        branch("lineitem", "l_orderkey", "LINE", "l_shipdate"),
        branch("events", "event_id", "EVENT", "ts"),
    )


@query(
    "union_by_name",
    """
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment
    FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier
    """,
)
def by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another order, and one the second branch lacks."""
    customers = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = given(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"),
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
    )
    return union_by_name(customers, suppliers, fill_missing=True)


@query(
    "empty_typed",
    """
    SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS DOUBLE) AS score,
           CAST(NULL AS DATE) AS noted_on, 0::BIGINT AS n_notes
    FROM events
    """,
)
def empty_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty relation stands in for a table that is not loaded yet: joined and counted."""
    absent = empty_relation(spark, "event_id bigint, note string, score double, noted_on date")
    events = given(spark, sf_dir, "events").select("event_id", "event_type")
    counted = child_counts(events, absent.withColumn("note_id", F.col("event_id")), "event_id", "note_id", "n_notes")
    return counted.join(absent, "event_id", "left").select(
        "event_id", "event_type", "note", "score", "noted_on", "n_notes"
    )


# --- joins -------------------------------------------------------------------


@query(
    "denormalised_bridge",
    """
    SELECT md5(CAST(o.o_orderkey AS VARCHAR) || '-'
               || coalesce(CAST(p.p_partkey AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS key,
           o.o_orderkey, o.o_orderpriority, p.p_partkey, p.p_brand, s.s_name
    FROM orders o
    LEFT JOIN (SELECT l_orderkey, CASE WHEN l_quantity > 20 THEN l_partkey END AS l_partkey
               FROM lineitem) l ON l.l_orderkey = o.o_orderkey
    LEFT JOIN (SELECT CASE WHEN p_size < 40 THEN p_partkey ELSE -p_partkey END AS p_partkey,
                      p_brand, p_size FROM part) p ON p.p_partkey = l.l_partkey
    LEFT JOIN (SELECT CASE WHEN s_acctbal > 0 THEN s_suppkey ELSE -s_suppkey END AS s_suppkey,
                      s_name FROM supplier) s ON s.s_suppkey = p.p_size
    """,
)
def denormalised_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order, its lines, the known parts among them, the part's supplier.

    All rows go through; lines without a part and keys nobody refers to are made here.
    """
    supplier = F.when(F.col("s_acctbal") > 0, F.col("s_suppkey")).otherwise(-F.col("s_suppkey"))
    suppliers = given(spark, sf_dir, "supplier").select(supplier.cast("int").alias("p_size"), "s_name")
    part = F.when(F.col("p_size") < 40, F.col("p_partkey")).otherwise(-F.col("p_partkey"))
    parts = given(spark, sf_dir, "part").withColumn("p_partkey", part)
    sizes = frequent_keys(parts, ["p_size"])[0]
    parts = spread_join(parts, suppliers, ["p_size"], frequent=sizes).select("p_partkey", "p_brand", "s_name")
    bought = F.when(F.col("l_quantity") > 20, F.col("l_partkey"))
    links = given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), bought.alias("l_partkey")
    )
    known = parts.withColumn("l_partkey", F.col("p_partkey"))
    parts_often, orders_large = frequent_keys(links, ["l_partkey"], ["o_orderkey"])
    widened = spread_join(links, known, ["l_partkey"], frequent=parts_often).drop("l_partkey")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    joined = left_join_hot_right(orders, widened, ["o_orderkey"], orders_large)
    key = surrogate_key("o_orderkey", "p_partkey").alias("key")
    return joined.select(key, "o_orderkey", "o_orderpriority", "p_partkey", "p_brand", "s_name")


@query(
    "classify_by_fanout",
    """
    SELECT o.o_orderkey, count(l.l_partkey) AS n_lines,
           CASE WHEN count(l.l_partkey) = 1 THEN 'single' ELSE 'group' END AS kind
    FROM orders o
    LEFT JOIN (SELECT l_orderkey, CASE WHEN l_linenumber < 4 THEN l_partkey END AS l_partkey
               FROM lineitem) l ON l.l_orderkey = o.o_orderkey
    GROUP BY o.o_orderkey
    """,
)
def classify_by_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders").select("o_orderkey")
    lines = given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_linenumber") < 4, F.col("l_partkey")).alias("l_partkey"),
    )
    counted = child_counts(orders, lines, "o_orderkey", "l_partkey", "n_lines")
    kind = F.when(F.col("n_lines") == 1, "single").otherwise("group")
    return counted.withColumn("kind", kind)


# --- aggregation -------------------------------------------------------------


@query(
    "daily_total_goal",
    """
    SELECT CAST(l_shipdate AS DATE) AS day, CAST(sum(q) AS BIGINT) AS total, sum(q) >= 700 AS met
    FROM (SELECT l_shipdate, CASE WHEN l_discount = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS q
          FROM lineitem)
    GROUP BY 1
    """,
)
def daily_total_goal(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.when(F.col("l_discount") != 0, F.col("l_quantity").cast("bigint"))
    daily = (
        given(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("day"))
        .agg(F.sum(F.coalesce(quantity, F.lit(0))).alias("total"))
    )
    return daily.withColumn("met", F.col("total") >= 700)


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and week, with how many of them were complete."""
    events = given(spark, sf_dir, "events").select(
        "event_type", "ts", (F.col("value") >= 50).alias("is_complete")
    )
    return events.groupBy("event_type", trunc_date("week", "ts").alias("period_start")).agg(
        F.count("*").alias("total_periods"),
        F.sum(F.when(F.col("is_complete"), 1).otherwise(0)).alias("completed_periods"),
    )


_WEEKLY_SQL = """
    SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS period_start,
           count(*) AS total_periods,
           CAST(sum(CASE WHEN value >= 50 THEN 1 ELSE 0 END) AS BIGINT) AS completed_periods
    FROM events GROUP BY 1, 2
"""


@query("weekly_completion", _WEEKLY_SQL)
def weekly_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(spark, sf_dir)


@query(
    "count_vs_threshold",
    """
    SELECT e.user_id, e.week, e.n,
           CASE WHEN e.n >= coalesce(nullif(c.c_nationkey % 6, 0), 1) THEN 1 ELSE 0 END AS reached
    FROM (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week,
                 count(*) FILTER (WHERE event_type IN ('purchase', 'view')) AS n
          FROM events GROUP BY 1, 2) e
    LEFT JOIN customer c ON c.c_custkey = e.user_id
    """,
)
def count_vs_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events")
    counts = events.groupBy("user_id", trunc_date("week", "ts").alias("week")).agg(
        F.count_if(F.col("event_type").isin("purchase", "view")).alias("n")
    )
    goals = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.nullif(F.col("c_nationkey") % 6, F.lit(0)).alias("threshold"),
    )
    reached = F.when(F.col("n") >= F.coalesce("threshold", F.lit(1)), 1).otherwise(0)
    joined = counts.join(goals, "user_id", "left")
    return joined.select("user_id", "week", "n", reached.alias("reached"))


@query(
    "metrics_vs_target",
    f"""
    WITH weekly AS ({_WEEKLY_SQL}),
    targets AS (
        SELECT CASE r_regionkey WHEN 0 THEN 'view' WHEN 1 THEN 'click' WHEN 2 THEN 'purchase'
                    WHEN 3 THEN 'signup' END AS event_type,
               r_name AS target_name, CAST(r_regionkey * 10 + 30 AS DOUBLE) / 100 AS target_pct
        FROM region)
    SELECT w.event_type, w.period_start, w.total_periods, w.completed_periods,
           round(CAST(w.completed_periods AS DOUBLE) / nullif(w.total_periods, 0), 4)
               AS completion_rate,
           t.target_name, t.target_pct,
           round(CAST(w.completed_periods AS DOUBLE) / nullif(w.total_periods, 0), 4)
               >= t.target_pct AS target_met
    FROM weekly w LEFT JOIN targets t ON t.event_type = w.event_type
    """,
)
def metrics_vs_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly completion rate of each event type against a target; one type has none.

    The targets come from the regions: one row per region, five event types.
    """
    kinds = F.create_map(
        *[F.lit(x) for pair in enumerate(("view", "click", "purchase", "signup")) for x in pair]
    )
    targets = given(spark, sf_dir, "region").select(
        F.try_element_at(kinds, F.col("r_regionkey")).alias("event_type"),
        F.col("r_name").alias("target_name"),
        ((F.col("r_regionkey") * 10 + 30).cast("double") / 100).alias("target_pct"),
    )
    rated = _weekly(spark, sf_dir).withColumn(
        "completion_rate", completion_rate("completed_periods", "total_periods")
    )
    met = F.col("completion_rate") >= F.col("target_pct")
    return rated.join(targets, "event_type", "left").withColumn("target_met", met)



# --- measures ----------------------------------------------------------------

EVENT_MODEL = SemanticModel(
    name="events",
    entities=(Entity("event", "event_id", primary=True), Entity("customer", "user_id")),
    dimensions=(
        Dimension("day", "ts", is_time=True),
        Dimension("kind", "event_type"),
        Dimension("size", "case when value >= 50 then 'large' else 'small' end"),
    ),
    measures=(
        Measure("n_large", "sum", "if(value >= 50, 1, 0)"),
        Measure("n_events", "count", "nullif(event_type, 'error')"),
        Measure("share_large", "average", "if(value >= 50, 1D, 0D)"),
        Measure("n_users", "count_distinct", "user_id"),
        Measure("n_large_users", "count_distinct", "user_id", where="value >= 50"),
        Measure("n_small_users", "count_distinct", "user_id", where="not value >= 50"),
        Measure("n_props", "count_distinct", "props"),
    ),
)
CUSTOMER_MODEL = SemanticModel(
    name="customers",
    entities=(Entity("customer", "c_custkey", primary=True),),
    dimensions=(Dimension("segment", "c_mktsegment"),),
)


@query(
    "measure_sum",
    """
    SELECT CAST(ts AS DATE) AS day,
           CAST(sum(CASE WHEN value >= 50 THEN 1 ELSE 0 END) AS BIGINT) AS n_large
    FROM events GROUP BY 1
    """,
)
def measure_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(EVENT_MODEL, given(spark, sf_dir, "events"), ["n_large"], ["day"])


@query(
    "measure_count",
    """
    SELECT CASE WHEN value >= 50 THEN 'large' ELSE 'small' END AS size,
           count(nullif(event_type, 'error')) AS n_events
    FROM events GROUP BY 1
    """,
)
def measure_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(EVENT_MODEL, given(spark, sf_dir, "events"), ["n_events"], ["size"])


@query(
    "measure_average",
    """
    SELECT event_type AS kind, round(avg(CASE WHEN value >= 50 THEN 1.0 ELSE 0.0 END), 9)
        AS share_large
    FROM events GROUP BY 1
    """,
)
def measure_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = measure(EVENT_MODEL, given(spark, sf_dir, "events"), ["share_large"], ["kind"])
    return share.withColumn("share_large", F.round("share_large", 9))


@query(
    "measure_count_distinct",
    """
    SELECT event_type AS kind, count(DISTINCT user_id) AS n_users,
           count(DISTINCT CASE WHEN value >= 50 THEN user_id END) AS n_large_users,
           count(DISTINCT CASE WHEN NOT value >= 50 THEN user_id END) AS n_small_users,
           count(DISTINCT props) AS n_props
    FROM events GROUP BY 1
    """,
)
def measure_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["n_users", "n_large_users", "n_small_users", "n_props"]
    return measure(EVENT_MODEL, given(spark, sf_dir, "events"), names, ["kind"])


@query(
    "measure_distinct_sketched",
    """
    WITH grains AS (
        SELECT 'week' AS grain, CAST(date_trunc('week', ts) AS DATE) AS period_start, event_type AS kind, user_id, value FROM events
        UNION ALL
        SELECT 'month', CAST(date_trunc('month', ts) AS DATE), event_type, user_id, value FROM events)
    SELECT grain, period_start, kind, count(DISTINCT user_id) AS n_users,
           count(DISTINCT CASE WHEN value >= 50 THEN user_id END) AS n_large_users,
           true AS users_close, true AS large_users_close
    FROM grains GROUP BY ALL
    """,
)
def measure_distinct_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct users per week and month beside those rolled up from daily sketches: within 5 %?"""
    events = given(spark, sf_dir, "events")
    names = ["n_users", "n_large_users"]
    sketches = distinct_sketches(EVENT_MODEL, events, names, "day", ["kind"])
    parts = []
    for grain in ("week", "month"):
        at = f"day__{grain}"
        exact = measure(EVENT_MODEL, events, names, [at, "kind"]).alias("e")
        about = rolled_up(sketches, names, "day", grain, ["kind"]).alias("s")
        same = F.col(f"e.{at}").eqNullSafe(F.col(f"s.{at}")) & F.col("e.kind").eqNullSafe(F.col("s.kind"))
        close = [
            (F.abs(F.col(f"s.{n}") - F.col(f"e.{n}")) <= 0.05 * F.col(f"e.{n}")).alias(f"{n.removeprefix('n_')}_close")
            for n in names
        ]
        parts.append(
            exact.join(about, same).select(
                F.lit(grain).alias("grain"), F.col(f"e.{at}").alias("period_start"), "e.kind", *[f"e.{n}" for n in names], *close
            )
        )
    return union_all(*parts)


@query(
    "measure_by_dimension",
    """
    SELECT e.event_type AS kind, CAST(date_trunc('week', e.ts) AS DATE) AS day__week,
           c.c_mktsegment AS customer__segment,
           CAST(sum(CASE WHEN e.value >= 50 THEN 1 ELSE 0 END) AS BIGINT) AS n_large,
           count(nullif(e.event_type, 'error')) AS n_events,
           round(avg(CASE WHEN e.value >= 50 THEN 1.0 ELSE 0.0 END), 9) AS share_large
    FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
    GROUP BY 1, 2, 3
    """,
)
def measure_by_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    related = {"customer": (CUSTOMER_MODEL, given(spark, sf_dir, "customer"))}
    result = measure(
        EVENT_MODEL,
        given(spark, sf_dir, "events"),
        ["n_large", "n_events", "share_large"],
        ["kind", "day__week", "customer__segment"],
        related,
    )
    return result.withColumn("share_large", F.round("share_large", 9))


@query(
    "measure_distinct_by_related",
    """
    SELECT c.c_mktsegment AS customer__segment, count(DISTINCT e.user_id) AS n_users,
           count(DISTINCT CASE WHEN e.value >= 50 THEN e.user_id END) AS n_large_users
    FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
    GROUP BY 1
    """,
)
def measure_distinct_by_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    related = {"customer": (CUSTOMER_MODEL, given(spark, sf_dir, "customer"))}
    names = ["n_users", "n_large_users"]
    events = given(spark, sf_dir, "events")
    return measure(EVENT_MODEL, events, names, ["customer__segment"], related)


# --- windows -----------------------------------------------------------------


@query(
    "dedupe_latest",
    """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC) = 1
    """,
)
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def overlap_sql(partition: str, entity: str, source: str) -> str:
    """Neighbouring logs that overlap, copies of a log counted together."""
    return f"""
    SELECT {entity} started, ended, min(following) AS next_start, count(*) AS n_overlaps
    FROM (SELECT *, lead(started) OVER ({partition} ORDER BY started, ended) AS following
          FROM ({source}))
    WHERE ended > following
    GROUP BY {entity} started, ended
    """


_INTERVALS_SQL = """
    SELECT user_id, epoch_us(ts) // 1000 AS started,
           epoch_us(ts) // 1000 + 100000 * CAST(floor(value) AS BIGINT) AS ended
    FROM events
"""


@query(
    "interval_overlap",
    overlap_sql("PARTITION BY user_id", "user_id,", _INTERVALS_SQL),
)
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    intervals = given(spark, sf_dir, "events").select(
        "user_id",
        ms.alias("started"),
        (ms + F.floor("value") * 100_000).alias("ended"),
    )
    return interval_overlaps(intervals, "started", "ended", ["user_id"])


_SHIPMENTS_SQL = """
    SELECT l_shipdate AS started,
           l_shipdate + INTERVAL '1' HOUR * CAST(l_quantity AS INT) AS ended
    FROM lineitem
"""


@query("interval_overlap_all", overlap_sql("", "", _SHIPMENTS_SQL))
def interval_overlap_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No entity, many logs with one start: the whole table is one sequence."""
    hours = F.expr("l_shipdate + interval '1' hour * cast(l_quantity as int)")
    logs = given(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("started"), hours.alias("ended")
    )
    return interval_overlaps(logs, "started", "ended")


# --- reshape -----------------------------------------------------------------


@query(
    "unpivot_flags",
    """
    SELECT event_id, flag, is_set FROM (
        SELECT event_id, value > 50 AS large, event_type = 'purchase' AS bought,
               CASE WHEN user_id % 2 = 0 THEN value < 10 END AS tiny,
               CASE WHEN event_type <> 'error' THEN user_id > 40 END AS late_user
        FROM events)
    UNPIVOT (is_set FOR flag IN (large, bought, tiny, late_user))
    """,
)
def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = given(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value") > 50).alias("large"),
        (F.col("event_type") == "purchase").alias("bought"),
        F.when(F.col("user_id") % 2 == 0, F.col("value") < 10).alias("tiny"),
        F.when(F.col("event_type") != "error", F.col("user_id") > 40).alias("late_user"),
    )
    flags = ["large", "bought", "tiny", "late_user"]
    return unpivot_flags(wide, ["event_id"], flags, "flag", "is_set")


@query(
    "json_array_unnest",
    """
    SELECT event_id, unnest([event_type, CAST(user_id AS VARCHAR)]) AS item
    FROM events WHERE event_type <> 'error'
    """,
)
def json_array_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(
        F.lit('["'), "event_type", F.lit('",'), F.col("user_id").cast("string"), F.lit("]")
    )
    items = F.when(F.col("event_type") == "error", "[]").otherwise(text)
    events = given(spark, sf_dir, "events").select("event_id", items.alias("items"))
    return json_array_rows(events, "items", "item").drop("items")


# --- spines ------------------------------------------------------------------


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = given(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("stop"),
    )
    return spine_between(bounds, "first", "stop")


@query(
    "date_spine",
    """
    SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY,
                                       INTERVAL 1 DAY)) AS DATE) AS date_day
    FROM orders
    """,
)
def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_days(spark, sf_dir)


@query(
    "gap_filled_daily",
    """
    WITH days AS (
        SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY,
                                           INTERVAL 1 DAY)) AS DATE) AS date_day
        FROM orders),
    daily AS (
        SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
                    THEN CAST(o_orderdate AS DATE) END AS date_day,
               count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
        FROM orders GROUP BY 1)
    SELECT date_day, coalesce(n_orders, 0) AS n_orders, coalesce(n_customers, 0) AS n_customers
    FROM days LEFT JOIN daily USING (date_day)
    """,
)
def gap_filled_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    urgent = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    daily = (
        orders.groupBy(F.when(urgent, F.col("o_orderdate").cast("date")).alias("day"))
        .agg(
            F.count("*").alias("n_orders"),
            F.countDistinct("o_custkey").alias("n_customers"),
        )
    )
    return gap_fill(_order_days(spark, sf_dir), daily, "day", ["n_orders", "n_customers"])


@query(
    "gap_filled_by_dimension",
    """
    WITH daily AS (
        SELECT nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day,
               count(*) AS n_orders
        FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL),
    days AS (
        SELECT priority, status, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS date_day
        FROM daily GROUP BY priority, status)
    SELECT d.priority, d.status, d.date_day, coalesce(v.n_orders, 0) AS n_orders
    FROM days d LEFT JOIN daily v
      ON v.priority IS NOT DISTINCT FROM d.priority AND v.status = d.status AND v.day = d.date_day
    """,
)
def gap_filled_by_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under way per day, for each priority (one of them null) and status."""
    orders = given(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    daily = orders.groupBy(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("day"),
    ).agg(F.count("*").alias("n_orders"))
    return gap_fill_by(daily, "day", ["priority", "status"], ["n_orders"])


# --- scalar functions ----------------------------------------------------------


@query(
    "surrogate_key",
    """
    SELECT o_orderkey, o_custkey,
           md5(CAST(o_orderkey AS VARCHAR) || '-'
               || coalesce(CAST(nullif(o_orderstatus, 'P') AS VARCHAR),
                           '_dbt_utils_surrogate_key_null_')
               || '-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-order') AS row_key
    FROM orders
    """,
)
def key(spark: SparkSession, sf_dir: str) -> DataFrame:
    row_key = surrogate_key(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")),
        F.col("o_orderdate").cast("date"),
        F.lit("order"),
    )
    return given(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", row_key.alias("row_key")
    )


@query(
    "safe_cast_tier",
    """
    SELECT p_partkey, TRY_CAST(right(p_brand, 1) AS INTEGER) AS tier,
           TRY_CAST(p_type AS INTEGER) AS type_number,
           CAST(round(TRY_CAST(CAST(p_size AS VARCHAR) || '.0' AS DOUBLE)) AS INTEGER) AS size
    FROM part
    """,
)
def safe_cast_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    size_text = F.concat(F.col("p_size").cast("string"), F.lit(".0"))
    return given(spark, sf_dir, "part").select(
        "p_partkey",
        last_char_as_int("p_brand").alias("tier"),
        safe_cast("p_type", "int").alias("type_number"),
        int_from_text(size_text).alias("size"),
    )


@query(
    "json_extract",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_number,
           json_extract_string(props, '$.missing') AS missing
    FROM events
    """,
)
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = json_value("props", "$.k")
    missing = json_value("props", "$.missing")
    return given(spark, sf_dir, "events").select(
        "event_id", k.alias("k"), int_from_text(k).alias("k_number"), missing.alias("missing")
    )


@query(
    "date_prefix",
    """
    SELECT event_id, CAST(ts AS DATE) AS day,
           CAST(NULL AS DATE) AS broken
    FROM events
    """,
)
def prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date as written, whatever zone the rest of the text names."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-11:00"))
    return given(spark, sf_dir, "events").select(
        "event_id", date_prefix(text).alias("day"), date_prefix("event_type").alias("broken")
    )


@query(
    "week_trunc",
    """
    SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter,
           CAST(date_trunc('year', o_orderdate) AS DATE) AS year
    FROM orders
    """,
)
def week_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ("week", "month", "quarter", "year")
    return given(spark, sf_dir, "orders").select(
        "o_orderkey", *[trunc_date(p, "o_orderdate").alias(p) for p in parts]
    )


@query(
    "derived_key_case",
    """
    SELECT p_partkey,
           CASE WHEN p_type = 'ECONOMY' THEN 'did_' || lower(replace(p_name, ' ', '_'))
                WHEN p_name LIKE 'red%'
                    THEN 'met_' || lower(replace(replace(p_name, 'red ', ''), ' ', '_'))
                ELSE lower(replace(nullif(p_name, 'small ring'), ' ', '_')) END AS part_key
    FROM part
    """,
)
def derived_key_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    part_key = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("did_"), snake_key(name)))
        .when(
            name.startswith("red"),
            F.concat(F.lit("met_"), snake_key(F.replace(name, F.lit("red "), F.lit("")))),
        )
        .otherwise(snake_key(F.nullif(name, F.lit("small ring"))))
    )
    return given(spark, sf_dir, "part").select("p_partkey", part_key.alias("part_key"))
