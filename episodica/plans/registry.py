"""Every operator as a query on the given tables, next to plain DuckDB SQL for the same result.

Roles of the given tables: a person's id is a customer, the natural key is (market segment, nation) with one segment
read as "no name"; an attendance is an order, its problem rows are the line items, part and supplier are their code
dimensions, and priority '4-NOT SPECIFIED' is the "not informed" sentinel. The SQL is written row by row (windows,
correlated subqueries); the Spark side uses the operators.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica import operators as ops
from episodica.functions import (
    Dating,
    age_at_first_contact,
    as_midnight,
    days_between,
    in_codes,
    join_text,
    known,
    lookback,
    prefer_known,
    starts_with_any,
    whole_weeks,
    yes_no,
)
from episodica.plans.worklist import Rule, worklist
from episodica.plans.worklist_oracle import worklist_sql
from episodica.session import scratch_root
from episodica.sources.order_tables import OrderTables, health_tables

AS_OF = datetime.date(2001, 8, 1)
TODAY = f"DATE '{AS_OF}'"
UNKNOWN = "4-NOT SPECIFIED"
NO_NAME = "MACHINERY"
RULE = Dating()

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str


REGISTRY: dict[str, Query] = {}


def query(sql: str):
    """Register a function of the given tables under its name, with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        REGISTRY[build.__name__] = Query(lambda spark, folder: build(OrderTables(spark, folder)), sql)
        return build

    return register


def today():
    return F.lit(AS_OF)


def attendances(t: Tables) -> DataFrame:
    """Orders with their date and the reported, possibly unknown start."""
    return t["orders"].withColumns(
        {
            "seen": F.col("o_orderdate").cast("date"),
            "reported_start": F.expr(
                f"CASE WHEN o_orderpriority = '{UNKNOWN}' THEN DATE '3000-12-31'"
                " ELSE date_sub(CAST(o_orderdate AS DATE), CAST(o_orderkey % 300 - 20 AS INT)) END"
            ),
            "weeks": F.expr("CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderkey % 40 AS INT) END"),
        }
    )


SQL_ATTENDANCES = f"""(SELECT *, CAST(o_orderdate AS DATE) AS seen,
    CASE WHEN o_orderpriority = '{UNKNOWN}' THEN DATE '3000-12-31'
         ELSE CAST(o_orderdate AS DATE) - CAST(o_orderkey % 300 - 20 AS INTEGER) END AS reported_start,
    CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderkey % 40 AS INTEGER) END AS weeks FROM orders)"""


def people(t: Tables) -> DataFrame:
    return t["customer"].select(
        "c_custkey", known(F.col("c_mktsegment"), NO_NAME).alias("person_name"), F.col("c_nationkey").alias("birth_key")
    )


SQL_PEOPLE = f"""(SELECT c_custkey, nullif(c_mktsegment, '{NO_NAME}') AS person_name, c_nationkey AS birth_key
    FROM customer)"""

PERSON = ["person_name", "birth_key"]


def attended(t: Tables) -> DataFrame:
    """Attendances with the natural key of their person."""
    return ops.lookup(attendances(t), people(t), "o_custkey", "c_custkey", {c: c for c in PERSON}, "inner")


SQL_ATTENDED = f"(SELECT * FROM {SQL_ATTENDANCES} o JOIN {SQL_PEOPLE} p ON p.c_custkey = o.o_custkey)"


# ---------------------------------------------------------------- scans, projections, predicates


@query(
    "SELECT o_orderkey AS attendance_id, o_custkey AS citizen_id, CAST(o_orderdate AS DATE) AS seen,"
    " o_orderpriority AS kind FROM orders"
)
def scan_project(t):
    return t["orders"].select(
        F.col("o_orderkey").alias("attendance_id"),
        F.col("o_custkey").alias("citizen_id"),
        F.col("o_orderdate").cast("date").alias("seen"),
        F.col("o_orderpriority").alias("kind"),
    )


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#2%'")
def prefix_filter(t):
    return t["part"].where(starts_with_any(F.col("p_brand"), ["Brand#2"])).select("p_partkey", "p_brand")


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#25%'")
def like_any_filter(t):
    return t["part"].where(starts_with_any(F.col("p_brand"), ["Brand#1", "Brand#25"])).select("p_partkey", "p_brand")


@query("SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'SMALL')")
def in_list_filter(t):
    return t["part"].where(in_codes("p_type", ["PROMO", "SMALL"])).select("p_partkey", "p_type")


@query(
    f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS seen FROM orders"
    f" WHERE CAST(o_orderdate AS DATE) >= {TODAY} - 294"
)
def lookback_filter(t):
    # On the stored timestamp, so that the scan can use its statistics.
    recent = t["orders"].where(lookback(F.col("o_orderdate"), today(), 294))
    return recent.select("o_orderkey", F.col("o_orderdate").cast("date").alias("seen"))


# ---------------------------------------------------------------- joins


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, p_type FROM lineitem"
    " JOIN part ON p_partkey = l_partkey WHERE p_brand LIKE 'Brand#1%'"
)
def star_inner(t):
    parts = t["part"].where(starts_with_any(F.col("p_brand"), ["Brand#1"]))
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey")
    return ops.lookup(lines, parts, "l_partkey", "p_partkey", {"p_type": "p_type"}, "inner")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, CAST(o_orderdate AS DATE) AS seen"
    " FROM lineitem JOIN orders ON o_orderkey = l_orderkey"
)
def fact_fact_inner(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey")
    found = {"o_custkey": "o_custkey", "o_orderdate": "o_orderdate"}
    joined = ops.lookup(lines, t["orders"], "l_orderkey", "o_orderkey", found, "inner")
    return joined.withColumn("seen", F.col("o_orderdate").cast("date")).drop("o_orderdate")


@query("""
SELECT l_orderkey, l_linenumber, p_brand, s_name FROM lineitem
LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) p ON p_partkey = l_partkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) s ON s_suppkey = l_suppkey""")
def left_dim_chain(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    small, solvent = t["part"].where("p_size <= 25"), t["supplier"].where("s_acctbal >= 0")
    lines = ops.lookup(lines, small, "l_partkey", "p_partkey", {"p_brand": "p_brand"})
    lines = ops.lookup(lines, solvent, "l_suppkey", "s_suppkey", {"s_name": "s_name"})
    return lines.drop("l_partkey", "l_suppkey")


def listed_lines(t: Tables, brands: list[str], nations: list[int]) -> DataFrame:
    """Line items whose part is of a listed brand or whose supplier is in a listed nation."""
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    by_part = t["part"].where(in_codes("p_brand", brands)).withColumn("hit", F.lit(True))
    by_supplier = t["supplier"].where(F.col("s_nationkey").isin(nations)).withColumn("hit", F.lit(True))
    lines = ops.lookup(lines, by_part, "l_partkey", "p_partkey", {"by_part": "hit"})
    lines = ops.lookup(lines, by_supplier, "l_suppkey", "s_suppkey", {"by_supplier": "hit"})
    return lines.where(F.col("by_part") | F.col("by_supplier"))


def sql_listed(brands: list[str], nations: list[int]) -> str:
    return f"""lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
    WHERE (p_brand IN ({", ".join(repr(b) for b in brands)}) OR s_nationkey IN ({", ".join(map(str, nations))}))"""


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {sql_listed(['Brand#3', 'Brand#14'], [1, 3])}")
def or_over_left_dims(t):
    lines = listed_lines(t, ["Brand#3", "Brand#14"], [1, 3])
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""
SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS line_count FROM lineitem
JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey
JOIN nation cn ON cn.n_nationkey = c_nationkey JOIN nation sn ON sn.n_nationkey = s_nationkey GROUP BY 1, 2""")
def role_playing_dim(t):
    # Orders meet customers first, so the line items shuffle once; the names join the counts, not the lines.
    nation = t["nation"]
    orders = t["orders"].select("o_orderkey", "o_custkey")
    orders = ops.lookup(orders, t["customer"], "o_custkey", "c_custkey", {"customer_key": "c_nationkey"}, "inner")
    lines = t["lineitem"].select("l_orderkey", "l_suppkey")
    lines = ops.lookup(lines, t["supplier"], "l_suppkey", "s_suppkey", {"supplier_key": "s_nationkey"}, "inner")
    lines = ops.lookup(lines, orders, "l_orderkey", "o_orderkey", {"customer_key": "customer_key"}, "inner")
    counts = lines.groupBy("customer_key", "supplier_key").agg(F.count("*").alias("line_count"))
    for role in ("customer", "supplier"):
        named = {f"{role}_nation": "n_name"}
        counts = ops.lookup(counts, nation, f"{role}_key", "n_nationkey", named, "inner").drop(f"{role}_key")
    return counts.groupBy("customer_nation", "supplier_nation").agg(F.sum("line_count").alias("line_count"))


@query(f"""
SELECT DISTINCT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS seen FROM orders
JOIN (SELECT l_orderkey FROM {sql_listed(['Brand#3', 'Brand#14'], [1, 3])}) l ON l_orderkey = o_orderkey""")
def fanout_semi(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("seen"))
    return ops.with_child(orders, listed_lines(t, ["Brand#3", "Brand#14"], [1, 3]), "o_orderkey", "l_orderkey")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS shipped FROM lineitem")
def distinct_rows(t):
    shipped = F.col("l_shipdate").cast("date").alias("shipped")
    return t["lineitem"].select("l_suppkey", "l_returnflag", "l_linestatus", shipped).distinct()


# ---------------------------------------------------------------- scalar expressions


@query(f"""
SELECT o_orderkey, reported_start, CASE WHEN reported_start <> DATE '3000-12-31' THEN reported_start END AS known_start,
    CAST(CASE WHEN year(reported_start) <> 3000 THEN year(reported_start) END AS INTEGER) AS start_year
FROM {SQL_ATTENDANCES} o""")
def sentinel_date(t):
    start = F.col("reported_start")
    return attendances(t).select(
        "o_orderkey",
        "reported_start",
        F.when(RULE.is_known(start), start).alias("known_start"),
        F.when(F.year(start) != 3000, F.year(start)).alias("start_year"),
    )


@query("""
SELECT o_orderkey, CAST(o_orderdate + INTERVAL 36 HOUR AS DATE) AS floored, CAST(o_orderkey AS VARCHAR) AS key_text,
    CAST(o_orderkey % 1000 AS INTEGER) AS key_int, CAST(o_custkey AS DOUBLE) AS key_double,
    CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS midnight FROM orders""")
def date_cast(t):
    return t["orders"].select(
        "o_orderkey",
        F.expr("CAST(o_orderdate + INTERVAL 36 HOURS AS DATE)").alias("floored"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        (F.col("o_orderkey") % 1000).cast("int").alias("key_int"),
        F.col("o_custkey").cast("double").alias("key_double"),
        as_midnight(F.col("o_orderdate").cast("date")).alias("midnight"),
    )


SQL_DATED = f"""(SELECT *, CASE WHEN year(reported_start) <> 3000 THEN reported_start
        WHEN weeks IS NOT NULL THEN seen - 7 * weeks END AS start_date FROM {SQL_ATTENDANCES} a)"""


def dated(t: Tables) -> DataFrame:
    reported = F.col("reported_start")
    start = RULE.start(reported, F.year(reported), F.col("seen"), F.col("weeks"))
    return attendances(t).withColumn("start_date", start)


@query(f"""
SELECT o_orderkey, start_date,
    CASE WHEN year(reported_start) <> 3000 THEN reported_start + INTERVAL 294 DAY
         WHEN weeks IS NOT NULL THEN seen - to_days(7 * weeks) + INTERVAL 294 DAY END AS due,
    CAST(CASE WHEN year(reported_start) <> 3000 THEN ({TODAY} - reported_start) // 7
         WHEN weeks IS NOT NULL THEN ({TODAY} - (seen - 7 * weeks)) // 7 END AS INTEGER) AS age
FROM {SQL_DATED} d""")
def due_date_case(t):
    start = F.col("start_date")
    return dated(t).select(
        "o_orderkey", "start_date", RULE.due(start).alias("due"), RULE.age(start, today()).alias("age")
    )


@query(f"""
SELECT o_orderkey, CAST((seen - reported_start) // 7 AS INTEGER) AS weeks_before,
    CAST((DATE '1998-04-10' - seen) // 7 AS INTEGER) AS weeks_to_fixed FROM {SQL_ATTENDANCES} o""")
def weeks_elapsed(t):
    return attendances(t).select(
        "o_orderkey",
        whole_weeks(F.col("seen"), F.col("reported_start")).alias("weeks_before"),
        whole_weeks(F.lit(datetime.date(1998, 4, 10)), F.col("seen")).alias("weeks_to_fixed"),
    )


@query(f"SELECT o_orderkey, CAST(start_date + 294 - {TODAY} AS INTEGER) AS days_to_due FROM {SQL_DATED} d")
def days_until(t):
    due = RULE.due(F.col("start_date")).cast("date")
    return dated(t).select("o_orderkey", days_between(due, today()).alias("days_to_due"))


@query(f"""
SELECT o_orderkey, CAST(CASE WHEN year(reported_start) <> 3000 THEN (seen - reported_start) // 7
    WHEN weeks IS NOT NULL THEN weeks END AS INTEGER) AS first_age FROM {SQL_ATTENDANCES} o""")
def age_at_first(t):
    age = age_at_first_contact(F.col("reported_start"), F.col("seen"), F.col("weeks"), RULE)
    return attendances(t).select("o_orderkey", age.alias("first_age"))


@query("SELECT p_partkey, upper(concat('São ', p_name)) AS name FROM part")
def upper_text(t):
    return t["part"].select("p_partkey", F.upper(F.concat(F.lit("São "), "p_name")).alias("name"))


@query("""
SELECT p_partkey, concat(nullif(p_type, 'PROMO'), ', ', CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END) AS raw,
    nullif(concat(nullif(p_type, 'PROMO'), ', ', CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END), ', ')
        AS address
FROM part""")
def null_safe_concat(t):
    text = join_text(known(F.col("p_type"), "PROMO"), F.when(F.col("p_size") > 10, F.col("p_size").cast("string")))
    return t["part"].select("p_partkey", text.alias("raw"), known(text, ", ").alias("address"))


@query(f"""
SELECT o_orderkey, nullif(o_orderpriority, '{UNKNOWN}') AS known_priority,
    coalesce(nullif(o_orderpriority, '{UNKNOWN}'), o_orderstatus) AS priority_or_status FROM orders""")
def sentinel_coalesce(t):
    priority = F.col("o_orderpriority")
    return t["orders"].select(
        "o_orderkey",
        known(priority, UNKNOWN).alias("known_priority"),
        prefer_known(priority, UNKNOWN, F.col("o_orderstatus")).alias("priority_or_status"),
    )


@query(f"""
SELECT o_orderkey, CASE WHEN (weeks > 20) IS TRUE THEN 'Sim' ELSE 'Não' END AS late,
    (weeks > 20) IS TRUE AS is_late FROM {SQL_ATTENDANCES} o""")
def flag_label(t):
    late = F.col("weeks") > 20
    return attendances(t).select(
        "o_orderkey", yes_no(late).alias("late"), F.coalesce(late, F.lit(False)).alias("is_late")
    )


@query(f"""
SELECT o_orderkey, (weeks > 20) AND (o_totalprice > 200000) AS both_true FROM {SQL_ATTENDANCES} o""")
def flag_and(t):
    return attendances(t).select(
        "o_orderkey", ((F.col("weeks") > 20) & (F.col("o_totalprice") > 200000)).alias("both_true")
    )


# ---------------------------------------------------------------- per-person summaries on every row


@query(f"SELECT o_orderkey, count(*) OVER (PARTITION BY person_name, birth_key) AS contacts FROM {SQL_ATTENDED} a")
def window_count(t):
    return ops.attach(attended(t), PERSON, {"contacts": F.count("*")}).select("o_orderkey", "contacts")


@query(f"""
SELECT o_orderkey, max(seen) OVER (PARTITION BY person_name, birth_key) AS last_seen,
    CAST({TODAY} - max(seen) OVER (PARTITION BY person_name, birth_key) AS INTEGER) AS days_since
FROM {SQL_ATTENDED} a""")
def window_max_days_since(t):
    rows = ops.attach(attended(t), PERSON, {"last_seen": F.max("seen")})
    return rows.select("o_orderkey", "last_seen", days_between(today(), F.col("last_seen")).alias("days_since"))


def sql_first_so_far(value: str, condition: str, by: str, order: str, tie: str) -> str:
    return f"""(array_agg({value} ORDER BY {order}, {tie}) FILTER (WHERE {condition})
        OVER (PARTITION BY {by} ORDER BY {order} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))[1]"""


@query(f"""
SELECT o_orderkey, {sql_first_so_far('weeks', 'weeks IS NOT NULL', 'person_name, birth_key', 'seen', 'o_orderkey')}
    AS first_weeks,
    {sql_first_so_far('price', 'price IS NOT NULL', 'person_name, birth_key', 'seen', 'o_orderkey')} AS first_urgent
FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS price FROM {SQL_ATTENDED} a) b""")
def first_non_null(t):
    rows = attended(t).withColumn("price", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")))
    values = {
        "first_weeks": ("weeks", "weeks IS NOT NULL"),
        "first_urgent": ("price", "price IS NOT NULL"),
    }
    found = ops.attach_first_so_far(rows, PERSON, "seen", "o_orderkey", values)
    return found.select("o_orderkey", "first_weeks", "first_urgent")


@query(f"""
SELECT event_id, {sql_first_so_far('value', "event_type = 'purchase'", 'user_id', 'ts', 'event_id')}
    AS first_purchase FROM events""")
def first_non_null_events(t):
    values = {"first_purchase": ("value", "event_type = 'purchase'")}
    found = ops.attach_first_so_far(t["events"], ["user_id"], "ts", "event_id", values)
    return found.select("event_id", "first_purchase")


@query(f"""
SELECT o_orderkey, {sql_first_so_far('reported_start', "reported_start <> DATE '3000-12-31'",
    'person_name, birth_key', 'seen', 'o_orderkey')} AS first_start FROM {SQL_ATTENDED} a""")
def first_non_sentinel(t):
    values = {"first_start": ("reported_start", "reported_start <> DATE '3000-12-31'")}
    found = ops.attach_first_so_far(attended(t), PERSON, "seen", "o_orderkey", values)
    return found.select("o_orderkey", "first_start")


@query(f"""
SELECT o_orderkey, min(seen) FILTER (WHERE weeks IS NOT NULL) OVER (PARTITION BY person_name, birth_key)
    AS first_dated FROM {SQL_ATTENDED} a""")
def conditional_min(t):
    first = F.min(F.when(F.col("weeks").isNotNull(), F.col("seen")))
    return ops.attach(attended(t), PERSON, {"first_dated": first}).select("o_orderkey", "first_dated")


# ---------------------------------------------------------------- top-1, identity, latest


@query(f"""
SELECT person_name, birth_key, o_orderkey, o_custkey, seen, o_totalprice, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY person_name, birth_key ORDER BY seen DESC, o_orderkey DESC) AS r
    FROM {SQL_ATTENDED} a) b WHERE r = 1""")
def top1_per_entity(t):
    # The text comes from the row that was found; only numbers and dates take part in the aggregate.
    latest = ops.latest_by(attended(t), PERSON, "seen", "o_orderkey", ["o_orderkey", "o_custkey", "seen", "o_totalprice"])
    return ops.lookup(latest, t["orders"], "o_orderkey", "o_orderkey", {"o_orderpriority": "o_orderpriority"}, "inner")


@query(f"""
SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey IN (
    SELECT same.c_custkey FROM {SQL_PEOPLE} same
    WHERE same.person_name = p.person_name AND same.birth_key = p.birth_key)) AS person_orders
FROM {SQL_PEOPLE} p""")
def identity_expand(t):
    ids = people(t)
    per_id, merged = {"n": F.count("*")}, {"person_orders": F.sum("n")}
    persons = ops.merge_ids(t["orders"], "o_custkey", ids, "c_custkey", PERSON, per_id, merged)
    matched = ops.members_of(ids, "c_custkey", PERSON, persons, ["person_orders"])
    counted = ids.select("c_custkey").join(matched, "c_custkey", "left")
    return counted.select("c_custkey", F.coalesce("person_orders", F.lit(0)).cast("bigint").alias("person_orders"))


SQL_UNTIMED = "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL ELSE seen END"


@query(f"""
SELECT c_custkey, o_orderkey AS latest_order, {SQL_UNTIMED} AS latest_seen, o_orderpriority FROM customer c
LEFT JOIN {SQL_ATTENDANCES} l ON l.o_orderkey = (
    SELECT o.o_orderkey FROM {SQL_ATTENDANCES} o WHERE o.o_custkey = c.c_custkey
    ORDER BY {SQL_UNTIMED} DESC NULLS FIRST, o.o_orderkey DESC LIMIT 1)""")
def latest_per_entity(t):
    untimed = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    rows = attendances(t).select(
        "o_custkey", F.col("o_orderkey").alias("latest_order"), F.when(~untimed, F.col("seen")).alias("latest_seen")
    )
    latest = ops.latest_by(rows, ["o_custkey"], "latest_seen", "latest_order", ["latest_order", "latest_seen"])
    named = {"o_orderpriority": "o_orderpriority"}
    latest = ops.lookup(latest, t["orders"], "latest_order", "o_orderkey", named, "inner")
    customers = t["customer"].select("c_custkey")
    return customers.join(latest, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")


@query("""
SELECT p_partkey, o_orderkey AS latest_order, CAST(o_orderdate AS DATE) AS latest_seen, o_custkey FROM part p
LEFT JOIN orders l ON l.o_orderkey = (
    SELECT o.o_orderkey FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey WHERE l_partkey = p.p_partkey
    ORDER BY o.o_orderdate DESC, o.o_orderkey DESC LIMIT 1)""")
def latest_via_bridge(t):
    # Keys are made once per order, before the bridge repeats it; the rest of the row is looked up for the winners.
    keyed = ops.with_order_key(t["orders"].select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")
    bridge = t["lineitem"].select("l_partkey", "l_orderkey")
    linked = ops.lookup(bridge, keyed, "l_orderkey", "o_orderkey", {c: c for c in keyed.columns}, "inner")
    best = linked.groupBy("l_partkey").agg(ops.best_of(linked, "_order_key", ["o_orderkey"]).alias("best"))
    latest = best.selectExpr("l_partkey", "best.o_orderkey AS latest_order")
    columns = {"latest_seen": "o_orderdate", "o_custkey": "o_custkey"}
    latest = ops.lookup(latest, t["orders"], "latest_order", "o_orderkey", columns, "inner")
    parts = t["part"].select("p_partkey").join(latest, F.col("p_partkey") == F.col("l_partkey"), "left")
    return parts.withColumn("latest_seen", F.col("latest_seen").cast("date")).drop("l_partkey")


def newest_of_person(condition: str) -> str:
    return f"""(SELECT o.o_orderkey FROM {SQL_ATTENDANCES} o WHERE {condition} AND o.o_custkey IN (
        SELECT same.c_custkey FROM {SQL_PEOPLE} same
        WHERE same.person_name = p.person_name AND same.birth_key = p.birth_key)
        ORDER BY o.seen DESC NULLS FIRST, o.o_orderkey DESC LIMIT 1)"""


@query(f"""
SELECT c_custkey, coalesce(nullif(rn.n_name, 'NATION_3'), an.n_name) AS unit,
    coalesce(vs.s_name, rs.s_name) AS worker, v.seen AS last_visit,
    nullif(concat(nullif(r.o_orderstatus, 'P'), ', ', nullif(r.o_orderpriority, '5-LOW')), ', ') AS address
FROM {SQL_PEOPLE} p
LEFT JOIN {SQL_ATTENDANCES} r ON r.o_orderkey = {newest_of_person("o.o_orderpriority IN ('3-MEDIUM', '5-LOW')")}
LEFT JOIN {SQL_ATTENDANCES} v ON v.o_orderkey = {newest_of_person("o.o_orderpriority = '1-URGENT'")}
LEFT JOIN {SQL_ATTENDANCES} a ON a.o_orderkey = {newest_of_person("true")}
LEFT JOIN nation rn ON rn.n_nationkey = r.o_custkey % 26 LEFT JOIN nation an ON an.n_nationkey = a.o_custkey % 25
LEFT JOIN supplier rs ON rs.s_suppkey = r.o_orderkey % 12 LEFT JOIN supplier vs ON vs.s_suppkey = v.o_orderkey % 15""")
def responsible_lookup(t):
    ids = people(t)
    kinds = {
        "registration": "o_orderpriority IN ('3-MEDIUM', '5-LOW')",
        "visit": "o_orderpriority = '1-URGENT'",
        "attendance": "true",
    }
    keep = ["o_orderkey", "o_custkey", "seen"]
    rows = ops.with_order_key(attendances(t), "seen", "o_orderkey")
    per_id = {kind: ops.best_of(rows, "_order_key", keep, where) for kind, where in kinds.items()}
    merged = {kind: ops.best_again(kind, keep) for kind in kinds}
    latest = ops.merge_ids(rows, "o_custkey", ids, "c_custkey", PERSON, per_id, merged)
    latest = latest.select(
        *PERSON,
        F.col("registration.o_orderkey").alias("registered"),
        (F.col("registration.o_custkey") % 26).alias("registration_unit"),
        (F.col("attendance.o_custkey") % 25).alias("attendance_unit"),
        (F.col("registration.o_orderkey") % 12).alias("registration_worker"),
        (F.col("visit.o_orderkey") % 15).alias("visit_worker"),
        F.col("visit.seen").alias("last_visit"),
    )
    texts = {"status": "o_orderstatus", "priority": "o_orderpriority"}
    latest = ops.lookup(latest, t["orders"], "registered", "o_orderkey", texts)
    address = known(join_text(known(F.col("status"), "P"), known(F.col("priority"), "5-LOW")), ", ")
    latest = latest.withColumn("address", address)
    for kind in ("registration", "attendance"):
        latest = ops.lookup(latest, t["nation"], f"{kind}_unit", "n_nationkey", {f"{kind}_unit_name": "n_name"})
    for kind in ("registration", "visit"):
        latest = ops.lookup(latest, t["supplier"], f"{kind}_worker", "s_suppkey", {f"{kind}_worker_name": "s_name"})
    latest = latest.select(
        *PERSON,
        prefer_known(F.col("registration_unit_name"), "NATION_3", F.col("attendance_unit_name")).alias("unit"),
        F.coalesce("visit_worker_name", "registration_worker_name").alias("worker"),
        "last_visit",
        "address",
    )
    found = ["unit", "worker", "last_visit", "address"]
    matched = ops.members_of(ids, "c_custkey", PERSON, latest, found)
    return ids.select("c_custkey").join(matched, "c_custkey", "left")


# ---------------------------------------------------------------- interval flags


def contacts(t: Tables, lines: DataFrame, bits: Column) -> DataFrame:
    """Every order, repeated for each day on which line items of it were shipped that set a bit: the day and its bits.

    Line items shrink to one row per order and day before they meet the orders, which are read once, for the start of the
    episode and for the events.
    """
    events = (
        lines.select("l_orderkey", F.col("l_shipdate").cast("date").alias("day"), bits.alias("bits"))
        .where("bits <> 0").groupBy("l_orderkey", "day").agg(F.bit_or("bits").alias("bits"))
    )
    orders = t["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("start"))
    return orders.join(events, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def due() -> Column:
    return RULE.due(F.col("start"))


SQL_PERSONS = f"""(SELECT person_name, birth_key, max(o_orderkey) AS case_id, min(seen) AS start,
    min(seen) + INTERVAL 294 DAY AS due FROM {SQL_ATTENDED} a GROUP BY 1, 2)"""


@query(f"""
SELECT person_name, birth_key, start, due, (SELECT count(*) > 0 FROM lineitem JOIN part ON p_partkey = l_partkey
    JOIN orders ON o_orderkey = l_orderkey
    WHERE o_custkey IN (SELECT same.c_custkey FROM {SQL_PEOPLE} same
        WHERE same.person_name = p.person_name AND same.birth_key = p.birth_key)
      AND l_returnflag = 'R' AND p_brand LIKE 'Brand#25%' AND l_shipdate >= p.start AND l_shipdate <= p.due) AS seen_in
FROM {SQL_PERSONS} p""")
def flag_interval_exists(t):
    parts = t["part"].where(starts_with_any(F.col("p_brand"), ["Brand#25"]))
    lines = t["lineitem"].where("l_returnflag = 'R'").select("l_orderkey", "l_partkey", "l_shipdate")
    lines = ops.lookup(lines, parts, "l_partkey", "p_partkey", {}, "inner")
    rows = contacts(t, lines, F.lit(1))
    rows = ops.lookup(rows, people(t), "o_custkey", "c_custkey", {c: c for c in PERSON}, "inner")
    # Rows without a name form one case, but match no events.
    named = F.col("person_name").isNotNull() & F.col("birth_key").isNotNull()
    rows = rows.withColumns({c: F.when(named, F.col(c)) for c in ("day", "bits")})
    return ops.flags_in_one_pass(rows, PERSON, {"start": "min"}, due(), "start", ["seen_in"])


SQL_CUSTOMERS = f"""(SELECT o_custkey, min(seen) AS start, min(seen) + INTERVAL 294 DAY AS due
    FROM {SQL_ATTENDANCES} a GROUP BY 1)"""


@query(f"""
SELECT o_custkey, start, due, (SELECT count(*) > 0 FROM (
    SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders o ON o.o_orderkey = l_orderkey
    WHERE o.o_custkey = c.o_custkey AND l_returnflag = 'R' AND p_type = 'PROMO' AND l_shipdate BETWEEN c.start AND c.due
    UNION ALL
    SELECT l_orderkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders o ON o.o_orderkey = l_orderkey
    WHERE o.o_custkey = c.o_custkey AND l_returnflag = 'A' AND s_nationkey = 3 AND l_shipdate BETWEEN c.start AND c.due
    ) u) AS tested FROM {SQL_CUSTOMERS} c""")
def flag_union_branches(t):
    # The branches of the union are conditions on one pass over the line items.
    lines = t["lineitem"].where("l_returnflag IN ('R', 'A')")
    promo = t["part"].where("p_type = 'PROMO'").withColumn("hit", F.lit(True))
    near = t["supplier"].where("s_nationkey = 3").withColumn("hit", F.lit(True))
    lines = ops.lookup(lines, promo, "l_partkey", "p_partkey", {"promo": "hit"})
    lines = ops.lookup(lines, near, "l_suppkey", "s_suppkey", {"near": "hit"})
    tested = F.expr("(l_returnflag = 'R' AND promo) OR (l_returnflag = 'A' AND near)")
    rows = contacts(t, lines, ops.flag_bits({"tested": tested}))
    return ops.flags_in_one_pass(rows, ["o_custkey"], {"start": "min"}, due(), "start", ["tested"])


def sql_recorded(brands: list[str], nations: list[int]) -> str:
    return f"""(SELECT count(*) > 0 FROM orders o JOIN (SELECT * FROM {sql_listed(brands, nations)}) l
        ON l.l_orderkey = o.o_orderkey WHERE o.o_custkey = c.o_custkey AND l.l_shipdate BETWEEN c.start AND c.due)"""


@query(f"""
SELECT o_custkey, start, due, {sql_recorded(['Brand#3'], [2])} AS loss, {sql_recorded(['Brand#14', 'Brand#9'], [7])}
    AS birth FROM {SQL_CUSTOMERS} c""")
def flag_or_codes(t):
    listed = {"loss": (["Brand#3"], [2]), "birth": (["Brand#14", "Brand#9"], [7])}
    by_part = {flag: in_codes("p_brand", brands) for flag, (brands, _) in listed.items()}
    by_supplier = {flag: F.col("s_nationkey").isin(nations) for flag, (_, nations) in listed.items()}
    parts = t["part"].withColumn("bits", ops.flag_bits(by_part)).where("bits <> 0")
    suppliers = t["supplier"].withColumn("bits", ops.flag_bits(by_supplier)).where("bits <> 0")
    lines = ops.lookup(t["lineitem"], parts, "l_partkey", "p_partkey", {"by_part": "bits"})
    lines = ops.lookup(lines, suppliers, "l_suppkey", "s_suppkey", {"by_supplier": "bits"})
    either = F.coalesce("by_part", F.lit(0)).bitwiseOR(F.coalesce("by_supplier", F.lit(0)))
    rows = contacts(t, lines, either)
    return ops.flags_in_one_pass(rows, ["o_custkey"], {"start": "min"}, due(), "start", list(listed))


# ---------------------------------------------------------------- sink and end to end


@query(f"""
SELECT person_name, birth_key, count(*) AS contacts, max(seen) AS last_seen FROM {SQL_ATTENDED} a GROUP BY 1, 2""")
def snapshot_table(t):
    per_id = {"contacts": F.count("*"), "last_seen": F.max("seen")}
    merged = {"contacts": F.sum("contacts"), "last_seen": F.max("last_seen")}
    persons = ops.merge_ids(attendances(t), "o_custkey", people(t), "c_custkey", PERSON, per_id, merged)
    folder = f"{scratch_root(persons.sparkSession)}/episodica-snapshots"
    return ops.write_snapshot(persons, "episodica_persons", "built_at", location=folder).drop("built_at")


def _worklist(spark: SparkSession, folder: str) -> DataFrame:
    return worklist(spark, health_tables(spark, folder), Rule(AS_OF)).drop("criacao_data")


REGISTRY["age_at_first_contact"] = REGISTRY.pop("age_at_first")
REGISTRY["episode_active_search"] = Query(_worklist, worklist_sql(AS_OF))
