"""Hierarchies and exclusion cascades.

Orders serve as trips: the parent of an order is the order numbered like its customer, which gives
deep chains and cycles. Customers are routes, orders their stops, lines the stop activities and
parts the transported goods.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.catalog.registry import query, table
from tidegate.operators.exclusion import exclude_routes, exclude_routes_and_trips, exclude_trips
from tidegate.operators.hierarchy import descendants


def _closure(name: str, seeds: str, nodes: str) -> str:
    return (
        f"{name}(id) AS ({seeds} UNION SELECT n.id FROM ({nodes}) n JOIN {name} ON n.parent = {name}.id)"
    )


CUSTOMERS = "SELECT c_custkey AS id, c_custkey // 3 AS parent FROM customer"
CUSTOMER_SEEDS = (
    "SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING' "
    "AND n_regionkey = 0 AND c_acctbal < 0"
)


@query(f"WITH RECURSIVE {_closure('d', CUSTOMER_SEEDS, CUSTOMERS)} SELECT id FROM d")
def hierarchy_closure(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 0)
    nodes = customers.select(F.col("c_custkey").alias("id"), F.expr("c_custkey DIV 3").alias("parent"))
    seeds = customers.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 0))
    seeds = seeds.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    return descendants(nodes, seeds.select(F.col("c_custkey").alias("id")), "id", "parent")


TRIPS = "SELECT o_orderkey AS id, o_custkey AS parent FROM orders"


@query(
    f"WITH RECURSIVE {_closure('d', 'SELECT o_orderkey FROM orders WHERE o_totalprice > 499000', TRIPS)} SELECT id FROM d"
)
def hierarchy_closure_cycles(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    nodes = orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("parent"))
    seeds = orders.where(F.col("o_totalprice") > 499000).select(F.col("o_orderkey").alias("id"))
    return descendants(nodes, seeds, "id", "parent")


@query(
    "WITH RECURSIVE e AS (SELECT l_orderkey AS id, l_suppkey AS parent FROM lineitem), d(id) AS "
    "(SELECT DISTINCT l_orderkey FROM lineitem WHERE l_extendedprice > 99000 "
    "UNION SELECT e.id FROM e JOIN d ON e.parent = d.id) SELECT id FROM d"
)
def hierarchy_closure_many_parents(spark, sf_dir):
    """Every line links its order below the order numbered like the line's supplier."""
    lines = table(spark, sf_dir, "lineitem")
    nodes = lines.select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("parent"))
    seeds = lines.where(F.col("l_extendedprice") > 99000).select(F.col("l_orderkey").alias("id"))
    return descendants(nodes, seeds, "id", "parent")


def _sources(spark, sf_dir) -> dict[str, DataFrame]:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    goods = F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("TO_ID")
    on_route = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("ROUTE_ID")
    return {
        "route": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ROUTE_ID")),
        "route_stop": orders.select(F.col("o_orderkey").alias("RS_ID"), F.col("o_custkey").alias("ROUTE_ID")),
        "route_stop_activity": lines.select(F.col("l_orderkey").alias("RS_ID"), goods, F.col("l_linenumber").alias("n")),
        "transportation_order": table(spark, sf_dir, "part").select(F.col("p_partkey").alias("TO_ID")),
        "transportation_order_line": lines.select(goods, F.col("l_orderkey").alias("n")),
        "trip": orders.select(
            F.col("o_orderkey").alias("TRIP_ID"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("PARENT_TRIP_ID"),
            on_route,
            F.col("o_orderpriority").alias("TRIP_CD"),
        ),
        "trip_activity": lines.select(F.col("l_orderkey").alias("TRIP_ID"), F.col("l_linenumber").alias("n")),
        "trip_stop": lines.select(F.col("l_suppkey").alias("TS_ID"), F.col("l_orderkey").alias("TRIP_ID")),
        "trip_stop_activity": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("TS_ID"), F.lit(1).alias("n")),
        "trip_stop_delay": lines.select(F.col("l_suppkey").alias("TS_ID"), F.col("l_linenumber").alias("n")),
    }


# Which column of a role identifies the surviving rows in the result.
SHOWN = {
    "route": "ROUTE_ID",
    "route_stop": "RS_ID",
    "route_stop_activity": "RS_ID",
    "transportation_order": "TO_ID",
    "transportation_order_line": "TO_ID",
    "trip": "TRIP_ID",
    "trip_activity": "TRIP_ID",
    "trip_stop": "TRIP_ID",
    "trip_stop_activity": "TS_ID",
    "trip_stop_delay": "TS_ID",
}


def _survivors(kept: dict[str, DataFrame]) -> DataFrame:
    frames = [df.select(F.lit(role).alias("role"), F.col(SHOWN[role]).alias("id")) for role, df in kept.items()]
    return reduce(DataFrame.unionByName, frames)


RELATIONS = {
    "route": "SELECT c_custkey AS ROUTE_ID FROM customer",
    "route_stop": "SELECT o_orderkey AS RS_ID, o_custkey AS ROUTE_ID FROM orders",
    "route_stop_activity": "SELECT l_orderkey AS RS_ID, CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS TO_ID FROM lineitem",
    "transportation_order": "SELECT p_partkey AS TO_ID FROM part",
    "transportation_order_line": "SELECT CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS TO_ID FROM lineitem",
    "trip": "SELECT o_orderkey AS TRIP_ID, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS PARENT_TRIP_ID, CASE WHEN "
    "o_orderpriority <> '5-LOW' THEN o_custkey END AS ROUTE_ID, o_orderpriority AS TRIP_CD, o_totalprice AS price FROM orders",
    "trip_activity": "SELECT l_orderkey AS TRIP_ID FROM lineitem",
    "trip_stop": "SELECT l_suppkey AS TS_ID, l_orderkey AS TRIP_ID FROM lineitem",
    "trip_stop_activity": "SELECT s_suppkey AS TS_ID FROM supplier",
    "trip_stop_delay": "SELECT l_suppkey AS TS_ID FROM lineitem",
}
RELATIONS_SQL = ", ".join(f"{role} AS ({sql})" for role, sql in RELATIONS.items())
TRIP_NODES = "SELECT TRIP_ID AS id, PARENT_TRIP_ID AS parent FROM trip"
ROUTE_SETS = (
    "x_route AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal < -980), "
    "x_route_stop AS (SELECT RS_ID AS id FROM route_stop WHERE ROUTE_ID IN (SELECT id FROM x_route)), "
    "x_order AS (SELECT TO_ID AS id FROM route_stop_activity WHERE TO_ID IS NOT NULL AND RS_ID IN (SELECT id FROM x_route_stop)), "
    + _closure("x_trip", "SELECT TRIP_ID FROM trip WHERE ROUTE_ID IN (SELECT id FROM x_route)", TRIP_NODES)
    + ", x_trip_stop AS (SELECT TS_ID AS id FROM trip_stop WHERE TRIP_ID IN (SELECT id FROM x_trip))"
)
TRIP_SETS = (
    _closure("y_trip", "SELECT TRIP_ID FROM trip WHERE {seed}", TRIP_NODES)
    + ", y_trip_stop AS (SELECT TS_ID AS id FROM trip_stop WHERE TRIP_ID IN (SELECT id FROM y_trip))"
)
ROUTE_KEEP = {
    "route": [("ROUTE_ID", "x_route")],
    "route_stop": [("ROUTE_ID", "x_route")],
    "route_stop_activity": [("RS_ID", "x_route_stop")],
    "transportation_order": [("TO_ID", "x_order")],
    "transportation_order_line": [("TO_ID", "x_order")],
    "trip": [("TRIP_ID", "x_trip")],
    "trip_activity": [("TRIP_ID", "x_trip")],
    "trip_stop": [("TRIP_ID", "x_trip")],
    "trip_stop_activity": [("TS_ID", "x_trip_stop")],
    "trip_stop_delay": [("TS_ID", "x_trip_stop")],
}
TRIP_KEEP = {
    "trip": [("TRIP_ID", "y_trip")],
    "trip_activity": [("TRIP_ID", "y_trip")],
    "trip_stop": [("TRIP_ID", "y_trip")],
    "trip_stop_activity": [("TS_ID", "y_trip_stop")],
    "trip_stop_delay": [("TS_ID", "y_trip_stop")],
}


def _kept_sql(*rules: dict[str, list[tuple[str, str]]]) -> str:
    parts = []
    for role, shown in SHOWN.items():
        tests = [
            f"NOT EXISTS (SELECT 1 FROM {keys} WHERE id = r.{column})" for rule in rules for column, keys in rule.get(role, [])
        ]
        where = f" WHERE {' AND '.join(tests)}" if tests else ""
        parts.append(f"SELECT '{role}' AS role, r.{shown} AS id FROM {role} r{where}")
    return " UNION ALL ".join(parts)


def _excluded_routes(spark, sf_dir):
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") < -980).select(F.col("c_custkey").alias("ROUTE_ID"))


@query(f"WITH RECURSIVE {RELATIONS_SQL}, {ROUTE_SETS} {_kept_sql(ROUTE_KEEP)}")
def route_exclusion(spark, sf_dir):
    sources = _sources(spark, sf_dir)
    return _survivors(exclude_routes(sources, sources, _excluded_routes(spark, sf_dir)))


BY_CODE = TRIP_SETS.format(seed="TRIP_CD IN ('1-URGENT')")
BY_BOTH = TRIP_SETS.format(seed="TRIP_CD IN ('1-URGENT') OR TRIP_ID IN (2, 3, 5)")


@query(f"WITH RECURSIVE {RELATIONS_SQL}, {BY_CODE} {_kept_sql(TRIP_KEEP)}")
def trip_exclusion_codes_first(spark, sf_dir):
    sources = _sources(spark, sf_dir)
    return _survivors(exclude_trips(sources, sources, ["1-URGENT"], [2, 3, 5], "codes_first"))


@query(f"WITH RECURSIVE {RELATIONS_SQL}, {ROUTE_SETS}, {BY_BOTH} {_kept_sql(ROUTE_KEEP, TRIP_KEEP)}")
def route_then_trip_exclusion(spark, sf_dir):
    sources = _sources(spark, sf_dir)
    return _survivors(exclude_routes_and_trips(sources, sources, _excluded_routes(spark, sf_dir), ["1-URGENT"], [2, 3, 5]))
