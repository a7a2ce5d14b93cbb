import pytest

from tidegate.operators.exclusion import exclude_routes, exclude_routes_and_trips, exclude_trips, role_frames


@pytest.fixture(scope="module")
def graph(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "route": frame([(1,), (2,), (None,)], "ROUTE_ID int"),
        "route_stop": frame([(10, 1), (20, 2), (30, None)], "RS_ID int, ROUTE_ID int"),
        "route_stop_activity": frame([(10, 100), (20, 100), (20, 200), (None, 300), (10, None)], "RS_ID int, TO_ID int"),
        "transportation_order": frame([(100,), (200,), (300,), (None,)], "TO_ID int"),
        "transportation_order_line": frame([(100, 1), (200, 1), (200, 2)], "TO_ID int, n int"),
        "trip": frame(
            [(1, None, 1, "A"), (2, 1, 2, "B"), (3, 2, None, "C"), (4, 4, 2, "D"), (5, None, None, "E")],
            "TRIP_ID int, PARENT_TRIP_ID int, ROUTE_ID int, TRIP_CD string",
        ),
        "trip_activity": frame([(1,), (3,), (5,), (99,)], "TRIP_ID int"),
        "trip_stop": frame([(11, 1), (33, 3), (55, 5), (99, 99)], "TS_ID int, TRIP_ID int"),
        "trip_stop_activity": frame([(11,), (55,), (None,)], "TS_ID int"),
        "trip_stop_delay": frame([(33,), (99,)], "TS_ID int"),
    }


def ids(df, column=None):
    return sorted((-1 if r[0] is None else r[0]) for r in df.select(column or df.columns[0]).collect())


def routes(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id int")


def test_route_cascade(spark, graph):
    kept = exclude_routes(graph, graph, routes(spark, 1))
    assert ids(kept["route"]) == [2]
    assert ids(kept["route_stop"]) == [20]
    assert ids(kept["route_stop_activity"]) == [-1, 20, 20]
    assert ids(kept["transportation_order"]) == [-1, 200, 300]
    assert ids(kept["transportation_order_line"]) == [200, 200]
    assert ids(kept["trip"]) == [4, 5]
    assert ids(kept["trip_activity"]) == [5, 99]
    assert ids(kept["trip_stop"]) == [55, 99]
    assert ids(kept["trip_stop_activity"]) == [-1, 55]
    assert ids(kept["trip_stop_delay"]) == [99]


def test_trip_seeds(spark, graph):
    both = exclude_trips(graph, graph, ["B"], [5])
    assert ids(both["trip"]) == [1, 4]
    first = exclude_trips(graph, graph, ["B"], [5], "codes_first")
    assert ids(first["trip"]) == [1, 4, 5]
    by_id = exclude_trips(graph, graph, trip_ids=[5], seed_policy="codes_first")
    assert ids(by_id["trip"]) == [1, 2, 3, 4]
    assert ids(by_id["trip_stop"]) == [11, 33, 99]
    assert exclude_trips(graph, graph) == graph
    with pytest.raises(ValueError):
        exclude_trips(graph, graph, ["B"], seed_policy="ids_first")


def test_roles_without_sources_stay_whole(spark, graph):
    sources = {role: graph[role] for role in ("route", "route_stop")}
    kept = exclude_routes(graph, sources, routes(spark, 1))
    assert ids(kept["route_stop_activity"]) == [-1, 20, 20]
    assert kept["trip"] is graph["trip"] and kept["transportation_order"] is graph["transportation_order"]


def test_incremental_batch_uses_the_full_graph(spark, graph):
    batch = {"trip": graph["trip"].where("TRIP_ID = 3")}
    assert exclude_routes(batch, graph, routes(spark, 1))["trip"].count() == 0


def test_decimal_keys_match_integer_rows(spark, graph):
    sources = dict(graph) | {"trip": graph["trip"].withColumn("TRIP_ID", graph["trip"].TRIP_ID.cast("decimal(38,0)"))}
    assert ids(exclude_routes(graph, sources, routes(spark, 1))["trip"]) == [4, 5]


def test_entity_names(graph):
    found = role_frames({"TripSource": graph["trip"], "Trip": graph["trip_stop"], "Other": graph["route"]})
    assert found == {"trip": graph["trip_stop"]}


def test_empty_route_list_removes_nothing(spark, graph):
    assert exclude_routes(graph, graph, routes(spark, 1).limit(0)) == graph


def test_routes_and_trips_in_one_join(spark, graph):
    listed = routes(spark, 1)
    chained = exclude_trips(exclude_routes(graph, graph, listed), graph, ["D"], [5])
    at_once = exclude_routes_and_trips(graph, graph, listed, ["D"], [5])
    assert {role: ids(df) for role, df in at_once.items()} == {role: ids(df) for role, df in chained.items()}
    assert at_once["trip_activity"]._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 1
    none = routes(spark, 1).limit(0)
    assert ids(exclude_routes_and_trips(graph, graph, none, ["D"])["trip"]) == ids(exclude_trips(graph, graph, ["D"])["trip"])
    assert ids(exclude_routes_and_trips(graph, graph, listed)["trip"]) == [4, 5]
    assert exclude_routes_and_trips(graph, graph, none) == graph
