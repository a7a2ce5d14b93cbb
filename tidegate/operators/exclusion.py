"""Exclusion cascades over a graph of keys.

The graph is data. A `KeyStep` derives the excluded keys of one relation from those of another; a
`Rule` says by which excluded keys a role loses rows. Keys are always taken from the full source
relations, so an incremental batch is filtered against the whole graph.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.dedupe import distinct_keys
from tidegate.operators.hierarchy import descendants
from tidegate.operators.membership import exclude_keys, filter_by_ids, include_keys
from tidegate.operators.names import not_null, resolve
from tidegate.workspace import scratch_path, stage


@dataclass(frozen=True)
class KeyStep:
    """Excluded keys ``key`` = values of ``select`` in rows of ``source`` whose ``match`` is an
    excluded key of ``parent``. With ``parent_column`` all descendants are excluded as well."""

    key: str
    source: str
    select: str
    match: str
    parent: str
    parent_column: str | None = None


@dataclass(frozen=True)
class Rule:
    """Rows of ``role`` go when ``column`` is an excluded key of ``key``; ``drop_nulls`` as NOT IN."""

    role: str
    column: str
    key: str
    drop_nulls: bool = False


# The key graph of routes and trips, and the rows each excluded key removes.
ROUTE_STEPS = (
    KeyStep("route_stop", "route_stop", "RS_ID", "ROUTE_ID", "route"),
    KeyStep("order", "route_stop_activity", "TO_ID", "RS_ID", "route_stop"),
    KeyStep("trip", "trip", "TRIP_ID", "ROUTE_ID", "route", "PARENT_TRIP_ID"),
    KeyStep("trip_stop", "trip_stop", "TS_ID", "TRIP_ID", "trip"),
)
TRIP_RULES = (
    Rule("trip", "TRIP_ID", "trip"),
    Rule("trip_activity", "TRIP_ID", "trip"),
    Rule("trip_stop", "TRIP_ID", "trip"),
    Rule("trip_stop_activity", "TS_ID", "trip_stop"),
    Rule("trip_stop_delay", "TS_ID", "trip_stop"),
)
ROUTE_RULES = (
    Rule("route", "ROUTE_ID", "route", drop_nulls=True),
    Rule("route_stop", "ROUTE_ID", "route", drop_nulls=True),
    Rule("route_stop_activity", "RS_ID", "route_stop"),
    Rule("transportation_order", "TO_ID", "order"),
    Rule("transportation_order_line", "TO_ID", "order"),
    *TRIP_RULES,
)
TRIP_STEPS = (KeyStep("trip_stop", "trip_stop", "TS_ID", "TRIP_ID", "trip"),)

# The entity names under which a role may be loaded.
ROLE_ENTITIES = {
    "route": ("Route", "RouteInitialLoad", "RouteSource"),
    "route_stop": ("RouteStop", "RouteStopSource"),
    "route_stop_activity": ("RouteStopActivity", "RouteStopActivitySource"),
    "transportation_order": ("TransportationOrder", "TransportationOrderSource"),
    "transportation_order_line": ("TransportationOrderLine", "TransportationOrderLineSource"),
    "trip": ("Trip", "TripSource"),
    "trip_activity": ("TripActivity", "TripActivitySource"),
    "trip_stop": ("TripStop", "TripStopSource"),
    "trip_stop_activity": ("TripStopActivity", "TripStopActivitySource"),
    "trip_stop_delay": ("TripStopDelay", "TripStopDelaySource"),
}


def role_frames(entities: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Loaded entities by role; of several names for a role the first listed one counts."""
    found = {}
    for role, names in ROLE_ENTITIES.items():
        name = next((n for n in names if n in entities), None)
        if name:
            found[role] = entities[name]
    return found


def excluded_keys(
    seeds: Mapping[str, DataFrame],
    sources: Mapping[str, DataFrame],
    steps: Sequence[KeyStep],
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Excluded key sets, one column of distinct ids each, propagated from ``seeds`` along ``steps``.

    A step whose source relation is absent, or whose parent set is unknown, is left out, and with
    it every rule that needs its keys. Each set is written once and then read by all its rules.
    """
    keys = dict(seeds)
    for step in steps:
        if step.parent not in keys or step.source not in sources:
            continue
        source = sources[step.source]
        select, match = resolve(source, [step.select, step.match])
        members = keys[step.parent]
        members = members.select(F.col(members.columns[0]).alias(match))
        hit = include_keys(source.select(*dict.fromkeys([select, match])), members, [match], unique=True)
        where = folder or scratch_path(source.sparkSession, "excluded")
        if step.parent_column:
            (parent,) = resolve(source, [step.parent_column])
            below = descendants(source.select(select, parent), hit.select(select), select, parent, folder=f"{where}/{step.key}")
            keys[step.key] = below
        else:
            keys[step.key] = stage(distinct_keys(hit, [select]), "keys", path=f"{where}/{step.key}").df
    return keys


def apply_rules(
    extracts: Mapping[str, DataFrame], keys: Mapping[str, DataFrame], rules: Sequence[Rule]
) -> dict[str, DataFrame]:
    """Extracts without the rows that ``rules`` exclude; roles without a known key set stay whole."""
    kept = dict(extracts)
    for rule in rules:
        if rule.role in kept and rule.key in keys:
            df = kept[rule.role]
            (column,) = resolve(df, [rule.column])
            members = keys[rule.key]
            # A key that does not fit the narrower type of the rows can match none of them.
            members = members.select(F.col(members.columns[0]).try_cast(df.schema[column].dataType).alias(column))
            kept[rule.role] = exclude_keys(df, not_null(members, [column]), [column], rule.drop_nulls, unique=True)
    return kept


def exclude_routes(
    extracts: Mapping[str, DataFrame],
    sources: Mapping[str, DataFrame],
    route_ids: DataFrame,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Remove excluded routes and everything that hangs on them. ``route_ids`` has one column; an
    empty list removes nothing, and otherwise rows with a NULL route id go too, as with NOT IN."""
    keys = _route_keys(sources, route_ids, folder)
    return dict(extracts) if keys is None else apply_rules(extracts, keys, ROUTE_RULES)


def _route_keys(
    sources: Mapping[str, DataFrame], route_ids: DataFrame, folder: str | None = None
) -> dict[str, DataFrame] | None:
    """Keys that hang on ``route_ids``; None for an empty list."""
    folder = folder or scratch_path(route_ids.sparkSession, "excluded")
    listed = distinct_keys(route_ids, route_ids.columns[:1])
    routes = stage(listed, "keys", F.count(F.lit(1)).alias("n"), path=f"{folder}/route")
    return excluded_keys({"route": routes.df}, sources, ROUTE_STEPS, folder) if routes.metrics["n"] else None


def exclude_trips(
    extracts: Mapping[str, DataFrame],
    sources: Mapping[str, DataFrame],
    trip_codes: Sequence[str] = (),
    trip_ids: Sequence[int] = (),
    seed_policy: str = "union",
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Remove excluded trips, their descendants and what hangs on them.

    ``union`` seeds by codes and by ids; ``codes_first`` ignores the ids as soon as a code is given.
    """
    keys = _trip_keys(sources, trip_codes, trip_ids, seed_policy, folder)
    return dict(extracts) if keys is None else apply_rules(extracts, keys, TRIP_RULES)


def _trip_keys(
    sources: Mapping[str, DataFrame], trip_codes: Sequence[str], trip_ids: Sequence[int], seed_policy: str, folder: str | None = None
) -> dict[str, DataFrame] | None:
    """Keys that hang on the chosen trips; None if none are chosen."""
    if seed_policy not in ("union", "codes_first"):
        raise ValueError(f"unsupported seed policy '{seed_policy}'")
    if not trip_codes and not trip_ids or "trip" not in sources:
        return None
    trips = sources["trip"]
    trip_id, parent, code = resolve(trips, ["TRIP_ID", "PARENT_TRIP_ID", "TRIP_CD"])
    chosen = []
    if trip_codes:
        chosen.append(filter_by_ids(trips, code, trip_codes).select(trip_id))
    if trip_ids and (seed_policy == "union" or not trip_codes):
        chosen.append(filter_by_ids(trips, trip_id, trip_ids).select(trip_id))
    seeds = chosen[0].unionByName(chosen[1]) if len(chosen) == 2 else chosen[0]
    folder = folder or scratch_path(trips.sparkSession, "excluded")
    below = descendants(trips.select(trip_id, parent), seeds, trip_id, parent, folder=f"{folder}/trip")
    return excluded_keys({"trip": below}, sources, TRIP_STEPS, folder)


def exclude_routes_and_trips(
    extracts: Mapping[str, DataFrame],
    sources: Mapping[str, DataFrame],
    route_ids: DataFrame,
    trip_codes: Sequence[str] = (),
    trip_ids: Sequence[int] = (),
    seed_policy: str = "union",
) -> dict[str, DataFrame]:
    """What `exclude_trips` leaves of what `exclude_routes` leaves.

    Both take their keys from the full ``sources``, so a role that both filter is joined once, with the union of keys.
    """
    by_route = _route_keys(sources, route_ids) or {}
    by_trip = _trip_keys(sources, trip_codes, trip_ids, seed_policy) or {}
    keys = by_route | {
        key: _united(by_route[key], found) if key in by_route else found for key, found in by_trip.items()
    }
    return apply_rules(extracts, keys, ROUTE_RULES)


def _united(first: DataFrame, second: DataFrame) -> DataFrame:
    return stage(distinct_keys(first.unionByName(second), first.columns[:1]), "keys").df
