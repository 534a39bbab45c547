"""Slowly changing dimensions: change detection, expiry, insertion and whole merges.

Two kinds of input: the order history of every customer as staging rows with
many duplicates per key, and the seven dimensions at a cutoff merged with what
their sources changed since.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.dedup import dedup_latest
from starloom.operators.keys import assign_keys
from starloom.operators.lookup import current_rows, fill_open_end
from starloom.operators.scd import (
    DimensionSpec, change_set, expire, merge_stats, new_versions, scd1_merge, scd2_merge, staged_duplicates,
)
from starloom.functions.scalar import open_end
from starloom.runtime import cut_lineage
from starloom.workload.base import query
from starloom.workload.dimension_queries import BUILDERS, DELTA_SQL, DIM_SQL, nullable_of, shape_of
from starloom.workload.fact_queries import EXTRA
from starloom.workload.oltp import OltpSources, read
from starloom.workload.oltp_sql import CUTOFF, with_sources

PROFILE = DimensionSpec("CustomerProfile", "ProfileKey", ("CustomerID",), ("Priority", "Status"))


def order_states(spark, sf):
    """Each order as a state of its customer: priority (null if not specified) and status."""
    orders = read(spark, sf, "orders")
    return orders.select(
        F.col("o_custkey").alias("CustomerID"), F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("Priority"),
        F.col("o_orderstatus").alias("Status"), F.col("o_orderdate").alias("StartDate"),
    )


def profile_target(spark, sf):
    """Newest state up to the cutoff, with keys and open ends."""
    known = order_states(spark, sf).filter(F.col("StartDate") <= F.lit(CUTOFF).cast("timestamp_ntz"))
    rows = dedup_latest(known, ["CustomerID"]).withColumn("EndDate", open_end())
    return assign_keys(rows.select(*PROFILE.row_columns), "ProfileKey", ["CustomerID"])


def profile_staging(spark, sf):
    """All states after the cutoff; those of low priority arrive late, ten years back."""
    new = order_states(spark, sf).filter(F.col("StartDate") > F.lit(CUTOFF).cast("timestamp_ntz"))
    late = F.when(F.col("Priority") == "5-LOW", F.col("StartDate") - F.expr("interval 10 years")).otherwise(F.col("StartDate"))
    return new.withColumn("StartDate", late.cast("timestamp_ntz"))


_PROFILE = {
    "states": "SELECT o_custkey AS CustomerID, nullif(o_orderpriority, '4-NOT SPECIFIED') AS Priority, o_orderstatus AS Status, o_orderdate AS StartDate FROM orders",
    "target_rows": f"""SELECT row_number() OVER (ORDER BY CustomerID) AS ProfileKey, *, TIMESTAMP '9999-12-31' AS EndDate FROM (
        SELECT * FROM states WHERE StartDate <= TIMESTAMP '{CUTOFF}' QUALIFY row_number() OVER
            (PARTITION BY CustomerID ORDER BY StartDate DESC, Priority ASC NULLS FIRST, Status ASC) = 1)""",
    "staged_rows": f"""SELECT CustomerID, Priority, Status,
        CASE WHEN Priority = '5-LOW' THEN StartDate - INTERVAL 10 YEAR ELSE StartDate END AS StartDate
        FROM states WHERE StartDate > TIMESTAMP '{CUTOFF}'""",
}


def merge_ctes(spec: DimensionSpec, target: str, staging: str) -> dict[str, str]:
    """CTEs ``base_rows``, ``batch_rows`` and ``change_rows`` of a merge in the oracle's SQL."""
    keys, tracked = list(spec.business_keys), [f'"{c}"' for c in spec.tracked]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in tracked)
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    changed = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in tracked)
    return {
        "base_rows": f"SELECT * FROM {target}",
        "batch_rows": f"""SELECT {', '.join(keys + tracked)}, StartDate FROM {staging}
            QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY StartDate DESC, {order}) = 1""",
        "change_rows": f"""SELECT s.*, CASE WHEN t.StartDate IS NULL THEN 'insert' WHEN NOT ({changed}) THEN 'same'
                WHEN s.StartDate > t.StartDate THEN 'change' ELSE 'late' END AS act
            FROM batch_rows s LEFT JOIN base_rows t ON {on} AND t.EndDate = TIMESTAMP '9999-12-31'""",
    }


def merge_sql(spec: DimensionSpec) -> str:
    keys = list(spec.business_keys)
    columns = ", ".join(f'"{c}"' for c in [*keys, *spec.tracked])
    return f"""
    SELECT t.{spec.surrogate_key}, {', '.join(f't."{c}"' for c in [*keys, *spec.tracked])}, t.StartDate,
           CASE WHEN c.StartDate IS NOT NULL AND t.EndDate = TIMESTAMP '9999-12-31' THEN c.StartDate - INTERVAL 1 SECOND ELSE t.EndDate END AS EndDate
    FROM base_rows t LEFT JOIN (SELECT * FROM change_rows WHERE act = 'change') c ON {' AND '.join(f't.{k} = c.{k}' for k in keys)}
    UNION ALL
    SELECT (SELECT coalesce(max({spec.surrogate_key}), 0) FROM base_rows) + row_number() OVER (ORDER BY {', '.join(keys)}), {columns}, StartDate,
           TIMESTAMP '9999-12-31'
    FROM change_rows WHERE act IN ('insert', 'change')"""


_PROFILE_CTES = {**_PROFILE, **merge_ctes(PROFILE, "target_rows", "staged_rows")}
_ROW = "CustomerID Priority Status StartDate:t EndDate:t"


def profile_changes(spark, sf):
    target = profile_target(spark, sf)
    return target, cut_lineage(change_set(target, profile_staging(spark, sf), PROFILE))


@query("change_detect", with_sources("SELECT CustomerID, Priority, Status, StartDate, act AS action FROM change_rows", _PROFILE_CTES),
       "CustomerID Priority Status StartDate:t action")
def change_query(spark, sf):
    return profile_changes(spark, sf)[1].withColumnRenamed("_action", "action")


@query("dedup_latest", with_sources("SELECT * FROM batch_rows", _PROFILE_CTES), "CustomerID Priority Status StartDate:t")
def dedup_query(spark, sf):
    return dedup_latest(profile_staging(spark, sf), ["CustomerID"])


@query("staged_duplicates", with_sources("SELECT CustomerID, count(*) AS n FROM staged_rows GROUP BY 1 HAVING count(*) > 1", _PROFILE_CTES))
def duplicates_query(spark, sf):
    return staged_duplicates(profile_staging(spark, sf), ["CustomerID"])


@query("scd2_expire", with_sources("""
    SELECT t.ProfileKey, t.CustomerID, t.Priority, t.Status, t.StartDate,
           coalesce(c.StartDate - INTERVAL 1 SECOND, t.EndDate) AS EndDate
    FROM base_rows t LEFT JOIN change_rows c ON c.CustomerID = t.CustomerID AND c.act = 'change'""", _PROFILE_CTES), f"ProfileKey {_ROW}")
def expire_query(spark, sf):
    return expire(*profile_changes(spark, sf), PROFILE)


@query("scd2_insert", with_sources("""
    SELECT CustomerID, Priority, Status, StartDate, TIMESTAMP '9999-12-31' AS EndDate FROM change_rows WHERE act IN ('insert', 'change')""",
    _PROFILE_CTES), _ROW)
def insert_query(spark, sf):
    return new_versions(profile_changes(spark, sf)[1], PROFILE)


@query("scd2_merge_profile", with_sources(merge_sql(PROFILE), _PROFILE_CTES), f"ProfileKey {_ROW}")
def merge_profile_query(spark, sf):
    return scd2_merge(profile_target(spark, sf), profile_staging(spark, sf), PROFILE)


@query("current_members", with_sources(f"SELECT * FROM ({merge_sql(PROFILE)}) WHERE EndDate = TIMESTAMP '9999-12-31'", _PROFILE_CTES),
       f"ProfileKey {_ROW}")
def current_query(spark, sf):
    return current_rows(scd2_merge(profile_target(spark, sf), profile_staging(spark, sf), PROFILE))


@query("scd2_merge_stats", with_sources("""
    SELECT count(*) FILTER (act = 'change') AS rows_expired, count(*) FILTER (act IN ('insert', 'change')) AS rows_inserted,
           count(*) FILTER (act = 'same') AS rows_unchanged, count(*) FILTER (act = 'late') AS rows_late FROM change_rows""", _PROFILE_CTES))
def stats_query(spark, sf):
    return merge_stats(profile_changes(spark, sf)[1])


@query("default_end_date", """
    SELECT o_custkey AS CustomerID, o_orderdate AS StartDate,
           CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY ELSE TIMESTAMP '9999-12-31' END AS EndDate FROM orders""",
    "CustomerID StartDate:t EndDate:t")
def default_end_query(spark, sf):
    """Finished orders have an end, the others get the sentinel."""
    rows = order_states(spark, sf)
    end = F.when(F.col("Status") == "F", F.col("StartDate") + F.expr("interval 30 days"))
    return fill_open_end(rows.select("CustomerID", "StartDate", end.alias("EndDate")))


@query("scd1_merge", with_sources("""
    SELECT t.ProfileKey, t.CustomerID, CASE WHEN c.act = 'change' THEN c.Priority ELSE t.Priority END AS Priority,
           CASE WHEN c.act = 'change' THEN c.Status ELSE t.Status END AS Status,
           CASE WHEN c.act = 'change' THEN c.StartDate ELSE t.StartDate END AS StartDate, t.EndDate
    FROM base_rows t LEFT JOIN change_rows c ON c.CustomerID = t.CustomerID
    UNION ALL
    SELECT (SELECT coalesce(max(ProfileKey), 0) FROM base_rows) + row_number() OVER (ORDER BY CustomerID), CustomerID, Priority, Status, StartDate,
           TIMESTAMP '9999-12-31'
    FROM change_rows WHERE act = 'insert'""", _PROFILE_CTES), f"ProfileKey {_ROW}")
def scd1_query(spark, sf):
    return scd1_merge(profile_target(spark, sf), profile_staging(spark, sf), PROFILE)


def merge_dimension(spark, sf, build, spec):
    """The dimension at the cutoff, merged with the delta since then."""
    target = assign_keys(build(OltpSources(spark, sf, CUTOFF)), spec.surrogate_key, spec.business_keys)
    staged = cut_lineage(build(OltpSources(spark, sf), CUTOFF))
    return scd2_merge(target, staged, spec)


def _dimension_ctes(name: str, spec: DimensionSpec) -> dict[str, str]:
    keys = ", ".join(spec.business_keys)
    keyed = f"SELECT row_number() OVER (ORDER BY {keys}) AS {spec.surrogate_key}, * FROM old_{name}"
    return {
        **EXTRA, "keyed_rows": keyed, "delta_rows": DELTA_SQL[f"delta_{name}"], **merge_ctes(spec, "keyed_rows", "delta_rows"),
    }


for _name, (_build, _spec) in BUILDERS.items():
    query(
        f"scd2_merge_{_name.removeprefix('dim_')}",
        with_sources(merge_sql(_spec), _dimension_ctes(_name, _spec)),
        f"{_spec.surrogate_key} {shape_of(_spec.row_columns)}",
        nullable_of(_spec.row_columns),
    )(lambda spark, sf, build=_build, spec=_spec: merge_dimension(spark, sf, build, spec))

__all__ = ["DIM_SQL"]
