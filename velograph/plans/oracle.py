"""DuckDB SQL for every query of the registry, over the same parquet tables."""

from __future__ import annotations

# Relaxation rounds written out for the path queries; more than any best path has hops.
PATH_ROUNDS = 16

TRIPS = """trips AS (
    SELECT l_partkey AS bike_id, o_orderdate AS start_time, l_shipdate AS stop_time,
           CAST(l_quantity AS INT) AS trip_duration,
           sn.n_name AS start_station_name, cn.n_name AS stop_station_name,
           l_orderkey AS k1, l_linenumber AS k2, l_suppkey AS k3
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation sn ON s_nationkey = sn.n_nationkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey)"""

FLOW = """flow AS MATERIALIZED (
    SELECT 2 * l_suppkey + 1 AS source, 2 * o_custkey AS target, CAST(l_quantity AS INT) AS weight
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL
    SELECT 2 * o_custkey, 2 * l_suppkey + 1, CAST(l_quantity AS INT)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'R')"""

TRADE = """trade AS MATERIALIZED (
    SELECT 2 * l_suppkey + 1 AS source, 2 * o_custkey AS target, CAST(l_quantity AS INT) AS weight
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL
    SELECT 2 * o_custkey, 2 * l_suppkey + 1, CAST(l_quantity AS INT)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _balance(source: str) -> str:
    return f"""
        SELECT coalesce(d.station, a.station) AS station,
               coalesce(num_departure_trips, 0) AS num_departure_trips,
               coalesce(num_arrival_trips, 0) AS num_arrival_trips
        FROM (SELECT start_station_name AS station, count(start_station_name) AS num_departure_trips
              FROM {source} GROUP BY 1) d
        FULL JOIN (SELECT stop_station_name AS station, count(stop_station_name) AS num_arrival_trips
              FROM {source} GROUP BY 1) a ON d.station = a.station
        ORDER BY station"""


_LAGGED = """lagged AS (
    SELECT *, lag(stop_station_name) OVER w AS prev_station, lag(stop_time) OVER w AS prev_time
    FROM trips
    WINDOW w AS (PARTITION BY bike_id ORDER BY start_time, stop_time, k1, k2, k3))"""

_MOVES = """
    prev_time AS start_time, prev_station AS start_station_name,
    start_time AS stop_time, start_station_name AS stop_station_name
    FROM lagged WHERE prev_station <> start_station_name"""


def _ranks(graph: str, direction: str) -> str:
    """Three iterations, written out; the result is the table ``ranks``."""
    taker, giver = ("target", "source") if direction == "in" else ("source", "target")
    steps = [
        f"""nodes AS (SELECT source AS id FROM {graph} UNION SELECT target FROM {graph}),
        degrees AS (SELECT source AS id, count(*) AS degree FROM {graph} GROUP BY 1),
        r0 AS (SELECT id, CAST(1 AS DOUBLE) AS pr FROM nodes)"""
    ]
    for k in range(1, 4):
        steps.append(
            f"""r{k} AS MATERIALIZED (
            SELECT n.id, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(s.total, 0) AS pr
            FROM nodes n LEFT JOIN (
                SELECT e.{taker} AS id, sum(r.pr / d.degree) AS total
                FROM {graph} e JOIN r{k - 1} r ON r.id = e.{giver} JOIN degrees d ON d.id = e.{giver}
                GROUP BY 1) s ON s.id = n.id)"""
        )
    # format rounds by the exact binary value of the double.
    steps.append("ranks AS (SELECT id, CAST(format('{:.2f}', pr) AS DOUBLE) AS pagerank FROM r3)")
    return ",\n".join(steps)


def _paths() -> str:
    """Relaxation from node 1 in written-out rounds; the result is the table ``reached``."""
    steps = [
        """hops AS MATERIALIZED (
            SELECT source, target, min(weight) AS weight FROM flow WHERE source <> target GROUP BY 1, 2),
        d0 AS (SELECT CAST(1 AS BIGINT) AS id, CAST(0 AS BIGINT) AS cost, 0 AS hop, CAST(NULL AS BIGINT) AS prev)"""
    ]
    for k in range(1, PATH_ROUNDS + 1):
        steps.append(
            f"""d{k} AS MATERIALIZED (
            SELECT id, m.cost AS cost, m.hop AS hop, m.prev AS prev FROM (
                SELECT id, min({{'cost': cost, 'hop': hop, 'prev': prev}}) AS m FROM (
                    SELECT id, cost, hop, prev FROM d{k - 1}
                    UNION ALL
                    SELECT h.target, d.cost + h.weight, d.hop + 1, d.id
                    FROM d{k - 1} d JOIN hops h ON h.source = d.id) GROUP BY id))"""
        )
    steps.append(
        f"""reached AS (
        SELECT id, cost, CAST(id AS VARCHAR) AS path FROM d{PATH_ROUNDS} WHERE prev IS NULL
        UNION ALL
        SELECT d.id, d.cost, r.path || '-' || d.id FROM reached r JOIN d{PATH_ROUNDS} d ON d.prev = r.id)"""
    )
    return ",\n".join(steps)


_DOMAIN = "domain AS (SELECT DISTINCT source AS id FROM flow)"
_PATH_RESULT = """
    SELECT id, coalesce(cost, -1) AS cost, coalesce(path, '') AS path
    FROM domain LEFT JOIN reached USING (id)"""

# The first step of the search from node 1: its best edge, and the paths after settling that.
_STEP = """best AS MATERIALIZED (
    SELECT source AS candidate_source, target AS candidate_target,
           CAST(weight AS BIGINT) AS candidate_cost, '1' AS candidate_path
    FROM flow WHERE source = 1 ORDER BY weight, target LIMIT 1),
settled AS (
    SELECT id,
           CASE WHEN id = (SELECT candidate_target FROM best) THEN (SELECT candidate_cost FROM best)
                WHEN id = 1 THEN 0 ELSE -1 END AS cost,
           CASE WHEN id = (SELECT candidate_target FROM best) THEN '1-' || id
                WHEN id = 1 THEN '1' ELSE '' END AS path
    FROM (SELECT DISTINCT source AS id FROM flow)),
frontier AS (SELECT * FROM flow WHERE source = 1),
leaving AS (SELECT * FROM flow WHERE source IN (SELECT candidate_target FROM best))"""

_PAIRS = """pairs AS (
    SELECT source, target, CAST(sum(weight) AS BIGINT) AS weight FROM flow GROUP BY 1, 2),
changed AS (
    SELECT source, target, CASE WHEN source = 1 THEN weight + 1 ELSE weight END AS weight
    FROM pairs WHERE source % 2 = 1)"""

_RANK_LINES = "SELECT concat('id=', id, '; pagerank=', CAST(pagerank AS VARCHAR)) AS line FROM ranks"

_IN_RANKS = f"WITH {FLOW}, {_ranks('flow', 'in')}"

ORACLE_SQL: dict[str, str] = {
    "top_n_vehicles": """
        SELECT l_partkey AS bike_id, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS totalTime,
               count(l_orderkey) AS numTrips
        FROM lineitem GROUP BY 1 ORDER BY totalTime DESC, bike_id LIMIT 10""",
    "station_trip_balance": f"WITH {TRIPS} {_balance('trips')}",
    "station_trip_balance_join": f"WITH {TRIPS} {_balance('trips')}",
    "station_trip_balance_parties": f"""WITH {FLOW}, parties AS (
        SELECT CAST(source AS VARCHAR) AS start_station_name, CAST(target AS VARCHAR) AS stop_station_name
        FROM flow) {_balance('parties')}""",
    "vehicle_relocations": f"WITH {TRIPS}, {_LAGGED} SELECT {_MOVES} AND bike_id = 42",
    "vehicle_relocations_all": f"WITH {TRIPS}, {_LAGGED} SELECT bike_id, {_MOVES}",
    "relocation_flags": f"""WITH {TRIPS}, {_LAGGED}
        SELECT * EXCLUDE (prev_station, prev_time),
               CASE WHEN prev_station <> start_station_name THEN prev_station END AS moved_from_station,
               CASE WHEN prev_station <> start_station_name THEN prev_time END AS moved_from_time
        FROM lagged""",
    "cheapest_pair": f"""WITH {TRIPS}
        SELECT start_station_name, stop_station_name, count(*) AS num_trips
        FROM trips GROUP BY 1, 2 ORDER BY 3, 1, 2 LIMIT 1""",
    "out_degree": f"WITH {FLOW} SELECT source AS id, count(*) AS num_neighbours FROM flow GROUP BY 1",
    "distinct_nodes": f"WITH {FLOW} SELECT source AS id FROM flow UNION SELECT target FROM flow",
    "node_count": f"""WITH {FLOW}
        SELECT count(*) AS num_nodes FROM (SELECT source FROM flow UNION SELECT target FROM flow)""",
    "positive_source_edges": f"WITH {FLOW} SELECT count(*) AS num_edges FROM flow WHERE source > 0",
    "adjacency": f"""WITH {FLOW},
        nodes AS (SELECT source AS id FROM flow UNION SELECT target FROM flow),
        lists AS (SELECT source AS id, count(*) AS n,
                         string_agg(CAST(target AS VARCHAR), ',' ORDER BY target) AS neighbours
                  FROM flow GROUP BY 1)
        SELECT id, coalesce(n, 0) AS num_neighbours, CAST(0 AS INT) AS block,
               coalesce(neighbours, '') AS neighbours
        FROM nodes LEFT JOIN lists USING (id)""",
    "pagerank_in": f"{_IN_RANKS} SELECT id, pagerank FROM ranks",
    "pagerank_out": f"WITH {TRADE}, {_ranks('trade', 'out')} SELECT id, pagerank FROM ranks",
    "rank_listing": f"{_IN_RANKS} {_RANK_LINES}",
    "rank_listing_file": f"{_IN_RANKS} {_RANK_LINES}",
    "shortest_paths": f"WITH RECURSIVE {FLOW}, {_paths()}, {_DOMAIN} {_PATH_RESULT}",
    "shortest_paths_with_sinks": f"""WITH RECURSIVE {FLOW}, {_paths()},
        domain AS (SELECT source AS id FROM flow UNION SELECT target FROM flow) {_PATH_RESULT}""",
    "path_listing": f"""WITH RECURSIVE {FLOW}, {_paths()}, {_DOMAIN}
        SELECT concat('Row(id=', id, ', cost=', cost, ', path=''', path, ''')') AS line
        FROM ({_PATH_RESULT})""",
    "best_frontier_edge": f"WITH {FLOW}, {_STEP} SELECT * FROM best",
    "settled_paths": f"WITH {FLOW}, {_STEP} SELECT * FROM settled",
    "unused_edges": """
        SELECT source, target, weight
        FROM (SELECT 2 * l_suppkey + 1 AS source, 2 * o_custkey AS target, CAST(l_quantity AS INT) AS weight
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              UNION ALL
              SELECT 2 * o_custkey, 2 * l_suppkey + 1, CAST(l_quantity AS INT)
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              WHERE l_returnflag = 'R')
        WHERE source <> 1 OR target <> (
            SELECT 2 * o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE l_suppkey = 0 ORDER BY CAST(l_quantity AS INT), o_custkey LIMIT 1)""",
    "unvisited_targets": f"""WITH {FLOW}, {_STEP}
        SELECT * FROM flow WHERE target IN (SELECT id FROM settled WHERE cost = -1)""",
    "union_frontier": f"WITH {FLOW}, {_STEP} SELECT * FROM frontier UNION ALL SELECT * FROM leaving",
    "next_frontier": f"""WITH {FLOW}, {_STEP}
        SELECT * FROM (
            SELECT * FROM frontier WHERE target NOT IN (SELECT candidate_target FROM best)
            UNION ALL SELECT * FROM leaving)
        WHERE target IN (SELECT id FROM settled WHERE cost = -1)""",
    "result_diff": f"""WITH {FLOW}, {_PAIRS}
        SELECT count(p.source) AS left_rows, count(c.source) AS right_rows,
               count(*) FILTER (WHERE p.weight IS DISTINCT FROM c.weight) AS differing_rows,
               count(*) FILTER (WHERE p.weight IS DISTINCT FROM c.weight) = 0 AS passed
        FROM pairs p FULL JOIN changed c ON p.source = c.source AND p.target = c.target""",
    "result_diff_positional": f"""WITH {FLOW}, {_PAIRS},
        l AS (SELECT *, row_number() OVER (ORDER BY source, target) AS position FROM pairs),
        r AS (SELECT *, row_number() OVER (ORDER BY source, target) AS position FROM changed),
        j AS (SELECT l.position AS lp, r.position AS rp,
                     (l.source, l.target, l.weight) IS DISTINCT FROM (r.source, r.target, r.weight) AS differs
              FROM l FULL JOIN r ON l.position = r.position)
        SELECT count(lp) AS left_rows, count(rp) AS right_rows,
               count(*) FILTER (WHERE differs) AS differing_rows,
               count(*) FILTER (WHERE differs) = 0 AS passed
        FROM j""",
    "result_diff_unordered": f"""WITH {FLOW}, {TRADE},
        one AS (SELECT * FROM flow EXCEPT ALL SELECT * FROM trade),
        two AS (SELECT * FROM trade EXCEPT ALL SELECT * FROM flow)
        SELECT (SELECT count(*) FROM flow) AS left_rows, (SELECT count(*) FROM trade) AS right_rows,
               (SELECT count(*) FROM one) + (SELECT count(*) FROM two) AS differing_rows,
               (SELECT count(*) FROM one) + (SELECT count(*) FROM two) = 0 AS passed""",
    "trip_file_scan": """
        SELECT strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') AS start_time,
               strftime(l_shipdate, '%Y/%m/%d %H:%M:%S') AS stop_time,
               CAST(l_quantity AS INT) AS trip_duration,
               CAST(s_nationkey AS BIGINT) AS start_station_id, sn.n_name AS start_station_name,
               CAST(s_nationkey * 0.5 AS FLOAT) AS start_station_latitude,
               CAST(s_nationkey * -1.25 AS FLOAT) AS start_station_longitude,
               CAST(c_nationkey AS BIGINT) AS stop_station_id, cn.n_name AS stop_station_name,
               CAST(c_nationkey * 0.5 AS FLOAT) AS stop_station_latitude,
               CAST(c_nationkey * -1.25 AS FLOAT) AS stop_station_longitude,
               l_partkey AS bike_id, l_returnflag AS user_type,
               CAST(l_linenumber + 1950 AS INT) AS birth_year, CAST(l_linenumber % 3 AS INT) AS gender,
               l_orderkey AS trip_id
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation sn ON s_nationkey = sn.n_nationkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation cn ON c_nationkey = cn.n_nationkey""",
    "edge_file_scan": f"WITH {FLOW} SELECT source, target, weight FROM flow",
    "edge_file_scan_strict": f"WITH {FLOW} SELECT source, target, weight FROM flow",
}
