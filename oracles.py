"""Independent DuckDB SQL for the registered queries.

``CTES`` holds named building blocks over the delivered tables; ``sql(final)`` puts
those a final SELECT mentions, directly or through others, in front of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from paddock.plans.declared import DECLARED
from paddock.plans.training import DEPTH, TREES

K = 3
FLAG_ID = "CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 WHEN 'R' THEN 3 END"


def rate(part: str, whole: str, digits: int = 3, empty: str = "0.0") -> str:
    scale = 10**digits
    return (
        f"CASE WHEN {whole} > 0 THEN ((({part})::BIGINT * {2 * scale} + ({whole})::BIGINT) "
        f"// (({whole})::BIGINT * 2)) / {scale}::DOUBLE ELSE {empty}::DOUBLE END"
    )


def career(entity: str, races: str) -> str:
    return f"""
SELECT {entity}, count(DISTINCT race_id) AS {races}, count(DISTINCT year) AS seasons_active,
  min(year) AS first_season, max(year) AS last_season, sum(points) AS career_points,
  sum(is_top_10::INT)::BIGINT AS top_10_finishes, sum(is_dnf::INT)::BIGINT AS dnf_count,
  count(DISTINCT race_id) FILTER (finish_position_order = 1) AS wins,
  count(DISTINCT race_id) FILTER (finish_position_order <= 3) AS podiums
FROM enriched GROUP BY {entity}"""


def entity_dim(entities: str, stats: str, entity: str, races: str, columns: str) -> str:
    n = f"coalesce(s.{races}, 0)"
    return f"""
SELECT {columns}, {n} AS {races}, coalesce(s.seasons_active, 0) AS seasons_active,
  s.first_season, s.last_season, coalesce(s.career_points, 0.0) AS career_points,
  coalesce(s.top_10_finishes, 0) AS top_10_finishes, coalesce(s.dnf_count, 0) AS dnf_count,
  coalesce(s.wins, 0) AS wins, coalesce(s.podiums, 0) AS podiums,
  {rate('coalesce(s.top_10_finishes, 0)', n)} AS top_10_rate,
  {rate('coalesce(s.dnf_count, 0)', n)} AS dnf_rate
FROM {entities} e LEFT JOIN {stats} s ON s.{entity} = e.{entity}"""


def frame(depth: int | None) -> str:
    start = "UNBOUNDED" if depth is None else depth
    return f"ROWS BETWEEN {start} PRECEDING AND 1 PRECEDING"


def avg_before(value: str, window: str, depth: int | None) -> str:
    return f"avg({value}) OVER ({window} {frame(depth)})"


def sum_before(value: str, window: str, depth: int | None) -> str:
    return f"sum({value}) OVER ({window} {frame(depth)})"


ORDER = "ORDER BY year, round, race_id, driver_id"
BY_DRIVER = f"PARTITION BY driver_id {ORDER}"
BY_TEAM = f"PARTITION BY constructor_id {ORDER}"
BY_VISIT = f"PARTITION BY driver_id, circuit_id {ORDER}"

PER_RACE = """
SELECT {keys}, year, round, race_id,
  sum(is_top_10::INT) AS top, sum(is_dnf::INT) AS dnf, count(*) AS n, sum(points) AS points,
  sum(finish_position_order - grid_position) AS gained,
  max((finish_position_order = 1)::INT) AS won
FROM enriched GROUP BY {keys}, year, round, race_id"""


def before_races(table: str, keys: str) -> str:
    w = f"PARTITION BY {keys} ORDER BY year, round, race_id"
    recent = "".join(
        f", {sum_before(c, w, 5)} AS r_{c}" for c in ("top", "n", "points", "gained")
    )
    ever = "".join(
        f", {sum_before(c, w, None)} AS e_{c}" for c in ("top", "dnf", "n", "won")
    )
    return f"""
SELECT {keys}, race_id{recent}{ever},
  {sum_before('dnf', w, 10)} AS r_dnf, {sum_before('n', w, 10)} AS r_n10,
  count(*) OVER ({w} {frame(5)}) AS r_races, count(*) OVER ({w} {frame(None)}) AS e_races
FROM {table}"""


FEATURES = """
SELECT r.result_id, r.race_id, r.driver_id, r.constructor_id, r.circuit_id, r.year, r.round,
  r.race_date, r.is_top_10 AS target_top_10, r.is_dnf AS target_dnf,
  r.grid_position, q.qualifying_position,
  d.total_races AS driver_career_races, d.top_10_rate AS driver_career_top10_rate,
  d.dnf_rate AS driver_career_dnf_rate, d.wins AS driver_career_wins,
  coalesce(f.driver_top10_rate_recent, d.top_10_rate, 0) AS driver_top10_rate_recent,
  coalesce(f.driver_dnf_rate_recent, d.dnf_rate, 0) AS driver_dnf_rate_recent,
  coalesce(f.driver_avg_points_recent, 0) AS driver_avg_points_recent,
  coalesce(f.driver_avg_positions_gained_recent, 0) AS driver_avg_positions_gained_recent,
  f.driver_races_in_window,
  c.total_race_entries AS constructor_career_entries,
  c.top_10_rate AS constructor_career_top10_rate, c.dnf_rate AS constructor_career_dnf_rate,
  coalesce(t.constructor_top10_rate_recent, c.top_10_rate, 0) AS constructor_top10_rate_recent,
  coalesce(t.constructor_dnf_rate_recent, c.dnf_rate, 0) AS constructor_dnf_rate_recent,
  coalesce(t.constructor_avg_points_recent, 0) AS constructor_avg_points_recent,
  v.avg_dnf_rate AS circuit_avg_dnf_rate, v.times_hosted AS circuit_times_hosted,
  coalesce(p.driver_top10_rate_at_circuit, 0) AS driver_top10_rate_at_circuit,
  coalesce(p.driver_dnf_rate_at_circuit, 0) AS driver_dnf_rate_at_circuit,
  p.driver_races_at_circuit,
  coalesce(r.grid_position <= 5, false) AS started_top_5,
  coalesce(r.grid_position <= 10, false) AS started_top_10
FROM enriched r
LEFT JOIN qclean q ON q.race_id = r.race_id AND q.driver_id = r.driver_id
JOIN driver_form f ON f.result_id = r.result_id
JOIN team_form t ON t.result_id = r.result_id
JOIN visit_form p ON p.result_id = r.result_id
LEFT JOIN driver_dim d ON d.driver_id = r.driver_id
LEFT JOIN team_dim c ON c.constructor_id = r.constructor_id
LEFT JOIN circuit_dim v ON v.circuit_id = r.circuit_id"""

STRICT = f"""
SELECT r.result_id, r.race_id, r.driver_id, r.constructor_id, r.circuit_id, r.year, r.round,
  r.race_date, r.is_top_10 AS target_top_10, r.is_dnf AS target_dnf,
  r.grid_position, q.qualifying_position,
  d.e_races AS driver_career_races,
  {rate('coalesce(d.e_top, 0)', 'd.e_races')} AS driver_career_top10_rate,
  {rate('coalesce(d.e_dnf, 0)', 'd.e_races')} AS driver_career_dnf_rate,
  coalesce(d.e_won, 0)::BIGINT AS driver_career_wins,
  coalesce(d.r_top / d.r_n, 0) AS driver_top10_rate_recent,
  coalesce(d.r_dnf / d.r_n10, 0) AS driver_dnf_rate_recent,
  coalesce(d.r_points / d.r_n, 0) AS driver_avg_points_recent,
  coalesce(d.r_gained / d.r_n, 0) AS driver_avg_positions_gained_recent,
  d.r_races AS driver_races_in_window,
  t.e_races AS constructor_career_entries,
  {rate('coalesce(t.e_top, 0)', 't.e_races')} AS constructor_career_top10_rate,
  {rate('coalesce(t.e_dnf, 0)', 't.e_races')} AS constructor_career_dnf_rate,
  coalesce(t.r_top / t.r_n, 0) AS constructor_top10_rate_recent,
  coalesce(t.r_dnf / t.r_n10, 0) AS constructor_dnf_rate_recent,
  coalesce(t.r_points / t.r_n, 0) AS constructor_avg_points_recent,
  {rate('c.e_dnf', 'c.e_n', empty='NULL')} AS circuit_avg_dnf_rate,
  c.e_races AS circuit_times_hosted,
  coalesce(v.e_top / v.e_n, 0) AS driver_top10_rate_at_circuit,
  coalesce(v.e_dnf / v.e_n, 0) AS driver_dnf_rate_at_circuit,
  v.e_races AS driver_races_at_circuit,
  coalesce(r.grid_position <= 5, false) AS started_top_5,
  coalesce(r.grid_position <= 10, false) AS started_top_10
FROM enriched r
LEFT JOIN qclean q ON q.race_id = r.race_id AND q.driver_id = r.driver_id
JOIN driver_past d ON d.driver_id = r.driver_id AND d.race_id = r.race_id
JOIN team_past t ON t.constructor_id = r.constructor_id AND t.race_id = r.race_id
JOIN circuit_past c ON c.circuit_id = r.circuit_id AND c.race_id = r.race_id
JOIN visit_past v ON v.driver_id = r.driver_id AND v.circuit_id = r.circuit_id
  AND v.race_id = r.race_id"""

NUMERIC_FEATURES = (
    "grid_position qualifying_position driver_career_races driver_career_top10_rate "
    "driver_career_dnf_rate driver_career_wins driver_top10_rate_recent driver_dnf_rate_recent "
    "driver_avg_points_recent driver_avg_positions_gained_recent driver_races_in_window "
    "constructor_career_entries constructor_career_top10_rate constructor_career_dnf_rate "
    "constructor_top10_rate_recent constructor_dnf_rate_recent constructor_avg_points_recent "
    "circuit_avg_dnf_rate circuit_times_hosted driver_top10_rate_at_circuit "
    "driver_dnf_rate_at_circuit driver_races_at_circuit"
).split()

CTES = {
    "races": """
SELECT o_orderkey AS race_id, year(o_orderdate)::INT AS year, dayofyear(o_orderdate)::INT AS round,
  o_custkey AS circuit_id, 'Race ' || o_orderkey AS race_name,
  strftime(o_orderdate, '%Y-%m-%d') AS race_date, o_orderpriority AS race_time
FROM orders""",
    "drivers": """
SELECT driver_id, driver_ref, driver_number, driver_code, forename, surname, date_of_birth,
  nationality, coalesce(forename, '') || ' ' || coalesce(surname, '') AS full_name
FROM (SELECT s_suppkey AS driver_id, s_name AS driver_ref, (s_suppkey % 100)::DOUBLE AS driver_number,
  CASE WHEN s_acctbal > 0 THEN right(s_name, 3) END AS driver_code,
  split_part(s_name, '#', 1) AS forename,
  CASE WHEN s_acctbal > 0 THEN split_part(s_name, '#', 2) END AS surname,
  NULL::VARCHAR AS date_of_birth, 'NATION_' || s_nationkey AS nationality FROM supplier)""",
    "constructors": """
SELECT n_nationkey AS constructor_id, lower(n_name) AS constructor_ref, n_name AS constructor_name,
  'REGION_' || n_regionkey AS nationality FROM nation""",
    "circuits": """
SELECT c_custkey AS circuit_id, lower(c_name) AS circuit_ref, c_name AS circuit_name,
  c_mktsegment AS location, 'NATION_' || c_nationkey AS country, c_acctbal AS latitude,
  c_nationkey::DOUBLE AS longitude, NULL::DOUBLE AS altitude FROM customer""",
    "statuses": f"""
SELECT DISTINCT {FLAG_ID} AS status_id,
  CASE l_returnflag WHEN 'N' THEN 'Finished' WHEN 'A' THEN '+1 Lap' WHEN 'R' THEN 'Accident' END
    AS status_description FROM lineitem""",
    "grouped": """
SELECT l_orderkey, l_suppkey, min(l_linenumber) AS line, min(l_partkey) AS part,
  max(l_partkey) AS last_part, sum(l_quantity) AS points, max(l_quantity)::INT AS laps,
  max(l_returnflag) AS l_returnflag, max(l_extendedprice) AS price, max(l_tax) AS tax,
  max(l_discount) AS discount, strftime(max(l_shipdate), '%Y-%m-%d') AS shipped
FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "results": f"""
SELECT l_orderkey || '-' || l_suppkey AS result_id, l_orderkey AS race_id, l_suppkey AS driver_id,
  s_nationkey AS constructor_id, {FLAG_ID} AS status_id,
  (l_suppkey % 100)::DOUBLE AS driver_number, (1 + part % 20)::INT AS grid_position,
  CASE WHEN l_returnflag <> 'R' THEN line::DOUBLE END AS finish_position,
  CASE WHEN l_returnflag <> 'R' THEN line::VARCHAR ELSE 'R' END AS finish_position_text,
  line AS finish_position_order, points, laps,
  CASE WHEN l_returnflag <> 'R' THEN shipped END AS finish_time,
  CASE WHEN l_returnflag <> 'R' THEN price END AS finish_time_ms,
  CASE WHEN l_returnflag <> 'R' THEN tax END AS fastest_lap,
  CASE WHEN l_returnflag <> 'R' THEN (1 + last_part % 20)::DOUBLE END AS fastest_lap_rank,
  CASE WHEN l_returnflag <> 'R' THEN shipped END AS fastest_lap_time,
  CASE WHEN l_returnflag <> 'R' THEN discount END AS fastest_lap_speed
FROM grouped JOIN supplier ON s_suppkey = l_suppkey""",
    "qualifying": """
SELECT l_orderkey || '-' || l_suppkey AS qualify_id, l_orderkey AS race_id, l_suppkey AS driver_id,
  s_nationkey AS constructor_id, (l_suppkey % 100)::INT AS driver_number,
  place::DOUBLE AS qualifying_position, '1:' || day AS q1,
  CASE WHEN place <= 15 THEN '2:' || day END AS q2, CASE WHEN place <= 10 THEN '3:' || day END AS q3
FROM (SELECT l_orderkey, l_suppkey, 1 + min(l_partkey) % 20 AS place,
    strftime(min(l_shipdate), '%Y-%m-%d') AS day
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_suppkey)
JOIN supplier ON s_suppkey = l_suppkey""",
    "enriched": f"""
SELECT r.result_id, r.race_id, r.driver_id, r.constructor_id, ra.year, ra.round, ra.race_name,
  ra.race_date, ra.circuit_id, ci.circuit_name, ci.country AS circuit_country, d.driver_code,
  d.full_name AS driver_name, d.nationality AS driver_nationality, co.constructor_name,
  co.nationality AS constructor_nationality, r.grid_position, r.finish_position,
  r.finish_position_order, r.points, r.laps, r.finish_time, r.finish_time_ms, r.fastest_lap,
  r.fastest_lap_rank, r.fastest_lap_time, r.fastest_lap_speed, r.status_id, s.status_description,
  coalesce(r.finish_position_order <= {K}, false) AS is_top_10,
  NOT coalesce(s.status_description = 'Finished' OR s.status_description LIKE '+%', false) AS is_dnf
FROM results r JOIN races ra ON ra.race_id = r.race_id JOIN drivers d ON d.driver_id = r.driver_id
JOIN constructors co ON co.constructor_id = r.constructor_id
JOIN circuits ci ON ci.circuit_id = ra.circuit_id JOIN statuses s ON s.status_id = r.status_id""",
    "qclean": """
SELECT q.qualify_id, q.race_id, q.driver_id, q.constructor_id, ra.year, ra.round, ra.race_name,
  ra.circuit_id, d.driver_code, d.full_name AS driver_name, co.constructor_name,
  q.qualifying_position, q.q1, q.q2, q.q3, q.q1 IS NOT NULL AS completed_q1,
  q.q2 IS NOT NULL AS completed_q2, q.q3 IS NOT NULL AS completed_q3,
  coalesce(q.q3, q.q2, q.q1) AS best_qualifying_time
FROM qualifying q JOIN races ra ON ra.race_id = q.race_id JOIN drivers d ON d.driver_id = q.driver_id
JOIN constructors co ON co.constructor_id = q.constructor_id""",
    "fact": """
SELECT result_id, race_id, driver_id, constructor_id, circuit_id, status_id, year, round,
  grid_position, finish_position, finish_position_order, points, laps, finish_time_ms, fastest_lap,
  fastest_lap_rank, fastest_lap_time, fastest_lap_speed,
  finish_position_order - grid_position AS positions_gained, is_top_10, is_dnf,
  coalesce(finish_position_order = 1, false) AS is_win,
  coalesce(finish_position_order <= 3, false) AS is_podium,
  coalesce(grid_position = 1, false) AS started_pole,
  coalesce(fastest_lap_rank = 1, false) AS had_fastest_lap FROM enriched""",
    "driver_career": career("driver_id", "total_races"),
    "team_career": career("constructor_id", "total_race_entries"),
    "driver_dim": entity_dim(
        "drivers", "driver_career", "driver_id", "total_races",
        "e.driver_id, e.driver_ref, e.driver_code, e.driver_number, e.forename, e.surname, "
        "e.full_name, e.date_of_birth, e.nationality",
    ),
    "team_dim": entity_dim(
        "constructors", "team_career", "constructor_id", "total_race_entries",
        "e.constructor_id, e.constructor_ref, e.constructor_name, e.nationality",
    ),
    "circuit_dim": f"""
SELECT c.*, coalesce(s.hosted, 0) AS times_hosted, coalesce(s.years, 0) AS years_active,
  s.lo AS first_race_year, s.hi AS last_race_year,
  {rate('s.laps', 's.n', 1, 'NULL')} AS avg_laps_per_race,
  {rate('s.dnf', 's.n', 3, 'NULL')} AS avg_dnf_rate
FROM circuits c LEFT JOIN (SELECT circuit_id, count(DISTINCT race_id) AS hosted,
    count(DISTINCT year) AS years, min(year) AS lo, max(year) AS hi, sum(laps) AS laps,
    count(*) AS n, sum(is_dnf::INT) AS dnf FROM enriched GROUP BY circuit_id) s
  ON s.circuit_id = c.circuit_id""",
    "race_dim": f"""
SELECT r.race_id, r.year, r.round, r.race_name, r.race_date, r.race_time, r.circuit_id,
  c.circuit_name, c.country AS circuit_country, c.location AS circuit_location,
  coalesce(s.n, 0) AS total_drivers, coalesce(s.dnf, 0)::BIGINT AS dnf_count,
  {rate('coalesce(s.dnf, 0)', 'coalesce(s.n, 0)')} AS dnf_rate, s.laps AS total_laps
FROM races r JOIN circuits c ON c.circuit_id = r.circuit_id
LEFT JOIN (SELECT race_id, count(*) AS n, sum(is_dnf::INT) AS dnf, max(laps) AS laps
  FROM enriched GROUP BY race_id) s ON s.race_id = r.race_id""",
    "driver_form": f"""
SELECT result_id,
  {avg_before('is_top_10::INT', BY_DRIVER, 5)} AS driver_top10_rate_recent,
  {avg_before('is_dnf::INT', BY_DRIVER, 10)} AS driver_dnf_rate_recent,
  {avg_before('points', BY_DRIVER, 5)} AS driver_avg_points_recent,
  {avg_before('finish_position_order - grid_position', BY_DRIVER, 5)}
    AS driver_avg_positions_gained_recent,
  count(*) OVER ({BY_DRIVER} {frame(5)}) AS driver_races_in_window FROM enriched""",
    "team_form": f"""
SELECT result_id,
  {avg_before('is_top_10::INT', BY_TEAM, 5)} AS constructor_top10_rate_recent,
  {avg_before('is_dnf::INT', BY_TEAM, 10)} AS constructor_dnf_rate_recent,
  {avg_before('points', BY_TEAM, 5)} AS constructor_avg_points_recent FROM enriched""",
    "visit_form": f"""
SELECT result_id,
  {avg_before('is_top_10::INT', BY_VISIT, None)} AS driver_top10_rate_at_circuit,
  {avg_before('is_dnf::INT', BY_VISIT, None)} AS driver_dnf_rate_at_circuit,
  count(*) OVER ({BY_VISIT} {frame(None)}) AS driver_races_at_circuit FROM enriched""",
    "features": FEATURES,
    "driver_race": PER_RACE.format(keys="driver_id"),
    "team_race": PER_RACE.format(keys="constructor_id"),
    "circuit_race": PER_RACE.format(keys="circuit_id"),
    "visit_race": PER_RACE.format(keys="driver_id, circuit_id"),
    "driver_past": before_races("driver_race", "driver_id"),
    "team_past": before_races("team_race", "constructor_id"),
    "circuit_past": before_races("circuit_race", "circuit_id"),
    "visit_past": before_races("visit_race", "driver_id, circuit_id"),
    "strict_features": STRICT,
    "splits": """
SELECT *, CASE WHEN year <= 1997 THEN 'train' WHEN year IN (1998, 1999) THEN 'val' ELSE 'test' END
  AS split FROM features WHERE year <= 1997 OR year IN (1998, 1999, 2000, 2001)""",
    "scored": """
SELECT f.*, least(driver_avg_points_recent / 100, 1.0) AS top10_probability,
  CASE WHEN driver_races_in_window > 0 THEN driver_avg_points_recent > 27 END AS top10_prediction,
  driver_dnf_rate_recent AS dnf_probability,
  CASE WHEN driver_races_in_window > 0 THEN driver_dnf_rate_recent > 0.3 END AS dnf_prediction
FROM features f""",
    "cells": """
SELECT count(*) FILTER (NOT target_top_10 AND NOT top10_prediction) AS tn,
  count(*) FILTER (NOT target_top_10 AND top10_prediction) AS fp,
  count(*) FILTER (target_top_10 AND NOT top10_prediction) AS fn,
  count(*) FILTER (target_top_10 AND top10_prediction) AS tp,
  count(*) FILTER (NOT target_top_10 AND top10_prediction IS NULL) AS missed0,
  count(*) FILTER (target_top_10 AND top10_prediction IS NULL) AS missed1 FROM scored""",
    "per_class": """
SELECT tn, tp, tn / (tn + fn) AS p0, tn / n0 AS r0, tp / (tp + fp) AS p1, tp / n1 AS r1, n0, n1, n0 + n1 AS n
FROM cells, (SELECT count(*) FILTER (NOT target_top_10) AS n0,
  count(*) FILTER (target_top_10) AS n1 FROM scored)""",
    "per_class_f": """
SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM per_class""",
    "report": """
SELECT 'false' AS label, p0 AS "precision", r0 AS recall, f0 AS f1, n0 AS support FROM per_class_f
UNION ALL SELECT 'true', p1, r1, f1, n1 FROM per_class_f
UNION ALL SELECT 'accuracy', (tn + tp) / n, (tn + tp) / n, (tn + tp) / n, n FROM per_class_f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM per_class_f
UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n,
  (f0 * n0 + f1 * n1) / n, n FROM per_class_f""",
    "counts": """
SELECT top10_probability AS score, sum(target_top_10::INT) AS pos,
  sum((NOT target_top_10)::INT) AS neg FROM scored GROUP BY 1""",
    "below": """
SELECT *, coalesce(sum(pos) OVER w, 0) AS pos_below, coalesce(sum(neg) OVER w, 0) AS neg_below,
  count(*) OVER w AS place
FROM counts WINDOW w AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "totals": "SELECT sum(pos) AS p, sum(neg) AS n, count(*) AS points FROM counts",
    "curve": """
SELECT place, score AS threshold,
  (p - pos_below)::DOUBLE / (p - pos_below + n - neg_below) AS "precision",
  (p - pos_below)::DOUBLE / p AS recall FROM below, totals""",
    "area": """
SELECT sum(pos::DOUBLE * (neg_below + neg / 2.0)) / (max(p)::DOUBLE * max(n)) AS roc_auc
FROM below, totals""",
    "loss": """
SELECT avg(-ln(CASE WHEN target_top_10 THEN q ELSE 1 - q END)) AS log_loss
FROM (SELECT target_top_10, least(greatest(top10_probability, 2.220446049250313e-16),
  1 - 2.220446049250313e-16) AS q FROM scored
  WHERE top10_probability IS NOT NULL AND target_top_10 IS NOT NULL)""",
    "numbers": f"""
SELECT split, {', '.join(f'{c}::DOUBLE AS {c}' for c in NUMERIC_FEATURES)} FROM splits""",
    "long_numbers": f"""
SELECT split, feature, value FROM (UNPIVOT numbers ON {', '.join(NUMERIC_FEATURES)}
  INTO NAME feature VALUE value)""",
    "drift_counts": """
SELECT feature, value, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'test') AS b
FROM long_numbers WHERE split IN ('train', 'test') GROUP BY feature, value""",
    "drift_steps": """
SELECT feature, value, abs(sum(a) OVER w / sum(a) OVER f - sum(b) OVER w / sum(b) OVER f) AS gap,
  lead(value) OVER w - value AS width
FROM drift_counts WINDOW w AS (PARTITION BY feature ORDER BY value), f AS (PARTITION BY feature)""",
    "flag_shares": """
SELECT feature, value, count(*) FILTER (split = 'train')
    / sum(count(*) FILTER (split = 'train')) OVER (PARTITION BY feature) AS p,
  count(*) FILTER (split = 'test')
    / sum(count(*) FILTER (split = 'test')) OVER (PARTITION BY feature) AS q
FROM (SELECT split, 'started_top_5' AS feature, started_top_5 AS value FROM splits
  UNION ALL SELECT split, 'started_top_10', started_top_10 FROM splits)
WHERE split IN ('train', 'test') GROUP BY feature, value""",
    "drift": """
SELECT feature, 'ks' AS score_name, max(gap) AS score, max(gap) > 0.1 AS drifted
FROM drift_steps GROUP BY feature
UNION ALL
SELECT feature, 'js', sqrt(greatest(d, 0)), sqrt(greatest(d, 0)) > 0.1 FROM (
  SELECT feature, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS d
  FROM flag_shares GROUP BY feature)""",
}



def _variant(suffix: str, base: str, block: str, of: Iterable[str] | None = None) -> None:
    """A second set of the blocks that depend on ``base``, made from another block instead."""
    names = {base}
    while True:
        pattern = re.compile(r"\b(" + "|".join(names) + r")\b")
        more = {n for n, text in CTES.items() if pattern.search(text) and (of is None or n in of)} - names
        if not more:
            break
        names |= more
    CTES[f"{base}_{suffix}"] = block
    # in their order, as a block may only use earlier ones
    for name in [n for n in CTES if n in names - {base}]:
        CTES[f"{name}_{suffix}"] = pattern.sub(rf"\1_{suffix}", CTES[name])


# the reports of the other model, by the names of the first one
_variant("dnf", "scored", """
SELECT target_dnf AS target_top_10, dnf_prediction AS top10_prediction, dnf_probability AS top10_probability FROM scored""")
# features from the rows of the first years alone
_variant("early", "enriched", "SELECT * FROM enriched WHERE year <= 1997", list(CTES))
_NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def sql(final: str) -> str:
    """``final`` preceded by the building blocks it needs."""
    needed, todo = set(), [final]
    while todo:
        for name in _NAMES.findall(todo.pop()):
            if name not in needed:
                needed.add(name)
                todo.append(CTES[name])
    parts = [f"{name} AS ({body})" for name, body in CTES.items() if name in needed]
    return f"WITH {', '.join(parts)} {final}" if parts else final


# delivered table name -> building block with the staged columns
_STAGED = {
    "races": "races", "results": "results", "qualifying": "qualifying", "drivers": "drivers",
    "constructors": "constructors", "circuits": "circuits", "status": "statuses",
}

_DRIVER_FORM = (
    "result_id, driver_top10_rate_recent, driver_dnf_rate_recent, driver_avg_points_recent, "
    "driver_avg_positions_gained_recent, driver_races_in_window"
)
_TEAM_FORM = (
    "result_id, constructor_top10_rate_recent, constructor_dnf_rate_recent, "
    "constructor_avg_points_recent"
)
_VISIT_FORM = (
    "result_id, driver_top10_rate_at_circuit, driver_dnf_rate_at_circuit, driver_races_at_circuit"
)
_VIEWS = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders "
    "pages part region supplier"
).split()
_PANEL = """
SELECT *, CASE WHEN dnf_probability > 0.5 THEN 'DNF' WHEN top10_probability > 0.5 THEN 'Top-10'
  ELSE 'Outside Top-10' END AS final_prediction FROM scored"""


def _right(prediction: str, actual: str) -> str:
    return f"avg(coalesce({prediction} = {actual}, false)::INT)"


_ACCURACY = (
    f"{_right('top10_prediction', 'target_top_10')} AS top10_accuracy, "
    f"{_right('dnf_prediction', 'target_dnf')} AS dnf_accuracy"
)


def _race_measures(top: str, dnf: str) -> str:
    return (
        f"count(*) AS drivers, count(*) FILTER ({top}) AS predicted_top10, "
        f"count(*) FILTER ({dnf}) AS predicted_dnf, "
        "round(avg(dnf_probability), 9) AS avg_dnf_probability, "
        f"{_right(top, 'target_top_10')} AS top10_accuracy, "
        f"{_right(dnf, 'target_dnf')} AS dnf_accuracy"
    )


def _counts_of(views: list[str], label: str) -> str:
    return " UNION ALL ".join(
        f"SELECT 'raw_{v}' AS {label}, count(*) AS n_rows FROM {v}" for v in views
    )


_ALL_FEATURES = (*NUMERIC_FEATURES, "started_top_5", "started_top_10")


def _imputed() -> str:
    medians = ", ".join(f"quantile_cont({c}::INT::DOUBLE, 0.5) AS m_{c}" if c.startswith("started")
                        else f"quantile_cont({c}::DOUBLE, 0.5) AS m_{c}" for c in _ALL_FEATURES)
    values = ", ".join(f"coalesce({_number(c)}, m_{c}) AS {c}" for c in _ALL_FEATURES)
    return (
        f"SELECT result_id, {values} FROM splits, "
        f"(SELECT {medians} FROM splits WHERE split = 'train') WHERE split = 'train'"
    )


def _number(c: str) -> str:
    return f"{c}::INT::DOUBLE" if c.startswith("started") else f"{c}::DOUBLE"


def _standardized() -> str:
    numbers = ", ".join(
        f"avg({_number(c)}) AS m_{c}, stddev_pop({_number(c)}) AS s_{c}" for c in _ALL_FEATURES
    )
    values = ", ".join(
        f"round(({_number(c)} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) AS {c}"
        for c in _ALL_FEATURES
    )
    return (
        f"SELECT result_id, {values} FROM splits, "
        f"(SELECT {numbers} FROM splits WHERE split = 'train') WHERE split = 'train'"
    )


# model -> block that holds it
_MODELS = {f"stg_{t}": block for t, block in _STAGED.items()} | {
    "stg_seasons": "(SELECT DISTINCT year(o_orderdate) AS year FROM orders)",
    "int_results_enriched": "enriched", "int_qualifying_clean": "qclean",
    "dim_driver": "driver_dim", "dim_constructor": "team_dim", "dim_circuit": "circuit_dim",
    "dim_race": "race_dim", "fct_results": "fact", "fct_qualifying": "qclean",
    "fct_features_pre_race": "features",
}


def _declared() -> str:
    parts = []
    for model, (key, present, relations) in DECLARED.items():
        block = _MODELS[model]
        parts.append(
            f"SELECT '{model}' AS model, '{key}' AS \"column\", 'unique' AS test, count(*) AS failures "
            f"FROM (SELECT {key} FROM {block} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
        )
        parts += [
            f"SELECT '{model}', '{c}', 'not_null', count(*) - count({c}) FROM {block}" for c in present
        ]
        parts += [
            f"SELECT '{model}', '{c}', 'in {parent}', count(*) FROM {block} WHERE {c} IS NOT NULL "
            f"AND {c} NOT IN (SELECT {k} FROM {_MODELS[parent]} WHERE {k} IS NOT NULL)"
            for c, parent, k in relations
        ]
    return " UNION ALL ".join(parts)


# table -> (number of rows, columns), as the raw lake is bound
_RAW = {
    "races": ("orders", 7), "drivers": ("supplier", 8), "constructors": ("nation", 4),
    "circuits": ("customer", 8), "results": ("results", 18), "qualifying": ("qualifying", 9),
    "status": ("(SELECT unnest([1, 2, 3]) AS i)", 2),
    "seasons": ("(SELECT DISTINCT year(o_orderdate) FROM orders)", 2),
}


def _lake_check(missing: str | None = None, table_without: str | None = None, column: str = "") -> str:
    parts = []
    for name, (block, _) in _RAW.items():
        there, whole = name != missing, name != table_without
        parts.append(
            f"SELECT '{name}' AS \"table\", {name != 'seasons'} AS required, {there} AS present, "
            f"{there and whole} AS ok, {repr('' if whole else column) if there else 'NULL'} AS missing, "
            f"{'count(*)' if there else 'NULL'} AS n_rows FROM {block if there else '(SELECT 1)'}"
        )
    return " UNION ALL ".join(parts)


def _conversions(extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", true AS ok, count(*) AS n_rows, {n} AS n_columns{extra} FROM {block}"
        for name, (block, n) in _RAW.items()
    )


def _boxes() -> str:
    shares = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    columns = ", ".join(
        f'round(quantile_cont(value, {p}), 9) AS "{name}"' for name, p in shares.items()
    )
    return f"SELECT feature, {columns} FROM all_numbers GROUP BY feature"


CTES["all_plain"] = (
    f"SELECT {', '.join(f'{c}::DOUBLE AS {c}' for c in NUMERIC_FEATURES)} FROM features"
)
CTES["all_numbers"] = (
    f"SELECT feature, value FROM (UNPIVOT all_plain ON {', '.join(NUMERIC_FEATURES)} "
    "INTO NAME feature VALUE value)"
)


def _variant(suffix: str, base: str, block: str, of: Iterable[str] | None = None) -> None:
    """A second set of the blocks that depend on ``base``, made from another block instead."""
    names = {base}
    while True:
        pattern = re.compile(r"\b(" + "|".join(names) + r")\b")
        more = {n for n, text in CTES.items() if pattern.search(text) and (of is None or n in of)} - names
        if not more:
            break
        names |= more
    CTES[f"{base}_{suffix}"] = block
    # in their order, as a block may only use earlier ones
    for name in [n for n in CTES if n in names - {base}]:
        CTES[f"{name}_{suffix}"] = pattern.sub(rf"\1_{suffix}", CTES[name])


# the reports of the other model, by the names of the first one
_variant("dnf", "scored", """
SELECT target_dnf AS target_top_10, dnf_prediction AS top10_prediction, dnf_probability AS top10_probability FROM scored""")
# features from the rows of the first years alone
_variant("early", "enriched", "SELECT * FROM enriched WHERE year <= 1997", list(CTES))
_NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def _row(table: str, values: str, source: str) -> str:
    """Rows as text: the values of the columns in the order of their names."""
    cells = ", ".join(f"coalesce(({v})::VARCHAR, '-')" for v in values.split("; "))
    return f"SELECT '{table}' AS \"table\", concat_ws('|', {cells}) AS row FROM {source}"


_TIMED = "printf('1:%d.%03d', place + {0}, place)"
SYNTH_TABLES = (
    """
WITH n AS (SELECT greatest(1, count(*) // 10) AS step FROM supplier
), e AS (SELECT o_orderkey AS race, s_suppkey AS driver, s_nationkey AS team, s_suppkey // step + 1 AS place,
    o_orderkey * 100 + s_suppkey // step + 1 AS id FROM orders JOIN (SELECT * FROM supplier, n) ON o_orderkey % step = s_suppkey % step
), r AS (SELECT *, place > 8 AND (place + race) % 3 = 0 AS out FROM e)
"""
    + " UNION ALL ".join(
        [
            _row("races", "o_custkey; strftime(o_orderdate, '%Y-%m-%d'); 'Race ' || o_orderkey; o_orderkey; "
                 "dayofyear(o_orderdate); o_orderpriority; year(o_orderdate)", "orders"),
            _row("drivers", "CASE WHEN s_acctbal > 0 THEN right(s_name, 3) END; NULL; s_suppkey; s_name; "
                 "split_part(s_name, '#', 1); 'NATION_' || s_nationkey; (s_suppkey % 100)::DOUBLE; "
                 "CASE WHEN s_acctbal > 0 THEN split_part(s_name, '#', 2) END", "supplier"),
            _row("constructors", "n_nationkey; lower(n_name); n_name; 'REGION_' || n_regionkey", "nation"),
            _row("circuits", "NULL; c_custkey; lower(c_name); 'NATION_' || c_nationkey; c_acctbal; c_nationkey::DOUBLE; "
                 "c_mktsegment; c_name", "customer"),
            _row("seasons", "'season/' || y; y", "(SELECT DISTINCT year(o_orderdate) AS y FROM orders)"),
            _row("status", "t; i", "(VALUES (1, 'Finished'), (2, '+1 Lap'), (3, 'Accident'), (4, 'Collision'), (5, 'Engine')) AS s(i, t)"),
            _row("qualifying", f"team; driver; place; place; {_TIMED.format(20)}; CASE WHEN place <= 15 THEN {_TIMED.format(19)} END; "
                 f"CASE WHEN place <= 10 THEN {_TIMED.format(18)} END; id; race", "r"),
            _row("results", f"team; driver; CASE WHEN NOT out THEN place END; CASE WHEN NOT out THEN 200 - place END; "
                 f"CASE WHEN NOT out THEN {_TIMED.format(25)} END; place; CASE WHEN out THEN 5 * place ELSE 50 END; "
                 "CASE WHEN NOT out THEN (place + 90) * 60000 END; place; "
                 "CASE WHEN NOT out AND place <= 10 THEN greatest(26 - 2 * place, 0) ELSE 0 END; "
                 "CASE WHEN NOT out THEN place END; place; CASE WHEN out THEN 'R' ELSE place::VARCHAR END; race; "
                 "CASE WHEN NOT out THEN place END; id; CASE WHEN out THEN 3 ELSE 1 END; "
                 "CASE WHEN NOT out THEN printf('1:%d:%02d.%03d', place + 30, place, place) END", "r"),
        ]
    )
)

RAW_RESULTS = """
SELECT result_id AS resultId, race_id AS raceId, driver_id AS driverId,
  constructor_id AS constructorId, driver_number AS number, grid_position AS grid,
  finish_position AS position, finish_position_text AS positionText,
  finish_position_order AS positionOrder, points, laps, finish_time AS time,
  finish_time_ms AS milliseconds, fastest_lap AS fastestLap, fastest_lap_rank AS rank,
  fastest_lap_time AS fastestLapTime, fastest_lap_speed AS fastestLapSpeed,
  status_id AS statusId FROM results"""


def _evaluation(model: str, suffix: str = "") -> str:
    report, cells, scored, curve, totals = (f"{n}{suffix}" for n in ("report", "cells", "scored", "curve", "totals"))
    return f"""
SELECT '{model}' AS model, section, name, round(value, 9) AS value FROM (
SELECT 'report' AS section, label || ' precision' AS name, "precision" AS value FROM {report}
UNION ALL SELECT 'report', label || ' recall', recall FROM {report}
UNION ALL SELECT 'report', label || ' f1', f1 FROM {report}
UNION ALL SELECT 'report', label || ' support', support FROM {report}
UNION ALL SELECT 'confusion', 'actual false predicted false', tn FROM {cells}
UNION ALL SELECT 'confusion', 'actual false predicted true', fp FROM {cells}
UNION ALL SELECT 'confusion', 'actual true predicted false', fn FROM {cells}
UNION ALL SELECT 'confusion', 'actual true predicted true', tp FROM {cells}
UNION ALL SELECT 'confusion', 'actual false predicted missing', missed0 FROM {cells}
UNION ALL SELECT 'confusion', 'actual true predicted missing', missed1 FROM {cells}
UNION ALL SELECT 'curve', 'precision', count(*) FILTER (target_top_10) / count(*) FROM {scored}
  WHERE top10_probability >= 0.3
UNION ALL SELECT 'curve', 'recall', count(*) FILTER (top10_probability >= 0.3) / count(*) FROM {scored}
  WHERE target_top_10
UNION ALL SELECT 'curve', 'middle precision', "precision" FROM {curve}, {totals} WHERE place = (points + 1) // 2
UNION ALL SELECT 'curve', 'middle recall', recall FROM {curve}, {totals} WHERE place = (points + 1) // 2)"""


def _leakage() -> str:
    """Values of the early rows that change once the later years are known."""
    features = [c for c in _ALL_FEATURES if c not in ("grid_position", "qualifying_position")]
    return " UNION ALL ".join(
        f"SELECT '{variant}' AS variant, count(*) AS n_rows, '{c}' AS feature, "
        f"count(*) FILTER (a.{c} IS DISTINCT FROM b.{c}) AS changed FROM {block}_early a JOIN {block} b USING (result_id)"
        for variant, block in (("published", "features"), ("strict", "strict_features"))
        for c in features
    )


def _catalog_statistics() -> str:
    """Table, column, whether its ends are whole numbers."""
    columns = {
        "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
        "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
        "supplier": "s_suppkey s_name s_nationkey s_acctbal",
        "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
        "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
        "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                    "l_returnflag l_linestatus l_shipdate",
        "events": "event_id ts user_id event_type value props", "documents": "doc_id text lang source n_chars",
        "embeddings": "vec_id label", "pages": "page_id url html", "benchmark": "item_id text",
        "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
    }
    whole = (
        "r_regionkey n_nationkey n_regionkey c_custkey c_nationkey s_suppkey s_nationkey p_partkey p_size o_orderkey "
        "o_custkey l_orderkey l_partkey l_suppkey l_linenumber event_id user_id doc_id n_chars vec_id label page_id "
        "item_id quality toxic conv_id turn"
    ).split()
    return " UNION ALL ".join(
        f"SELECT 'raw_{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
        + (f"min({c})::BIGINT AS min_value, max({c})::BIGINT AS max_value" if c in whole else "NULL::BIGINT, NULL::BIGINT")
        + f" FROM {table}"
        for table, names in columns.items()
        for c in names.split()
    )


def all_sql() -> dict[str, str]:
    finals = {f"stg_{t}": f"SELECT * FROM {block}" for t, block in _STAGED.items()}
    finals |= {
        "stg_seasons": "SELECT DISTINCT year(o_orderdate)::INT AS year FROM orders",
        "int_results_enriched": "SELECT * FROM enriched",
        "int_qualifying_clean": "SELECT * FROM qclean",
        "fct_results": "SELECT * FROM fact",
        "fct_qualifying": f"""
SELECT qualify_id, race_id, driver_id, constructor_id, circuit_id, year, round, qualifying_position,
  q1, q2, q3, best_qualifying_time, completed_q1, completed_q2, completed_q3,
  qualifying_position = 1 AS is_pole_position, qualifying_position <= 3 AS is_top_3,
  qualifying_position <= {K} AS is_top_10 FROM qclean""",
        "dim_driver": "SELECT * FROM driver_dim",
        "dim_constructor": "SELECT * FROM team_dim",
        "dim_circuit": "SELECT * FROM circuit_dim",
        "dim_race": "SELECT * FROM race_dim",
        "cond_count_distinct":
            "SELECT driver_id, total_races AS races, wins, podiums FROM driver_career",
        "guarded_rate": f"""
SELECT o_orderkey, {rate('coalesce(returned, 0)', 'coalesce(n, 0)')} AS rate FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS returned
  FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
        "dnf_flag": """
SELECT l_returnflag, l_linestatus, NOT (l_linestatus = 'F' AND l_returnflag IN ('N', 'A')) AS is_dnf,
  count(*) AS n_rows FROM lineitem GROUP BY ALL""",
        "topk_flags": """
SELECT result_id, coalesce(finish_position = 1, false) AS is_win,
  coalesce(finish_position <= 3, false) AS is_podium,
  coalesce(finish_position <= 10, false) AS is_top_10 FROM results""",
        "presence_flags": """
SELECT qualify_id, q1 IS NOT NULL AS completed_q1, q2 IS NOT NULL AS completed_q2,
  q3 IS NOT NULL AS completed_q3 FROM qualifying""",
        "grid_flags": """
SELECT result_id, coalesce(nullif(grid_position - 1, 7) <= 5, false) AS started_top_5,
  coalesce(nullif(grid_position - 1, 7) <= 10, false) AS started_top_10 FROM results""",
        "coalesce_best_time":
            "SELECT qualify_id, coalesce(q3, q2, q1) AS best_qualifying_time FROM qualifying",
        "positions_gained":
            "SELECT result_id, finish_position - grid_position AS positions_gained FROM results",
        "label_summary": """
SELECT result_id, CASE WHEN top10_prediction THEN 'TOP-10' WHEN dnf_prediction THEN 'DNF'
  ELSE '11th-20th' END AS label FROM scored""",
        "label_panel": f"""
SELECT result_id, final_prediction, final_prediction = 'Top-10' AS top10_prediction,
  final_prediction = 'DNF' AS dnf_prediction FROM ({_PANEL})""",
        "prerace_base": """
SELECT r.result_id, r.race_id, r.driver_id, r.constructor_id, r.circuit_id, r.year, r.round,
  q.qualifying_position, q.q1, q.q2, q.q3, r.grid_position, r.is_top_10 AS target_top_10,
  r.is_dnf AS target_dnf, d.race_date FROM fact r
LEFT JOIN qclean q ON q.race_id = r.race_id AND q.driver_id = r.driver_id
JOIN race_dim d ON d.race_id = r.race_id""",
        "win_driver_form": f"SELECT {_DRIVER_FORM} FROM driver_form",
        "win_constructor_form": f"SELECT {_TEAM_FORM} FROM team_form",
        "win_driver_circuit": f"SELECT {_VISIT_FORM} FROM visit_form",
        "fct_features_pre_race": "SELECT * FROM features",
        "features_strict": "SELECT * FROM strict_features",
        "career_asof": f"""
SELECT driver_id, race_id, e_races AS career_races,
  {rate('coalesce(e_top, 0)', 'e_races')} AS career_top10_rate,
  {rate('coalesce(e_dnf, 0)', 'e_races')} AS career_dnf_rate,
  coalesce(e_won, 0)::BIGINT AS career_wins FROM driver_past""",
        "constructor_form_strict": """
SELECT result_id, r_top / r_n AS constructor_top10_rate_recent,
  r_dnf / r_n10 AS constructor_dnf_rate_recent, r_points / r_n AS constructor_avg_points_recent
FROM enriched e JOIN team_past t ON t.constructor_id = e.constructor_id AND t.race_id = e.race_id""",
        "temporal_split": "SELECT result_id, year, split FROM splits",
        "filter_race": """
SELECT * FROM features WHERE race_id = (SELECT race_id FROM features WHERE year = 1998
  GROUP BY race_id ORDER BY count(*) DESC, race_id LIMIT 1)""",
        "filter_years": "SELECT * FROM features WHERE year IN (2000, 2001)",
        "union_splits": "SELECT result_id, year, target_top_10 FROM splits",
        "split_distribution": """
SELECT split, count(*) AS n_rows, min(year) AS first_year, max(year) AS last_year,
  count(*) FILTER (target_top_10) AS target_top_10_positive,
  count(*) FILTER (NOT target_top_10) AS target_top_10_negative,
  avg(target_top_10::INT) * 100 AS target_top_10_pct,
  count(*) FILTER (target_dnf) AS target_dnf_positive,
  count(*) FILTER (NOT target_dnf) AS target_dnf_negative,
  avg(target_dnf::INT) * 100 AS target_dnf_pct FROM splits GROUP BY split""",
        "split_stats": """
SELECT split, count(*) AS samples, min(year) || '-' || max(year) AS years
FROM splits GROUP BY split""",
        "accuracy": f"SELECT {_ACCURACY} FROM scored",
        "accuracy_by_year":
            f"SELECT year, {_ACCURACY}, count(*) AS samples FROM scored GROUP BY year",
        "confusion_matrix": """
SELECT false AS actual, false AS predicted, tn AS n_rows FROM cells
UNION ALL SELECT false, true, fp FROM cells UNION ALL SELECT true, false, fn FROM cells
UNION ALL SELECT true, true, tp FROM cells UNION ALL SELECT false, NULL, missed0 FROM cells
UNION ALL SELECT true, NULL, missed1 FROM cells""",
        "classification_report": "SELECT * FROM report",
        "roc_auc": "SELECT round(roc_auc, 9) AS roc_auc FROM area",
        "log_loss": "SELECT round(log_loss, 9) AS log_loss FROM loss",
        "metrics_single_class": f"""
SELECT {_right('top10_prediction', 'target_top_10')} AS accuracy, 1.0::DOUBLE AS roc_auc,
  0.0::DOUBLE AS log_loss, count(*) AS n_rows FROM scored WHERE target_top_10""",
        "pr_curve": 'SELECT threshold, "precision", recall FROM curve',
        "pr_at_threshold": """
SELECT tp / (tp + fp) AS "precision", tp / (tp + fn) AS recall,
  (SELECT "precision" FROM curve, totals WHERE place = (points + 1) // 2) AS middle_precision,
  (SELECT recall FROM curve, totals WHERE place = (points + 1) // 2) AS middle_recall
FROM (SELECT count(*) FILTER (target_top_10 AND top10_probability >= 0.3) AS tp,
  count(*) FILTER (NOT target_top_10 AND top10_probability >= 0.3) AS fp,
  count(*) FILTER (target_top_10 AND top10_probability < 0.3) AS fn FROM scored)""",
        "report_classification": f"""
SELECT section, name, round(value, 9) AS value FROM (
SELECT 'overall' AS section, 'accuracy' AS name,
  {_right('top10_prediction', 'target_top_10')} AS value FROM scored
UNION ALL SELECT 'overall', 'roc_auc', roc_auc FROM area
UNION ALL SELECT 'overall', 'log_loss', log_loss FROM loss
UNION ALL SELECT 'per class', label || ' precision', "precision" FROM report
UNION ALL SELECT 'per class', label || ' recall', recall FROM report
UNION ALL SELECT 'per class', label || ' f1', f1 FROM report
UNION ALL SELECT 'confusion', 'actual false predicted false', tn FROM cells
UNION ALL SELECT 'confusion', 'actual false predicted true', fp FROM cells
UNION ALL SELECT 'confusion', 'actual true predicted false', fn FROM cells
UNION ALL SELECT 'confusion', 'actual true predicted true', tp FROM cells
UNION ALL SELECT 'confusion', 'actual false predicted missing', missed0 FROM cells
UNION ALL SELECT 'confusion', 'actual true predicted missing', missed1 FROM cells
UNION ALL SELECT 'probability', 'bin ' || least(floor(top10_probability * 10)::INT, 9), count(*)
  FROM scored GROUP BY 2)""",
        "evaluation_report": _evaluation("top10") + " UNION ALL " + _evaluation("dnf", "_dnf"),
        "drift_with_targets": """
SELECT feature, score_name, round(score, 9) AS score, drifted FROM drift
UNION ALL
SELECT feature, 'js', round(sqrt(greatest(d, 0)), 9), sqrt(greatest(d, 0)) > 0.1 FROM (
  SELECT feature, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS d FROM (
    SELECT feature, value,
      count(*) FILTER (split = 'train') / sum(count(*) FILTER (split = 'train')) OVER (PARTITION BY feature) AS p,
      count(*) FILTER (split = 'test') / sum(count(*) FILTER (split = 'test')) OVER (PARTITION BY feature) AS q
    FROM (SELECT split, 'target_top_10' AS feature, target_top_10 AS value FROM splits
      UNION ALL SELECT split, 'target_dnf', target_dnf FROM splits)
    WHERE split IN ('train', 'test') GROUP BY feature, value) GROUP BY feature)""",
        "drift_ks":
            "SELECT feature, round(max(gap), 9) AS ks FROM drift_steps GROUP BY feature",
        "drift_wasserstein": """
SELECT feature, round(coalesce(sum(gap * width), 0), 6) AS wasserstein
FROM drift_steps GROUP BY feature""",
        "drift_distances": """
SELECT feature, round(max(gap), 9) AS ks, round(coalesce(sum(gap * width), 0), 6) AS wasserstein
FROM drift_steps GROUP BY feature""",
        "drift_js":
            "SELECT feature, round(score, 9) AS js FROM drift WHERE score_name = 'js'",
        "drift_summary": """
SELECT count(*) AS features, count(*) FILTER (drifted) AS drifted_features,
  avg(drifted::INT) AS drifted_share, avg(drifted::INT) >= 0.5 AS dataset_drift FROM drift""",
        "dq_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
        "dq_not_null": "SELECT column_name, nulls FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM results"
            for c in (
                "result_id race_id driver_id constructor_id status_id driver_number grid_position "
                "finish_position finish_position_text finish_position_order points laps finish_time "
                "finish_time_ms fastest_lap fastest_lap_rank fastest_lap_time fastest_lap_speed"
            ).split()
        ) + ")",
        "dq_relationships": """
SELECT 'orders.o_orderkey' AS relation, o_orderkey AS key FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'documents.doc_id', doc_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "key_containment": """
SELECT 'lineitem in orders' AS relation, count(*) AS child_keys, count(o_orderkey) AS found,
  count(*) - count(o_orderkey) AS not_found
FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN orders ON o_orderkey = l_orderkey
UNION ALL SELECT 'orders in lineitem', count(*), count(l_orderkey), count(*) - count(l_orderkey)
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey""",
        "dq_feature_contract": """
SELECT 'features' AS "table", 'key_missing' AS "check", count(*) FILTER (result_id IS NULL) AS failures FROM features
UNION ALL SELECT 'features', 'key_repeated', count(*) - count(DISTINCT result_id) FROM features
UNION ALL SELECT 'features', 'forbidden_name', 0 UNION ALL SELECT 'features', 'not_numeric', 0
UNION ALL SELECT 'broken', 'key_missing', count(*) FROM features WHERE year = 1999
UNION ALL SELECT 'broken', 'key_repeated', count(*) FROM features WHERE year = 1998
UNION ALL SELECT 'broken', 'forbidden_name', 1 UNION ALL SELECT 'broken', 'not_numeric', 1""",
        "first_per_group": """
SELECT year, round, arg_min(race_id, result_id) AS race_id,
  arg_min(circuit_id, result_id) AS circuit_id FROM features GROUP BY year, round""",
        "race_labels": """
SELECT *, circuit_label || ' (' || race_label || ')' AS label FROM (
SELECT f.race_id, f.circuit_id, f.round, coalesce(c.circuit_name, 'Circuit ' || f.circuit_id)
    AS circuit_label, coalesce(n.race_name, 'Round ' || f.round) AS race_label
FROM (SELECT DISTINCT race_id, circuit_id, round FROM features) f
LEFT JOIN races n ON n.race_id = f.race_id AND n.race_time NOT LIKE '1%'
LEFT JOIN circuits c ON c.circuit_id = f.circuit_id AND c.latitude > 0)""",
        "race_selector": """
SELECT f.year, f.round, f.race_id, f.circuit_id, c.circuit_name AS circuit_label,
  n.race_name AS race_label, c.circuit_name || ' (' || n.race_name || ')' AS label
FROM (SELECT year, round, arg_min(race_id, result_id) AS race_id,
    arg_min(circuit_id, result_id) AS circuit_id FROM features WHERE year = 2000
  GROUP BY year, round) f
JOIN races n ON n.race_id = f.race_id JOIN circuits c ON c.circuit_id = f.circuit_id""",
        "race_summary": f"""
SELECT race_id, year, round, {_race_measures('top10_prediction', 'dnf_prediction')},
  round(avg(top10_probability), 9) AS avg_top10_probability FROM scored GROUP BY race_id, year, round""",
        "race_panel": f"""
SELECT race_id, {_race_measures("(final_prediction = 'Top-10')", "(final_prediction = 'DNF')")}
FROM ({_PANEL}) GROUP BY race_id""",
        "topk_per_race": """
SELECT race_id, rank, driver_id, top10_probability FROM (SELECT *, row_number()
  OVER (PARTITION BY race_id ORDER BY top10_probability DESC, driver_id) AS rank FROM scored)
WHERE rank <= 3""",
        "topk_global": """
SELECT race_id, driver_id, dnf_probability FROM scored
ORDER BY dnf_probability DESC, race_id, driver_id LIMIT 10""",
        "sort_grid": """
SELECT result_id, grid_position, row_number() OVER (ORDER BY grid_position NULLS LAST, result_id) AS position
FROM features""",
        "distinct_years": "SELECT DISTINCT year FROM features ORDER BY year DESC",
        "yearly_trend": """
SELECT year, avg(target_top_10::INT) AS top10_rate, avg(target_dnf::INT) AS dnf_rate,
  count(*) AS samples FROM features GROUP BY year""",
        "dataset_overview": """
SELECT count(DISTINCT race_id) AS races, count(*) AS results,
  min(year) || '-' || max(year) AS years, (SELECT count(*) FROM supplier) AS drivers
FROM features""",
        "dim_extracts": """
SELECT 'driver' AS dimension, driver_id AS id, full_name AS name, nationality AS detail FROM drivers
UNION ALL SELECT 'circuit', circuit_id, circuit_name, location || '|' || country FROM circuits
UNION ALL SELECT 'race', race_id, race_name, year || '|' || round || '|' || circuit_id FROM races""",
        "feature_histogram": """
SELECT feature, bin, lo + bin * width AS bin_start, count(*) AS n_rows FROM (
SELECT feature, lo, width, least(floor((value - lo) / width)::INT, 29) AS bin FROM all_numbers
JOIN (SELECT feature, min(value) AS lo, CASE WHEN max(value) > min(value) THEN (max(value) - min(value)) / 30 ELSE 1 END AS width
  FROM all_numbers GROUP BY feature) USING (feature)) GROUP BY feature, bin, lo, width""",
        "feature_box": _boxes(),
        "impute_median": _imputed(),
        "standardize": _standardized(),
        "class_weights": " UNION ALL ".join(
            f"SELECT '{t}' AS target, {t} AS label, count(*) AS n_rows, (SELECT count(*) FROM splits "
            f"WHERE split = 'train') / (2 * count(*)) AS weight FROM splits WHERE split = 'train' GROUP BY 2"
            for t in ("target_top_10", "target_dnf")
        ),
        "dq_leakage": _leakage(),
        "lake_statistics": _catalog_statistics(),
        "io_quarantine": """
SELECT driver_id % 7 AS kind, CASE driver_id % 7 WHEN 3 THEN '19 fields' WHEN 5 THEN '17 fields' ELSE 'kept' END AS what,
  count(*) AS n_rows, (SELECT count(*) FROM results) AS n_read FROM results GROUP BY 1, 2""",
        "score_filtered_rules": """
SELECT result_id, year, true AS top10_holds, true AS dnf_holds FROM features WHERE year = 1999""",
        "score_from_csv_rules": " UNION ALL ".join(
            f"SELECT count(*) AS n_rows, '{c}' AS feature, 0 AS changed FROM splits WHERE split = 'test'"
            for c in ("top10_probability", "top10_prediction", "dnf_probability", "dnf_prediction")
        ),
        "sink_per_race_again": """
SELECT * REPLACE (CASE WHEN year = 2000 THEN 0.0 ELSE top10_probability END AS top10_probability)
FROM scored WHERE year IN (2000, 2001)""",
        "sink_all_predictions": "SELECT * FROM scored WHERE year IN (2000, 2001)",
        "io_csv_scan": RAW_RESULTS,
        "io_typed_cast": RAW_RESULTS,
        "io_parquet_roundtrip": RAW_RESULTS,
        "io_convert_all": _conversions(),
        "io_convert_stats": _conversions(
            ", NULL AS error, true AS has_sizes, true AS compression_holds"
        ),
        "dq_declared": _declared(),
        "dq_required_columns": _lake_check(),
        "dq_lake_schema": _lake_check("status", "results", "points"),
        "model_roundtrip": """
SELECT 'top10_probability' AS feature, count(*) AS n_rows, 0 AS changed FROM splits WHERE split = 'test'
UNION ALL SELECT 'dnf_probability', count(*), 0 FROM splits WHERE split = 'test'""",
        "score_rules": """
SELECT result_id, true AS top10_holds, true AS dnf_holds FROM splits WHERE split = 'test'""",
        "race_prediction_table": f"""
SELECT coalesce(d.full_name, p.driver_id::VARCHAR) AS "Driver", p.grid_position AS "Grid Pos",
  p.qualifying_position AS "Quali Pos", p.top10_probability AS "Top-10 Prob",
  p.dnf_probability AS "DNF Prob", p.final_prediction AS "Prediction"
FROM ({_PANEL}) p LEFT JOIN drivers d ON d.driver_id = p.driver_id WHERE p.year IN (2000, 2001)""",
        "run_metrics": f"""
SELECT r.run, m.* EXCLUDE (run) FROM (VALUES ('form baseline'), ('2')) AS r(run), (
SELECT 'form baseline' AS run, 'parameter' AS kind, 'target' AS name, 'target_top_10' AS text, NULL::DOUBLE AS value
UNION ALL SELECT 'form baseline', 'parameter', 'trees', '{TREES}', NULL
UNION ALL SELECT 'form baseline', 'parameter', 'depth', '{DEPTH}', NULL
UNION ALL SELECT 'form baseline', 'metric', 'top10_accuracy', NULL, top10_accuracy FROM (SELECT {_ACCURACY} FROM scored)
UNION ALL SELECT 'form baseline', 'metric', 'dnf_accuracy', NULL, dnf_accuracy FROM (SELECT {_ACCURACY} FROM scored)) m""",
        "lake_register": _counts_of(_VIEWS, "view_name"),
        "lake_inventory": _counts_of(_VIEWS, "table_name"),
        "lake_sql": """
SELECT s_nationkey, count(*) AS n_rows, sum(l_quantity) AS quantity
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_nationkey""",
        "synth_lake": """
SELECT id AS resultId, race AS raceId, p AS driverId, (p - 1) // 2 + 1 AS constructorId,
  p AS number, p AS grid, CASE WHEN NOT out THEN p END AS position,
  CASE WHEN out THEN 'R' ELSE p::VARCHAR END AS positionText, p AS positionOrder,
  CASE WHEN NOT out AND p <= 10 THEN 26 - 2 * p ELSE 0 END AS points,
  CASE WHEN out THEN 5 * p ELSE 50 END AS laps,
  CASE WHEN NOT out THEN printf('1:%d:%02d.%03d', p + 30, p, p) END AS time,
  CASE WHEN NOT out THEN (p + 90) * 60000 END AS milliseconds,
  CASE WHEN NOT out THEN p END AS fastestLap, CASE WHEN NOT out THEN p END AS rank,
  CASE WHEN NOT out THEN printf('1:%d.%03d', p + 25, p) END AS fastestLapTime,
  CASE WHEN NOT out THEN 200 - p END AS fastestLapSpeed,
  CASE WHEN out THEN 3 ELSE 1 END AS statusId, printf('1:%d.%03d', p + 20, p) AS q1,
  CASE WHEN p <= 15 THEN printf('1:%d.%03d', p + 19, p) END AS q2,
  CASE WHEN p <= 10 THEN printf('1:%d.%03d', p + 18, p) END AS q3
FROM (SELECT DISTINCT l_orderkey AS race, 1 + l_suppkey % 20 AS p,
    l_orderkey * 20 + 1 + l_suppkey % 20 AS id,
    (1 + l_suppkey % 20 > 8 AND (1 + l_suppkey % 20 + l_orderkey) % 3 = 0) AS out FROM lineitem)""",
        "sink_splits": "SELECT * FROM splits",
        "sink_predictions": """
SELECT race_id, year, round, driver_id, grid_position, qualifying_position, top10_probability,
  top10_prediction, dnf_probability, dnf_prediction, target_top_10, target_dnf FROM scored""",
        "sink_per_race": "SELECT * FROM scored WHERE year IN (2000, 2001)",
        "predictions_json": """
SELECT race_id, year, round, driver_id, grid_position, qualifying_position, top10_probability,
  top10_prediction, dnf_probability, dnf_prediction, target_top_10, target_dnf, NULL::INT AS broken
FROM scored
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  length('{"race_id":' || race_id || ',"driver_id":' || driver_id) FROM scored WHERE driver_id % 2 = 1""",
        "eval_predictions": """
SELECT target_dnf AS actual, dnf_prediction AS prediction, dnf_probability AS probability,
  count(*) AS n_rows FROM scored GROUP BY ALL""",
    }
    for name in ("win_driver_form", "win_constructor_form", "win_driver_circuit", "roc_auc"):
        finals[f"{name}_chunked"] = finals[name]
    finals["warehouse_features"] = finals["fct_features_pre_race"]
    blocks = {
        "fct_results": "fact", "fct_qualifying": "qclean", "dim_driver": "driver_dim",
        "dim_constructor": "team_dim", "dim_circuit": "circuit_dim", "dim_race": "race_dim",
        "fct_features_pre_race": "features",
    }
    finals["warehouse_build"] = " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, count(*) AS n_rows FROM {block}"
        for mart, block in blocks.items()
    )
    finals["feature_scan_ordered"] = """
SELECT *, row_number() OVER (ORDER BY year, round, race_id, driver_id) AS position FROM features"""
    finals["features_qualifying_last"] = finals["fct_features_pre_race"]
    return {name: sql(final) for name, final in finals.items()} | {"synth_tables": SYNTH_TABLES}
