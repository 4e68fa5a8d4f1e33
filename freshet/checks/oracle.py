"""SQL twins of the registered queries, for an independent engine on the same tables.

Named pieces are assembled into one WITH clause per query. Where an algorithm of the library is not obvious, the twin
uses another one: recursion for the flood duration, edge-crossing parity for spans and points, stage-by-stage outer
joins for the single-shuffle fusion.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}
QUERIES: dict[str, str] = {}


def _with(final: str) -> str:
    """The query with all pieces it names, in order of definition."""
    names = list(CTES)

    def used(text: str) -> set[str]:
        words = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", text))
        return {n for n in names if n in words}

    needed: set[str] = set()
    todo = used(final)
    while todo:
        n = todo.pop()
        if n not in needed:
            needed.add(n)
            todo |= used(CTES[n]) - {n}
    if not needed:
        return final
    # A piece that is used more than once is computed once; recursive ones are anyway.
    texts = [final, *(CTES[n] for n in needed)]

    def hint(n: str) -> str:
        uses = sum(len(re.findall(rf"\b{n}\b", t)) for t in texts)
        return "MATERIALIZED " if uses > 1 and not re.search(rf"\b{n}\b", CTES[n]) else ""

    return "WITH RECURSIVE " + ",\n".join(f"{n} AS {hint(n)}({CTES[n]})" for n in names if n in needed) + "\n" + final


def rnd(expression: str) -> str:
    """Six digits, shifted off the decimal ties that engines round differently."""
    return f"round({expression} + 3e-10, 6) + 0e0"


def r6(*cols: str) -> str:
    return ", ".join(f"{rnd(c)} AS {c}" for c in cols)


def plain(*cols: str) -> str:
    return ", ".join(cols)


# --- fixtures ---------------------------------------------------------------------------------------------------------

RUN = "TIMESTAMP '2024-01-01 18:00:00'"
DAY = "DATE '2024-01-01'"
NOW = "TIMESTAMP '2024-01-31 06:00:00'"

CTES["f_attributes"] = """
SELECT c_custkey AS pfaf_id, 500e0 + abs(c_acctbal) AS area_km2, 'N' || c_nationkey AS iso, n_name AS admin0,
 c_mktsegment AS admin1, (c_custkey % 26) / 5e0 AS rfr_score, (c_custkey % 11) / 2e0 AS cfr_score
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
CTES["f_resilience"] = """
SELECT 'N' || n_nationkey AS iso, CASE WHEN n_nationkey % 8 = 0 THEN -9999e0 ELSE n_nationkey / 25e0 END AS resilience_index,
 1e0 - n_nationkey / 50e0 AS normalized_lack_of_resilience
FROM nation WHERE n_nationkey <> 7"""
CTES["f_exposure"] = """
SELECT pfaf_id, area_km2, a.iso, admin0, admin1, rfr_score, cfr_score, resilience_index, normalized_lack_of_resilience
FROM f_attributes a JOIN f_resilience r ON a.iso = r.iso"""
CTES["f_stations"] = f"""
SELECT {RUN} AS run_ts, o_orderkey AS point_no, o_custkey AS pfaf_id, ((o_orderkey * 7) % 103)::DOUBLE AS glofas_2yr,
 ((o_orderkey * 5) % 104)::DOUBLE AS glofas_5yr, ((o_orderkey * 11) % 105)::DOUBLE AS glofas_20yr,
 CASE WHEN o_orderkey % 41 = 0 THEN 4 ELSE (o_orderkey % 4)::INTEGER END AS alert_level,
 (1 + o_orderkey % 33)::INTEGER AS days_until_peak
FROM orders"""


def _gfms(source: str, keys: str) -> str:
    return f"""
SELECT {keys}, l_partkey + 40 AS pfaf_id, round(sum(l_quantity) * 7e0, 9) AS gfms_totalarea_km,
 round(sum(l_quantity) / 60e0, 9) AS gfms_perc_area, round(avg(l_discount) * 200e0, 9) AS gfms_meandepth,
 round(max(l_discount) * 1000e0, 9) AS gfms_maxdepth, count(*)::INTEGER AS gfms_duration
FROM {source} GROUP BY ALL"""


def _hwrf(source: str, keys: str) -> str:
    return f"""
SELECT {keys}, l_partkey + 70 AS pfaf_id, round(sum(l_quantity) * 13e0, 9) AS rain_totalarea_km,
 round(avg(l_quantity) * 1.5e0, 9) AS perc_area, round((avg(l_tax) * 100e0 - 2e0) * 3e0, 9) AS meanrain,
 round((avg(l_extendedprice) - 20000e0) / 3000e0, 9) AS maxrain
FROM {source} GROUP BY ALL"""


CTES["f_gfms"] = _gfms("lineitem", f"{RUN} AS run_ts")
CTES["f_hwrf"] = _hwrf("lineitem", f"{RUN} AS run_ts")


def _dfo(date: str) -> str:
    return f"""
SELECT {date} AS run_date, p_partkey + 20 AS pfaf_id, p_size * 1e0 AS d1_area, p_size / 50e0 AS d1_perc,
 p_size * 30e0 AS d1cs_area, p_size / 4e0 AS d1cs_perc, p_size * 20e0 AS d2_area, p_size / 5e0 AS d2_perc,
 p_size * 10e0 AS d3_area, p_size / 10e0 AS d3_perc
FROM part"""


def _viirs(date: str) -> str:
    return f"""
SELECT {date} AS run_date, p_partkey + 90 AS pfaf_id, p_size * 25e0 AS oneday_flood_area_km, p_size / 6e0 AS oneday_perc_area,
 p_size * 40e0 AS fiveday_flood_area_km, p_size / 3e0 AS fiveday_perc_area
FROM part"""


CTES["f_dfo"] = _dfo(DAY)
CTES["f_viirs"] = _viirs(DAY)

CTES["f_slots"] = """
SELECT *, TIMESTAMP '2024-01-10 00:00:00' + to_hours((l_linenumber % 4) * 6) AS run_ts FROM lineitem"""
CTES["f_slots3"] = """
SELECT *, TIMESTAMP '2024-01-10 00:00:00' + to_hours((l_linenumber % 3) * 6) AS run_ts FROM lineitem"""
CTES["f_gfms_runs"] = _gfms("f_slots", "run_ts")
CTES["f_hwrf_runs"] = _hwrf("f_slots3", "run_ts")
CTES["f_station_runs"] = """
SELECT * REPLACE (CASE WHEN point_no % 3 = 0 THEN TIMESTAMP '2024-01-09 00:00:00'
 ELSE TIMESTAMP '2024-01-10 00:00:00' END AS run_ts) FROM f_stations"""
CTES["f_dfo_dates"] = _dfo("CASE WHEN p_partkey % 2 = 0 THEN DATE '2024-01-10' ELSE DATE '2024-01-08' END")
CTES["f_viirs_dates"] = _viirs("CASE WHEN p_partkey % 2 = 1 THEN DATE '2024-01-09' ELSE DATE '2023-12-20' END")

CTES["f_bins3"] = "SELECT *, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '2000-01-01') AS run_ts FROM events"
CTES["f_bins6"] = "SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') AS run_ts FROM events"
CTES["f_series"] = """
SELECT w.pfaf_id, s.run_ts, coalesce(v.total, 0e0) AS gfms_totalarea_km
FROM (SELECT unnest(generate_series(min(run_ts), max(run_ts), INTERVAL 3 HOUR)) AS run_ts FROM f_bins3) s
CROSS JOIN (SELECT unnest(range(10))::BIGINT AS pfaf_id) w
LEFT JOIN (SELECT user_id % 10 AS pfaf_id, run_ts, round(sum(value), 6) AS total FROM f_bins3 GROUP BY ALL) v
 ON v.pfaf_id = w.pfaf_id AND v.run_ts = s.run_ts"""


def alert_sql(severity: str, hazard: str) -> str:
    s, h = f"round({severity}, 9)", f"round({hazard}, 9)"
    return f"""CASE WHEN {s} > 0.8e0 OR {h} > 80 THEN 'Warning'
 WHEN ({s} > 0.6e0 AND {s} < 0.8e0) OR ({h} > 60 AND {h} < 80) THEN 'Watch'
 WHEN ({s} > 0.35e0 AND {s} < 0.6e0) OR ({h} > 35 AND {h} < 60) THEN 'Advisory'
 WHEN ({s} > 0 AND {s} < 0.35e0) OR ({h} > 0 AND {h} < 35) THEN 'Information' END"""


CODE = "CASE {0} WHEN 'Information' THEN 1 WHEN 'Advisory' THEN 2 WHEN 'Watch' THEN 3 WHEN 'Warning' THEN 4 END"

CTES["f_alerts"] = f"""
SELECT *, {alert_sql('NULL::DOUBLE', 'hazard_score')} AS alert FROM (
 SELECT user_id AS pfaf_id, run_ts, least(100e0, round(sum(value) / 4e0, 9)) AS hazard_score FROM f_bins6 GROUP BY ALL)"""
CTES["f_runs"] = "SELECT DISTINCT run_ts FROM f_bins6"
CTES["f_click_dates"] = "SELECT DISTINCT ts::DATE AS run_date FROM events WHERE event_type = 'click' AND day(ts) % 3 <> 0"
CTES["f_view_dates"] = "SELECT DISTINCT ts::DATE AS run_date FROM events WHERE event_type = 'view' AND day(ts) % 4 <> 0"
CTES["f_sparse_dates"] = "SELECT DISTINCT ts::DATE AS run_date FROM events WHERE day(ts) IN (3, 20)"
CTES["f_storms"] = """
SELECT run_ts FROM f_runs WHERE (epoch(run_ts)::BIGINT // 21600) % 3 <> 0 AND run_ts < TIMESTAMP '2024-01-30 06:00:00'"""
CTES["f_checks"] = """
SELECT 'site' || (user_id % 5) AS name, CASE WHEN event_type = 'error' THEN 'DOWN' ELSE 'UP' END AS status, ts FROM events"""

CTES["f_cells"] = """
SELECT TIMESTAMP '2024-01-01 00:00:00' + to_hours((l_suppkey % 4 * 3)::INTEGER) AS run_ts,
 (l_orderkey % 180)::INTEGER AS row_no, ((l_partkey * 7 + l_linenumber) % 360)::INTEGER AS col_no,
 CASE WHEN l_linenumber = 7 THEN -9999e0 ELSE l_quantity END AS value, *
FROM lineitem"""
_LAST = "ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC"
CTES["f_pixels"] = f"""
SELECT run_ts, row_no, col_no, value FROM f_cells
QUALIFY row_number() OVER (PARTITION BY run_ts, row_no, col_no {_LAST}) = 1"""
CTES["f_dfo_pixels"] = f"""
SELECT run_date, layer, row_no, col_no, l_quantity % 4 AS value, (row_no // 30) * 12 + col_no // 30 AS tile
FROM (SELECT *, ({DAY} + (l_linenumber % 2)::INTEGER) AS run_date,
 CASE l_suppkey % 4 WHEN 0 THEN 'd1' WHEN 1 THEN 'd1cs' WHEN 2 THEN 'd2' ELSE 'd3' END AS layer FROM f_cells)
QUALIFY row_number() OVER (PARTITION BY run_date, layer, row_no, col_no {_LAST}) = 1"""
CTES["f_viirs_pixels"] = f"""
SELECT run_date, product, row_no, col_no, l_quantity * 4e0 AS value
FROM (SELECT *, ({DAY} + (l_linenumber % 2)::INTEGER) AS run_date,
 CASE WHEN l_suppkey % 2 = 0 THEN '1day' ELSE '5day' END AS product FROM f_cells)
QUALIFY row_number() OVER (PARTITION BY run_date, product, row_no, col_no {_LAST}) = 1"""
CTES["f_corner"] = """
SELECT n_nationkey AS pfaf_id, n_nationkey, 1000e0 + n_nationkey * 137e0 AS area_km2,
 -170e0 + (n_nationkey % 5) * 65e0 + 0.3e0 AS x, -70e0 + (n_nationkey // 5) * 28e0 + 0.2e0 AS y FROM nation"""
CTES["f_sheds"] = "SELECT pfaf_id::BIGINT AS pfaf_id, area_km2 FROM f_corner"
CTES["f_edges"] = """
SELECT pfaf_id::BIGINT AS pfaf_id, x + e[1] AS x1, y + e[2] AS y1, x + e[3] AS x2, y + e[4] AS y2 FROM (
 SELECT *, unnest([[0e0, 0e0, 25e0, 3e0], [25e0, 3e0, 9e0, 22e0], [9e0, 22e0, 0e0, 0e0]]) AS e FROM f_corner
 UNION ALL
 SELECT *, unnest([[9e0, 6e0, 13e0, 6e0], [13e0, 6e0, 13e0, 10e0], [13e0, 10e0, 9e0, 10e0], [9e0, 10e0, 9e0, 6e0]]) AS e
 FROM f_corner WHERE n_nationkey % 4 = 0)"""


def parity(points: str, keys: str) -> str:
    """Points (lon, lat) with an odd number of edge crossings to their right, per polygon."""
    return f"""
SELECT {keys}, e.pfaf_id FROM {points} p JOIN f_edges e
 ON (e.y1 <= p.lat) <> (e.y2 <= p.lat) AND p.lon < e.x1 + (p.lat - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
GROUP BY {keys}, e.pfaf_id HAVING count(*) % 2 = 1"""


CTES["f_centers"] = """
SELECT r AS row_no, c AS col_no, 90e0 - (r + 0.5e0) AS lat, -180e0 + (c + 0.5e0) AS lon
FROM (SELECT DISTINCT row_no AS r, col_no AS c FROM f_cells)"""
CTES["f_members"] = parity("f_centers", "row_no, col_no, lat")
CTES["f_points"] = """
SELECT o_orderkey AS point_no, -180e0 + (o_orderkey * 37 % 3600) / 10e0 AS lon, -90e0 + (o_custkey * 13 % 1800) / 10e0 AS lat
FROM orders"""
CTES["f_odd"] = parity("f_points", "point_no, lon, lat")
# Points on a border are not within.
CTES["f_border"] = """
SELECT DISTINCT point_no, pfaf_id FROM f_points p JOIN f_edges e
 ON (e.x2 - e.x1) * (p.lat - e.y1) = (e.y2 - e.y1) * (p.lon - e.x1)
 AND p.lon BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) AND p.lat BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)"""
CTES["f_located"] = "SELECT * FROM f_odd o WHERE NOT EXISTS (SELECT 1 FROM f_border b WHERE b.point_no = o.point_no AND b.pfaf_id = o.pfaf_id)"
CTES["f_raw_stations"] = """
SELECT CASE WHEN o_orderkey % 2 = 1 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS run_ts,
 o_orderkey AS point_no, 'S' || o_orderkey AS station, o_orderpriority AS basin, o_orderstatus AS country,
 o_totalprice AS upstream_area, -180e0 + (o_orderkey * 37 % 3600) / 10e0 AS lon,
 -90e0 + (o_custkey * 13 % 1800) / 10e0 AS lat, (o_orderkey % 33 + 1)::INTEGER AS days_until_peak,
 (o_orderkey * 7 % 101) * (CASE WHEN o_orderkey % 2 = 1 THEN 0.01e0 ELSE 1e0 END) AS glofas_2yr,
 (o_orderkey * 5 % 101) * (CASE WHEN o_orderkey % 2 = 1 THEN 0.01e0 ELSE 1e0 END) AS glofas_5yr,
 (o_orderkey * 11 % 101) * (CASE WHEN o_orderkey % 2 = 1 THEN 0.01e0 ELSE 1e0 END) AS glofas_20yr,
 (o_orderkey % 4)::INTEGER AS alert_level
FROM orders"""
CTES["f_rescaled"] = """
SELECT * REPLACE (glofas_2yr * factor AS glofas_2yr, glofas_5yr * factor AS glofas_5yr, glofas_20yr * factor AS glofas_20yr)
FROM (SELECT *, CASE WHEN max(glofas_2yr) OVER (PARTITION BY run_ts) <= 1e0 THEN 100e0 ELSE 1e0 END AS factor
 FROM f_raw_stations)"""
CTES["f_rain"] = """
SELECT TIMESTAMP '2024-01-01 06:00:00' AS run_ts, 'storm' || (o_orderkey % 4) AS source, o_orderkey AS ordinal,
 -180e0 + (o_orderkey * 37 % 3600) / 10e0 AS lon, -90e0 + (o_custkey * 13 % 1800) / 10e0 AS lat,
 ((o_orderkey * 3 + o_custkey) % 200) / 10e0 - 1e0 AS z, -180e0 + (o_orderkey % 4) * 60e0 AS xlc,
 -20e0 + (o_orderkey % 4) * 60e0 AS xrc, -80e0 AS ybc, 80e0 AS ytc
FROM orders"""
CTES["f_clipped"] = "SELECT * FROM f_rain WHERE lon >= xlc AND lon <= xrc AND lat >= ybc AND lat <= ytc AND z > 0"
CTES["f_centroids"] = """
SELECT c_custkey AS pfaf_id, c_name AS admin_name, part_no AS part, (c_custkey * 7 % 180) - 90e0 AS centroid_y
FROM customer JOIN (SELECT unnest([1, 2])::INTEGER AS part_no) ON part_no = 1 OR c_custkey % 3 = 0"""

# --- scores -----------------------------------------------------------------------------------------------------------


def capped(v: str, wt: str, points: str, top: str, cap: str = "10") -> str:
    """``points`` per unit below ``cap`` weighted units, ``top`` above."""
    return f"CASE WHEN {v} / {wt} > {cap} THEN {top} ELSE {points} * {v} / {wt} END"


def scored_gfms(source: str) -> str:
    return f"""
SELECT *, gfms_area_score + gfms_perc_area_score + gfms_meandepth_score + gfms_maxdepth_score + gfms_duration_score AS gfms_score
FROM (SELECT *, {capped('gfms_totalarea_km', '1000e0', '1e0', '10e0')} AS gfms_area_score,
 {capped('gfms_perc_area', '5e0', '1e0', '10e0')} AS gfms_perc_area_score,
 {capped('gfms_meandepth', '10e0', '1e0', '10e0')} AS gfms_meandepth_score,
 {capped('gfms_maxdepth', '10e0', '1e0', '10e0')} AS gfms_maxdepth_score,
 {capped('gfms_duration', '24e0', '1e0', '10e0')} AS gfms_duration_score FROM {source})"""


def step(v: str, lo: str, inc: str) -> str:
    return f"CASE WHEN {v} >= {lo} THEN CASE WHEN ({v} - {lo}) / {inc} + 1e0 > 10 THEN 10e0 ELSE ({v} - {lo}) / {inc} + 1e0 END ELSE 0e0 END"


def scored_hwrf(source: str) -> str:
    return f"""
SELECT *, (hwrf_area_score + hwrf_percarea_score + meanrain_score + maxrain_score) * 2.5e0 AS hwrf_total
FROM (SELECT *, {capped('rain_totalarea_km', '1000e0', '1e0', '10e0')} AS hwrf_area_score,
 {capped('perc_area', '5e0', '1e0', '10e0')} AS hwrf_percarea_score,
 {step('meanrain', '2e0', '0.5e0')} AS meanrain_score, {step('maxrain', '4e0', '1e0')} AS maxrain_score FROM {source})"""


def scored_dfo(source: str) -> str:
    cols, names = [], []
    for d, layer, mult, top in (("1day", "d1cs", "1e0", "10e0"), ("2day", "d2", "1.5e0", "15e0"), ("3day", "d3", "2.5e0", "25e0")):
        for m, c, wt in (("area", "area", "100e0"), ("perc_area", "perc", "1e0")):
            names.append(f"dfo_{m}_{d}_score")
            cols.append(f"{capped(f'{layer}_{c}', wt, mult, top)} AS {names[-1]}")
    return f"SELECT *, {' + '.join(names)} AS dfo_total FROM (SELECT *, {', '.join(cols)} FROM {source})"


def scored_viirs(source: str) -> str:
    cols, names = [], []
    for d, layer, mult, top in (("1day", "oneday", "1.5e0", "15e0"), ("5day", "fiveday", "3.5e0", "35e0")):
        for m, c, wt in (("area", "flood_area_km", "100e0"), ("perc_area", "perc_area", "1e0")):
            names.append(f"viirs_{m}_{d}_score")
            cols.append(f"{capped(f'{layer}_{c}', wt, mult, top)} AS {names[-1]}")
    return f"SELECT *, {' + '.join(names)} AS viirs_total FROM (SELECT *, {', '.join(cols)} FROM {source})"


CTES["checked"] = """
SELECT *, CASE WHEN alert_level > 3 OR alert_level < 0 THEN 'alert level outside 0 to 3'
 WHEN glofas_2yr > 100 THEN '2-year probability above 100' WHEN glofas_5yr > 100 THEN '5-year probability above 100'
 WHEN glofas_20yr > 100 THEN '20-year probability above 100' WHEN days_until_peak > 30 THEN 'peak later than 30 days' END AS error
FROM f_stations"""


def scored_stations(source: str) -> str:
    return f"""
SELECT *, alert_score + peak_score + two_score + five_score + twenty_score AS glofas_score
FROM (SELECT *, round_even(alert_level * 3.33e0, 0) AS alert_score,
 CASE WHEN glofas_2yr = 0 AND glofas_5yr = 0 AND glofas_20yr = 0 AND alert_level = 0 THEN 0e0
  WHEN days_until_peak >= 10 THEN 1e0 WHEN days_until_peak >= 1 THEN (11 - days_until_peak)::DOUBLE ELSE 0e0 END AS peak_score,
 glofas_2yr / 10e0 AS two_score, glofas_5yr / 10e0 AS five_score, glofas_20yr / 10e0 AS twenty_score
 FROM {source} WHERE alert_level BETWEEN 0 AND 3 AND glofas_2yr <= 100 AND glofas_5yr <= 100 AND glofas_20yr <= 100
 AND days_until_peak <= 30)"""


def averaged(source: str) -> str:
    return f"""
SELECT * REPLACE (mean AS glofas_score) FROM (
 SELECT *, avg(glofas_score) OVER (PARTITION BY run_ts, pfaf_id) AS mean FROM {source})
QUALIFY row_number() OVER (PARTITION BY run_ts, pfaf_id ORDER BY point_no DESC) = 1"""


CTES["s_stations"] = scored_stations("f_stations")
CTES["s_glofas"] = averaged("s_stations")
CTES["s_gfms"] = scored_gfms("f_gfms")
CTES["s_hwrf"] = scored_hwrf("f_hwrf")
CTES["s_dfo_all"] = scored_dfo("f_dfo")
CTES["s_viirs_all"] = scored_viirs("f_viirs")
CTES["s_dfo"] = f"SELECT {RUN} AS run_ts, * EXCLUDE (run_date) FROM s_dfo_all WHERE dfo_total > 0.1e0"
CTES["s_viirs"] = f"SELECT {RUN} AS run_ts, * EXCLUDE (run_date) FROM s_viirs_all WHERE viirs_total > 0.1e0"

GLOFAS_PARTS = ["alert_score", "peak_score", "two_score", "five_score", "twenty_score"]
STATION = ["point_no", "alert_level", "days_until_peak", "glofas_2yr", "glofas_5yr", "glofas_20yr", *GLOFAS_PARTS]
GFMS = ["gfms_totalarea_km", "gfms_perc_area", "gfms_meandepth", "gfms_maxdepth", "gfms_duration", "gfms_area_score",
        "gfms_perc_area_score", "gfms_meandepth_score", "gfms_maxdepth_score", "gfms_duration_score"]
HWRF = ["rain_totalarea_km", "perc_area", "meanrain", "maxrain", "hwrf_area_score", "hwrf_percarea_score",
        "meanrain_score", "maxrain_score", "hwrf_total"]
DFO_RAW = ["d1_area", "d1_perc", "d1cs_area", "d1cs_perc", "d2_area", "d2_perc", "d3_area", "d3_perc"]
DFO_PARTS = [f"dfo_{m}_{d}_score" for d in ("1day", "2day", "3day") for m in ("area", "perc_area")]
VIIRS_RAW = ["oneday_flood_area_km", "oneday_perc_area", "fiveday_flood_area_km", "fiveday_perc_area"]
VIIRS_PARTS = [f"viirs_{m}_{d}_score" for d in ("1day", "5day") for m in ("area", "perc_area")]
EXPOSED = ["area_km2", "iso", "admin0", "admin1", "rfr_score", "cfr_score", "resilience_index", "normalized_lack_of_resilience"]
WHOLE = {"point_no", "alert_level", "days_until_peak", "gfms_duration", "iso", "admin0", "admin1", "alert", "flag",
         "run_ts", "pfaf_id", "dfo_date", "viirs_date", "status", "previous_alert", "run_date"}


def select(cols: list[str], source: str) -> str:
    """Final projection with floating point columns rounded to 6 digits."""
    return f"SELECT {', '.join(c if c in WHOLE else r6(c) for c in cols)} FROM {source}"


QUERIES["score_gfms"] = select(["run_ts", "pfaf_id", *GFMS, "gfms_score"], "s_gfms")
CTES["s_gfms_table"] = re.sub(r"/ (\d+)e0", lambda m: f"/ {int(m[1]) / 2}e0", scored_gfms("f_gfms")).replace("1e0 *", "2e0 *").replace("> 10 THEN 10e0", "> 20 THEN 20e0")
QUERIES["score_gfms_weights"] = select(["run_ts", "pfaf_id", *GFMS, "gfms_score"], "s_gfms_table")
CTES["s_hwrf_table"] = f"""
SELECT *, (hwrf_area_score + hwrf_percarea_score + meanrain_score + maxrain_score) * 2.5e0 AS hwrf_total
FROM (SELECT *, {capped('rain_totalarea_km', '500e0', '2e0', '20e0', '20')} AS hwrf_area_score,
 {capped('perc_area', '2.5e0', '2e0', '20e0', '20')} AS hwrf_percarea_score,
 CASE WHEN meanrain >= 1 THEN least(20e0, (meanrain - 1e0) / 0.25e0 + 2e0) ELSE 0e0 END AS meanrain_score,
 CASE WHEN maxrain >= 2 THEN least(20e0, (maxrain - 2e0) / 0.5e0 + 2e0) ELSE 0e0 END AS maxrain_score FROM f_hwrf)"""
QUERIES["score_hwrf_weights"] = select(["run_ts", "pfaf_id", *HWRF], "s_hwrf_table")


def table_scored(source: str, days: list[tuple[str, str, int]], parts: tuple[tuple[str, str, str], ...], product: str) -> str:
    """Daily products with half the weights, twice the points and other day multipliers."""
    names, cols = [], []
    for d, layer, mult in days:
        for m, c, wt in parts:
            names.append(f"{product}_{m}_{d}_score")
            cols.append(f"{capped(f'{layer}_{c}', wt, f'{2 * mult}e0', f'{20 * mult}e0', '20')} AS {names[-1]}")
    return f"SELECT *, {' + '.join(names)} AS {product}_total FROM (SELECT *, {', '.join(cols)} FROM {source})"


CTES["s_dfo_table"] = table_scored(
    "f_dfo", [("1day", "d1cs", 2), ("2day", "d2", 3), ("3day", "d3", 4)], (("area", "area", "50e0"), ("perc_area", "perc", "0.5e0")), "dfo")
CTES["s_viirs_table"] = table_scored(
    "f_viirs", [("1day", "oneday", 2), ("5day", "fiveday", 3)], (("area", "flood_area_km", "50e0"), ("perc_area", "perc_area", "0.5e0")), "viirs")
QUERIES["score_dfo_weights"] = select(["run_date", "pfaf_id", *DFO_RAW, *DFO_PARTS, "dfo_total"], "s_dfo_table WHERE dfo_total > 0.1e0")
QUERIES["score_viirs_weights"] = select(["run_date", "pfaf_id", *VIIRS_RAW, *VIIRS_PARTS, "viirs_total"], "s_viirs_table WHERE viirs_total > 0.1e0")
QUERIES["score_hwrf"] = select(["run_ts", "pfaf_id", *HWRF], "s_hwrf")
QUERIES["score_dfo"] = select(["run_date", "pfaf_id", *DFO_RAW, *DFO_PARTS, "dfo_total"], "s_dfo_all WHERE dfo_total > 0.1e0")
QUERIES["score_viirs"] = select(["run_date", "pfaf_id", *VIIRS_RAW, *VIIRS_PARTS, "viirs_total"], "s_viirs_all WHERE viirs_total > 0.1e0")
QUERIES["score_glofas"] = select(["run_ts", "pfaf_id", *STATION, "glofas_score"], "s_stations")
_RAW = ["run_ts", "point_no", "pfaf_id", "glofas_2yr", "glofas_5yr", "glofas_20yr", "alert_level", "days_until_peak"]
QUERIES["stations_ok"] = select(_RAW, "checked WHERE error IS NULL")
QUERIES["stations_rejected"] = select(_RAW, "checked WHERE error IS NOT NULL").replace(" FROM", ", error FROM", 1)
QUERIES["station_average"] = select(["run_ts", "pfaf_id", *STATION, "glofas_score"], "s_glofas")

# --- fusion -----------------------------------------------------------------------------------------------------------

_N = ["0.0352624965998911e0", "0.700383064443688e0", "6.37396220353165e0", "33.912866078383e0", "112.079291497871e0",
      "221.213596169931e0", "220.206867912376e0"]
_D = ["0.0883883476483184e0", "1.75566716318264e0", "16.064177579207e0", "86.7807322029461e0", "296.564248779674e0",
      "637.333633378831e0", "793.826512519948e0", "440.413735824752e0"]


def horner(coefficients: list[str]) -> str:
    text = coefficients[0]
    for c in coefficients[1:]:
        text = f"({text} * a + {c})"
    return text


def severity_sql(source: str, keep: str = "*") -> str:
    """Rows of ``source`` with both scaled risks and the severity."""
    far = "e / ((a + 1e0 / (a + 2e0 / (a + 3e0 / (a + 4e0 / (a + 0.65e0))))) * 2.506628274631e0)"
    return f"""
SELECT * EXCLUDE (risk, x, a, e, tail), CASE WHEN hazard_score IS NULL OR risk IS NULL OR hazard_score < 0 OR risk > 100 THEN NULL
 WHEN hazard_score = 0 THEN CASE WHEN risk < 100 THEN 0e0 END WHEN risk = 100 THEN 1e0 WHEN x > 0 THEN 1e0 - tail ELSE tail END AS severity
FROM (SELECT *, CASE WHEN a > 37 THEN 0e0 WHEN a < 7.07106781186547e0 THEN e * {horner(_N)} / {horner(_D)} ELSE {far} END AS tail
FROM (SELECT *, abs(x) AS a, exp(-(x * x) / 2e0) AS e
FROM (SELECT *, CASE WHEN hazard_score > 0 AND risk < 100 THEN ln(hazard_score) - ln(100e0 - risk) END AS x
FROM (SELECT *, greatest(scaled_riverine_risk, scaled_coastal_risk) AS risk
FROM (SELECT {keep}, rfr_score * 20e0 AS scaled_riverine_risk, cfr_score * 20e0 AS scaled_coastal_risk FROM {source})))))"""


def finish(name: str, source: str, flag: bool) -> None:
    """Define ``name``: rows of ``source`` that remain, with severity, alert and the cleared flag."""
    CTES[f"{name}_kept"] = f"""
SELECT * FROM {source} WHERE (hazard_score IS NULL OR hazard_score <> 0) AND NOT coalesce(rfr_score = 0 AND cfr_score = 0, false)"""
    CTES[f"{name}_sev"] = severity_sql(f"{name}_kept")
    CTES[f"{name}_cls"] = f"SELECT *, {alert_sql('severity', 'hazard_score')} AS alert FROM {name}_sev"
    clear = "CASE WHEN alert IN ('Information', 'Advisory') THEN NULL ELSE flag END"
    CTES[name] = f"SELECT * REPLACE ({clear} AS flag) FROM {name}_cls" if flag else f"SELECT * FROM {name}_cls"


def prefixed(cols: list[str], alias: str) -> str:
    return ", ".join(f"{alias}.{c}" for c in cols)


def stages(p: str, glofas: str, gfms: str, hwrf: str, dfo: str, viirs: str, runs: str) -> None:
    """The four alert stages, one full outer join after the other, with the whole exposure table per run."""
    on = "USING (run_ts, pfaf_id)"
    x = "CASE WHEN coalesce(gfms_score, 0) = 0 THEN 2e0 * coalesce(glofas_score, 0) ELSE coalesce(glofas_score, 0e0) END"
    y = "CASE WHEN coalesce(glofas_score, 0) = 0 THEN 2e0 * coalesce(gfms_score, 0) ELSE coalesce(gfms_score, 0e0) END"
    fore = [*STATION, *GFMS]
    CTES[f"{p}_exp"] = f"SELECT run_ts, e.* FROM f_exposure e CROSS JOIN (SELECT DISTINCT run_ts FROM {runs}) q"
    CTES[f"{p}_fc"] = f"SELECT run_ts, pfaf_id, {prefixed([*STATION, 'glofas_score'], 's')}, {prefixed([*GFMS, 'gfms_score'], 'g')} FROM {glofas} s FULL JOIN {gfms} g {on}"
    CTES[f"{p}_ex0"] = f"SELECT run_ts, pfaf_id, {prefixed(EXPOSED, 'e')}, f.* EXCLUDE (run_ts, pfaf_id) FROM {p}_exp e FULL JOIN {p}_fc f {on}"
    CTES[f"{p}_ex1"] = f"SELECT * REPLACE ({x} AS glofas_score, {y} AS gfms_score) FROM {p}_ex0"
    CTES[f"{p}_ex2"] = f"SELECT *, glofas_score + gfms_score AS forecast_score, glofas_score + gfms_score AS hazard_score FROM {p}_ex1"
    finish(f"{p}_p3", f"{p}_ex2", False)
    CTES[f"{p}_s1"] = f"""
SELECT f.* REPLACE (greatest(hazard_score, hwrf_total) AS hazard_score, coalesce(f.run_ts, h.run_ts) AS run_ts, coalesce(f.pfaf_id, h.pfaf_id) AS pfaf_id),
 {prefixed(HWRF, 'h')}, CASE WHEN hazard_score < hwrf_total THEN 1 END AS flag
FROM {p}_ex2 f FULL JOIN {hwrf} h ON f.run_ts = h.run_ts AND f.pfaf_id = h.pfaf_id"""
    finish(f"{p}_p4", f"{p}_s1", True)

    def observe(prev: str, name: str, source: str, raw: list[str], total: str, code: int, carried: list[str]) -> None:
        carry = [*carried, "hazard_score", "flag"]
        CTES[f"{name}_j"] = f"SELECT run_ts, pfaf_id, {prefixed(carry, 'm')}, {prefixed(raw, 'd')} FROM {prev} m FULL JOIN {source} d {on}"
        CTES[f"{name}_e"] = f"SELECT run_ts, pfaf_id, {prefixed(EXPOSED, 'e')}, j.* EXCLUDE (run_ts, pfaf_id) FROM {p}_exp e RIGHT JOIN {name}_j j {on}"
        CTES[f"{name}_h"] = f"""
SELECT * REPLACE (greatest(coalesce(hazard_score, 0e0), {total}) AS hazard_score,
 CASE WHEN coalesce(hazard_score, 0e0) < {total} THEN {code} ELSE flag END AS flag) FROM {name}_e"""
        finish(name, f"{name}_h", True)

    storm = [*fore, "glofas_score", "gfms_score", "forecast_score", *HWRF]
    seen = [*DFO_RAW, *DFO_PARTS, "dfo_total"]
    observe(f"{p}_p4", f"{p}_p5", dfo, seen, "dfo_total", 2, storm)
    observe(f"{p}_p5", f"{p}_p6", viirs, [*VIIRS_RAW, *VIIRS_PARTS, "viirs_total"], "viirs_total", 3, [*storm, *seen])


CTES["q_single"] = f"SELECT {RUN} AS run_ts"
stages("a", "s_glofas", "s_gfms", "s_hwrf", "s_dfo", "s_viirs", "q_single")
_FORE = [*STATION, "glofas_score", *GFMS, "gfms_score"]
_STORM = [*_FORE, "forecast_score", *HWRF]
_SEEN = [*DFO_RAW, *DFO_PARTS, "dfo_total"]
_LAYERS = [*VIIRS_RAW, *VIIRS_PARTS, "viirs_total"]
_END = ["hazard_score", "scaled_riverine_risk", "scaled_coastal_risk", "severity", "alert"]
_K = ["run_ts", "pfaf_id"]
QUERIES["forecast_alerts"] = select([*_K, *EXPOSED, *_FORE, *_END], "a_p3")
QUERIES["hwrf_alerts"] = select([*_K, *EXPOSED, *_STORM, *_END, "flag"], "a_p4")
QUERIES["dfo_alerts"] = select([*_K, *EXPOSED, *_STORM, *_SEEN, *_END, "flag"], "a_p5")
QUERIES["viirs_alerts"] = select([*_K, *EXPOSED, *_STORM, *_SEEN, *_LAYERS, *_END, "flag"], "a_p6")

# Several runs: every source expanded to the runs that use it.
CTES["m_runs"] = "SELECT DISTINCT run_ts FROM f_gfms_runs"
CTES["m_seen"] = """
SELECT r.run_ts, (SELECT max(run_date) FROM f_dfo_dates d WHERE d.run_date >= r.run_ts::DATE - 9
  AND (d.run_date < r.run_ts::DATE OR (hour(r.run_ts) = 18 AND d.run_date = r.run_ts::DATE))) AS dfo_date,
 (SELECT max(run_date) FROM f_viirs_dates v WHERE v.run_date >= r.run_ts::DATE - 9
  AND (v.run_date < r.run_ts::DATE OR (hour(r.run_ts) = 18 AND v.run_date = r.run_ts::DATE))) AS viirs_date
FROM m_runs r"""
CTES["m_map"] = "SELECT * FROM m_seen WHERE dfo_date IS NOT NULL AND viirs_date IS NOT NULL"
CTES["m_st"] = """
SELECT m.run_ts, s.* EXCLUDE (run_ts) FROM f_station_runs s JOIN m_map m ON s.run_ts::DATE =
 CASE WHEN m.run_ts::DATE IN (SELECT run_ts::DATE FROM f_station_runs) THEN m.run_ts::DATE
 ELSE (SELECT max(run_ts::DATE) FROM f_station_runs x WHERE x.run_ts::DATE <= m.run_ts::DATE) END"""
CTES["m_hw"] = """
SELECT m.run_ts, h.* EXCLUDE (run_ts) FROM f_hwrf_runs h JOIN m_map m ON h.run_ts =
 CASE WHEN m.run_ts IN (SELECT run_ts FROM f_hwrf_runs) THEN m.run_ts
 ELSE (SELECT max(run_ts) FROM f_hwrf_runs x WHERE x.run_ts <= m.run_ts AND x.run_ts >= m.run_ts - INTERVAL 6 HOUR) END"""
CTES["m_gf"] = "SELECT g.* FROM f_gfms_runs g WHERE g.run_ts IN (SELECT run_ts FROM m_map)"
CTES["m_df"] = "SELECT m.run_ts, d.* EXCLUDE (run_date) FROM f_dfo_dates d JOIN m_map m ON d.run_date = m.dfo_date"
CTES["m_vi"] = "SELECT m.run_ts, v.* EXCLUDE (run_date) FROM f_viirs_dates v JOIN m_map m ON v.run_date = m.viirs_date"
CTES["m_s_st"] = scored_stations("m_st")
CTES["m_s_glofas"] = averaged("m_s_st")
CTES["m_s_gfms"] = scored_gfms("m_gf")
CTES["m_s_hwrf"] = scored_hwrf("m_hw")
CTES["m_s_dfo0"] = scored_dfo("m_df")
CTES["m_s_viirs0"] = scored_viirs("m_vi")
CTES["m_s_dfo"] = "SELECT * FROM m_s_dfo0 WHERE dfo_total > 0.1e0"
CTES["m_s_viirs"] = "SELECT * FROM m_s_viirs0 WHERE viirs_total > 0.1e0"
stages("b", "m_s_glofas", "m_s_gfms", "m_s_hwrf", "m_s_dfo", "m_s_viirs", "m_map")
QUERIES["combined_alerts"] = select(
    [*_K, *EXPOSED, *_STORM, *_SEEN, *_LAYERS, *_END, "flag", "dfo_date", "viirs_date"], "b_p6 JOIN m_map USING (run_ts)")

# Two days of runs, published with the status against the day before.
CTES["c_gfms"] = "SELECT * FROM f_gfms_runs UNION ALL SELECT * REPLACE (run_ts + INTERVAL 1 DAY AS run_ts) FROM f_gfms_runs"
CTES["k_gfms"] = """
SELECT * REPLACE (CASE WHEN run_ts = TIMESTAMP '2024-01-10 06:00:00' THEN gfms_totalarea_km * 9e0 ELSE gfms_totalarea_km END AS gfms_totalarea_km,
 CASE WHEN run_ts = TIMESTAMP '2024-01-10 06:00:00' THEN gfms_perc_area * 9e0 ELSE gfms_perc_area END AS gfms_perc_area) FROM c_gfms"""


def published(p: str) -> str:
    """Published alerts of all runs in ``p``_gfms, computed at once."""
    for n in ("runs", "seen", "map", "st", "hw", "gf", "df", "vi"):
        sql = CTES[f"m_{n}"].replace("f_gfms_runs", f"{p}_gfms")
        CTES[f"{p}_{n}"] = sql.replace("m_runs", f"{p}_runs").replace("m_seen", f"{p}_seen").replace("m_map", f"{p}_map")
    CTES[f"{p}_s_st"] = scored_stations(f"{p}_st")
    CTES[f"{p}_s_glofas"] = averaged(f"{p}_s_st")
    CTES[f"{p}_s_gfms"] = scored_gfms(f"{p}_gf")
    CTES[f"{p}_s_hwrf"] = scored_hwrf(f"{p}_hw")
    CTES[f"{p}_s_dfo0"] = scored_dfo(f"{p}_df")
    CTES[f"{p}_s_viirs0"] = scored_viirs(f"{p}_vi")
    CTES[f"{p}_s_dfo"] = f"SELECT * FROM {p}_s_dfo0 WHERE dfo_total > 0.1e0"
    CTES[f"{p}_s_viirs"] = f"SELECT * FROM {p}_s_viirs0 WHERE viirs_total > 0.1e0"
    stages(f"{p}x", f"{p}_s_glofas", f"{p}_s_gfms", f"{p}_s_hwrf", f"{p}_s_dfo", f"{p}_s_viirs", f"{p}_map")
    CTES[f"{p}_coded"] = f"SELECT *, {CODE.format('alert')} AS code FROM {p}x_p6"
    CTES[f"{p}_status"] = f"""
SELECT a.*, CASE WHEN b.code IS NULL THEN 'New' WHEN a.code = b.code THEN 'Continued' WHEN a.code > b.code THEN 'Upgraded'
 WHEN a.code < b.code THEN 'Downgraded' ELSE 'Other' END AS status
FROM {p}_coded a LEFT JOIN {p}_coded b ON b.run_ts = a.run_ts - INTERVAL 1 DAY AND b.pfaf_id = a.pfaf_id
WHERE a.run_ts - INTERVAL 1 DAY IN (SELECT run_ts FROM {p}_coded)"""
    return select(
        [*_K, "area_km2", "rfr_score", "cfr_score", *_STORM, *_SEEN, *_LAYERS, *_END, "flag", "dfo_date", "viirs_date", "status"],
        f"{p}_status JOIN {p}_map USING (run_ts) JOIN f_centroids USING (pfaf_id)",
    ).replace(" FROM", f", admin_name, part, {r6('centroid_y')} FROM", 1)


QUERIES["published_alerts"] = published("c")
QUERIES["published_alerts_north"] = QUERIES["published_alerts"] + " WHERE NOT (dfo_total IS NULL AND forecast_score IS NULL AND centroid_y > 50)"
QUERIES["republished_alerts"] = published("k")

# The same with the inputs of the storm runs and of the evening runs.
CTES["f_viirs_today"] = _viirs("DATE '2024-01-10'")


def chosen(p: str, runs: str, dfo: str, viirs: str) -> None:
    """Inputs of the runs in ``runs`` by the storm rule, observations of the run's own day."""
    CTES[f"{p}_st"] = CTES["m_st"].replace("m_map", runs)
    CTES[f"{p}_hw"] = CTES["m_hw"].replace("m_map", runs)
    CTES[f"{p}_gf"] = CTES["m_gf"].replace("m_map", runs)
    CTES[f"{p}_df"] = f"SELECT m.run_ts, d.* EXCLUDE (run_date) FROM {dfo} d JOIN {runs} m ON d.run_date = m.run_ts::DATE"
    CTES[f"{p}_vi"] = f"SELECT m.run_ts, v.* EXCLUDE (run_date) FROM {viirs} v JOIN {runs} m ON v.run_date = m.run_ts::DATE"
    CTES[f"{p}_s_st"] = scored_stations(f"{p}_st")
    CTES[f"{p}_s_glofas"] = averaged(f"{p}_s_st")
    CTES[f"{p}_s_gfms"] = scored_gfms(f"{p}_gf")
    CTES[f"{p}_s_hwrf"] = scored_hwrf(f"{p}_hw")
    CTES[f"{p}_s_dfo0"] = scored_dfo(f"{p}_df")
    CTES[f"{p}_s_viirs0"] = scored_viirs(f"{p}_vi")
    CTES[f"{p}_s_dfo"] = f"SELECT * FROM {p}_s_dfo0 WHERE dfo_total > 0.1e0"
    CTES[f"{p}_s_viirs"] = f"SELECT * FROM {p}_s_viirs0 WHERE viirs_total > 0.1e0"
    stages(f"{p}x", *[f"{p}_s_{n}" for n in ("glofas", "gfms", "hwrf", "dfo", "viirs")], runs)


CTES["n_runs"] = "SELECT run_ts FROM m_runs WHERE hour(run_ts) = 0"
CTES["e_runs"] = "SELECT run_ts FROM m_runs WHERE hour(run_ts) = 18"
chosen("n", "n_runs", "f_dfo_dates", "f_viirs_today")
chosen("w", "m_runs", "f_dfo_dates", "f_viirs_today")
chosen("e", "e_runs", "f_dfo_dates", "f_viirs_today")
QUERIES["daily_forecast"] = select([*_K, *EXPOSED, *_FORE, *_END], "nx_p3")

# From raw stations: rescaled, located, cut to whole numbers.
CTES["q_runs"] = "SELECT TIMESTAMP '2024-01-02 00:00:00' AS run_ts"
CTES["q_st"] = """
SELECT r.run_ts, r.point_no, l.pfaf_id, trunc(glofas_2yr) AS glofas_2yr, trunc(glofas_5yr) AS glofas_5yr, trunc(glofas_20yr) AS glofas_20yr,
 alert_level, days_until_peak
FROM f_rescaled r JOIN f_located l ON r.point_no = l.point_no WHERE r.run_ts = TIMESTAMP '2024-01-02 00:00:00'"""
CTES["q_gf"] = "SELECT TIMESTAMP '2024-01-02 00:00:00' AS run_ts, * EXCLUDE (run_ts) FROM f_gfms"
CTES["q_s_st"] = scored_stations("q_st")
CTES["q_s_glofas"] = averaged("q_s_st")
CTES["q_s_gfms"] = scored_gfms("q_gf")
stages("qx", "q_s_glofas", "q_s_gfms", "m_s_hwrf", "m_s_dfo", "m_s_viirs", "q_runs")
QUERIES["stations_to_alerts"] = select([*_K, *EXPOSED, *_FORE, *_END], "qx_p3")
QUERIES["storm_alerts"] = select([*_K, *EXPOSED, *_STORM, *_END, "flag"], "wx_p4")
QUERIES["daily_dfo"] = select([*_K, *EXPOSED, *_STORM, *_SEEN, *_END, "flag"], "ex_p5")
QUERIES["daily_viirs"] = select([*_K, *EXPOSED, *_STORM, *_SEEN, *_LAYERS, *_END, "flag"], "ex_p6")

QUERIES["exposure"] = select(["pfaf_id", *EXPOSED], "f_exposure")
CTES["u_fc"] = "SELECT coalesce(s.pfaf_id, g.pfaf_id) AS pfaf_id, s.glofas_score, g.gfms_score FROM s_glofas s FULL JOIN s_gfms g ON s.pfaf_id = g.pfaf_id"
QUERIES["fuse_forecast"] = select(["pfaf_id", "glofas_score", "gfms_score"], "u_fc")
QUERIES["combine_forecast"] = """
SELECT pfaf_id, round(CASE WHEN y = 0 THEN x * 2e0 ELSE x END + 3e-10, 6) + 0e0 AS glofas_score,
 round(CASE WHEN x = 0 THEN y * 2e0 ELSE y END + 3e-10, 6) + 0e0 AS gfms_score,
 round(CASE WHEN y = 0 THEN x * 2e0 ELSE x END + CASE WHEN x = 0 THEN y * 2e0 ELSE y END + 3e-10, 6) + 0e0 AS forecast_score
FROM (SELECT pfaf_id, coalesce(glofas_score, 0e0) AS x, coalesce(gfms_score, 0e0) AS y FROM u_fc)"""
QUERIES["fuse_exposure_full"] = select(["pfaf_id", "gfms_score", *EXPOSED], "(SELECT coalesce(e.pfaf_id, s.pfaf_id) AS pfaf_id, s.gfms_score, e.* EXCLUDE (pfaf_id) FROM f_exposure e FULL JOIN s_gfms s ON e.pfaf_id = s.pfaf_id)")
QUERIES["fuse_exposure_right"] = select(["pfaf_id", "viirs_total", *EXPOSED], "(SELECT s.pfaf_id, s.viirs_total, e.* EXCLUDE (pfaf_id) FROM f_exposure e RIGHT JOIN s_viirs s ON e.pfaf_id = s.pfaf_id)")
_BASE = "(SELECT run_ts, pfaf_id, hazard_score, flag FROM {0})"
QUERIES["fuse_hwrf"] = f"""
SELECT run_ts, pfaf_id, {r6('hwrf_total')}, round(greatest(hazard_score, hwrf_total) + 3e-10, 6) + 0e0 AS hazard_score,
 CASE WHEN hazard_score < hwrf_total THEN 1 END AS flag
FROM (SELECT run_ts, pfaf_id, hazard_score FROM a_p3) FULL JOIN (SELECT run_ts, pfaf_id, hwrf_total FROM s_hwrf) USING (run_ts, pfaf_id)"""
for _name, _prev, _src, _total, _code in (("fuse_dfo", "a_p4", "s_dfo", "dfo_total", 2), ("fuse_viirs", "a_p5", "s_viirs", "viirs_total", 3)):
    QUERIES[_name] = f"""
SELECT run_ts, pfaf_id, {r6(_total)}, round(greatest(coalesce(hazard_score, 0e0), {_total}) + 3e-10, 6) + 0e0 AS hazard_score,
 CASE WHEN coalesce(hazard_score, 0e0) < {_total} THEN {_code} ELSE flag END AS flag
FROM {_BASE.format(_prev)} FULL JOIN (SELECT run_ts, pfaf_id, {_total} FROM {_src}) USING (run_ts, pfaf_id)"""
QUERIES["drop_no_hazard"] = select(["run_ts", "pfaf_id", "gfms_score"], "s_gfms WHERE gfms_score IS NULL OR gfms_score <> 0")
QUERIES["drop_unexposed"] = select(["pfaf_id", "rfr_score", "cfr_score"], "f_attributes WHERE pfaf_id NOT IN (SELECT pfaf_id FROM f_attributes WHERE rfr_score = 0 AND cfr_score = 0)")
CTES["u_sev"] = severity_sql("(SELECT s.pfaf_id, s.gfms_score AS hazard_score, rfr_score, cfr_score FROM s_gfms s LEFT JOIN f_exposure e ON s.pfaf_id = e.pfaf_id)")
QUERIES["severity"] = f"SELECT pfaf_id, {r6('hazard_score', 'scaled_riverine_risk', 'scaled_coastal_risk', 'severity')}, {alert_sql('severity', 'hazard_score')} AS alert FROM u_sev"
QUERIES["alerts_clean"] = select([*_K, *EXPOSED, "alert", "flag"], "(SELECT p.run_ts, p.pfaf_id, e.* EXCLUDE (pfaf_id), p.alert, p.flag FROM f_exposure e RIGHT JOIN a_p5 p ON e.pfaf_id = p.pfaf_id)")

# --- time -------------------------------------------------------------------------------------------------------------

_STATUS = f"""CASE WHEN {CODE.format('previous_alert')} IS NULL THEN 'New'
 WHEN {CODE.format('alert')} = {CODE.format('previous_alert')} THEN 'Continued'
 WHEN {CODE.format('alert')} > {CODE.format('previous_alert')} THEN 'Upgraded'
 WHEN {CODE.format('alert')} < {CODE.format('previous_alert')} THEN 'Downgraded' ELSE 'Other' END"""
CTES["t_pairs"] = """
SELECT a.*, b.alert AS previous_alert FROM f_alerts a
LEFT JOIN f_alerts b ON a.pfaf_id = b.pfaf_id AND b.run_ts = a.run_ts - INTERVAL 1 DAY
WHERE a.run_ts - INTERVAL 1 DAY IN (SELECT run_ts FROM f_alerts)"""
CTES["t_status"] = f"SELECT *, {_STATUS} AS status FROM t_pairs"
QUERIES["alert_status"] = select(["run_ts", "pfaf_id", "hazard_score", "alert", "previous_alert", "status"], "t_status")
QUERIES["alert_codes"] = f"SELECT run_ts, pfaf_id, alert, {CODE.format('alert')} AS code, alert AS label FROM f_alerts"
QUERIES["final_alert"] = f"""
SELECT run_ts, pfaf_id, {r6('hazard_score')}, NULL::DOUBLE AS severity, alert, NULL::INTEGER AS flag, status, admin_name, part, {r6('centroid_y')}
FROM f_centroids JOIN t_status USING (pfaf_id)"""
CTES["t_steps"] = "SELECT *, row_number() OVER (PARTITION BY pfaf_id ORDER BY run_ts) AS n FROM f_series"
CTES["t_dur"] = """
SELECT pfaf_id, run_ts, n, CASE WHEN gfms_totalarea_km > 100 THEN 3 ELSE 0 END AS hours FROM t_steps WHERE n = 1
UNION ALL
SELECT s.pfaf_id, s.run_ts, s.n, CASE WHEN s.gfms_totalarea_km > 100 THEN 3 + CASE WHEN s.run_ts - d.run_ts <= INTERVAL 3 HOUR THEN d.hours ELSE 0 END ELSE 0 END
FROM t_dur d JOIN t_steps s ON s.pfaf_id = d.pfaf_id AND s.n = d.n + 1"""
QUERIES["flood_duration"] = f"SELECT pfaf_id, run_ts, {r6('gfms_totalarea_km')}, hours::INTEGER AS gfms_duration FROM t_dur JOIN f_series USING (pfaf_id, run_ts)"
QUERIES["flood_duration_carry"] = QUERIES["flood_duration"] + " WHERE run_ts >= TIMESTAMP '2024-01-15 00:00:00'"
CTES["t_gapped"] = "SELECT pfaf_id, run_ts, gfms_totalarea_km, row_number() OVER (PARTITION BY pfaf_id ORDER BY run_ts) AS n FROM f_series WHERE gfms_totalarea_km > 0"
CTES["t_gdur"] = """
SELECT pfaf_id, run_ts, n, CASE WHEN gfms_totalarea_km > 100 THEN 3 ELSE 0 END AS hours FROM t_gapped WHERE n = 1
UNION ALL
SELECT s.pfaf_id, s.run_ts, s.n, CASE WHEN s.gfms_totalarea_km > 100 THEN 3 + CASE WHEN s.run_ts - d.run_ts <= INTERVAL 3 HOUR THEN d.hours ELSE 0 END ELSE 0 END
FROM t_gdur d JOIN t_gapped s ON s.pfaf_id = d.pfaf_id AND s.n = d.n + 1"""
QUERIES["flood_duration_gaps"] = f"SELECT pfaf_id, run_ts, {r6('gfms_totalarea_km')}, hours::INTEGER AS gfms_duration FROM t_gdur JOIN f_series USING (pfaf_id, run_ts)"


def _asof(dates: str) -> str:
    return f"""(SELECT max(run_date) FROM {dates} d WHERE d.run_date >= r.run_ts::DATE - 9
 AND (d.run_date < r.run_ts::DATE OR (hour(r.run_ts) = 18 AND d.run_date = r.run_ts::DATE)))"""


QUERIES["asof_latest"] = f"SELECT run_ts, {_asof('f_click_dates')} AS dfo_date, {_asof('f_view_dates')} AS viirs_date, {_asof('f_sparse_dates')} AS rare_date FROM f_runs r"
QUERIES["observation_runs"] = f"SELECT * FROM (SELECT run_ts, {_asof('f_sparse_dates')} AS dfo_date, {_asof('f_view_dates')} AS viirs_date FROM f_runs r) WHERE dfo_date IS NOT NULL AND viirs_date IS NOT NULL"
QUERIES["latest_within"] = """
SELECT r.run_ts, CASE WHEN date_diff('hour', s.run_ts, r.run_ts) <= 6 THEN s.run_ts END AS source_ts
FROM f_runs r ASOF LEFT JOIN f_storms s ON r.run_ts >= s.run_ts"""
QUERIES["latest_or"] = """
SELECT r.run_ts, d.run_date AS source_date
FROM (SELECT run_ts, run_ts::DATE AS day FROM f_runs) r ASOF LEFT JOIN f_click_dates d ON r.day >= d.run_date"""
QUERIES["latest_n"] = "SELECT run_ts FROM f_runs ORDER BY run_ts DESC LIMIT 7"
QUERIES["latest_n_per"] = f"SELECT run_ts, pfaf_id, {r6('hazard_score')}, alert FROM f_alerts QUALIFY row_number() OVER (PARTITION BY pfaf_id ORDER BY run_ts DESC) <= 5"
QUERIES["pending_dates"] = "SELECT run_date FROM f_click_dates EXCEPT SELECT run_date FROM f_view_dates"
QUERIES["run_dates"] = f"SELECT run_ts FROM f_storms UNION SELECT run_date::TIMESTAMP FROM f_view_dates UNION SELECT run_date::TIMESTAMP FROM f_click_dates"
QUERIES["ready_runs"] = "SELECT run_ts FROM f_runs WHERE TIMESTAMP '2024-01-30 20:30:00' - run_ts > INTERVAL 6 HOUR"
QUERIES["date_scalars"] = f"""
SELECT event_id, floor((epoch(ts::DATE) - epoch({NOW})) / 86400e0)::INTEGER AS days_from_now,
 trunc((epoch_us(ts) - epoch_us({NOW})) / 3600e6)::INTEGER AS hours_to_now,
 time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') AS slot,
 time_bucket(INTERVAL 6 HOUR, ts - INTERVAL 6 HOUR, TIMESTAMP '2000-01-01') AS due_slot,
 ts::DATE AS doy_day, ts::DATE - 3 AS three_days_before, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
 ts::DATE AS text_day, date_trunc('hour', ts) AS path_ts, {NOW} - ts > INTERVAL 6 HOUR AS ready
FROM events"""

# --- rasters, polygons, points ----------------------------------------------------------------------------------------

_KM = "111.111e0 * 111.111e0"


def zonal(deg2rad: str) -> str:
    return f"""
SELECT p.run_ts, m.pfaf_id, sum({_KM} * cos(m.lat * {deg2rad})) AS area, avg(p.value) AS mean, max(p.value) AS top
FROM f_pixels p JOIN f_members m USING (row_no, col_no) WHERE p.value <> -9999 GROUP BY p.run_ts, m.pfaf_id"""


CTES["z_gfms"] = zonal("(pi() / 180e0)")
CTES["z_hwrf"] = zonal("0.01745e0")
CTES["z_runs"] = "SELECT run_ts, pfaf_id, area_km2 FROM f_sheds CROSS JOIN (SELECT DISTINCT run_ts FROM f_pixels)"
CTES["z_gfms_summary"] = """
SELECT w.run_ts, w.pfaf_id, coalesce(area, 0) AS gfms_totalarea_km, coalesce(area / area_km2 * 100e0, 0) AS gfms_perc_area,
 coalesce(mean, 0) AS gfms_meandepth, coalesce(top, 0) AS gfms_maxdepth, CASE WHEN area > 100 THEN 3 ELSE 0 END AS gfms_duration
FROM z_runs w LEFT JOIN z_gfms z ON w.run_ts = z.run_ts AND w.pfaf_id = z.pfaf_id"""
QUERIES["zonal_gfms"] = select([*_K, "gfms_totalarea_km", "gfms_perc_area", "gfms_meandepth", "gfms_maxdepth", "gfms_duration"], "z_gfms_summary")
CTES["z_hwrf_summary"] = """
SELECT z.run_ts, z.pfaf_id, area AS rain_totalarea_km, area / area_km2 * 100e0 AS perc_area, mean AS meanrain, top AS maxrain
FROM z_hwrf z JOIN f_sheds USING (pfaf_id)"""
QUERIES["zonal_gfms_rows"] = QUERIES["zonal_gfms_grids"] = QUERIES["zonal_gfms"]
QUERIES["float_grid"] = "SELECT run_ts, row_no, col_no, value FROM f_pixels WHERE value <> -9999e0"
QUERIES["zonal_hwrf"] = select([*_K, "rain_totalarea_km", "perc_area", "meanrain", "maxrain"], "z_hwrf_summary")
CTES["z_dfo"] = """
SELECT q.run_date, q.layer, w.pfaf_id, round(coalesce(n, 0) * 0.0625e0, 3) AS area, round(coalesce(n, 0) * 0.0625e0 / area_km2 * 100e0, 3) AS perc
FROM f_sheds w CROSS JOIN (SELECT DISTINCT run_date, layer FROM f_dfo_pixels) q
LEFT JOIN (SELECT run_date, layer, pfaf_id, count(*) AS n FROM f_dfo_pixels JOIN f_members USING (row_no, col_no) WHERE value = 3 GROUP BY ALL) c
 ON c.pfaf_id = w.pfaf_id AND c.run_date = q.run_date AND c.layer = q.layer"""
QUERIES["zonal_dfo"] = f"SELECT run_date, layer, pfaf_id, {r6('area', 'perc')} FROM z_dfo"
CTES["z_dfo_wide"] = "SELECT a.run_date, a.pfaf_id, " + ", ".join(
    f"{n}.area AS {n}_area, {n}.perc AS {n}_perc" for n in ("d1", "d1cs", "d2", "d3")
) + " FROM (SELECT DISTINCT run_date, pfaf_id FROM {src}) a" + "".join(
    f" JOIN (SELECT * FROM {{src}} WHERE layer = '{n}') {n} ON {n}.run_date = a.run_date AND {n}.pfaf_id = a.pfaf_id" for n in ("d1", "d1cs", "d2", "d3"))
_WIDE = CTES.pop("z_dfo_wide")
CTES["z_dfo_wide"] = _WIDE.format(src="z_dfo")
CTES["z_dfo_some"] = "SELECT * FROM z_dfo WHERE area > 0"
CTES["z_dfo_part"] = _WIDE.format(src="z_dfo_some")
QUERIES["merge_dfo_layers"] = select(["run_date", "pfaf_id", *DFO_RAW], "z_dfo_part")
CTES["z_viirs"] = """
SELECT run_date, product, pfaf_id, n * 0.140625e0 AS area, n * 0.140625e0 / area_km2 * 100e0 AS perc
FROM (SELECT run_date, product, pfaf_id, count(*) AS n FROM f_viirs_pixels JOIN f_members USING (row_no, col_no)
 WHERE value > 140 AND value < 201 GROUP BY ALL) JOIN f_sheds USING (pfaf_id)"""
QUERIES["zonal_viirs"] = f"""
SELECT q.run_date, q.product, w.pfaf_id, round(coalesce(area, 0) + 3e-10, 6) + 0e0 AS area, round(coalesce(perc, 0) + 3e-10, 6) + 0e0 AS perc
FROM f_sheds w CROSS JOIN (SELECT DISTINCT run_date, product FROM f_viirs_pixels) q
LEFT JOIN z_viirs z ON z.pfaf_id = w.pfaf_id AND z.run_date = q.run_date AND z.product = q.product"""
CTES["z_viirs_wide"] = """
SELECT run_date, pfaf_id, coalesce(a.area, 0) AS oneday_flood_area_km, coalesce(a.perc, 0) AS oneday_perc_area,
 coalesce(b.area, 0) AS fiveday_flood_area_km, coalesce(b.perc, 0) AS fiveday_perc_area
FROM (SELECT * FROM z_viirs WHERE product = '1day') a FULL JOIN (SELECT * FROM z_viirs WHERE product = '5day') b USING (run_date, pfaf_id)"""
QUERIES["merge_viirs"] = select(["run_date", "pfaf_id", *VIIRS_RAW], "z_viirs_wide")
QUERIES["viirs_pipeline"] = QUERIES["merge_viirs"]
CTES["z_complete"] = f"SELECT run_date, count(DISTINCT tile) AS tiles FROM f_dfo_pixels GROUP BY run_date HAVING run_date < DATE '2024-01-02' OR count(DISTINCT tile) >= 73"
QUERIES["complete_dates"] = "SELECT * FROM z_complete"
QUERIES["dfo_pipeline"] = select(["run_date", "pfaf_id", *DFO_RAW], "z_dfo_wide WHERE run_date IN (SELECT run_date FROM z_complete)")
QUERIES["watershed_spans"] = """
SELECT pfaf_id, row_no::INTEGER AS row_no, count(*) AS cells FROM (
 SELECT r AS row_no, c AS col_no, e.pfaf_id FROM (SELECT unnest(range(180)) AS r) JOIN f_edges e
  ON (e.y1 <= 90e0 - (r + 0.5e0)) <> (e.y2 <= 90e0 - (r + 0.5e0))
 JOIN (SELECT unnest(range(360)) AS c) ON -180e0 + (c + 0.5e0) < e.x1 + ((90e0 - (r + 0.5e0)) - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
 GROUP BY r, c, e.pfaf_id HAVING count(*) % 2 = 1) GROUP BY pfaf_id, row_no"""
QUERIES["pixel_geometry"] = f"""
SELECT run_ts, row_no, col_no, -180e0 + (col_no + 0.5e0) AS lon, 90e0 - (row_no + 0.5e0) AS lat,
 round({_KM} * cos((90e0 - (row_no + 0.5e0)) * (pi() / 180e0)) + 3e-10, 6) AS km2,
 round({_KM} * cos((90e0 - (row_no + 0.5e0)) * 0.01745e0) + 3e-10, 6) AS rain_km2 FROM f_pixels"""
QUERIES["points_in_watersheds"] = "SELECT point_no, pfaf_id, round(lon + 3e-10, 6) AS lon, round(lat + 3e-10, 6) AS lat FROM f_located"
QUERIES["upsample"] = "SELECT run_ts, row_no * 2 + r AS row_no, col_no * 2 + c AS col_no, value FROM f_pixels, (SELECT unnest([0, 1]) AS r), (SELECT unnest([0, 1]) AS c)"
QUERIES["clip_rain"] = f"SELECT source, ordinal, {r6('lon', 'lat', 'z')} FROM f_clipped"
CTES["z_rcells"] = """
SELECT *, floor((90e0 - lat) / 1e0)::INTEGER AS row_no, floor((lon + 180e0) / 1e0)::INTEGER AS col_no FROM f_clipped"""
CTES["z_rast"] = """
SELECT run_ts, source, row_no, col_no, arg_max(z, ordinal) AS value FROM z_rcells
WHERE row_no BETWEEN 0 AND 179 AND col_no BETWEEN 0 AND 359 GROUP BY ALL"""
QUERIES["rasterize"] = f"SELECT run_ts, source, row_no, col_no, {r6('value')} FROM z_rast"
QUERIES["mosaic"] = f"SELECT run_ts, row_no, col_no, {r6('value')} FROM (SELECT run_ts, row_no, col_no, arg_max(value, source) AS value FROM z_rast GROUP BY ALL)"
CTES["z_prast"] = """
SELECT run_ts, source, row_no, col_no, z AS value FROM z_rcells WHERE row_no BETWEEN 0 AND 179 AND col_no BETWEEN 0 AND 359
QUALIFY row_number() OVER (PARTITION BY run_ts, source, row_no, col_no ORDER BY lat DESC, lon DESC, z DESC) = 1"""
CTES["z_pmos"] = "SELECT run_ts, row_no, col_no, 90e0 - (row_no + 0.5e0) AS lat, -180e0 + (col_no + 0.5e0) AS lon, arg_max(value, source) AS value FROM z_prast GROUP BY ALL"
CTES["z_pmem"] = parity("z_pmos", "run_ts, row_no, col_no, lat, value")
QUERIES["hwrf_pipeline"] = f"""
SELECT run_ts, pfaf_id, round(sum(a) + 3e-10, 6) AS rain_totalarea_km, round(sum(a) / any_value(area_km2) * 100e0 + 3e-10, 6) AS perc_area,
 round(avg(value) + 3e-10, 6) AS meanrain, round(max(value) + 3e-10, 6) AS maxrain
FROM (SELECT *, {_KM} * cos(lat * 0.01745e0) AS a FROM z_pmem) JOIN f_sheds USING (pfaf_id) GROUP BY run_ts, pfaf_id"""
# Upsampled by two, a cell's four children have their own centres on the finer grid.
CTES["z_fine"] = """
SELECT run_ts, value, 90e0 - (row_no * 2 + r + 0.5e0) * 0.5e0 AS lat, -180e0 + (col_no * 2 + c + 0.5e0) * 0.5e0 AS lon
FROM f_pixels, (SELECT unnest([0, 1]) AS r), (SELECT unnest([0, 1]) AS c)"""
CTES["z_fmem"] = parity("z_fine", "run_ts, value, lat, lon")
CTES["z_fstat"] = f"""
SELECT run_ts, pfaf_id, sum({_KM} * cos(lat * (pi() / 180e0)) * 0.5e0 * 0.5e0) AS area, avg(value) AS mean, max(value) AS top
FROM z_fmem WHERE value <> -9999 GROUP BY run_ts, pfaf_id"""
CTES["z_fsum"] = """
SELECT w.run_ts, w.pfaf_id, coalesce(area, 0) AS gfms_totalarea_km, coalesce(area / area_km2 * 100e0, 0) AS gfms_perc_area,
 coalesce(mean, 0) AS gfms_meandepth, coalesce(top, 0) AS gfms_maxdepth,
 row_number() OVER (PARTITION BY w.pfaf_id ORDER BY w.run_ts) AS n
FROM z_runs w LEFT JOIN z_fstat z ON w.run_ts = z.run_ts AND w.pfaf_id = z.pfaf_id"""
CTES["z_fdur"] = """
SELECT pfaf_id, run_ts, n, CASE WHEN gfms_totalarea_km > 100 THEN 3 ELSE 0 END AS hours FROM z_fsum WHERE n = 1
UNION ALL
SELECT s.pfaf_id, s.run_ts, s.n, CASE WHEN s.gfms_totalarea_km > 100 THEN 3 + CASE WHEN s.run_ts - d.run_ts <= INTERVAL 3 HOUR THEN d.hours ELSE 0 END ELSE 0 END
FROM z_fdur d JOIN z_fsum s ON s.pfaf_id = d.pfaf_id AND s.n = d.n + 1"""
QUERIES["gfms_pipeline"] = f"""
SELECT run_ts, pfaf_id, {r6('gfms_totalarea_km', 'gfms_perc_area', 'gfms_meandepth', 'gfms_maxdepth')}, hours::INTEGER AS gfms_duration
FROM z_fsum JOIN z_fdur USING (run_ts, pfaf_id)"""

# --- stations ---------------------------------------------------------------------------------------------------------

_PLACE = ["run_ts", "point_no", "station", "basin", "country", "alert_level", "days_until_peak"]
_FLOATS = ["upstream_area", "lon", "lat", "glofas_2yr", "glofas_5yr", "glofas_20yr"]
QUERIES["station_union"] = f"SELECT {plain(*_PLACE)}, {r6(*_FLOATS)} FROM f_raw_stations WHERE point_no % 3 <> 0 OR run_ts < TIMESTAMP '2024-01-02 00:00:00'"
QUERIES["probability_rescale"] = f"SELECT {plain(*_PLACE)}, {r6(*_FLOATS)} FROM f_rescaled"


def published(source: str, pfaf: str) -> str:
    return f"""
SELECT point_no, station, basin, country, round(lat, 3) AS lat, round(lon, 3) AS lon, round(upstream_area, 3) AS upstream_area,
 strftime(run_ts, '%Y-%m-%dT%H:%M:%S') AS forecast_date,
 trunc(glofas_2yr)::INTEGER || '/' || trunc(glofas_5yr)::INTEGER || '/' || trunc(glofas_20yr)::INTEGER AS max_eps,
 trunc(glofas_2yr)::INTEGER AS glofas_2yr, trunc(glofas_5yr)::INTEGER AS glofas_5yr, trunc(glofas_20yr)::INTEGER AS glofas_20yr,
 alert_level, days_until_peak, {pfaf} AS pfaf_id FROM {source}"""


QUERIES["station_output"] = published("f_rescaled", "point_no")
# The rescaling looks at located stations only.
CTES["z_placed"] = "SELECT f.*, l.pfaf_id FROM f_raw_stations f JOIN f_located l USING (point_no)"
CTES["z_prescaled"] = """
SELECT * REPLACE (glofas_2yr * factor AS glofas_2yr, glofas_5yr * factor AS glofas_5yr, glofas_20yr * factor AS glofas_20yr)
FROM (SELECT *, CASE WHEN max(glofas_2yr) OVER (PARTITION BY run_ts) <= 1e0 THEN 100e0 ELSE 1e0 END AS factor FROM z_placed)"""
QUERIES["glofas_stations"] = published("z_prescaled", "pfaf_id")
QUERIES["to_geojson_lines"] = """
SELECT '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || lon || ',' || lat || ']},"properties":{"point_no":'
 || point_no || ',"pfaf_id":' || pfaf_id || '}}' AS value FROM f_located"""

# --- monitoring -------------------------------------------------------------------------------------------------------

CTES["o_fresh"] = f"""
SELECT 'data' AS kind, event_type AS product, max(ts::DATE) AS latest,
 floor((epoch(max(ts::DATE)) - epoch({NOW})) / 86400e0)::INTEGER AS days,
 CASE event_type WHEN 'click' THEN -1 WHEN 'view' THEN -2 WHEN 'error' THEN -3 WHEN 'purchase' THEN -1 END AS oldest,
 event_type <> 'error' AND event_type <> 'purchase' AS counted
FROM events GROUP BY event_type"""
CTES["o_status"] = "SELECT kind, product, latest, days, CASE WHEN days < oldest THEN 'warning' ELSE 'normal' END AS status, counted FROM o_fresh WHERE oldest IS NOT NULL"
QUERIES["freshness"] = "SELECT * FROM o_status"
QUERIES["freshness_absent"] = """
SELECT * FROM o_status UNION ALL SELECT 'data', 'refund', NULL, NULL, 'warning', true"""
QUERIES["freshness_overall"] = "SELECT CASE WHEN coalesce(bool_or(counted AND status = 'warning'), false) THEN 'warning' ELSE 'normal' END AS status, count(*) AS products FROM o_status"
_UP = "count(*) AS total, count(*) FILTER (status = 'UP') AS up, count(*) FILTER (status <> 'UP') AS down, round(count(*) FILTER (status = 'UP') * 100e0 / count(*) + 3e-10, 6) AS success_rate"
QUERIES["uptime_summary"] = f"SELECT name, {_UP} FROM f_checks GROUP BY name"
QUERIES["uptime_latest"] = f"SELECT {_UP} FROM (SELECT name, arg_max(status, ts) AS status FROM f_checks GROUP BY name)"

# --- files and streams: what was written and read back, what the batch twin gives -------------------------------------

QUERIES["read_summary"] = select([*_K, *GFMS[:5]], "f_gfms")
QUERIES["read_pixels"] = "SELECT run_date, layer, row_no, col_no, value, tile::INTEGER AS tile FROM f_dfo_pixels WHERE layer IN ('d1', 'd2') AND run_date >= DATE '2024-01-02'"
QUERIES["read_stations"] = f"""
SELECT run_ts, CASE WHEN point_no % 3 <> 0 THEN 'fixed' ELSE 'dynamic' END AS kind,
 CASE WHEN run_ts < TIMESTAMP '2024-01-02 00:00:00' THEN 19 ELSE 18 END AS width, point_no, station, basin, country,
 {r6('upstream_area', 'lon', 'lat', 'glofas_2yr', 'glofas_5yr', 'glofas_20yr')}, alert_level, days_until_peak FROM f_raw_stations"""
QUERIES["read_rain_text"] = f"SELECT run_ts, {r6('lon', 'lat', 'z')} FROM (SELECT * FROM f_rain)"
QUERIES["read_watersheds"] = "SELECT pfaf_id, area_km2, count(*) AS edges FROM f_sheds JOIN f_edges USING (pfaf_id) GROUP BY ALL"
QUERIES["read_dimensions"] = f"SELECT pfaf_id, {r6(*[c for c in EXPOSED if c not in WHOLE])}, iso, admin0, admin1, admin_name, part::VARCHAR AS part, {r6('centroid_y')} FROM f_exposure JOIN f_centroids USING (pfaf_id)"
QUERIES["write_product_csv"] = QUERIES["read_summary"].replace("gfms_duration", "gfms_duration")
QUERIES["write_rejected"] = "SELECT error, count(*) AS n FROM checked WHERE error IS NOT NULL GROUP BY error"
QUERIES["write_partitions"] = f"SELECT run_ts, pfaf_id, {r6('hazard_score')}, alert FROM f_alerts"
QUERIES["reprocess"] = f"SELECT run_ts, pfaf_id, round(CASE WHEN run_ts >= TIMESTAMP '2024-01-20 00:00:00' THEN -hazard_score ELSE hazard_score END + 3e-10, 6) AS hazard_score, alert FROM f_alerts"
QUERIES["stream_summaries"] = QUERIES["read_summary"]
QUERIES["stream_bins"] = """
SELECT run_ts, pfaf_id, round(sum(value) + 3e-10, 6) + 0e0 AS total, count(*) AS n
FROM (SELECT *, user_id % 10 AS pfaf_id FROM f_bins3) GROUP BY run_ts, pfaf_id"""
QUERIES["stream_summaries_daily"] = f"SELECT run_date, pfaf_id, {r6(*VIIRS_RAW)} FROM f_viirs"
QUERIES["stream_upsert"] = f"SELECT run_ts, pfaf_id, {rnd('hazard_score * CASE WHEN run_ts >= TIMESTAMP \'2024-01-20 00:00:00\' THEN 2 ELSE 1 END')} AS hazard_score, alert FROM f_alerts"
QUERIES["merge_duplicates"] = f"""
SELECT coalesce(g.run_ts, h.run_ts) AS run_ts, coalesce(g.pfaf_id, h.pfaf_id) AS pfaf_id, {r6('gfms_totalarea_km', 'rain_totalarea_km')}
FROM f_gfms g FULL JOIN f_hwrf h ON g.pfaf_id = h.pfaf_id"""
QUERIES["flood_duration_redelivered"] = QUERIES["flood_duration"]
QUERIES["stream_flood_duration"] = QUERIES["stream_flood_duration_batches"] = QUERIES["flood_duration"]
QUERIES["stream_alert_status"] = "SELECT run_ts, pfaf_id, alert, previous_alert, status FROM t_status"


for _name in ("zonal_hwrf", "gfms_pipeline"):
    QUERIES[f"{_name}_rows"] = QUERIES[_name]


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql.strip()) for name, sql in QUERIES.items()}
