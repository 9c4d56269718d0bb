"""DuckDB SQL for the correctness oracle.

The oracle recomputes every registered query from the driver's parquet
views with plain SQL: the same adapter rules, the scoring as one flat
CASE over all 35 bands (an independent form of the band-index column), and
window functions where the Spark side uses aggregates. All literals are
cast to DOUBLE so that both engines do identical IEEE arithmetic.
"""

from __future__ import annotations

from airlens.functions import aqi
from airlens.sources import testdata as td


def d(x: float) -> str:
    if x == float("inf"):
        return "CAST('inf' AS DOUBLE)"
    return f"CAST({float(x)!r} AS DOUBLE)"


def s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _truncate(x: str, decimals: int) -> str:
    f = d(10 ** decimals)
    return (f"(CASE WHEN ({x}) IS NULL OR isnan({x}) OR isinf({x}) THEN NULL "
            f"WHEN abs(({x}) * {f}) >= {d(1 << 53)} THEN {x} ELSE trunc(({x}) * {f}) / {f} END)")


def unit_sql(unit: str) -> str:
    return f"replace(replace(lower({unit}), 'µ', 'u'), 'g/m³', 'g/m3')"


def concentration_sql(p: str, v: str, u: str) -> str:
    mass = ", ".join(s(m) for m in aqi.MASS_UNITS)
    arms = []
    for name, (target, decimals) in aqi.BREAKPOINT_UNIT.items():
        if name in aqi.PARTICULATES:
            conc = f"CASE WHEN {u} IN ({mass}) THEN {_truncate(v, decimals)} END"
        else:
            mw = aqi.MOLECULAR_WEIGHT[name]
            ppm = (f"(CASE WHEN {u} = 'ppm' THEN {v} WHEN {u} = 'ppb' THEN {v} / {d(1000.0)} "
                   f"WHEN {u} IN ({mass}) THEN ({v} * {d(aqi.MOLAR_VOLUME_25C)}) / ({d(mw)} * {d(1000.0)}) END)")
            conc = _truncate(ppm if target == "ppm" else f"({ppm} * {d(1000.0)})", decimals)
        arms.append(f"WHEN {p} = {s(name)} THEN {conc}")
    return "(CASE " + " ".join(arms) + " END)"


def sub_index_sql(p: str, c: str) -> str:
    """Flat CASE over every band, then the clamp rows."""
    arms = [f"WHEN {c} IS NULL OR {c} < 0 THEN NULL"]
    for name, bands in aqi.BREAKPOINTS.items():
        for lo, hi, alo, ahi in bands:
            interp = f"(({d(ahi)} - {d(alo)}) / ({d(hi)} - {d(lo)})) * ({c} - {d(lo)}) + {d(alo)}"
            arms.append(f"WHEN {p} = {s(name)} AND {c} >= {d(lo)} AND {c} <= {d(hi)} THEN {interp}")
        top_hi, top_aqi = bands[-1][1], bands[-1][3]
        arms.append(f"WHEN {p} = {s(name)} AND {c} > {d(top_hi)} THEN {d(top_aqi)}")
    return "(CASE " + " ".join(arms) + " END)"


def category_sql(a: str) -> str:
    arms = [f"WHEN {a} IS NULL THEN NULL", f"WHEN isnan({a}) THEN 'Good'"]
    for lo, hi, name in aqi.CATEGORIES:
        arms.append(f"WHEN {a} >= {lo} AND {a} <= {hi} THEN {s(name)}")
    arms.append(f"WHEN {a} > {aqi.CATEGORIES[-1][1]} THEN 'Hazardous'")
    return "(CASE " + " ".join(arms) + " ELSE 'Good' END)"


def dominant_sql(top: str, prefix: str = "m_") -> str:
    arms = " ".join(f"WHEN {prefix}{n} = {top} THEN {s(n)}" for n in aqi.POLLUTANTS)
    return f"(CASE {arms} END)"


def pollutant_max_sql(score: str = "aqi_sub_index", p: str = "p", prefix: str = "m_") -> str:
    return ", ".join(f"max(CASE WHEN {p} = {s(n)} THEN {score} END) AS {prefix}{n}"
                     for n in aqi.POLLUTANTS)


def _cycle_sql(ix: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {ix} = {i} THEN {s(v)}" for i, v in enumerate(values))
    return f"(CASE {arms} END)"


def readings_cte(ingest: bool = False) -> str:
    """The adapter of ``airlens.sources.testdata`` in SQL (CTE body).

    ``ingest``: the readings that the ingest path builds from the derived
    station documents: units by pollutant only, bc entries (no sensor)
    dropped, ``ingested_at`` = newest reading time.
    """
    pol = _cycle_sql(f"(e.event_id % {len(td.POLLUTANT_CYCLE)})", td.POLLUTANT_CYCLE)
    val = f"(CASE WHEN e.event_id % {td.NEGATIVE_EVERY} = {td.NEGATIVE_AT} THEN -e.value ELSE e.value END)"
    units = " ".join(f"WHEN {pol} = {s(p)} THEN {s(u)}" for p, u in td.SENSOR_UNITS.items())
    if ingest:
        unit = f"CASE {units} END"
        where = f"WHERE e.event_id % {len(td.POLLUTANT_CYCLE)} <> 6 AND e.value IS NOT NULL"
        ingested = "(SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') FROM events)"
    else:
        unit = f"""CASE WHEN e.event_id % {td.MYSTERY_EVERY} = 0 THEN 'mystery'
                WHEN {pol} IN ('pm25', 'pm10') OR e.event_id % {td.MASS_EVERY} = {td.MASS_AT} THEN 'µg/m³'
                WHEN {pol} IN ('o3', 'co') THEN 'ppm'
                ELSE 'ppb' END"""
        where = ""
        ingested = "strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
    return f"""
    SELECT CAST(e.user_id AS INTEGER) AS location_id,
           'Station ' || CAST(e.user_id AS VARCHAR) AS location_name,
           n.n_name AS city, r.r_name AS country,
           CASE WHEN e.user_id % {td.NO_COORDS_EVERY} = 0 THEN NULL
                ELSE n.n_nationkey * {d(td.LAT_STEP)} + {d(td.LAT_BASE)} END AS latitude,
           CASE WHEN e.user_id % {td.NO_COORDS_EVERY} = 0 THEN NULL
                ELSE n.n_nationkey * {d(td.LON_STEP)} + {d(td.LON_BASE)} END AS longitude,
           {pol} AS pollutant,
           CASE WHEN {pol} = 'o3' THEN {val} / {d(1000.0)}
                WHEN {pol} = 'co' THEN {val} / {d(10.0)}
                ELSE {val} END AS value,
           {unit} AS unit,
           strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS datetime_utc,
           {ingested} AS ingested_at,
           CAST(e.ts AS TIMESTAMP) AS event_time,
           e.event_id AS event_id
    FROM events e
    JOIN nation n ON e.user_id % {td.NATIONS} = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    {where}
    """


def scored_ctes(ingest: bool = False) -> str:
    """WITH-list entries: readings, scored (every reading, with score),
    prepared (scored only, with hour)."""
    conc = concentration_sql("p", "value", "u")
    return f"""
    readings AS ({readings_cte(ingest)}),
    norm AS (SELECT *, lower(pollutant) AS p, {unit_sql('unit')} AS u FROM readings),
    conc AS (SELECT *, {conc} AS c FROM norm),
    scored AS (SELECT *, {sub_index_sql('p', 'c')} AS aqi_sub_index FROM conc),
    prepared AS (SELECT *, date_trunc('hour', event_time) AS hour FROM scored
                 WHERE aqi_sub_index IS NOT NULL)
    """


def hourly_ctes() -> str:
    return scored_ctes() + f""",
    hourly_m AS (
      SELECT city, country, hour, max(aqi_sub_index) AS aqi,
             CAST(count(*) AS BIGINT) AS reading_count, {pollutant_max_sql()}
      FROM prepared GROUP BY city, country, hour),
    hourly AS (
      SELECT city, country, hour, {dominant_sql('aqi')} AS dominant_pollutant, aqi,
             reading_count, aqi >= {aqi.DANGEROUS_AQI} AS dangerous
      FROM hourly_m)
    """


def summary_ctes() -> str:
    return hourly_ctes() + """,
    summary_agg AS (
      SELECT city, country, CAST(count(*) AS BIGINT) AS hours_observed, avg(aqi) AS avg_aqi,
             max(aqi) AS max_aqi,
             CAST(sum(CAST(dangerous AS INTEGER)) AS DOUBLE) / count(*) AS pct_hours_dangerous
      FROM hourly GROUP BY city, country),
    summary_best AS (
      SELECT city, country, hour AS max_aqi_at, dominant_pollutant AS worst_pollutant FROM (
        SELECT *, row_number() OVER (PARTITION BY city, country
                                     ORDER BY aqi DESC, hour ASC NULLS LAST) AS rn
        FROM hourly) WHERE rn = 1),
    summary AS (
      SELECT a.city, a.country, a.hours_observed, a.avg_aqi, a.max_aqi, b.max_aqi_at,
             b.worst_pollutant, a.pct_hours_dangerous
      FROM summary_agg a JOIN summary_best b
        ON a.city IS NOT DISTINCT FROM b.city AND a.country IS NOT DISTINCT FROM b.country)
    """


def windowed_ctes() -> str:
    """60-minute windows sliding by 5 minutes: each reading's 5-minute
    bucket start minus 0..11 slides."""
    return scored_ctes() + f""",
    wsrc AS (
      SELECT *, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN location_id END AS sid,
             make_timestamp((epoch_us(event_time) // 300000000) * 300000000) AS bucket
      FROM scored WHERE aqi_sub_index IS NOT NULL AND event_time IS NOT NULL),
    wexp AS (
      SELECT w.*, bucket - to_minutes(CAST(5 * k AS BIGINT)) AS window_start
      FROM wsrc w, range(12) t(k)),
    windowed_m AS (
      SELECT window_start, city, country, max(aqi_sub_index) AS aqi,
             CAST(count(*) AS BIGINT) AS reading_count,
             arg_min(latitude, sid) AS latitude, arg_min(longitude, sid) AS longitude,
             {pollutant_max_sql()}
      FROM wexp GROUP BY window_start, city, country),
    windowed AS (
      SELECT m.window_start, m.window_start + INTERVAL 60 MINUTE AS window_end, m.city, m.country,
             m.aqi, {dominant_sql('m.aqi', 'm.m_')} AS dominant_pollutant, m.reading_count,
             m.aqi >= {aqi.DANGEROUS_AQI} AS dangerous, m.latitude, m.longitude
      FROM windowed_m m)
    """
