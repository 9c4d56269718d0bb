"""US EPA Air Quality Index as Spark column expressions (no UDF).

A reading's concentration is normalised to the breakpoint unit, truncated
toward zero, then interpolated linearly inside its band:

    ((aqi_hi - aqi_lo) / (c_hi - c_lo)) * (c - c_lo) + aqi_lo

Above the top band the score clamps to that band's ceiling; anything that
cannot be scored is NULL. The band is found by a *band index* (count of band
floors at or below ``c``) and the four band constants are read from literal
arrays, which keeps the generated code small (a flat 35-arm CASE compiles
to a method too large for the JIT).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the published EPA table (effective 6 May
# 2024) and the conversion constants used for the reference results.
# ---------------------------------------------------------------------------

DANGEROUS_AQI = 151

# L/mol at 25 C and 1 atm, and g/mol per gas.
MOLAR_VOLUME_25C = 24.45
MOLECULAR_WEIGHT = {
    "o3": 48.00,
    "co": 28.01,
    "no2": 46.0055,
    "so2": 64.066,
}

# pollutant -> (breakpoint unit, decimals the concentration is truncated to)
BREAKPOINT_UNIT = {
    "pm25": ("ugm3", 1),
    "pm10": ("ugm3", 0),
    "o3": ("ppm", 3),
    "co": ("ppm", 1),
    "so2": ("ppb", 0),
    "no2": ("ppb", 0),
}

# pollutant -> [(c_lo, c_hi, aqi_lo, aqi_hi), ...], in the units above.
BREAKPOINTS = {
    "pm25": [
        (0.0, 9.0, 0, 50),
        (9.1, 35.4, 51, 100),
        (35.5, 55.4, 101, 150),
        (55.5, 125.4, 151, 200),
        (125.5, 225.4, 201, 300),
        (225.5, 325.4, 301, 500),
    ],
    "pm10": [
        (0, 54, 0, 50),
        (55, 154, 51, 100),
        (155, 254, 101, 150),
        (255, 354, 151, 200),
        (355, 424, 201, 300),
        (425, 604, 301, 500),
    ],
    "o3": [
        (0.000, 0.054, 0, 50),
        (0.055, 0.070, 51, 100),
        (0.071, 0.085, 101, 150),
        (0.086, 0.105, 151, 200),
        (0.106, 0.200, 201, 300),
    ],
    "co": [
        (0.0, 4.4, 0, 50),
        (4.5, 9.4, 51, 100),
        (9.5, 12.4, 101, 150),
        (12.5, 15.4, 151, 200),
        (15.5, 30.4, 201, 300),
        (30.5, 50.4, 301, 500),
    ],
    "so2": [
        (0, 35, 0, 50),
        (36, 75, 51, 100),
        (76, 185, 101, 150),
        (186, 304, 151, 200),
        (305, 604, 201, 300),
        (605, 1004, 301, 500),
    ],
    "no2": [
        (0, 53, 0, 50),
        (54, 100, 51, 100),
        (101, 360, 101, 150),
        (361, 649, 151, 200),
        (650, 1249, 201, 300),
        (1250, 2049, 301, 500),
    ],
}

# Closed integer ranges -> label; above 500 is Hazardous, anything else Good.
CATEGORIES = [
    (0, 50, "Good"),
    (51, 100, "Moderate"),
    (101, 150, "Unhealthy for Sensitive Groups"),
    (151, 200, "Unhealthy"),
    (201, 300, "Very Unhealthy"),
    (301, 500, "Hazardous"),
]

# Units the table accepts after normalisation (lower case, micro sign -> u,
# superscript three -> 3).
MASS_UNITS = ("ug/m3", "ugm3")

# ---------------------------------------------------------------------------

POLLUTANTS = list(BREAKPOINTS)          # tie order for the dominant pollutant
PARTICULATES = ("pm25", "pm10")

# A double of this magnitude or more has no fraction to cut off.
_INTEGRAL = float(1 << 53)


def _band_layout():
    """Offsets of each pollutant's first band in the flattened band arrays."""
    offsets, c_lo, c_hi, a_lo, a_hi = {}, [], [], [], []
    for p, bands in BREAKPOINTS.items():
        offsets[p] = len(c_lo)
        for lo, hi, alo, ahi in bands:
            c_lo.append(float(lo))
            c_hi.append(float(hi))
            a_lo.append(float(alo))
            a_hi.append(float(ahi))
    return offsets, c_lo, c_hi, a_lo, a_hi


BAND_OFFSET, BAND_C_LO, BAND_C_HI, BAND_AQI_LO, BAND_AQI_HI = _band_layout()


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def normalize_unit(unit) -> Column:
    """lower, micro sign U+00B5 -> 'u', 'g/m³' -> 'g/m3'. Only U+00B5 is
    replaced: Greek mu U+03BC stays, so such a unit scores NULL."""
    return F.replace(F.replace(F.lower(_col(unit)), F.lit("µ"), F.lit("u")),
                     F.lit("g/m³"), F.lit("g/m3"))


def truncate(x, decimals) -> Column:
    """Truncate toward zero at ``decimals`` places (an int, or a Column
    holding the factor ``10**decimals`` as a double); NaN and +-inf give
    NULL."""
    x = _col(x)
    factor = F.lit(float(10 ** decimals)) if isinstance(decimals, int) else decimals
    scaled = x * factor
    whole = F.abs(scaled) >= F.lit(_INTEGRAL)
    # The cast sees only values that fit; NULL and NaN fall through to NULL.
    return (F.when(F.abs(scaled) < F.lit(_INTEGRAL), scaled.cast("long") / factor)
            .when(whole & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), x))


# Per-pollutant constants as arrays indexed by the pollutant code (table
# order), so that the per-row code is array reads and arithmetic instead of
# CASE chains. Small generated code matters: the scoring is fused with the
# scan and the partial aggregate into one generated method, and HotSpot does
# not JIT-compile methods above 8,000 bytes of bytecode.
_MAX_BANDS = max(len(b) for b in BREAKPOINTS.values())
_IS_PARTICULATE = [p in PARTICULATES for p in POLLUTANTS]
_MOLECULAR_WEIGHT = [MOLECULAR_WEIGHT.get(p) for p in POLLUTANTS]
_TARGET_MULTIPLIER = [1.0 if BREAKPOINT_UNIT[p][0] == "ppm" else 1000.0 for p in POLLUTANTS]
_TRUNCATION_FACTOR = [float(10 ** BREAKPOINT_UNIT[p][1]) for p in POLLUTANTS]
_FIRST_BAND = [BAND_OFFSET[p] for p in POLLUTANTS]
_TOP_BAND = [BAND_OFFSET[p] + len(BREAKPOINTS[p]) - 1 for p in POLLUTANTS]
# _FLOOR[k][code]: floor of band k (0-based) of a pollutant, +inf past its last band.
_FLOOR = [[float(BREAKPOINTS[p][k][0]) if k < len(BREAKPOINTS[p]) else math.inf for p in POLLUTANTS]
          for k in range(_MAX_BANDS)]
_UNITS = ["ppm", "ppb", *MASS_UNITS]


def _get(values, index) -> Column:
    """0-based read of a literal array; NULL for a NULL index."""
    return F.get(_lit_array(values), _col(index))


def pollutant_code(pollutant_lower) -> Column:
    """0-based position of a (lower-case) pollutant in the table order, NULL
    for a pollutant without breakpoints."""
    pos = F.array_position(_lit_array(POLLUTANTS), _col(pollutant_lower))
    return F.when(pos > 0, (pos - 1).cast("int"))


UNIT_PPM, UNIT_PPB, UNIT_MASS = 1, 2, 3


def unit_code(unit_normalized) -> Column:
    """1 = ppm, 2 = ppb, 3 = mass concentration, NULL otherwise."""
    pos = F.array_position(_lit_array(_UNITS), _col(unit_normalized))
    return F.when(pos > 0, F.least(pos, F.lit(UNIT_MASS)).cast("int"))


def raw_concentration(code, value, ucode) -> Column:
    """Value converted to the breakpoint unit, before truncation; NULL for
    an unsupported pollutant/unit pair. Same operations, in the same order,
    as the per-reading rule: ppm = v | v / 1000 | (v * 24.45) / (mw * 1000),
    then * 1000 for the ppb tables (* 1.0, an identity, for ppm tables)."""
    k, v, u = _col(code), _col(value), _col(ucode)
    ppm = (F.when(u == UNIT_PPM, v)
           .when(u == UNIT_PPB, v / F.lit(1000.0))
           .when(u == UNIT_MASS,
                 (v * F.lit(MOLAR_VOLUME_25C)) / (_get(_MOLECULAR_WEIGHT, k) * F.lit(1000.0))))
    gas = ppm * _get(_TARGET_MULTIPLIER, k)
    return F.when(_get(_IS_PARTICULATE, k), F.when(u == UNIT_MASS, v)).otherwise(gas)


def truncation_factor(code) -> Column:
    return _get(_TRUNCATION_FACTOR, code)


def concentration(pollutant, value, unit, unit_is_normalized: bool = False) -> Column:
    """Concentration in the breakpoint unit, truncated; NULL when the
    pollutant/unit pair is not supported. ``pollutant`` must be lower case."""
    u = _col(unit) if unit_is_normalized else normalize_unit(unit)
    code = pollutant_code(pollutant)
    return truncate(raw_concentration(code, value, unit_code(u)), truncation_factor(code))


def band_number(code, c) -> Column:
    """0-based position in the flattened band arrays of the band whose floor
    is the largest one at or below ``c`` (``c`` >= 0), for pollutant code
    ``code``."""
    c, k = _col(c), _col(code)
    idx = _get(_FIRST_BAND, k)
    for floors in _FLOOR[1:]:
        idx = idx + (c >= _get(floors, k)).cast("int")
    return idx


def sub_index_from_band(code, c, band) -> Column:
    """Interpolate inside band ``band``; clamp above the top band; NULL for
    a negative or missing concentration (or one in a gap between bands)."""
    c, b = _col(c), _col(band)
    c_lo, c_hi = _get(BAND_C_LO, b), _get(BAND_C_HI, b)
    a_lo, a_hi = _get(BAND_AQI_LO, b), _get(BAND_AQI_HI, b)
    interpolated = ((a_hi - a_lo) / (c_hi - c_lo)) * (c - c_lo) + a_lo
    return (F.when(c.isNull() | (c < 0), F.lit(None).cast("double"))
            .when(c <= c_hi, interpolated)
            .when(b == _get(_TOP_BAND, code), a_hi))


def sub_index(pollutant, value, unit) -> Column:
    """EPA sub-index of one reading (double), NULL when unscorable.

    One self-contained column; it repeats sub-trees, so for whole tables
    use ``airlens.operators.scoring.score``, which stages the same steps as
    separate projections.
    """
    code = pollutant_code(F.lower(_col(pollutant)))
    c = truncate(raw_concentration(code, value, unit_code(normalize_unit(unit))), truncation_factor(code))
    return sub_index_from_band(code, c, band_number(code, c))


def category(aqi) -> Column:
    """Category label. Ranges are closed integers: a fractional value
    between two ranges (50.5) and any negative or NaN value read "Good"."""
    a = _col(aqi)
    expr = F.when(a.isNull(), F.lit(None).cast("string")).when(F.isnan(a), F.lit("Good"))
    for lo, hi, name in CATEGORIES:
        expr = expr.when((a >= lo) & (a <= hi), F.lit(name))
    return expr.when(a > CATEGORIES[-1][1], F.lit("Hazardous")).otherwise(F.lit("Good"))


def is_dangerous(aqi) -> Column:
    return _col(aqi) >= F.lit(DANGEROUS_AQI)


def round_half_even(x) -> Column:
    return F.bround(_col(x), 0)
