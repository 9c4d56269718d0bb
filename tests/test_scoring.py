"""Sub-index, category, danger and the worst-pollutant rule."""

import math

import pytest
from pyspark.sql import functions as F

from airlens.functions import aqi
from airlens.operators.scoring import overall_aqi, score, score_with_table

SCHEMA = "pollutant string, value double, unit string"


def scores(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("aqi_sub_index", F.lit(None).cast("double"))
    return [r.aqi_sub_index for r in score(df).collect()]


def one(spark, pollutant, value, unit):
    return scores(spark, [(pollutant, value, unit)])[0]


# --- cases the reference tests --------------------------------------------

def test_pm25_breakpoint_boundaries(spark):
    got = scores(spark, [("pm25", v, "ug/m3") for v in (9.0, 9.1, 35.4, 55.4, 55.5, 125.4)])
    assert got == [50, 51, 100, 150, 151, 200]


def test_pm25_interpolation_midpoint(spark):
    assert 174 <= one(spark, "pm25", (55.5 + 125.4) / 2, "ug/m3") <= 177


def test_unsupported_unit_is_null(spark):
    assert one(spark, "pm25", 40.0, "mystery-unit") is None


def test_no2_in_ppb(spark):
    assert scores(spark, [("no2", 53.0, "ppb"), ("no2", 100.0, "ppb")]) == [50, 100]


def test_o3_in_ppm_and_mass(spark):
    ppm, mass = scores(spark, [("o3", 0.070, "ppm"), ("o3", 137.2, "ug/m3")])
    assert ppm == 100
    assert abs(mass - ppm) <= 5


def test_clamp_above_top(spark):
    assert one(spark, "pm25", 900.0, "ug/m3") == 500


# --- our additions ----------------------------------------------------------

NATIVE_UNIT = {"pm25": "ug/m3", "pm10": "ug/m3", "o3": "ppm", "co": "ppm", "so2": "ppb", "no2": "ppb"}


def test_every_band_edge_maps_to_its_aqi(spark):
    rows, expected = [], []
    for p, bands in aqi.BREAKPOINTS.items():
        for lo, hi, alo, ahi in bands:
            rows += [(p, float(lo), NATIVE_UNIT[p]), (p, float(hi), NATIVE_UNIT[p])]
            expected += [float(alo), float(ahi)]
    assert len(rows) == 70
    assert scores(spark, rows) == expected


def test_o3_clamps_to_300(spark):
    assert one(spark, "o3", 0.5, "ppm") == 300


def test_small_negative_truncates_to_zero(spark):
    # truncation toward zero happens before the negative test
    assert one(spark, "pm25", -0.05, "ug/m3") == 0
    assert one(spark, "pm25", -0.1, "ug/m3") is None


def test_ppb_round_trip_loses_one_ppb(spark):
    a, b = scores(spark, [("so2", 1001.0, "ppb"), ("so2", 1000.0, "ppb")])
    assert a == b


def test_micro_sign_variants(spark):
    micro, greek = scores(spark, [("pm25", 10.0, "µg/m³"), ("pm25", 10.0, "μg/m³")])
    assert micro is not None
    assert greek is None


def test_null_nan_inf_and_huge(spark):
    got = scores(spark, [("pm25", None, "ug/m3"), ("pm25", math.nan, "ug/m3"),
                         ("pm25", math.inf, "ug/m3"), ("pm25", 1e30, "ug/m3"),
                         ("pm25", 10.0, None), (None, 10.0, "ug/m3")])
    assert got == [None, None, None, 500.0, None, None]


def test_pollutant_name_is_case_insensitive(spark):
    a, b = scores(spark, [("PM25", 40.0, "ug/m3"), ("pm25", 40.0, "ug/m3")])
    assert a is not None and a == b


def test_unknown_pollutant_is_null(spark):
    assert one(spark, "radon", 5.0, "pci/l") is None


def test_range_join_form_equals_column_form(spark):
    import random

    rnd = random.Random(7)
    units = ["ug/m3", "µg/m³", "ppm", "ppb", "ugm3", "bogus"]
    rows = []
    for _ in range(3000):
        p = rnd.choice(list(aqi.BREAKPOINTS) + ["bc"])
        scale = {"o3": 0.3, "co": 60.0}.get(p, 2500.0)
        rows.append((p, rnd.uniform(-0.2, 1.0) * scale, rnd.choice(units)))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("aqi_sub_index", F.lit(None).cast("double"))
    df = df.withColumn("rid", F.monotonically_increasing_id())
    a = {r.rid: r.aqi_sub_index for r in score(df).collect()}
    b = {r.rid: r.aqi_sub_index for r in score_with_table(df).collect()}
    assert a == b
    assert sum(v is not None for v in a.values()) > 1000


def test_binned_join_equals_column_form_on_the_breakpoints(spark):
    import random

    from airlens.operators.scoring import band_table

    rnd = random.Random(8)
    rows = [(p, float(c), "ug/m3" if p in aqi.PARTICULATES else aqi.BREAKPOINT_UNIT[p][0])
            for p, bands in aqi.BREAKPOINTS.items() for lo, hi, _, _ in bands for c in (lo, hi, (lo + hi) / 2, hi + 1, -1.0)]
    rows += [(rnd.choice([*aqi.BREAKPOINTS, "bc"]), rnd.uniform(-1, 3000), rnd.choice(["ug/m3", "ppm", "ppb", "x"])) for _ in range(800)]
    rows += [("pm25", None, "ug/m3"), ("pm25", math.nan, "ug/m3"), ("pm25", math.inf, "ug/m3"), (None, 1.0, "ug/m3")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("aqi_sub_index", F.lit(None).cast("double"))
    df = df.withColumn("rid", F.monotonically_increasing_id())
    a = {r.rid: r.aqi_sub_index for r in score(df).collect()}
    b = {r.rid: r.aqi_sub_index for r in score_with_table(df, band_table(spark)).collect()}
    assert len(b) == len(rows) and a == b


def test_binned_join_with_a_million_bands(spark):
    """Bands of very different widths: every value finds the one that holds it."""
    n = 1_000_000
    ident = F.col("id").cast("double")
    # Widths grow with the square of the position; a gap after every tenth band.
    bands = spark.range(n).select(
        F.lit(0).alias("b_code"), F.lit("pm25").alias("b_pollutant"), (ident * ident / 1e7).alias("c_lo"),
        ((ident + 1) * (ident + 1) / 1e7 - F.when(F.col("id") % 10 == 9, 1e-9).otherwise(0)).alias("c_hi"),
        ident.alias("aqi_lo"), ident.alias("aqi_hi"), F.lit(False).alias("clamp"))
    top = spark.createDataFrame([(0, "pm25", n * n / 1e7, math.inf, -7.0, -7.0, True)], bands.schema)
    values = [(k * 37.3 + 0.1) for k in range(3000)] + [2e5]
    df = spark.createDataFrame([("pm25", v, "ug/m3") for v in values], SCHEMA).withColumn("aqi_sub_index", F.lit(None).cast("double"))
    got = score_with_table(df, bands.unionByName(top))
    for r in got.collect():
        c = math.floor(r.value * 10) / 10
        if c > n * n / 1e7:
            assert r.aqi_sub_index == -7.0
        else:
            k = r.aqi_sub_index
            assert k * k / 1e7 <= c + 1e-9 and c <= (k + 1) * (k + 1) / 1e7 + 1e-9
    assert got.count() == len(values)


def test_binned_join_without_bands(spark):
    from airlens.operators.scoring import band_table

    df = spark.createDataFrame([("pm25", 3.0, "ug/m3")], SCHEMA).withColumn("aqi_sub_index", F.lit(None).cast("double"))
    assert score_with_table(df, band_table(spark).limit(0)).first().aqi_sub_index is None


def test_equal_scores_of_other_pollutants_name_the_first(spark):
    from airlens.operators.scoring import merge_other_pollutant_aggs, other_pollutant_aggs

    rows = [("radon", 9.0), ("bc", 9.0), ("zinc", 9.0), ("bc", 1.0), ("pm25", 50.0), ("lead", None)]
    df = spark.createDataFrame(rows, "pollutant string, aqi_sub_index double")
    assert tuple(df.agg(*other_pollutant_aggs()).first()) == (9.0, "bc")
    parts = df.groupBy("pollutant").agg(*other_pollutant_aggs())
    assert tuple(parts.agg(*merge_other_pollutant_aggs()).first()) == (9.0, "bc")


# --- category and danger ----------------------------------------------------

def test_category_labels(spark):
    vals = [25.0, 75.0, 125.0, 175.0, 250.0, 400.0, 50.5, 501.0, -1.0, math.nan, None]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    got = [r.c for r in df.select(aqi.category("a").alias("c")).collect()]
    assert got == ["Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy",
                   "Very Unhealthy", "Hazardous", "Good", "Hazardous", "Good", "Good", None]


def test_dangerous_threshold(spark):
    assert aqi.DANGEROUS_AQI == 151
    df = spark.createDataFrame([(150.0,), (151.0,)], "a double")
    assert [r.d for r in df.select(aqi.is_dangerous("a").alias("d")).collect()] == [False, True]


def test_round_half_even(spark):
    df = spark.createDataFrame([(150.5,), (151.5,)], "a double")
    assert [r.r for r in df.select(aqi.round_half_even("a").alias("r")).collect()] == [150.0, 152.0]


# --- overall AQI of a group ---------------------------------------------------

def groups(spark, rows):
    df = spark.createDataFrame(rows, "group_id int, " + SCHEMA).withColumn(
        "aqi_sub_index", F.lit(None).cast("double"))
    return {r.group_id: r for r in overall_aqi(score(df), ["group_id"]).collect()}


def test_overall_picks_worst_pollutant(spark):
    out = groups(spark, [(1, "pm25", 10.0, "ug/m3"), (1, "o3", 0.090, "ppm"), (2, "radon", 5.0, "pci/l")])
    r = out[1]
    assert r.dominant_pollutant == "o3"
    assert r.aqi >= 151 and r.dangerous is True and r.category == "Unhealthy"
    assert set(r.sub_indices) == {"pm25", "o3"}
    assert 2 not in out                                # nothing scorable: no row


def test_overall_tie_takes_fixed_order(spark):
    out = groups(spark, [(1, "o3", 0.054, "ppm"), (1, "pm25", 9.0, "ug/m3")])
    assert out[1].aqi == 50 and out[1].dominant_pollutant == "pm25"


@pytest.mark.parametrize("value,expected", [(35.4, 100.0), (900.0, 500.0)])
def test_overall_rounds(spark, value, expected):
    assert groups(spark, [(1, "pm25", value, "ug/m3")])[1].aqi == expected


def test_danger_uses_unrounded_in_views_and_rounded_in_overall(spark):
    from airlens.operators.batch import hourly_aqi, prepare
    from airlens.schemas import READING

    row = (1, "S", "A", "IN", 1.0, 2.0, "pm25", 55.45, "ug/m3", "2026-07-02T10:00:00Z",
           "2026-07-02T10:00:00Z", 150.6)
    trusted = prepare(spark.createDataFrame([row], READING), rescore=False)
    assert hourly_aqi(trusted).first().dangerous is False          # 150.6 < 151
    overall = overall_aqi(trusted, ["city"]).first()
    assert overall.aqi == 151 and overall.dangerous is True


def test_several_readings_of_one_pollutant_count_by_max(spark):
    out = groups(spark, [(1, "pm25", 10.0, "ug/m3"), (1, "pm25", 40.0, "ug/m3"), (1, "o3", 0.06, "ppm")])
    assert out[1].dominant_pollutant == "pm25"
    assert out[1].sub_indices["pm25"] == one(spark, "pm25", 40.0, "ug/m3")
