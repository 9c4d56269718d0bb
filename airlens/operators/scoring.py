"""Scoring operators: per-reading sub-index, the breakpoint-table range join,
and the EPA worst-pollutant rule over a group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.functions import aqi
from airlens.functions.cache import cached

SCORE = "aqi_sub_index"


def _with_concentration(readings: DataFrame) -> DataFrame:
    """Adds ``_aq_k`` (pollutant code) and ``_aq_c`` (truncated
    concentration) as separate projections, so each is computed once per row
    (Catalyst keeps them apart because they are reused)."""
    staged = readings.withColumns(cached(("score", "codes"), lambda: {
        "_aq_k": aqi.pollutant_code(F.lower(F.col("pollutant"))),
        "_aq_u": aqi.unit_code(aqi.normalize_unit("unit")),
    }))
    staged = staged.withColumn("_aq_x", cached(("score", "raw"), lambda: aqi.raw_concentration(
        "_aq_k", "value", "_aq_u")))
    return staged.withColumn("_aq_c", cached(("score", "conc"), lambda: aqi.truncate(
        "_aq_x", aqi.truncation_factor("_aq_k"))))


def score(readings: DataFrame, trust_existing: bool = False) -> DataFrame:
    """Fill ``aqi_sub_index`` from (pollutant, value, unit).

    The steps are separate projections (pollutant and unit codes, converted
    value, truncated concentration, band, score), so each intermediate is
    computed once per row. With ``trust_existing`` a score already present
    in the data is kept and only missing ones are computed (the raw files
    carry the ingest score).

    Unscored rows are kept (NULL score): every aggregate here ignores them.
    Do not filter on the score before a big plan: the filter would be pushed
    below these projections and recompute the whole score.
    """
    staged = _with_concentration(readings)
    staged = staged.withColumn("_aq_b", cached(("score", "band"), lambda: aqi.band_number("_aq_k", "_aq_c")))
    computed = cached(("score", "index"), lambda: aqi.sub_index_from_band("_aq_k", "_aq_c", "_aq_b"))
    if trust_existing and SCORE in readings.columns:
        computed = F.coalesce(F.col(SCORE), computed)
    return staged.withColumn(SCORE, computed).drop("_aq_k", "_aq_u", "_aq_x", "_aq_c", "_aq_b")


def band_table(spark: SparkSession) -> DataFrame:
    """The breakpoint table as rows keyed by pollutant code, plus one
    open-ended clamp row per pollutant above its top band. 41 rows: a fixed,
    proven size."""
    rows = []
    for code, (p, bands) in enumerate(aqi.BREAKPOINTS.items()):
        for lo, hi, alo, ahi in bands:
            rows.append((code, p, float(lo), float(hi), float(alo), float(ahi), False))
        _lo, top_hi, _alo, top_aqi = bands[-1]
        rows.append((code, p, float(top_hi), float("inf"), float(top_aqi), float(top_aqi), True))
    return spark.createDataFrame(
        rows, "b_code int, b_pollutant string, c_lo double, c_hi double, aqi_lo double, "
              "aqi_hi double, clamp boolean")


def _in_band(c: Column) -> Column:
    return (c >= 0) & ((~F.col("clamp") & c.between(F.col("c_lo"), F.col("c_hi"))) | (F.col("clamp") & (c > F.col("c_lo"))))


def _band_index(c: Column) -> Column:
    interpolated = (((F.col("aqi_hi") - F.col("aqi_lo")) / (F.col("c_hi") - F.col("c_lo")))
                    * (c - F.col("c_lo")) + F.col("aqi_lo"))
    return F.when(F.col("clamp"), F.col("aqi_hi")).otherwise(interpolated)


def score_with_table(readings: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    """Same score as :func:`score`, computed as a range join of each reading
    with its breakpoint band (pollutant equal, ``c_lo <= c <= c_hi``).

    The fixed 41-row table is broadcast and the readings are never shuffled. A
    caller's table may be of any size: :func:`score_with_bands` takes it.
    """
    if bands is not None:
        return score_with_bands(readings, bands)
    with_c = _with_concentration(readings)
    cond = (F.col("_aq_k") == F.col("b_code")) & _in_band(F.col("_aq_c"))
    joined = with_c.join(F.broadcast(band_table(readings.sparkSession)), cond, "left")
    keep = [col for col in readings.columns if col != SCORE]
    return joined.select(*keep, _band_index(F.col("_aq_c")).alias(SCORE))


def _grid(bands: DataFrame) -> Column:
    """pollutant code -> (origin, width, bins) of its concentration grid, as a
    scalar subquery of at most one entry per pollutant with breakpoints. As many
    bins as bands, so a band that shares no ground with others covers two or
    three of them, whatever the bands' widths."""
    finite = F.when(F.abs("c_hi") < F.lit(math.inf), F.col("c_hi")).otherwise(F.col("c_lo"))
    spans = (bands.where(F.col("b_code").between(0, len(aqi.POLLUTANTS) - 1)).groupBy("b_code")
             .agg(F.min("c_lo").alias("lo"), F.max(finite).alias("hi"), F.count(F.lit(1)).alias("n")))
    width = F.greatest((F.col("hi") - F.col("lo")) / F.col("n"), F.lit(1e-9))
    entry = F.struct("b_code", F.struct(F.col("lo"), width.alias("w"), F.col("n")))
    return F.map_from_entries(spans.select(F.collect_list(entry).alias("g")).scalar())


def _bin(x: Column, grid: Column) -> Column:
    """Bin of a concentration; the last one is open. Never falls as x grows, so
    a value between two bounds lies in a bin between theirs."""
    return F.floor(F.least((x - grid["lo"]) / grid["w"], grid["n"].cast("double"))).cast("long")


def score_with_bands(readings: DataFrame, bands: DataFrame) -> DataFrame:
    """:func:`score_with_table` with a band table of any size: a binned interval
    join. Each band is cut over the bins of its pollutant's grid that it covers, a reading
    lies in one bin, both meet by an equi-join on (pollutant, bin), and the exact test
    follows. Nothing is broadcast; a bin with a large share of all readings is the
    streamed side of a sort-merge join, which AQE may split.

    Bands of a pollutant are expected not to overlap (bounds may touch: then a
    value on both bounds matches both, as in a plain range join); a band with a
    NULL bound matches nothing. Readings without a band keep a NULL score.
    """
    grid = _grid(bands)
    cut = (bands.where("c_lo IS NOT NULL AND c_hi IS NOT NULL").withColumn("_g", F.try_element_at(grid, F.col("b_code")))
           .where("_g IS NOT NULL"))
    last = F.when(F.col("clamp"), F.col("_g")["n"]).otherwise(_bin(F.col("c_hi"), F.col("_g")))
    cut = cut.withColumn("_bin", F.explode(F.sequence(_bin(F.col("c_lo"), F.col("_g")), last))).drop("_g")
    with_c = _with_concentration(readings).withColumn(
        "_aq_bin", _bin(F.col("_aq_c"), F.try_element_at(grid, F.col("_aq_k"))))
    cond = (F.col("_aq_k") == F.col("b_code")) & (F.col("_aq_bin") == F.col("_bin")) & _in_band(F.col("_aq_c"))
    joined = with_c.join(cut.hint("merge"), cond, "left")
    keep = [col for col in readings.columns if col != SCORE]
    return joined.select(*keep, _band_index(F.col("_aq_c")).alias(SCORE))


# --- worst-pollutant rule ---------------------------------------------------

def _max_name(p: str) -> str:
    return f"_max_{p}"


def pollutant_max_aggs(score_col: str = SCORE, pollutant_col: str = "pollutant") -> list[Column]:
    """One ``max`` per scorable pollutant. Keeps the aggregate a
    HashAggregate (a ``max_by`` on a string forces a sort aggregate) and
    gives a deterministic dominant pollutant on ties."""
    def build():
        p = F.lower(F.col(pollutant_col))
        return [F.max(F.when(p == name, F.col(score_col))).alias(_max_name(name))
                for name in aqi.POLLUTANTS]
    return list(cached(("max_aggs", score_col, pollutant_col), build))


def merge_pollutant_max_aggs() -> list[Column]:
    """Re-aggregate partial per-pollutant maxima (bucketed windows)."""
    return list(cached(("merge_max_aggs",), lambda: [
        F.max(_max_name(name)).alias(_max_name(name)) for name in aqi.POLLUTANTS]))


def pollutant_max_columns() -> list[str]:
    return [_max_name(name) for name in aqi.POLLUTANTS]


def worst_of_maxes() -> Column:
    return F.greatest(*[F.col(_max_name(n)) for n in aqi.POLLUTANTS])


def dominant_of_maxes(top: Column | str) -> Column:
    """First pollutant, in the fixed tie order, whose maximum equals ``top``."""
    if isinstance(top, str):
        return cached(("dominant", top), lambda: dominant_of_maxes(F.col(top)))
    expr = None
    for name in aqi.POLLUTANTS:
        hit = F.col(_max_name(name)) == top
        expr = F.when(hit, F.lit(name)) if expr is None else expr.when(hit, F.lit(name))
    return expr


def other_pollutant_aggs(score_col: str = SCORE, pollutant_col: str = "pollutant") -> list[Column]:
    """Worst score among pollutants without breakpoints and its name (equal
    scores: the smallest name, so a merge of parts names the same one as a single
    run). Only trusted stored scores can give such a score; the ``min`` of a
    struct makes the aggregate sort-based, so it is opt-in."""
    other = aqi.pollutant_code(F.lower(F.col(pollutant_col))).isNull()
    s = F.when(other, F.col(score_col))
    return [F.max(s).alias("_max_other"), _first_worst(s, F.col(pollutant_col)).alias("_other_name")]


def merge_other_pollutant_aggs() -> list[Column]:
    """Re-aggregate partial worst scores of other pollutants."""
    return [F.max("_max_other").alias("_max_other"),
            _first_worst(F.col("_max_other"), F.col("_other_name")).alias("_other_name")]


def _first_worst(s: Column, name: Column) -> Column:
    rank = F.struct((-s).alias("below"), name.alias("name"))
    return F.min(F.when(s.isNotNull(), rank)).getField("name")


def dominant_with_other(top: str) -> Column:
    """The fixed-order dominant pollutant, else the other pollutant whose
    score is the maximum."""
    return F.coalesce(dominant_of_maxes(top),
                      F.when(F.col("_max_other") == F.col(top), F.col("_other_name")))


def sub_index_map() -> Column:
    m = F.map_from_arrays(F.array(*[F.lit(n) for n in aqi.POLLUTANTS]),
                          F.array(*[F.col(_max_name(n)) for n in aqi.POLLUTANTS]))
    return F.map_filter(m, lambda _k, v: v.isNotNull())


def overall_aqi(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """EPA overall AQI per group: the worst sub-index wins.

    Output per group with something scorable: ``aqi`` (rounded half to
    even), ``category``, ``dominant_pollutant``, ``dangerous`` (on the
    rounded value) and ``sub_indices`` (pollutant -> max sub-index). Groups
    with nothing scorable give no row. Several readings of one pollutant in
    a group count by their maximum.
    """
    agg = scored.groupBy(*keys).agg(*pollutant_max_aggs())
    worst = worst_of_maxes()
    rounded = aqi.round_half_even(F.col("_worst"))
    return (
        agg.withColumn("_worst", worst)
        .filter(F.col("_worst").isNotNull())
        .select(
            *keys,
            rounded.alias("aqi"),
            aqi.category(rounded).alias("category"),
            dominant_of_maxes(F.col("_worst")).alias("dominant_pollutant"),
            aqi.is_dangerous(rounded).alias("dangerous"),
            sub_index_map().alias("sub_indices"),
        )
    )
