"""Report states that merge (O-75, O-76): per date the sums, counts and
co-moments from which totals, means and correlations follow.

A load computes the states of the dates it touched, from the enriched rows
of those dates, and replaces them; a report adds up states and never reads
readings.  Sums are exact: measures are whole units of their NUMERIC scale,
their squares and products are DECIMAL(38, 0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.measures import div_half_away, from_units

TOTAL_KEYS = ("date", "turbine_name", "region")
IMPACT_KEYS = ("date", "region", "gust_band", "time_period")
EXACT = "decimal(38,0)"


def _units(c: str) -> Column:
    """Whole hundredths of a NUMERIC(p, 2) column."""
    return (F.col(c).cast("decimal(18,2)") * 100).cast(EXACT)


def daily_total_state(enriched: DataFrame) -> DataFrame:
    """Per date and turbine: readings and the sum of their energy."""
    return enriched.groupBy(*TOTAL_KEYS).agg(
        F.count(F.lit(1)).alias("readings"), F.sum(_units("energy_produced")).cast(EXACT).alias("energy"))


def period_totals(state: DataFrame, *by: Column) -> DataFrame:
    """Totals per turbine and the periods ``by`` (expressions of ``date``)."""
    return state.groupBy("turbine_name", "region", *by).agg(
        F.sum("readings").alias("readings"),
        (F.sum("energy").cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)").alias("total_energy"))


def impact_state(enriched: DataFrame, gust_band: int = 50) -> DataFrame:
    """Per date, region, gust band and day part: what means and correlations need.

    Pairs are rows that have both energy and gust; the energy mean counts all
    rows that have an energy."""
    band = (F.floor(F.col("wind_gust_10m") / gust_band) * gust_band).cast("int")
    x, y, t = _units("energy_produced"), _units("wind_gust_10m"), _units("temperature_2m")
    both = x.isNotNull() & y.isNotNull()

    def exact(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast(EXACT)

    return enriched.groupBy("date", "region", band.alias("gust_band"), "time_period").agg(
        F.count(F.lit(1)).alias("readings"), F.count(x).alias("n_x"), exact(x).alias("x"),
        F.count(t).alias("n_t"), exact(t).alias("t"), F.count(F.when(both, 1)).alias("n"),
        exact(F.when(both, x)).alias("sx"), exact(F.when(both, y)).alias("sy"),
        exact(F.when(both, (x * y).cast(EXACT))).alias("sxy"), exact(F.when(both, (x * x).cast(EXACT))).alias("sxx"),
        exact(F.when(both, (y * y).cast(EXACT))).alias("syy"))


def merged_impact(state: DataFrame) -> DataFrame:
    """The columns of ``reports.condition_impact`` from states of any dates."""
    sums = state.groupBy("region", "gust_band", "time_period").agg(*[
        F.sum(c).cast("long" if c in ("readings", "n_x", "n_t", "n") else EXACT).alias(c)
        for c in ("readings", "n_x", "x", "n_t", "t", "n", "sx", "sy", "sxy", "sxx", "syy")])

    def moment(a: str, b: str, ab: str) -> Column:
        """n * sum(ab) - sum(a) * sum(b), exactly."""
        n = F.col("n").cast("decimal(19,0)")
        return (n * F.col(ab) - F.col(a) * F.col(b)).cast("double")

    spread = moment("sx", "sx", "sxx") * moment("sy", "sy", "syy")
    return sums.select(
        "region", "gust_band", "time_period", "readings",
        F.when(F.col("n_x") > 0, from_units(div_half_away(F.col("x").cast("long"), F.col("n_x")), 12, 2)).alias("avg_energy"),
        F.when(F.col("n_t") > 0, from_units(div_half_away(F.col("t").cast("long"), F.col("n_t")), 12, 2)).alias("avg_temperature"),
        F.round(F.when(spread > 0, F.try_divide(moment("sx", "sy", "sxy"), F.sqrt(spread))), 6).alias("corr_energy_gust"))
