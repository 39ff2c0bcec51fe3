"""Reports over the star schema (O-75..O-77).

Each aggregates the fact first (partial aggregation, one row per group)
and joins the small aggregated result to the dimension afterwards, so the
dimension join never sees the fact's volume.  Averages and shares are
computed exactly in integers and rounded half away from zero."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.measures import div_half_away, from_units, to_units
from starloom.operators.star import TURBINE_KEY


def _named(aggregated: DataFrame, turbine_dim: DataFrame | None) -> DataFrame:
    """Add the turbine's natural key, unless the aggregate carries it."""
    if turbine_dim is None:
        return aggregated
    return aggregated.join(turbine_dim.select("turbine_id", *TURBINE_KEY), "turbine_id", "left")


def daily_totals(fact_energy: DataFrame, turbine_dim: DataFrame | None = None) -> DataFrame:
    """Energy per date and turbine, with the turbine's name and region: from its
    dimension or, if the fact still carries them, from the fact's rows (an id
    is a hash of them, so they add no group)."""
    own = [] if turbine_dim is not None else list(TURBINE_KEY)
    agg = fact_energy.groupBy("date_id", "turbine_id", *own).agg(
        F.sum("energy_produced").cast("decimal(18,2)").alias("total_energy"),
        F.count(F.lit(1)).alias("readings"))
    return _named(agg, turbine_dim).select(
        "date_id", "turbine_id", "turbine_name", "region", "total_energy", "readings")


def condition_impact(enriched: DataFrame, gust_band: int = 50) -> DataFrame:
    """Energy against weather: per region, gust band and day part, the
    number of readings, mean energy, mean temperature and the correlation
    of energy with gusts."""
    _x = F.col("energy_produced").cast("double")
    _y = F.col("wind_gust_10m").cast("double")
    band = (F.floor(F.col("wind_gust_10m") / gust_band) * gust_band).cast("int")
    agg = enriched.groupBy("region", band.alias("gust_band"), "time_period").agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum(to_units("energy_produced", 2)).alias("_e"),
        F.count("energy_produced").alias("_ne"),
        F.sum(to_units("temperature_2m", 2)).alias("_t"),
        F.count("temperature_2m").alias("_nt"),
        F.covar_samp(_x, _y).alias("_cov"), F.stddev_samp(_x).alias("_sx"),
        F.stddev_samp(_y).alias("_sy"),
    )
    return agg.select(
        "region", "gust_band", "time_period", "readings",
        F.when(F.col("_ne") > 0, from_units(div_half_away(F.col("_e"), F.col("_ne")), 12, 2))
        .alias("avg_energy"),
        F.when(F.col("_nt") > 0, from_units(div_half_away(F.col("_t"), F.col("_nt")), 12, 2))
        .alias("avg_temperature"),
        # Pearson correlation; NULL when either side has no spread (ANSI
        # mode would raise inside corr() on a zero variance).
        F.round(F.when(F.col("_sx") * F.col("_sy") > 0,
                       F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sy"))), 6)
        .alias("corr_energy_gust"),
    )


def availability(fact_energy: DataFrame, available_status: str, status_dim: DataFrame | None = None,
                 turbine_dim: DataFrame | None = None) -> DataFrame:
    """Share of readings per turbine whose status is ``available_status``; status and
    names from the dimensions or, if the fact still carries them, from its rows."""
    ok = F.col("status") == F.lit(available_status)
    own = [] if turbine_dim is not None else list(TURBINE_KEY)
    if status_dim is None:
        f = fact_energy.groupBy("turbine_id", "status_id", *own, ok.alias("_ok")).agg(F.count(F.lit(1)).alias("_n"))
    else:
        f = fact_energy.groupBy("turbine_id", "status_id", *own).agg(F.count(F.lit(1)).alias("_n")) \
            .join(status_dim.select("status_id", ok.alias("_ok")), "status_id", "left")
    agg = f.groupBy("turbine_id", *own).agg(
        F.sum("_n").alias("readings"),
        F.sum(F.when(F.col("_ok"), F.col("_n")).otherwise(0)).cast("bigint")
        .alias("available_readings"))
    return _named(agg, turbine_dim).select(
        "turbine_id", "turbine_name", "region", "readings", "available_readings",
        from_units(div_half_away(F.col("available_readings") * 10000, F.col("readings")), 7, 4)
        .alias("availability"))
