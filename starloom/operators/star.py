"""Star schema: five conformed dimensions and two facts (O-26, O-33..O-46).

Dimension keys are stable hashes of natural attributes, so a fact row can
compute its foreign keys from its own attributes: no join, no shuffle, and
the same answer as a null-safe key lookup against the dimension.
``key_lookup`` performs the reference-style left equi join for dimensions
whose keys cannot be derived (or to reproduce strict NULL semantics); its
join strategy (broadcast when the dimension's measured size is under the
threshold, sort-merge with skew splitting otherwise) is left to AQE.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.keys import stable_key
from starloom.operators.contracts import CONTRACTS

KeyFn = Callable[..., Column]

# Natural key of each dimension.  One that is not among the dimension's
# attributes (a date, a time of day) is its id; else the id is a hash of it.
NATURAL_KEYS = {
    "date_dim": ("date",), "time_dim": ("time",), "turbine_dim": ("turbine_name", "region"),
    "status_dim": ("status", "responsible_department"), "location_dim": ("region", "latitude", "longitude"),
}
TURBINE_ATTRS, STATUS_ATTRS, LOCATION_ATTRS = (
    tuple(CONTRACTS[n].names[1:]) for n in ("turbine_dim", "status_dim", "location_dim"))
TURBINE_KEY, STATUS_KEY, LOCATION_KEY = (NATURAL_KEYS[n] for n in ("turbine_dim", "status_dim", "location_dim"))


def collapse_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest (order..., rest...) tuple.

    A "last wins" with an explicit, total order.  ``max(struct)`` is a
    partial aggregate, so a key holding a large share of the rows is
    combined map-side instead of being gathered into one task."""
    keys = list(keys)
    order = list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] + [F.col(c) for c in rest]
    if not payload:
        return df.select(*keys).distinct()
    agg = df.groupBy(*keys).agg(F.max(F.struct(*payload)).alias("_w"))
    return agg.select(*keys, *[F.col(f"_w._o{i}").alias(c) for i, c in enumerate(order)],
                      *[F.col(f"_w.{c}") for c in rest]).select(*df.columns)


def _keyed(attrs: Sequence[str], key_parts: Sequence[str], key_name: str,
           key_fn: KeyFn, strict: bool) -> list[Column]:
    key = key_fn(*key_parts)
    if strict:
        present = None
        for a in attrs:
            present = F.col(a).isNotNull() if present is None else present & F.col(a).isNotNull()
        key = F.when(present, key)
    return [key.alias(key_name)]


def dimension(enriched: DataFrame, name: str, key_fn: KeyFn = stable_key, collapse: bool = True) -> DataFrame:
    """The dimension that contract ``name`` declares (O-26, O-38, O-40..O-44):
    its id column first, then its attributes.  Where the natural key is
    narrower than the row, variants of one key are collapsed with an explicit
    order, grouped by the natural key, so two of them never merge on a hash."""
    id_col, *attrs = CONTRACTS[name].names
    natural = NATURAL_KEYS[name]
    hashed = set(natural) <= set(attrs)
    key = key_fn(*natural) if hashed else F.col(natural[0])
    rows = enriched.select(*dict.fromkeys([*natural, *attrs])).distinct().select(key.alias(id_col), *attrs)
    return collapse_last(rows, [id_col, *natural]) if collapse and hashed and len(natural) < len(attrs) else rows


def date_dim(enriched: DataFrame) -> DataFrame:
    return dimension(enriched, "date_dim")


def time_dim(enriched: DataFrame) -> DataFrame:
    return dimension(enriched, "time_dim")


def turbine_dim(enriched: DataFrame, key_fn: KeyFn = stable_key, collapse: bool = True) -> DataFrame:
    return dimension(enriched, "turbine_dim", key_fn, collapse)


def status_dim(enriched: DataFrame, key_fn: KeyFn = stable_key) -> DataFrame:
    return dimension(enriched, "status_dim", key_fn)


def location_dim(enriched: DataFrame, key_fn: KeyFn = stable_key, collapse: bool = True) -> DataFrame:
    return dimension(enriched, "location_dim", key_fn, collapse)


def distinct_things(enriched: DataFrame) -> DataFrame:
    """The distinct attributes of turbines, states and locations together: a
    hashed aggregate over the readings, after which the dimensions with hashed
    ids need no reading any more."""
    return enriched.select(*dict.fromkeys([*TURBINE_ATTRS, *STATUS_ATTRS, *LOCATION_ATTRS])).distinct()


def build_dimensions(enriched: DataFrame, key_fn: KeyFn = stable_key,
                     things: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every dimension; ``things``: the stored ``distinct_things(enriched)``."""
    def rows(name: str) -> DataFrame:
        return enriched if things is None or name in ("date_dim", "time_dim") else things

    return {name: dimension(rows(name), name, key_fn) for name in NATURAL_KEYS}


def key_lookup(fact: DataFrame, dim: DataFrame, attrs: Sequence[str], key: str,
               null_safe: bool = True) -> DataFrame:
    """Left equi join of a fact to a dimension on natural attributes,
    returning the fact with the dimension key added (O-33..O-35).

    ``null_safe`` matches NULL attributes to each other (<=>); the strict
    form (plain equality) leaves the key NULL for such rows."""
    d = dim.select(key, *[F.col(a).alias(f"_d_{a}") for a in attrs])
    cond = None
    for a in attrs:
        c = F.col(a).eqNullSafe(F.col(f"_d_{a}")) if null_safe else (F.col(a) == F.col(f"_d_{a}"))
        cond = c if cond is None else cond & c
    return fact.join(d, cond, "left").drop(*[f"_d_{a}" for a in attrs])


def with_fact_keys(enriched: DataFrame, key_fn: KeyFn = stable_key, strict: bool = False,
                   dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """Attach turbine_id, status_id and location_id.

    Without ``dims`` the keys are derived from the row's attributes (the
    scalable default).  With ``dims`` they are looked up by left joins,
    null-safe unless ``strict``."""
    if dims is None:
        return enriched.select(
            "*",
            *_keyed(TURBINE_ATTRS, TURBINE_KEY, "turbine_id", key_fn, strict),
            *_keyed(STATUS_ATTRS, STATUS_KEY, "status_id", key_fn, strict),
            *_keyed(LOCATION_ATTRS, LOCATION_KEY, "location_id", key_fn, strict),
        )
    out = key_lookup(enriched, dims["turbine_dim"], TURBINE_ATTRS, "turbine_id", not strict)
    out = key_lookup(out, dims["status_dim"], STATUS_ATTRS, "status_id", not strict)
    return key_lookup(out, dims["location_dim"], LOCATION_ATTRS, "location_id", not strict)


def fact_energy(keyed: DataFrame, *extra: str) -> DataFrame:
    """O-45: one row per enriched row (``extra``: more columns to show)."""
    return keyed.select(
        F.col("production_id").alias("fact_production_id"),
        F.col("date").alias("date_id"), F.col("time").alias("time_id"),
        "turbine_id", "status_id", "energy_produced", "wind_speed", "wind_direction", *extra)


def fact_weather(keyed: DataFrame, collapse: bool = False) -> DataFrame:
    """O-46: distinct weather rows; ``collapse`` keeps one row per
    fact_weather_id (greatest date, time, location, then measures), the
    form a table keyed on the id can hold.  Collapsing needs no prior
    distinct (the greatest row is the same), so it is one aggregate.
    Readings without a weather match carry no conditions and add no row
    (their energy is still in the energy fact)."""
    d = keyed.filter(F.col("weather_id").isNotNull()).select(
        F.col("weather_id").alias("fact_weather_id"),
        F.col("date").alias("date_id"), F.col("time").alias("time_id"),
        "location_id", "temperature_2m", "cloud_cover", "wind_gust_10m", "wind_speed")
    if collapse:
        return collapse_last(d, ["fact_weather_id"], ["date_id", "time_id", "location_id"])
    return d.distinct()


def build_facts(enriched: DataFrame, key_fn: KeyFn = stable_key, strict: bool = False,
                dims: dict[str, DataFrame] | None = None,
                for_load: bool = False) -> dict[str, DataFrame]:
    """Both facts.  ``for_load`` gives the weather fact one row per id,
    as loaded into a table keyed on it."""
    keyed = with_fact_keys(enriched, key_fn, strict, dims)
    return {"fact_energy": fact_energy(keyed), "fact_weather": fact_weather(keyed, for_load)}
