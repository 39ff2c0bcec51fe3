"""Bronze -> silver cleaning (O-23, O-55..O-57, O-64, O-65).

Measures are rounded half up to their declared scale, lineage columns are
dropped, and calendar / clock / day-part attributes are derived from the
event timestamp (not by re-parsing the time text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starloom.functions.calendar import with_time_attributes
from starloom.functions.measures import to_decimal
from starloom.operators.contracts import SILVER_PRODUCTION, cast_to_contract


def silver_production(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The silver contract's columns; ``keep`` names bronze columns to carry
    along (those that order the corrections of a reading)."""
    df = bronze.withColumns({
        "wind_speed": to_decimal("wind_speed", 6, 2),
        "energy_produced": to_decimal("energy_produced", 12, 2),
    })
    df = with_time_attributes(df, "measured_at")
    return cast_to_contract(df, SILVER_PRODUCTION, keep=keep)
