"""Lineage columns added on entry to bronze (O-27, O-28, O-63, O-68, O-69)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_batch_id() -> str:
    """One identifier per run, chosen on the driver (O-69)."""
    return str(uuid.uuid4())


def with_lineage(df: DataFrame, batch_id: str | None = None,
                 source_file: bool = True, source_api: str | None = None) -> DataFrame:
    """ingested_at, source_file (base name of the input file), batch_id and
    an optional constant source label.  ``source_file`` needs a file scan."""
    cols = {"ingested_at": F.current_timestamp()}
    if source_file:
        cols["source_file"] = F.col("_metadata.file_name")
    cols["batch_id"] = F.lit(batch_id or new_batch_id())
    if source_api is not None:
        cols["source_api"] = F.lit(source_api)
    return df.withColumns(cols)
