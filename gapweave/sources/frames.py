"""Any table as the rows that the operators take."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.schema import CARB, EVENT, GLUCOSE, INSULIN, TS


def from_frame(df: DataFrame, ts: Column, event: Column, glucose: Column, insulin: Column | None = None, carb: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Columns computed from df's, and those of keep (series keys and ties). Rows with a null time are left out."""
    none = F.lit(None).cast("double")
    rows = df.select(*keep, ts.cast("timestamp_ntz").alias(TS), event.alias(EVENT), glucose.alias(GLUCOSE), (none if insulin is None else insulin).alias(INSULIN), (none if carb is None else carb).alias(CARB))
    return rows.filter(F.col(TS).isNotNull())
