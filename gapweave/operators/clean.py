"""Sentinel readings to numbers, and rows of unwanted events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions import replace_first, to_number
from gapweave.schema import CALIBRATION, CARB, EVENT, GLUCOSE, HIGH, INSULIN, LOW


def replace_sentinels(df: DataFrame, high: float = 401, low: float = 39, enabled: bool = True) -> DataFrame:
    """glucose text to double: the first 'High', then the first 'Low' in it becomes a number, what is no number then
    becomes null. insulin and carb, if text, become doubles too."""
    kinds = dict(df.dtypes)
    out = {}
    if kinds[GLUCOSE] == "string":
        text = replace_first(replace_first(GLUCOSE, HIGH, high), LOW, low) if enabled else F.col(GLUCOSE)
        out[GLUCOSE] = to_number(text)
    out |= {c: to_number(c) for c in (INSULIN, CARB) if kinds.get(c) == "string"}
    return df.withColumns(out) if out else df


def drop_events(df: DataFrame, event: str = CALIBRATION, enabled: bool = True) -> DataFrame:
    """Rows of other events; a null event counts as none and stays."""
    return df.filter(~F.col(EVENT).eqNullSafe(F.lit(event))) if enabled else df
