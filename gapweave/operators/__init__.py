"""The steps as DataFrame -> DataFrame functions, each usable alone through df.transform()."""

from gapweave.operators.clean import drop_events, replace_sentinels
from gapweave.operators.fill import fill_gaps, gap_census
from gapweave.operators.segment import Series, balanced, purge_after_outages, segment
from gapweave.operators.select import ml_columns, of_length, value_only

__all__ = ["Series", "balanced", "drop_events", "fill_gaps", "gap_census", "ml_columns", "of_length", "purge_after_outages", "replace_sentinels", "segment", "value_only"]
