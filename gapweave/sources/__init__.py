"""Where rows come from: folders of CSV files, or any table."""

from gapweave.sources.csv_folder import read_folder
from gapweave.sources.frames import from_frame

__all__ = ["from_frame", "read_folder"]
