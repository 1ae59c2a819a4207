"""Names: the columns that operators use inside, and those of files."""

from __future__ import annotations

TS, EVENT, GLUCOSE, INSULIN, CARB, SEQUENCE = "ts", "event_type", "glucose", "insulin", "carb", "sequence_id"
TS_TEXT = "ts_text"
VALUES = (GLUCOSE, INSULIN, CARB)
#: Columns that order rows of equal time.
TIES = ("src_file", "src_block", "src_pos")

#: Column names of the files read and written.
FILE_COLUMNS = {
    TS_TEXT: "Timestamp (YYYY-MM-DDThh:mm:ss)",
    EVENT: "Event Type",
    GLUCOSE: "Glucose Value (mg/dL)",
    INSULIN: "Insulin Value (u)",
    CARB: "Carb Value (grams)",
}
CALIBRATION, INTERPOLATED = "Calibration", "Interpolated"
HIGH, LOW = "High", "Low"
