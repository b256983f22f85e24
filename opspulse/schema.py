"""Names, roll-ups and dimensions of the hourly report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The report's metrics, in column order after the date and the hour.
METRICS = (
    "INFLOW_STRETCHER Infl_Stretcher_cum INFLOW_AMBULATORY Infl_Ambulatory_cum Inflow_Total Inflow_Cum_Total "
    "INFLOW_AMBULANCES Infl_Ambulances_cum FLS CUM_ADMREQ CUM_BA1 WAITINGADM TTStr TRG_HALLWAY1 TRG_HALLWAY_TBS "
    "reoriented_cum reoriented_cum_MD QTRACK1 RESUS Pod_T POD_GREEN POD_GREEN_TBS POD_YELLOW POD_YELLOW_TBS POD_ORANGE "
    "POD_ORANGE_TBS POD_CONS_MORE2H POD_IMCONS_MORE4H POD_XRAY_MORE2H POD_CT_MORE2H POST_POD1 VERTSTRET RAZ_TBS "
    "RAZ_LAZYBOY RAZ_WAITINGREZ AMBVERT1 AMBVERTTBS QTrack_TBS Garage_TBS RAZ_CONS_MORE2H RAZ_IMCONS_MORE4H "
    "RAZ_XRAY_MORE2H RAZ_CT_MORE2H1 PSYCH1 PSYCH_WAITINGADM"
).split()

# Roll-ups; nulls count as 0 or make the sum null.
POD_TBS = ["TRG_HALLWAY_TBS", "POD_GREEN_TBS", "POD_YELLOW_TBS", "POD_ORANGE_TBS"]
VERT_TBS = ["RAZ_TBS", "AMBVERTTBS", "QTrack_TBS", "Garage_TBS"]
ROLLUPS = {
    "total_tbs": (POD_TBS + VERT_TBS, "zero"),
    "vert_tbs": (VERT_TBS, "zero"),
    "pod_tbs": (POD_TBS, "zero"),
    "overflow": (["TRG_HALLWAY1", "POST_POD1"], "propagate"),
}

# Metrics that raise alerts.
ALERT_METRICS = (
    "INFLOW_STRETCHER INFLOW_AMBULATORY Inflow_Total INFLOW_AMBULANCES TRG_HALLWAY1 TRG_HALLWAY_TBS QTRACK1 "
    "POD_GREEN_TBS POD_YELLOW_TBS POD_ORANGE_TBS POD_CONS_MORE2H POD_IMCONS_MORE4H POD_XRAY_MORE2H POD_CT_MORE2H "
    "RAZ_TBS AMBVERTTBS QTrack_TBS RAZ_CONS_MORE2H RAZ_IMCONS_MORE4H RAZ_XRAY_MORE2H RAZ_CT_MORE2H1"
).split()

# The type of each shift code.
SHIFT_TYPES = {
    "W1": "flow", "X1": "pod", "X3": "pod", "X4": "vertical", "X2": "vertical", "WOC1": "oncall",
    "WOC2": "oncall", "WOC3": "oncall", "X5": "pod", "W3": "overlap", "Y1": "pod", "Y3": "pod",
    "Y4": "vertical", "Y2": "vertical", "Y5": "pod", "Z1": "night", "Z2": "night", "D1": "pod",
    "R1": "pod", "P1": "vertical", "D2": "vertical", "OC1": "oncall", "OC2": "oncall", "V1": "flow",
    "A1": "pod", "G1": "vertical", "E1": "pod", "R2": "pod", "A2": "pod", "P2": "vertical",
    "E2": "vertical", "N1": "night", "N2": "night", "L2": "overlap", "L4": "overlap", "H1": "teaching",
    "B1": "vertical", "L1": "overlap", "W5": "overlap", "L6": "overlap", "B2": "vertical",
}

REPORT_RAW = T.StructType([T.StructField(c, T.StringType()) for c in ["dateflg", "timeflg", *METRICS]])
SHIFTS = T.StructType([
    T.StructField("scheduled_shift_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("first_name", T.StringType()), T.StructField("last_name", T.StringType()),
    T.StructField("shift_short_name", T.StringType()),
    T.StructField("shift_start", T.TimestampNTZType()), T.StructField("shift_end", T.TimestampNTZType()),
])


def shift_types(spark: SparkSession) -> DataFrame:
    """(shift_short_name, shift_type): a dimension of 41 rows."""
    return spark.createDataFrame(list(SHIFT_TYPES.items()), "shift_short_name string, shift_type string")
