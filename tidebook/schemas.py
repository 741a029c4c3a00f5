"""Schemas, session constants and barrier candidates of the order-book pipeline.

Fixed values: they define what the operators compute.
"""

from __future__ import annotations

from pyspark.sql import types as T

TICK = 0.25
DAY_US = 86_400_000_000
DEPTH_EPOCH_US = 2_209_161_600_000_000  # microseconds from 1899-12-30 to 1970-01-01
SESSION = ("13:40:00", "19:50:00")
SPLITS = (("train", "13:40:00", "18:00:00"), ("val", "18:00:00", "18:55:00"), ("test", "18:55:00", "19:50:00"))
COMMANDS = ("NO_COMMAND", "CLEAR_BOOK", "ADD_BID_LEVEL", "ADD_ASK_LEVEL", "MODIFY_BID_LEVEL", "MODIFY_ASK_LEVEL", "DELETE_BID_LEVEL", "DELETE_ASK_LEVEL")
MAX_LEVELS = 20
TOP_LEVELS = 10
#: (vertical barrier in ticks of the snapshot clock, profit ticks, stop ticks)
CANDIDATES = ((500, 8.0, 8.0), (2000, 10.0, 10.0), (4000, 20.0, 20.0), (8000, 40.0, 40.0))
HORIZONS_S = (30, 60, 120)
TARGET_TICKS = {"ES": 40, "NQ": 80}
#: Columns that may never be features of a model.
LEAKAGE = (
    "ts day seq label label_class barrier_hit hit_price pt_price sl_price vb_ticks pt_ticks sl_ticks mid_price_at_t window_complete n_obs horizon_end_ts min_mid max_mid"
).split()

EVENTS = T.StructType([
    T.StructField("record_index", T.LongType()), T.StructField("datetime_raw", T.LongType()), T.StructField("datetime_utc", T.TimestampType()),
    T.StructField("command_code", T.IntegerType()), T.StructField("command_name", T.StringType()), T.StructField("flags", T.IntegerType()),
    T.StructField("end_of_batch", T.BooleanType()), T.StructField("num_orders", T.IntegerType()), T.StructField("price", T.DoubleType()), T.StructField("quantity", T.LongType()),
])
TRADES = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("price", T.DoubleType()), T.StructField("size", T.LongType()), T.StructField("side", T.StringType())])
