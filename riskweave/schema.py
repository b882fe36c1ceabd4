"""Column contracts of raw and engineered transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Raw transaction columns and types.
RAW_TRANSACTION = T.StructType([
    T.StructField("trans_date_trans_time", T.TimestampType()),
    T.StructField("cc_num", T.LongType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("city_pop", T.LongType()),
    T.StructField("job", T.StringType()),
    T.StructField("dob", T.StringType()),
    T.StructField("trans_num", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("merch_lat", T.DoubleType()),
    T.StructField("merch_long", T.DoubleType()),
    T.StructField("is_fraud", T.IntegerType()),
])

# Engineered feature order, which scoring and training share.
FEATURE_ORDER = [
    "hour", "day_of_week", "is_night",
    "txn_count_1h", "txn_amount_1h", "txn_count_24h", "txn_amount_24h",
    "amt_hist_mean", "amt_hist_std", "amt_zscore",
    "dist_from_prev_km", "time_since_prev_h", "speed_kmh",
    "merchant_freq", "category_freq", "category_target_enc", "merchant_target_enc",
    "age", "amt", "city_pop", "gender",
]
TARGET = "is_fraud"

# Columns without which history features are undefined.
REQUIRED = ("trans_num", "cc_num", "trans_ts", "amt", "merch_lat", "merch_long")


def require_columns(df: DataFrame, names=REQUIRED) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s): {', '.join(missing)}")
    return df


def with_optional_defaults(df: DataFrame) -> DataFrame:
    """Population 0 and gender 'U' where the input lacks these columns."""
    if "city_pop" not in df.columns:
        df = df.withColumn("city_pop", F.lit(0).cast("long"))
    if "gender" not in df.columns:
        df = df.withColumn("gender", F.lit("U"))
    return df
