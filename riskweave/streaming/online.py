"""Online features from bounded per-card state, and scoring of a transaction stream.

Each card keeps its newest MAX_HISTORY transactions, and the number, mean and squared deviations of all its amounts. A
transaction is scored from what the card held before it and is remembered afterwards, so it never sees itself. State
sits in the state store next to the task that owns the card; a write renews the expiry of all of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskweave import schema
from riskweave.functions import scalar
from riskweave.models import explain
from riskweave.operators.features import calendar_features
from riskweave.plans.training import TrainedModel
from riskweave.session import ROCKSDB, ship_package

# Fixed values.
MAX_HISTORY = 100
IDLE_EXPIRY_MS = 7 * 24 * 3600 * 1000
COLD_START_GAP_H = 999.0
WINDOWS_S = (3600, 86400)
BLOCK = 4096  # rows of a card handled at once
NO_INPUT_WARNING = "invalid history input, used cold-start online features"

#: The newest rows as doubles: time, amount, latitude, longitude of each.
PACKED = T.StructType([T.StructField("rows", T.BinaryType())])

ONLINE_COLUMNS = T.StructType([
    T.StructField("txn_count_1h", T.LongType()), T.StructField("txn_count_24h", T.LongType()),
    T.StructField("txn_amount_1h", T.DoubleType()), T.StructField("txn_amount_24h", T.DoubleType()),
    T.StructField("dist_from_prev_km", T.DoubleType()), T.StructField("time_since_prev_h", T.DoubleType()),
    T.StructField("speed_kmh", T.DoubleType())])


#: As `history_features` gives them, from all earlier transactions of the card.
AMOUNT_COLUMNS = T.StructType([T.StructField(n, T.DoubleType()) for n in ("amt_hist_mean", "amt_hist_std", "amt_zscore")])
MOMENTS = T.StructType([T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType())])


def distance_km(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    p1, p2 = math.radians(lat1), math.radians(lat2)
    chord = (math.sin((p2 - p1) / 2) ** 2
             + math.cos(p1) * math.cos(p2) * math.sin((math.radians(lon2) - math.radians(lon1)) / 2) ** 2)
    return 2 * scalar.EARTH_RADIUS_KM * math.asin(math.sqrt(min(chord, 1.0)))


def online_features(now: int, lat: float, lon: float, past: np.ndarray, digits: int | None = 2) -> tuple:
    """Features of one transaction from its card's history (rows: time, amount, lat, lon; oldest first)."""
    cut = (lambda v: round(v, digits)) if digits is not None else (lambda v: v)
    if len(past) == 0:
        return 0, 0, 0.0, 0.0, 0.0, COLD_START_GAP_H, 0.0
    age = now - past[:, 0]
    inside = [(age >= 0) & (age <= w) for w in WINDOWS_S]
    counts = [int(m.sum()) for m in inside]
    sums = [cut(float(past[m, 1].sum())) for m in inside]
    last = past[-1]
    km = distance_km(last[2], last[3], lat, lon)
    gap_h = max((now - last[0]) / 3600.0, 0.0)
    return (*counts, *sums, cut(km), cut(gap_h), cut(km / max(gap_h, scalar.MIN_GAP_H)))


def online_features_of(every: np.ndarray, first: int, max_history: int, digits: int | None = 2) -> dict[str, list | np.ndarray]:
    """`online_features` of the rows from `first` on, each from up to `max_history` rows before it, as columns."""
    cut = (lambda v: [round(x, digits) for x in v.tolist()]) if digits is not None else (lambda v: v)
    rows, width = len(every) - first, min(max_history, max(len(every) - 1, 1))
    times, amounts = every[:, 0].astype(np.int64), every[:, 1]
    counts, sums = np.zeros((len(WINDOWS_S), rows), np.int64), np.zeros((len(WINDOWS_S), rows))
    for lo in range(0, rows, BLOCK):
        now = np.arange(first + lo, first + min(rows, lo + BLOCK))
        at = now[:, None] + np.arange(-width, 0)
        age = times[now][:, None] - times[at]
        there = (at >= 0) & (age >= 0)
        held = amounts[at]
        for w, span in enumerate(WINDOWS_S):
            inside = there & (age <= span)
            counts[w, lo : lo + BLOCK] = inside.sum(axis=1)
            sums[w, lo : lo + BLOCK] = np.where(inside, held, 0.0).sum(axis=1)
    km, gap = np.zeros(rows), np.full(rows, COLD_START_GAP_H)
    start = max(first, 1)
    if start < len(every):
        places = every[start - 1 :, 2:].tolist()
        km[start - first :] = [distance_km(*a, *b) for a, b in zip(places, places[1:])]
        gap[start - first :] = np.maximum((times[start:] - every[start - 1 : -1, 0]) / 3600.0, 0.0)
    speed = km / np.maximum(gap, scalar.MIN_GAP_H)
    return dict(zip(ONLINE_COLUMNS.names, (*counts, *map(cut, sums), cut(km), cut(gap), cut(speed))))


def amount_behaviour(amounts: np.ndarray, held: tuple[int, float, float]) -> tuple[np.ndarray, tuple[int, float, float]]:
    """(mean, spread and z-score of each amount against the earlier ones, the moments after all of them)."""
    n, mean, m2 = held
    out = np.empty((len(amounts), 3))
    for k, amt in enumerate(amounts.tolist()):
        std = math.sqrt(m2 / (n - 1)) if n > 1 else 0.0
        out[k] = (mean if n else amt, std, (amt - mean) / std if std > 0 else 0.0)
        n += 1
        gap = amt - mean
        mean += gap / n
        m2 += gap * (amt - mean)
    return out, (n, mean, m2)


class CardHistory(StatefulProcessor):
    """Per card: features from the held list, then append, keep the newest entries, write back.

    With `amounts` the moments of all earlier amounts are held and used too.
    """

    def __init__(self, columns: Sequence[str], max_history: int = MAX_HISTORY, expiry_ms: int | None = IDLE_EXPIRY_MS,
                 digits: int | None = 2, amounts: bool = False):
        self.columns, self.max_history, self.expiry_ms, self.digits = list(columns), max_history, expiry_ms, digits
        self.amounts = amounts

    def init(self, handle: StatefulProcessorHandle) -> None:
        # One value: entries of a list state cross to the state store one by one.
        self.history = handle.getValueState("packed_history", PACKED, self.expiry_ms)
        self.moments = handle.getValueState("moments", MOMENTS, self.expiry_ms) if self.amounts else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # One card's share of one micro-batch; the source's rate limit bounds it.
        frames = list(rows)
        batch = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        if pd.api.types.is_numeric_dtype(batch["trans_num"]):
            batch = batch.iloc[np.lexsort((batch["trans_num"].to_numpy(), batch["clock_s"].to_numpy()))]
        else:
            batch = batch.sort_values(["clock_s", "trans_num"], kind="stable")
        packed = self.history.get()
        held = np.frombuffer(packed[0] if packed else b"").reshape(-1, 4)
        # Held rows and new ones in one array: the history of a row is a slice of it.
        every = np.concatenate((held, np.stack([batch[c].to_numpy(float) for c in ("clock_s", "amt", "merch_lat", "merch_long")], axis=1)))
        first = len(held)
        # Rewriting the value gives every entry the same new expiry.
        self.history.update((every[-self.max_history :].tobytes(),))
        columns = {c: batch[c].array for c in self.columns} | online_features_of(every, first, self.max_history, self.digits)
        if self.amounts:
            behaviour, moments = amount_behaviour(every[first:, 1], tuple(self.moments.get()) if self.moments.exists() else (0, 0.0, 0.0))
            self.moments.update(moments)
            columns |= dict(zip(AMOUNT_COLUMNS.names, behaviour.T))
        yield pd.DataFrame(columns | {"cold_start": np.arange(first, len(every)) == 0})

    def close(self) -> None:
        pass


def read_stream(spark: SparkSession, path: str, struct: T.StructType, fmt: str = "json", files_per_trigger: int = 100,
                pattern: str | None = None) -> DataFrame:
    """A folder of transaction files as a stream with a fixed schema and a bounded micro-batch."""
    reader = spark.readStream.schema(struct).option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    # Time since the file arrived is the stream's counterpart of request latency.
    return reader.format(fmt).load(path).withColumn("ingest_ms", F.unix_millis(F.col("_metadata.file_modification_time")))


def parse_messages(raw: DataFrame, struct: T.StructType, column: str = "value") -> DataFrame:
    """JSON text messages as typed columns; unreadable messages give nulls and fail `valid_input`."""
    return raw.select(F.from_json(F.col(column).cast("string"), struct).alias("t")).select("t.*")


def valid_input():
    """What the state needs from a transaction."""
    numbers = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("amt", "merch_lat", "merch_long")]
    ok = F.col("cc_num").isNotNull() & F.col("trans_num").isNotNull() & F.col("clock_s").isNotNull()
    for part in numbers:
        ok = ok & part
    return ok


def with_clock(df: DataFrame, time_col: str = "trans_ts") -> DataFrame:
    unix = F.col("unix_time") if "unix_time" in df.columns else F.lit(None)
    return df.withColumn("clock_s", scalar.online_clock(unix, time_col))


def quarantine(transactions: DataFrame) -> DataFrame:
    """Transactions the state cannot take, for a sink of their own."""
    return with_clock(transactions).filter(~valid_input())


def with_online_features(transactions: DataFrame, max_history: int = MAX_HISTORY,
                         expiry_ms: int | None = IDLE_EXPIRY_MS, digits: int | None = 2, amounts: bool = False) -> DataFrame:
    """Add online features (with `amounts` also amount behaviour) and `cold_start` to a stream.

    Transactions without usable history input are left out here; `cold_defaults` has them.
    """
    ship_package(transactions.sparkSession)
    rows = with_clock(transactions).filter(valid_input())
    shape = T.StructType([*rows.schema.fields, *ONLINE_COLUMNS.fields, *(AMOUNT_COLUMNS.fields if amounts else []),
                          T.StructField("cold_start", T.BooleanType())])
    return rows.groupBy("cc_num").transformWithStateInPandas(
        statefulProcessor=CardHistory(rows.columns, max_history, expiry_ms, digits, amounts), outputStructType=shape,
        outputMode="Append", timeMode="ProcessingTime" if expiry_ms else "None")


def cold_defaults(transactions: DataFrame) -> DataFrame:
    """Transactions the state cannot take, with the features of a card that was never seen."""
    rows = with_clock(transactions).filter(~valid_input())
    plain = {f.name: F.lit(COLD_START_GAP_H if f.name == "time_since_prev_h" else 0).cast(f.dataType) for f in ONLINE_COLUMNS.fields}
    return rows.withColumns({**plain, "cold_start": F.lit(True)})


def overwrite_with_online(features: DataFrame, online: DataFrame, id_col: str = "trans_num") -> DataFrame:
    """Replace history columns of an engineered frame by online values, where a transaction has them."""
    names = [n for n in ONLINE_COLUMNS.names if n in features.columns]
    other = online.select(id_col, *[F.col(n).alias(f"_on_{n}") for n in names])
    return features.join(other, id_col, "left").withColumns(
        {n: F.coalesce(F.col(f"_on_{n}").cast("double"), F.col(n)) for n in names}).drop(*[f"_on_{n}" for n in names])


def score_stream(transactions: DataFrame, trained: TrainedModel, top: int = 5, **state_options) -> DataFrame:
    """Probability, decision, online features and reasons per transaction of a stream.

    Amount behaviour comes from the moments that a card's state holds, so that it means what it meant in training; a
    transaction that the state can't take gets neutral values: mean = amount, spread and z-score 0.
    """
    now_ms = F.unix_millis(F.current_timestamp())
    timed = transactions if "ingest_ms" in transactions.columns else transactions.withColumn("ingest_ms", now_ms)
    none = F.array().cast("array<string>")
    neutral = {"amt_hist_mean": F.col("amt").cast("double"), "amt_hist_std": F.lit(0.0), "amt_zscore": F.lit(0.0)}
    rows = with_online_features(timed, amounts=True, **state_options).withColumn("warnings", none).unionByName(
        cold_defaults(timed).withColumns({**neutral, "warnings": F.array(F.lit(NO_INPUT_WARNING))}))
    fm = trained.features
    frame = schema.with_optional_defaults(rows)
    frame = frame.withColumn("online_features", F.struct(*ONLINE_COLUMNS.names))
    frame = frame.withColumns({n: F.col(n).cast("double") for n in ("txn_count_1h", "txn_count_24h")})
    if "dob" in frame.columns:
        fill = F.lit(fm.age_fill).cast("double")
        frame = frame.withColumn("age", F.coalesce(F.round(scalar.age_years(fm.time_col, "dob"), 1), fill))
    frame = fm.encoders.transform(calendar_features(frame, fm.time_col, fm.night_hours))

    matrix = trained.matrix
    leaves, _ = explain.read_leaves(trained.trees)
    frame = frame.withColumn("_parts", explain.attribution_udf(leaves)(matrix.vector()))
    why = explain.top_reasons(matrix.columns, [F.col(c) for c in matrix.columns], F.col("_parts"), top)
    frame = frame.withColumn("reasons", F.transform(why, lambda r: F.struct(r["feature"].alias("feature"), r["value"].alias("value"),
                                                                           r["impact"].alias("impact"))))
    keep = ("trans_num", "cc_num", "cold_start", "online_features", "reasons", "ingest_ms", "warnings")
    scored = trained.score_features(frame, keep)
    return scored.select(
        "trans_num", "cc_num", scalar.half_even("p", 4).alias("fraud_probability"), "decision",
        F.lit(trained.threshold).alias("threshold"), "cold_start", "online_features", "reasons",
        (now_ms - F.col("ingest_ms")).cast("double").alias("latency_ms"), "warnings")


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = False):
    """Append to a file sink; `available_now` stops after the data at hand."""
    writer = df.writeStream.outputMode("append").format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_apart(scored: DataFrame, path: str, rejected: str, checkpoint: str, available_now: bool = False):
    """Scored events to `path`, those that the state could not take to `rejected`, each batch in a folder of its number.

    A batch that is repeated after a failure overwrites what it wrote, so no row is lost or doubled in either sink.
    """
    def put(batch: DataFrame, number: int) -> None:
        # Both sinks read the batch, and its state must be stepped once.
        batch.persist()
        bad = F.array_contains("warnings", NO_INPUT_WARNING)
        for part, folder in ((batch.filter(~bad), path), (batch.filter(bad), rejected)):
            part.write.mode("overwrite").parquet(f"{folder}/batch={number}")
        batch.unpersist()
    writer = scored.writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_to_end(df: DataFrame, path: str, checkpoint: str, timeout_s: int | None = None) -> DataFrame:
    """Run a stream over the data at hand and read back what it wrote; without `timeout_s` however long it takes."""
    spark = df.sparkSession
    # Expiring state would otherwise keep an available-now query alive with empty batches; list state
    # needs the RocksDB store. A query keeps the settings it was started with.
    wanted = {"spark.sql.streaming.noDataMicroBatches.enabled": "false", "spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        query = write_stream(df, path, checkpoint, available_now=True)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s} s")
    return spark.read.schema(df.schema).parquet(path)
