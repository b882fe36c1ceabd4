"""Per-card history features that see only the past.

Trailing windows are running sums: every transaction adds its amount at its own time and takes it
back once it is older than the window. The sums are decimal with 12 places, so that taking back leaves
nothing behind; amounts of 1e18 and more, and infinite ones, are counted instead of added. One ordered pass per card therefore serves all windows,
whatever their length, instead of re-reading each row's frame. Row-based statistics (mean, spread,
previous point) come from the same pass. Cards too large for a task are scanned in time chunks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.functions.scalar import (
    MICROS_PER_HOUR, haversine_km, implied_speed, micros, nan_to_null, number_or_zero)
from riskweave.operators import keyed_chunks

# Default trailing windows, in hours.
VELOCITY_WINDOWS_H = {"1h": 1, "24h": 24}
NULL_KEY_SPREAD = 4096
HUGE = 1e18
NEGATIVE = 1 << 32  # step of the counter of huge negative amounts, above that of the positive ones
PARTS = ("n", "s", "p")


def _base(df: DataFrame, key: str, time_col: str, tie: str, amount: str, lat: str, lon: str) -> DataFrame:
    return df.select(
        F.struct(*[F.col(c) for c in df.columns]).alias("_row"),
        F.col(key).alias(key), micros(time_col).alias("_us"), F.col(tie).alias("_tie"),
        F.when(F.col(key).isNotNull(), nan_to_null(amount)).alias("_amt"),
        nan_to_null(lat).alias("_lat"), nan_to_null(lon).alias("_lon")).withColumn("_salt", _null_key_salt(key))


def _moments(windows: Mapping[str, float]) -> list[tuple[int, Column]]:
    """When a transaction enters (kind 0) and when it leaves each window (kind 1, 2, ...)."""
    return [(0, F.col("_us"))] + [(i, F.col("_us") + F.lit(int(hours * MICROS_PER_HOUR)))
                                  for i, hours in enumerate(windows.values(), start=1)]


def _changes(n_windows: int) -> list[Column]:
    """What a mark adds to each window's count and sum, and to the row statistics."""
    kind, amt = F.col("_m.kind"), F.col("_amt")
    plain = F.when(F.abs(amt) < HUGE, amt).cast("decimal(38,12)")
    huge = F.when(amt >= HUGE, 1).when(amt <= -HUGE, NEGATIVE).otherwise(0).cast("long")
    cols = [F.when(kind == 0, amt).alias("_x")]
    for i in range(1, n_windows + 1):
        def signed(value):
            return F.when(kind == 0, value).when(kind == i, -value)
        cols += [F.when(amt.isNotNull(), signed(F.lit(1))).alias(f"_n{i}"), signed(plain).alias(f"_s{i}"), signed(huge).alias(f"_p{i}")]
    return cols


def _amount(plain: Column, huge: Column) -> Column:
    """A window's amount from its decimal sum and its counts of huge amounts."""
    above, below = huge % NEGATIVE > 0, huge >= NEGATIVE
    return (F.when(above & below, float("nan")).when(above, float("inf")).when(below, float("-inf"))
            .otherwise(plain.cast("double")))


def _marks(base: DataFrame, key: str, windows: Mapping[str, float], chunks: keyed_chunks.KeyChunks) -> DataFrame:
    """One row per transaction plus one per window at the moment the transaction leaves it.

    The rows arrive partitioned by (card, salt, chunk), so the windows add no exchange.
    """
    moments = _moments(windows)
    if chunks.any_hot:
        # A leave mark of a hot card may belong to a later chunk, so it has to travel on its own;
        # those of ordinary cards are made after the exchange.
        base = chunks.attach(base)
        travelling = [_moment(kind, at, chunks.chunk_of(at)) for kind, at in moments]
        hot = F.col("_chunks").isNotNull()
        # The chunk array must not be carried through the explode.
        base = base.select(*[c for c in base.columns if c not in chunks.COLUMNS], hot.alias("_hot"),
                           F.when(hot, F.array(*travelling)).otherwise(F.array(travelling[0])).alias("_ms"))
        base = base.withColumn("_m", F.explode("_ms")).drop("_ms").withColumns(
            {"_chunk": F.col("_m.chunk"), "_row": F.when(F.col("_m.kind") == 0, F.col("_row"))})
        base = base.repartition(key, "_salt", "_chunk")
    else:
        base = base.withColumns({"_chunk": F.lit(0), "_hot": F.lit(False), "_m": _moment(*moments[0], F.lit(0))})
        base = base.repartition(key, "_salt")
    rest = F.array(F.col("_m"), *[_moment(kind, at, F.lit(0)) for kind, at in moments[1:]])
    marks = base.withColumn("_m", F.explode(F.when(F.col("_hot"), F.array(F.col("_m"))).otherwise(rest)))
    is_row = F.col("_m.kind") == 0
    return marks.select(
        F.col(key), F.col("_chunk"), F.col("_salt"), F.col("_m.kind").alias("_kind"), F.col("_m.at").alias("_at"),
        F.when(is_row, F.col("_tie")).alias("_tie"), F.when(is_row, F.col("_row")).alias("_row"),
        F.when(is_row & F.col(key).isNotNull(), F.struct("_lat", "_lon", "_us")).alias("_point"),
        *_changes(len(windows)))


def _moment(kind: int, at: Column, chunk: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), at.alias("at"), chunk.cast("int").alias("chunk"))


def _null_key_salt(key: str) -> Column:
    """Rows without a card have no history; they are spread instead of sharing one task."""
    return F.when(F.col(key).isNull(), F.pmod(F.xxhash64("_tie"), F.lit(NULL_KEY_SPREAD)).cast("int")).otherwise(0)


def _chunk_offsets(base: DataFrame, key: str, windows: Mapping[str, float], chunks: keyed_chunks.KeyChunks) -> DataFrame:
    """State of a hot card at the start of each of its chunks.

    Rows of hot cards are summed where they are read; only chunk totals are exchanged.
    """
    n_windows = len(windows)
    rows = base.select(key, "_us", "_tie", "_amt", "_lat", "_lon").join(chunks.sized(chunks.table), key)
    marks = rows.select(key, "_amt", F.array(*[_moment(kind, at, chunks.chunk_of(at)) for kind, at in _moments(windows)]).alias("_ms"))
    marks = marks.select(key, "_amt", F.explode("_ms").alias("_m")).select(key, F.col("_m.chunk").alias("_chunk"), *_changes(n_windows))
    totals = marks.groupBy(key, "_chunk").agg(
        F.count("_x").alias("n"), F.avg("_x").alias("mean"), (F.var_pop("_x") * F.count("_x")).alias("m2"),
        *[F.sum(f"_{p}{i}").alias(f"{p}{i}") for i in range(1, n_windows + 1) for p in PARTS])
    # The last point: first the latest time per chunk, then the highest id among the rows at that time.
    points = rows.select(key, chunks.chunk_of(F.col("_us")).alias("_chunk"), "_us", "_tie", "_lat", "_lon")
    latest = points.groupBy(key, "_chunk").agg(F.max("_us").alias("_us"))
    last = points.join(chunks.sized(latest), [key, "_chunk", "_us"]).groupBy(key, "_chunk").agg(
        F.max(F.struct("_tie", F.struct("_lat", "_lon", "_us").alias("_point"))).alias("last"))
    totals = totals.join(last, [key, "_chunk"], "left")
    per_key = Window.partitionBy(key)
    before = per_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # Chunk means are taken relative to the card's own mean so that squares stay small.
    totals = totals.withColumn("g", F.sum(F.col("n") * F.coalesce("mean", F.lit(0.0))).over(per_key) / F.sum("n").over(per_key))
    dev = F.coalesce(F.col("mean") - F.col("g"), F.lit(0.0))
    n, nd = F.sum("n").over(before), F.sum(F.col("n") * dev).over(before)
    ss = F.sum(F.coalesce("m2", F.lit(0.0)) + F.col("n") * dev * dev).over(before)
    return totals.select(
        F.col(key), F.col("_chunk"),
        n.alias("_on"),
        (F.col("g") + F.try_divide(nd, n)).alias("_omean"),
        (ss - F.try_divide(nd * nd, n)).alias("_om2"),
        F.last("last._point", ignorenulls=True).over(before).alias("_opoint"),
        *[F.sum(f"{p}{i}").over(before).alias(f"_o{p}{i}") for i in range(1, n_windows + 1) for p in PARTS])


def history_features(df: DataFrame, key: str = "cc_num", time_col: str = "trans_ts", tie: str = "trans_num",
                     amount: str = "amt", lat: str = "merch_lat", lon: str = "merch_long",
                     windows: Mapping[str, float] | None = None,
                     hot_share: float = keyed_chunks.HOT_SHARE,
                     min_hot_rows: int = keyed_chunks.MIN_HOT_ROWS) -> DataFrame:
    """Add velocity, amount-behaviour and travel features to every row.

    Velocity covers [t - w, t): rows at the same instant are excluded. Amount behaviour and the
    previous point follow row order (time, then `tie`).
    """
    windows = dict(VELOCITY_WINDOWS_H if windows is None else windows)
    order = df.select(F.col(key), micros(time_col).alias("_us"))
    chunks = keyed_chunks.find_chunks(order, key, "_us", hot_share, min_hot_rows)
    base = _base(df, key, time_col, tie, amount, lat, lon)
    marks = _marks(base, key, windows, chunks)

    part = Window.partitionBy(key, "_salt", "_chunk") if chunks.any_hot else Window.partitionBy(key, "_salt")
    by_row = part.orderBy("_at", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    by_time = part.orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    # Row frames first: their sort order also serves the time frames.
    out = marks.withColumns({
        "_ln": F.count("_x").over(by_row),
        "_lmean": F.avg("_x").over(by_row),
        "_lvar": F.var_samp("_x").over(by_row),
        "_lpoint": F.last("_point", ignorenulls=True).over(by_row),
    })
    out = out.withColumns({f"_l{p}{i}": F.sum(f"_{p}{i}").over(by_time)
                           for i in range(1, len(windows) + 1) for p in PARTS})
    out = out.filter(F.col("_kind") == 0)

    if chunks.any_hot:
        # One row per chunk of a hot card.
        out = out.join(chunks.sized(_chunk_offsets(base, key, windows, chunks)), [key, "_chunk"], "left")
        on, ln = F.coalesce("_on", F.lit(0)), F.col("_ln")
        n = on + ln
        gap = F.col("_lmean") - F.col("_omean")
        prior_mean = (F.when(on == 0, F.col("_lmean")).when(ln == 0, F.col("_omean"))
                      .otherwise(F.col("_omean") + gap * ln / n))
        local_m2 = F.coalesce(F.col("_lvar") * (ln - 1), F.lit(0.0))
        joint = F.when((on > 0) & (ln > 0), gap * gap * on * ln / n).otherwise(0.0)
        m2 = local_m2 + F.when(on > 0, F.greatest(F.col("_om2"), F.lit(0.0))).otherwise(0.0) + joint
        prior_std = F.when(n > 1, F.sqrt(m2 / (n - 1)))
        point = F.coalesce("_lpoint", "_opoint")
        count_of = lambda i: F.coalesce(f"_ln{i}", F.lit(0)) + F.coalesce(f"_on{i}", F.lit(0))
        both = lambda part, i: F.coalesce(f"_l{part}{i}", F.lit(0)) + F.coalesce(f"_o{part}{i}", F.lit(0))
        sum_of = lambda i: _amount(both("s", i), both("p", i))
    else:
        prior_mean, prior_std, point = F.col("_lmean"), F.sqrt("_lvar"), F.col("_lpoint")
        count_of = lambda i: F.coalesce(f"_ln{i}", F.lit(0))
        sum_of = lambda i: _amount(F.coalesce(f"_ls{i}", F.lit(0)), F.coalesce(f"_lp{i}", F.lit(0)))

    amt = nan_to_null(F.col(f"_row.{amount}"))
    out = out.select(
        "_row.*",
        *[c for i, label in enumerate(windows, start=1) for c in (
            count_of(i).cast("double").alias(f"txn_count_{label}"),
            F.when(count_of(i) > 0, sum_of(i)).otherwise(0.0).alias(f"txn_amount_{label}"))],
        F.coalesce(prior_mean, amt).alias("amt_hist_mean"),
        F.coalesce(prior_std, F.lit(0.0)).alias("amt_hist_std"),
        point.alias("_prev"), F.col("_at"))
    out = out.withColumn("amt_zscore", F.coalesce(
        F.try_divide(nan_to_null(amount) - F.col("amt_hist_mean"), F.nullif("amt_hist_std", F.lit(0.0))), F.lit(0.0)))
    out = out.withColumns({
        "dist_from_prev_km": number_or_zero(haversine_km("_prev._lat", "_prev._lon", lat, lon)),
        "time_since_prev_h": F.coalesce((F.col("_at") - F.col("_prev._us")) / F.lit(float(MICROS_PER_HOUR)), F.lit(0.0)),
    })
    return out.withColumn("speed_kmh", implied_speed("dist_from_prev_km", "time_since_prev_h")).drop("_prev", "_at")


def features_with_past(past: DataFrame, target: DataFrame, add_features) -> DataFrame:
    """Features of `target` rows that may look back into `past`; only `target` rows return.

    `add_features` maps a frame to a frame. The flag is filtered after the windows, so a target row
    sees the earlier rows of both frames.
    """
    both = past.withColumn("_is_target", F.lit(False)).unionByName(
        target.withColumn("_is_target", F.lit(True)), allowMissingColumns=True)
    return add_features(both).filter("_is_target").drop("_is_target")
