"""Chronological cuts. Rows are ordered by (time, id); the cut row is found without sorting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskweave.functions.scalar import micros
from riskweave.operators.ordered import before, row_at_rank

# Fixed values.
TRAIN_SHARE = 0.8
VALIDATION_SHARE = 0.15
_US, _ID = "_cut_us", "_cut_id"


def _keyed(df: DataFrame, time_col: str, tie: str) -> DataFrame:
    integral = dict(df.dtypes)[tie] in ("tinyint", "smallint", "int", "bigint")
    # Text ids only break ties between equal times; a hash of them does that reproducibly.
    return df.withColumns({_US: micros(time_col), _ID: F.col(tie).cast("long") if integral else F.xxhash64(tie)})


def _first_rows(df: DataFrame, rows: int, total: int, time_col: str, tie: str) -> tuple[DataFrame, Column]:
    """The keyed frame and the condition that selects its first `rows` rows."""
    keyed = _keyed(df, time_col, tie)
    if rows <= 0:
        return keyed, F.lit(False)
    if rows >= total:
        return keyed, F.lit(True)
    return keyed, before(_US, _ID, row_at_rank(keyed, _US, _ID, rows))


def split_at(df: DataFrame, rows: int, total: int, time_col: str = "trans_ts", tie: str = "trans_num",
             names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Add `fold`: the first `rows` rows by time get the first name."""
    keyed, first = _first_rows(df, rows, total, time_col, tie)
    return keyed.withColumn("fold", F.when(first, names[0]).otherwise(names[1])).drop(_US, _ID)


def train_test(df: DataFrame, train_share: float = TRAIN_SHARE, **columns) -> DataFrame:
    """First int(n * share) rows are train."""
    total = df.count()
    return split_at(df, int(total * train_share), total, **columns)


def hold_out(df: DataFrame, share: float, names=("fit", "val"), **columns) -> DataFrame:
    """Last rows from int(n * (1 - share)) on are held out."""
    total = df.count()
    return split_at(df, int(total * (1.0 - share)), total, names=names, **columns)


def folds(df: DataFrame, train_share: float = TRAIN_SHARE, val_share: float = VALIDATION_SHARE, **columns) -> DataFrame:
    """`fold` = fit, val or test in one frame, from two cuts of the same ordering."""
    total = df.count()
    train_rows = int(total * train_share)
    fit_rows = int(train_rows * (1.0 - val_share))
    time_col, tie = columns.get("time_col", "trans_ts"), columns.get("tie", "trans_num")
    keyed, is_train = _first_rows(df, train_rows, total, time_col, tie)
    _, is_fit = _first_rows(df, fit_rows, total, time_col, tie)
    return keyed.withColumn("fold", F.when(is_fit, "fit").when(is_train, "val").otherwise("test")).drop(_US, _ID)


def take_fold(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("fold") == name).drop("fold")


def most_recent(df: DataFrame, share: float | None, time_col: str = "trans_ts", tie: str = "trans_num") -> DataFrame:
    """Last int(n * share) rows by time; no share, or one of at least 1, keeps everything."""
    if not share or share >= 1.0:
        return df
    total = df.count()
    keyed, older = _first_rows(df, total - int(total * share), total, time_col, tie)
    return keyed.filter(~older).drop(_US, _ID)


def tuning_tail(df: DataFrame, share: float | None, time_col: str = "trans_ts", tie: str = "trans_num") -> DataFrame:
    """Rows from int(n * (1 - share)) on, by time."""
    if not share or share >= 1.0:
        return df
    total = df.count()
    keyed, older = _first_rows(df, int(total * (1.0 - share)), total, time_col, tie)
    return keyed.filter(~older).drop(_US, _ID)


def assert_chronological(df: DataFrame, order: tuple[str, ...], time_col: str = "trans_ts") -> None:
    """Raise unless every fold ends no later than the next begins and none is empty."""
    spans = {r["fold"]: (r["lo"], r["hi"]) for r in
             df.groupBy("fold").agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).collect()}
    for earlier, later in zip(order, order[1:]):
        if earlier not in spans or later not in spans:
            raise ValueError(f"empty fold between {earlier} and {later}")
        if spans[earlier][1] > spans[later][0]:
            raise ValueError(f"{earlier} reaches past the start of {later}")


def seeded_sample(df: DataFrame, rows: int, tie: str = "trans_num", seed: int = 42) -> DataFrame:
    """`rows` rows chosen by a hash of id and seed; the same rows on every run and cluster."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(tie).cast("string"), F.lit(str(seed)))), tie).limit(rows)
