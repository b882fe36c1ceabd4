"""The engineered frame: calendar, history, encodings and profile in a fixed column order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from riskweave import schema
from riskweave.functions import scalar
from riskweave.operators import encoders, history, keyed_chunks


def calendar_features(df: DataFrame, time_col: str = "trans_ts", night_hours=scalar.NIGHT_HOURS) -> DataFrame:
    return df.withColumns({
        "hour": scalar.hour_of_day(time_col),
        "day_of_week": scalar.day_of_week(time_col),
        "is_night": scalar.is_night(time_col, night_hours),
    })


def median_age(df: DataFrame, time_col: str = "trans_ts", dob: str = "dob") -> DataFrame:
    """One row. Ages are whole days, so the exact percentile keeps one counter per day of age."""
    return df.agg((F.percentile(scalar.age_days(time_col, dob), 0.5) / F.lit(scalar.DAYS_PER_YEAR)).alias("age"))


def customer_age(df: DataFrame, time_col: str = "trans_ts", dob: str = "dob", fill=None) -> DataFrame:
    """Age in years, one decimal; unknown ages take `fill` or else the frame's own median."""
    if dob not in df.columns:
        return df
    fill = median_age(df, time_col, dob).scalar() if fill is None else F.lit(float(fill))
    return df.withColumn("age", F.coalesce(F.round(scalar.age_years(time_col, dob), 1), fill))


@dataclass
class FeatureModel:
    """Fitted feature step. Only the encoders (and optionally the age fill) are learned."""

    encoders: encoders.Encoders
    windows: dict[str, float] = field(default_factory=lambda: dict(history.VELOCITY_WINDOWS_H))
    night_hours: tuple[int, ...] = scalar.NIGHT_HOURS
    age_fill: float | None = None
    time_col: str = "trans_ts"
    keep: tuple[str, ...] = ("trans_num",)
    hot_share: float = keyed_chunks.HOT_SHARE
    min_hot_rows: int = keyed_chunks.MIN_HOT_ROWS

    def names(self, df: DataFrame) -> list[str]:
        velocity = [f"txn_{what}_{w}" for w in self.windows for what in ("count", "amount")]
        default = {f"txn_{what}_{w}" for w in history.VELOCITY_WINDOWS_H for what in ("count", "amount")}
        order = []
        for name in schema.FEATURE_ORDER:
            if name == "txn_count_1h":
                order += velocity
            elif name not in default:
                order.append(name)
        absent = set() if "dob" in df.columns else {"age"}
        for column in ("merchant", "category"):
            absent |= {e for e in (f"{column}_freq", f"{column}_target_enc")
                       if column not in df.columns or not self.encoders.has(e)}
        return [name for name in order if name not in absent]

    def transform(self, df: DataFrame) -> DataFrame:
        """Kept ids, the features in contract order, then the label when present."""
        schema.require_columns(df)
        names = self.names(df)
        out = self.add_all(df)
        tail = [schema.TARGET] if schema.TARGET in df.columns else []
        return out.select(*self.keep, *names, *tail)

    def add_all(self, df: DataFrame) -> DataFrame:
        used = {"trans_num", "cc_num", self.time_col, "amt", "merch_lat", "merch_long", "merchant", "category",
                "dob", "city_pop", "gender", schema.TARGET, "_is_target", *self.keep}
        # Narrow before the exchange: history carries whole rows through the shuffle.
        out = schema.with_optional_defaults(df.select(*[c for c in df.columns if c in used]))
        out = customer_age(out, self.time_col, fill=self.age_fill).drop("dob")
        out = history.history_features(out, time_col=self.time_col, windows=self.windows,
                                       hot_share=self.hot_share, min_hot_rows=self.min_hot_rows)
        return self.encoders.transform(calendar_features(out, self.time_col, self.night_hours))

    def transform_with_past(self, past: DataFrame, target: DataFrame) -> DataFrame:
        schema.require_columns(target)
        names = self.names(target)
        out = history.features_with_past(past, target, self.add_all)
        tail = [schema.TARGET] if schema.TARGET in target.columns else []
        return out.select(*self.keep, *names, *tail)


def fit_features(train: DataFrame, age_fill: str = "frame", smoothing: float = encoders.SMOOTHING,
                 materialise: bool = False, **options) -> FeatureModel:
    """Learn encoders from training rows. `age_fill="fit"` also freezes their median age."""
    model = FeatureModel(encoders.fit_encoders(train, smoothing=smoothing, materialise=materialise), **options)
    if age_fill == "fit" and "dob" in train.columns:
        model.age_fill = median_age(train, model.time_col).first()["age"]
    elif age_fill not in ("frame", "fit"):
        raise ValueError(f"unknown age_fill: {age_fill!r}")
    return model


def missing_values(features: DataFrame) -> DataFrame:
    """Null or NaN cells per column, one row; an engineered frame should show zeros only."""
    def bad(name: str, kind: str):
        col = F.col(name)
        return col.isNull() | F.isnan(col) if kind in ("double", "float") else col.isNull()
    return features.agg(*[F.count_if(bad(n, k)).alias(n) for n, k in features.dtypes])
