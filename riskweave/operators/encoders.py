"""Frequency and smoothed target encoders, fitted on training rows only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from riskweave.session import checkpointed

# Fixed values.
FREQUENCY_COLUMNS = ("merchant", "category")
TARGET_COLUMNS = ("category", "merchant")
SMOOTHING = 50.0
# A lookup table above this many rows is left to a shuffle join.
BROADCAST_ROWS = 1_000_000


def frequency_table(train: DataFrame, column: str) -> DataFrame:
    """Share of all training rows per value; nulls count in the denominator only."""
    counts = train.groupBy(column).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").cast("double").alias("t")).scalar()
    return counts.filter(F.col(column).isNotNull()).select(column, (F.col("_n") / total).alias(f"{column}_freq"))


def label_rate(train: DataFrame, target: str = "is_fraud") -> DataFrame:
    return train.agg(F.avg(target).alias("prior"))


def target_table(train: DataFrame, column: str, target: str = "is_fraud", smoothing: float = SMOOTHING) -> DataFrame:
    """Positive rate per value, pulled towards the overall rate by `smoothing` pseudo-rows."""
    prior = label_rate(train, target).scalar()
    stats = (train.filter(F.col(column).isNotNull()).groupBy(column)
             .agg(F.sum(target).cast("double").alias("_s"), F.count(target).alias("_n")))
    return stats.select(column, ((F.col("_s") + prior * F.lit(smoothing)) / (F.col("_n") + F.lit(smoothing)))
                        .alias(f"{column}_target_enc"))


def lookup(df: DataFrame, table: DataFrame, column: str, encoded: str, default, small: bool = True) -> DataFrame:
    """Left lookup with a default for misses. `small` states that the table's size was checked."""
    return df.join(F.broadcast(table) if small else table, column, "left").withColumn(
        encoded, F.coalesce(F.col(encoded), default))


@dataclass
class Encoders:
    """Fitted lookup tables, one per column; `small` marks those whose row count allows a broadcast."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    small: dict[str, bool] = field(default_factory=dict)
    prior: float = 0.0

    def has(self, encoded: str) -> bool:
        return any(encoded in t.columns for t in self.tables.values())

    def transform(self, df: DataFrame) -> DataFrame:
        for column, table in self.tables.items():
            if column not in df.columns:
                continue
            df = df.join(F.broadcast(table) if self.small[column] else table, column, "left")
            misses = {f"{column}_freq": 0.0, f"{column}_target_enc": self.prior}
            df = df.fillna({name: value for name, value in misses.items() if name in table.columns})
        return df

    def save(self, path: str) -> None:
        for column, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/tables/{column}")
        spark = next(iter(self.tables.values())).sparkSession
        spark.createDataFrame([(c, self.small[c], self.prior) for c in self.tables],
                              "name string, small boolean, prior double") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark, path: str) -> "Encoders":
        out = cls()
        for row in spark.read.parquet(f"{path}/meta").collect():
            out.tables[row.name] = spark.read.parquet(f"{path}/tables/{row.name}")
            out.small[row.name], out.prior = row.small, row.prior
        return out


def fit_encoders(train: DataFrame, target: str = "is_fraud", frequency=FREQUENCY_COLUMNS,
                 target_columns=TARGET_COLUMNS, smoothing: float = SMOOTHING,
                 broadcast_rows: int = BROADCAST_ROWS, materialise: bool = False) -> Encoders:
    """Fit both encodings of a column in one aggregate over the training rows.

    `materialise` writes the tables to the shared folder, for models that are applied many times.
    """
    has_target = target in train.columns
    wanted = [*frequency, *(target_columns if has_target else ())]
    names = [c for c in dict.fromkeys(wanted) if c in train.columns]
    sizes = train.agg(F.count("*").alias("n"),
                      (F.avg(target) if has_target else F.lit(None).cast("double")).alias("prior"),
                      *[F.approx_count_distinct(c).alias(f"d_{c}") for c in names]).first()
    out = Encoders(prior=float(sizes["prior"] or 0.0))
    for column in names:
        # The sketch may be several percent low; half the limit keeps the true size below it.
        out.small[column] = sizes[f"d_{column}"] <= broadcast_rows // 2
        encodings = []
        if column in frequency:
            encodings.append((F.count("*") / F.lit(float(sizes["n"]))).alias(f"{column}_freq"))
        if has_target and column in target_columns:
            encodings.append(((F.sum(target) + F.lit(out.prior * smoothing)) / (F.count(target) + F.lit(smoothing)))
                             .alias(f"{column}_target_enc"))
        table = train.filter(F.col(column).isNotNull()).groupBy(column).agg(*encodings)
        out.tables[column] = checkpointed(table) if materialise else table
    return out


def category_table(training: DataFrame, column: str) -> DataFrame:
    """(column, category_code): every training value with its place in sorted order, however many there are."""
    values = training.filter(F.col(column).isNotNull()).select(column).distinct()
    # One row per distinct value, numbered within first letters and shifted by the letters before.
    values = values.withColumn("_letter", F.substring(column, 1, 1))
    earlier = Window.orderBy("_letter").rowsBetween(Window.unboundedPreceding, -1)
    shift = values.groupBy("_letter").count().select("_letter", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_letter").orderBy(column))
    return values.withColumn("_place", place).join(shift, "_letter").select(
        column, (F.col("_before") + F.col("_place") - 1).cast("int").alias("category_code"))


def with_known_category(df: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """`column` where training has seen it, else null, and `category_code`, -1 for null and unseen values."""
    known = table.select(F.col(column).alias("_known"), "category_code")
    out = df.join(known, F.col(column) == F.col("_known"), "left")
    return out.withColumns({column: F.col("_known"), "category_code": F.coalesce("category_code", F.lit(-1))}).drop("_known")
