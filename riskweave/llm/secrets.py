"""Secret scan with SQL expressions only: fixed patterns, and sliding-window entropy over candidate strings.

A candidate is a run of at least 20 characters of `A-Za-z0-9+/_=-`. It belongs to a class by the characters it
holds, and each class has its own entropy bound. The entropy of every 20-character window follows from the one
before: the character that enters and the one that leaves change two counts and the sum of c log2 c. A
candidate is reported from the first window over the bound to the end of the last one, unless the allow-list
knows it. Allow-listing never removes a span of the fixed patterns.

Defined results: a null text is an empty one; positions count code points from 0, ends are exclusive; spans of
one kind never overlap, those of different kinds may. Texts are scanned whole. Repeated rows are each
reported; a null doc_id is kept. Other columns are not read.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds and patterns of the base scan, in report order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_LEAST = 6

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Least bits per character of a window, by class (the most possible is log2(20) = 4.32).
HEX_BITS, MIXED_BITS, ONE_CASE_BITS = 2.9, 3.6, 3.4
# Without digits: near what a window of random letters of both cases (3.96) or of one case (3.68) has on average.
BOTH_CASES_BITS, LETTER_BITS = 3.9, 3.65
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # a UUID
    r"(?i)example|placeholder|changeme|dummy|your[_-]",
    r"(?i)0123456789|abcdefghij",
    r"^[0-9_/=+-]+$",  # numbers, dates and rulers
    r"^[a-z]+([_/-][a-z]+)+$",  # paths and names of plain words
)
_PLACES = "array<struct<start:int,end:int>>"


def _places(text: Column, hits: Column, pattern: str) -> Column:
    """Starts and ends of `hits`, the pattern's matches in the text, from the pieces between them."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def step(state: Column, i: Column) -> Column:
        start = state["at"] + F.element_at(gaps_col, i)
        end = start + F.length(F.element_at(hits, i))
        return F.struct(end.alias("at"), F.concat(
            state["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out"))

    # The pieces are cut once and handed on as the state of an outer call.
    gaps_col = F.col("__gaps")
    found = F.aggregate(F.sequence(F.lit(1), F.size(hits)),
                        F.struct(F.lit(0).alias("at"), F.array().cast(_PLACES).alias("out")), step)["out"]
    return gaps, found


def _with_places(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds `name`: the pattern's matches in column `text` as (start, end)."""
    df = df.withColumn("__hits", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    some = F.size("__hits") > 0
    gaps, found = _places(F.col("text"), F.col("__hits"), pattern)
    df = df.withColumn("__gaps", F.when(some, gaps))
    return df.withColumn(name, F.when(some, found).otherwise(F.array().cast(_PLACES))).drop("__gaps")


def _kind_bits(text: Column) -> Column:
    """The entropy bound of a candidate's character class."""
    digit, upper, lower = text.rlike("[0-9]"), text.rlike("[A-Z]"), text.rlike("[a-z]")
    return (F.when(text.rlike("^([0-9a-f]+|[0-9A-F]+)$"), HEX_BITS)
            .when(digit & upper & lower, MIXED_BITS)
            .when(digit, ONE_CASE_BITS)
            .when(upper & lower, BOTH_CASES_BITS)
            .otherwise(LETTER_BITS))


def entropy_span(text: Column, bits: Column) -> Column:
    """(first, last): ends of the first and last window whose entropy is at least `bits`; 0 if there is none."""
    weight = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    start = F.struct(
        codes.alias("codes"), F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"),
        F.lit(0.0).alias("sum"), F.lit(0).alias("first"), F.lit(0).alias("last"))

    def at(c: Column) -> Column:
        return F.element_at(weight, c + 1)

    def step(state: Column, i: Column) -> Column:
        new = F.element_at(state["codes"], i)
        old = F.when(i > WINDOW, F.element_at(state["codes"], F.greatest(i - WINDOW, F.lit(1)))).otherwise(F.lit(-1))
        into = F.element_at(state["counts"], new + 1)
        out_of = F.element_at(state["counts"], F.greatest(old, F.lit(0)) + 1)
        total = (F.when(new == old, state["sum"])
                 .otherwise(state["sum"] + at(into + 1) - at(into)
                            + F.when(old >= 0, at(F.greatest(out_of - 1, F.lit(0))) - at(out_of)).otherwise(0.0)))
        counts = F.transform(state["counts"], lambda c, k: c + (k == new).cast("int") - (k == old).cast("int"))
        high = (i >= WINDOW) & (F.lit(log2(WINDOW)) - total / WINDOW >= bits - 1e-9)
        return F.struct(
            state["codes"].alias("codes"), counts.alias("counts"), total.alias("sum"),
            F.when(high & (state["first"] == 0), i).otherwise(state["first"]).alias("first"),
            F.when(high, i).otherwise(state["last"]).alias("last"))

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), start, step,
                       lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def scan(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """`docs` (doc_id, text, ...) with columns assign, access, hex and entropy added: arrays of (start, end).

    The columns of `docs` stay as they are; they must not bear the four names.
    """
    df = docs.withColumn("__given", F.col("text")).withColumn("text", F.coalesce("text", F.lit("")))
    df = _with_places(df, "__assign", ASSIGN).withColumn(
        "__values", F.when(F.size("__hits") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))))
    df = df.withColumn("assign", F.filter(
        "__assign", lambda x, i: F.length(F.element_at(F.col("__values"), i + 1)) >= ASSIGN_LEAST))
    df = _with_places(df, "access", ACCESS)
    df = _with_places(df, "hex", HEX)
    df = _with_places(df, "__runs", CANDIDATE)
    known = F.lit(False)

    def examine(run: Column, i: Column) -> Column:
        string = F.element_at(F.col("__hits"), i + 1)
        rejected = known
        for pattern in allowed:
            rejected = rejected | string.rlike(pattern)
        seen = F.when(~rejected, entropy_span(string, _kind_bits(string)))
        return F.when(seen["first"] > 0, F.struct(
            (run["start"] + seen["first"] - WINDOW).alias("start"), (run["start"] + seen["last"]).alias("end")))

    df = df.withColumn("entropy", F.filter(F.transform("__runs", examine), lambda x: x.isNotNull()))
    return df.withColumn("text", F.col("__given")).drop("__given", "__hits", "__assign", "__values", "__runs")


def _listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans by start, then kind in report order."""
    def ranked(rank: int):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"))

    named = [F.transform(F.col(kind), ranked(rank)) for rank, kind in enumerate(kinds)]
    label = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(F.array_sort(F.concat(*named)), lambda x: F.concat_ws(
        ":", F.element_at(label, x["rank"] + 1), x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy) for every row of `docs`."""
    found = scan(docs.select("doc_id", "text"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_listed(KINDS[:3]).cast("binary"), 256).alias("base_sha256"), _listed(KINDS).alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"))


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every found span replaced by `mark`; overlapping spans become one. Null texts stay null."""
    found = scan(docs)
    spans = F.array_sort(F.concat(*[F.col(k) for k in KINDS]))

    def step(state: Column, x: Column) -> Column:
        gap = F.substring(F.col("text"), state["at"] + 1, x["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], x["end"]).alias("at"),
            F.when(x["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"))

    clean = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(
        s["out"], F.substring(F.col("text"), s["at"] + 1, F.length(F.col("text")))))
    some = F.exists(spans, lambda x: F.lit(True))
    return found.withColumn("text", F.when(F.col("text").isNotNull() & some, clean).otherwise(F.col("text"))).drop(*KINDS)
