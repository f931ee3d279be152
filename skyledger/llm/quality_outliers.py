"""Quality rules: counted rules, then robust multivariate outliers per language and source.

Every document becomes a vector of transformed statistics. For each (language, source) the
minimum-covariance-determinant estimate is approached by concentration steps over all rows: start from
the per-group medians and spreads, then again and again take the half of the group nearest to the
centre and re-estimate mean and covariance from it. A document is rejected if its squared Mahalanobis
distance is above ``CUTOFF``.

* The half is found by counting distances in fixed steps of a logarithmic scale, so it depends on all
  rows and not on their order; the step that reaches the half is taken whole.
* The covariance of the half is scaled to be consistent for normal data (by the median distance) and
  every variance has a floor, as counts are often equal in half of the rows.
* A group with fewer than ``MIN_ROWS`` rows uses the estimate of its language, and a language with fewer
  than that the one of all rows; the same fallback holds at every size.
* A group's rows are dealt over salts for each join and combined before each shuffle, so a group may hold
  any share of the rows.

Missing texts have no words and fail the base rule. A missing language or source is a group of its own.
Repeated rows are judged alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import TokenCodes, column_of, ids_and_texts, salt, settle, texts_of, windows

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
FEATURES = ("f_words", "f_word_length", "f_symbols", "f_dup_lines", "f_repeats")
#: Least standard deviation of each transformed statistic.
FLOORS = (0.25, 0.1, 0.05, 0.1, 0.1)
#: Squared distance beyond which a document is an outlier: far out, as real statistics have heavier
#: tails than the normal distribution (chi-squared, 5 degrees: 0.9999 lies at 25.7).
CUTOFF = 100.0
STEPS = 4
MIN_ROWS = 100
SALTS = 32
#: Distances are counted in steps of 1/32 of a doubling.
RESOLUTION = 32.0

STATISTICS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_CHARS = bytes(b for b in range(256) if 0x80 <= b < 0xC0)  # continuation bytes: no character starts there
_OTHERS = bytes(b for b in range(256) if b not in SYMBOLS)


def repeated_words(codes: np.ndarray) -> int:
    """Words that stand in a window which occurs at least twice in the text."""
    runs = windows(codes, WINDOW)
    if len(runs) < 2:
        return 0
    ordered = np.sort(runs)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return 0
    at = np.searchsorted(again, runs)
    starts = np.flatnonzero(again[np.minimum(at, len(again) - 1)] == runs)
    edges = np.zeros(len(codes) + 1, np.int64)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edges)[:-1] > 0))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    worded = [line for line in lines if line and not line.isspace()]
    return len(worded) - len(set(worded))


def statistics(text: bytes, codes: TokenCodes) -> tuple[int, int, int, int, int]:
    words = text.split()
    joined = b"".join(words)
    return (
        len(words),
        len(joined) if joined.isascii() else len(joined.translate(None, _CHARS)),
        len(text.translate(None, _OTHERS)),
        repeated_lines(text),
        repeated_words(codes.array(words)) if len(words) > WINDOW else 0,
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """Counts per document, with ``lang`` and ``source`` of its group."""
    names = [part.split()[0] for part in STATISTICS.split(",")] + ["lang", "source"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TokenCodes()
        for batch in batches:
            rows = [statistics(text, codes) for text in texts_of(batch)]
            arrays = [pa.array(values, pa.int64()) for values in zip(*rows)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), *arrays, column_of(batch, "lang"), column_of(batch, "source")], names
            )

    texts = ids_and_texts(
        docs, "doc_id", "text",
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
    )
    return texts.mapInArrow(run, f"{STATISTICS}, lang string, source string")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def with_features(stats: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return stats.withColumns({
        "f_words": F.log1p("n_words"),
        "f_word_length": F.log1p(F.col("word_chars") / words),
        "f_symbols": F.sqrt(F.col("n_symbols") / words),
        "f_dup_lines": F.sqrt(F.col("n_dup_lines") / words),
        "f_repeats": F.sqrt(F.col("n_repeat_words") / words),
    })


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Count, sums and sums of products: combined in hash maps before the shuffle."""
    sums = [F.sum(f).alias(f"s_{f}") for f in FEATURES]
    products = [
        F.sum(F.col(f) * F.col(g)).alias(f"p_{f}_{g}") for i, f in enumerate(FEATURES) for g in FEATURES[i:]
    ]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums, *products)


PRECISION = [f"w_{i}_{j}" for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
ESTIMATE = ", ".join(["n long", *[f"m_{f} double" for f in FEATURES], *[f"{w} double" for w in PRECISION]])


def _estimates(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and inverse covariance per group: each row is solved by itself."""
    names = keys + ["n"] + [f"m_{f}" for f in FEATURES] + PRECISION
    floors = np.diag(np.square(FLOORS))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {key: frame[key] for key in keys} | {"n": frame["n"]}
            mean = np.stack([frame[f"s_{f}"] / frame["n"] for f in FEATURES], 1)
            count = len(FEATURES)
            second = np.empty((len(frame), count, count))
            for i, f in enumerate(FEATURES):
                for j in range(i, count):
                    second[:, i, j] = second[:, j, i] = frame[f"p_{f}_{FEATURES[j]}"] / frame["n"]
            covariance = second - mean[:, :, None] * mean[:, None, :]
            inverse = np.linalg.inv(covariance + floors)
            out |= {f"m_{f}": mean[:, i] for i, f in enumerate(FEATURES)}
            out |= {
                f"w_{i}_{j}": inverse[:, i, j] * (1 if i == j else 2) for i in range(count) for j in range(i, count)
            }
            yield pd.DataFrame(out)[names]

    return moments.mapInPandas(run, ", ".join([*[f"{key} string" for key in keys], ESTIMATE]))


def distance() -> Column:
    """Squared Mahalanobis distance of the row's features under the estimate joined to it."""
    centred = [F.col(f) - F.col(f"m_{f}") for f in FEATURES]
    terms = [
        F.col(f"w_{i}_{j}") * centred[i] * centred[j] for i in range(len(FEATURES)) for j in range(i, len(FEATURES))
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return F.greatest(total, F.lit(0.0))


def _attach(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Joins a small table of groups to rows whose group is dealt over salts."""
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, ["group", "salt"])


def _step() -> Column:
    return F.floor(F.log2(F.col("d2") + 1e-6) * RESOLUTION).cast("int")


def _cut(near: DataFrame) -> DataFrame:
    """The step of distance at which half of each group is reached, from counts per step."""
    counts = near.groupBy("group", "step").agg(F.count(F.lit(1)).alias("c"))
    by_group = Window.partitionBy("group")
    return (
        counts.withColumn("upto", F.sum("c").over(by_group.orderBy("step")))
        .withColumn("all", F.sum("c").over(by_group))
        .where(F.col("upto") * 2 >= F.col("all"))
        .groupBy("group").agg(F.min("step").alias("cut"))
    )


def robust_estimates(rows: DataFrame, steps: int) -> DataFrame:
    """Location and precision of each ``group`` of the rows (group, salt, features), with ``scale``."""
    start = rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), *[F.percentile_approx(f, 0.5, 1000).alias(f"m_{f}") for f in FEATURES]
    )
    first = _attach(rows, start)
    spreads = first.groupBy("group").agg(
        *[F.percentile_approx(F.abs(F.col(f) - F.col(f"m_{f}")), 0.5, 1000).alias(f"a_{f}") for f in FEATURES]
    )
    weights = [
        (F.lit(0.0) if i != j else 1 / F.greatest(F.pow(1.4826 * F.col(f"a_{FEATURES[i]}"), 2), F.lit(FLOORS[i] ** 2)))
        .alias(f"w_{i}_{j}")
        for i in range(len(FEATURES)) for j in range(i, len(FEATURES))
    ]
    estimate = settle(
        start.join(spreads, "group").select("group", "n", *[f"m_{f}" for f in FEATURES], *weights), "mcd-start"
    )
    for _ in range(steps):
        near = _attach(rows, estimate).withColumn("d2", distance()).withColumn("step", _step())
        half = _attach(near.drop(*estimate.columns[1:]), _cut(near)).where(F.col("step") <= F.col("cut"))
        estimate = settle(_estimates(_moments(half, ["group"]), ["group"]), "mcd-step")
    near = _attach(rows, estimate).withColumn("d2", distance()).withColumn("step", _step())
    # The median of a chi-squared variable with five degrees of freedom is 4.351.
    scale = _cut(near).select("group", (F.pow(F.lit(2.0), (F.col("cut") + 1) / RESOLUTION) / 4.351).alias("scale"))
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("rows"))
    return estimate.drop("n").join(scale, "group").join(sizes, "group").withColumn(
        "scale", F.greatest(F.col("scale"), F.lit(1.0))
    )


def _levels(lang: Column, source: Column) -> list[Column]:
    """Names of a row's groups, from the narrowest to all rows."""
    def text(column: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), column), F.lit("-"))

    return [
        F.to_json(F.array(F.lit("group"), text(lang), text(source))),
        F.to_json(F.array(F.lit("language"), text(lang))),
        F.lit("all"),
    ]


def group_estimates(docs: DataFrame, steps: int = STEPS, min_rows: int = MIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """Statistics of all documents, and the estimate each (language, source) uses; both settled."""
    stats = settle(
        with_features(document_statistics(docs)).withColumn("base_failed", base_failed()), "quality-statistics"
    )
    passed = stats.where(~F.col("base_failed"))
    levels = _levels(F.col("lang"), F.col("source"))
    fitted = passed.select(
        F.explode(F.array(*levels)).alias("group"), salt(SALTS, "doc_id", "n_words").alias("salt"), *FEATURES
    )
    estimates = settle(robust_estimates(fitted, steps), "quality-estimates")
    groups = passed.select(levels[0].alias("own"), levels[1].alias("language")).distinct()
    large = estimates.where(F.col("rows") >= min_rows).select(F.col("group").alias("g"))
    chosen = (
        groups.join(large.withColumnRenamed("g", "own_g"), F.col("own") == F.col("own_g"), "left")
        .join(large.withColumnRenamed("g", "language_g"), F.col("language") == F.col("language_g"), "left")
        .select("own", F.coalesce("own_g", "language_g", F.lit("all")).alias("group"))
    )
    used = chosen.join(estimates, "group").drop("group", "rows").withColumnRenamed("own", "group")
    return stats, settle(used, "quality-used")


def judge_documents(
    docs: DataFrame, cutoff: float = CUTOFF, steps: int = STEPS, min_rows: int = MIN_ROWS
) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``distance`` (null where the base rule failed) and
    ``kept``. The estimates are fitted to the documents that pass the base rule."""
    stats, used = group_estimates(docs, steps, min_rows)
    salted = used.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keyed = stats.withColumn("group", _levels(F.col("lang"), F.col("source"))[0]).withColumn("salt", salt(SALTS, "doc_id", "n_words"))
    return keyed.join(salted, ["group", "salt"], "left").withColumn(
        "distance", F.when(~F.col("base_failed"), F.round(distance() / F.col("scale"), 6))
    ).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce(~F.col("base_failed") & (F.col("distance") <= cutoff), F.lit(False)).alias("kept"), "distance",
    )


def keep_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their own columns.

    Each row carries its own counts, so rows that share an id are judged apart and no text is shuffled: the
    verdict needs only the estimate of the row's group.
    """
    used = group_estimates(docs, **{k: v for k, v in options.items() if k != "cutoff"})[1]
    names = [part.split()[0] for part in STATISTICS.split(", ")][1:]
    rows = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TokenCodes()
        for batch in batches:
            row = batch.column(0)
            texts = row.field("text").cast(pa.binary()).to_pylist()
            counted = [statistics(text or b"", codes) for text in texts]
            arrays = [pa.array(values, pa.int64()) for values in zip(*counted)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([row, *arrays], ["row", *names])

    schema = T.StructType([rows.schema["row"], *[T.StructField(name, T.LongType()) for name in names]])
    judged = with_features(rows.mapInArrow(run, schema)).where(~base_failed()).withColumn(
        "group", _levels(F.col("row.lang").cast("string"), F.col("row.source").cast("string"))[0]
    ).join(used, "group")
    kept = judged.where(F.round(distance() / F.col("scale"), 6) <= options.get("cutoff", CUTOFF))
    return kept.select(*[F.col("row")[name].alias(name) for name in docs.columns])
