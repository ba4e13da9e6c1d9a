"""Importance resampling: sample raw text so that it looks like target text.

Words and punctuation runs, and pairs of neighbours, are hashed into a fixed number of buckets. Two generative models
are bucket shares with add-one smoothing: one of all documents, one of a bounded sample of target documents (ids that
labels name as good). The log weight of a document is the sum of the log ratios of target to raw over its n-grams, that
is the log of the ratio of its probabilities under both models; ``length_exponent`` divides it by a power of the number
of n-grams, where long texts shall weigh less. Adding Gumbel noise to the log weights and keeping the k largest is
sampling without replacement in proportion to the weights. The noise is a hash of doc_id.

The k-th largest key is found by counting keys in ever narrower cells, so nothing is sorted as a whole.

Defined results: a document without any n-gram (null, empty or blank text) has a null weight and is never kept; keys
are cut to millionths and all documents tied with the k-th are kept; null ids share one noise value; without target
documents every log weight is 0 and the sample is uniform; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import whole_text
from ledgerlens.llm.word_hash import PUNCTUATED, mix, words
from ledgerlens.operators.small import settled

BUCKETS = 1 << 16
TARGET_ROWS = 20_000
UNITS = 1_000_000
CELLS = 1024


def buckets_of(raw: bytes) -> np.ndarray:
    """Buckets of the single words and the neighbouring pairs of a text."""
    single, _ = words(raw, PUNCTUATED)
    pairs = mix(single[:-1] * np.uint64(3) + single[1:])
    return (np.concatenate([single, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def target_ids(labels: DataFrame, good, target_rows: int = TARGET_ROWS) -> DataFrame:
    """At most ``target_rows`` ids (those with the lowest hashes) that ``good`` holds for."""
    ids = labels.where(good & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return ids.orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id").limit(target_rows)


def fit(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Log ratio of target to raw for each bucket. ``ids`` is bounded; all documents are counted in one pass."""
    flagged = docs.select("doc_id", whole_text().alias("text")).join(
        F.broadcast(ids.withColumn("target", F.lit(True))), "doc_id", "left"
    )
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("bucket", "raw", "target")])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, target in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = buckets_of(text.as_py().encode("utf-8"))
                np.add.at(counts[0], found, 1)
                if target:
                    np.add.at(counts[1], found, 1)
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, counts[0][used], counts[1][used])], schema.names)

    rows = (
        flagged.select("text", "target")
        .mapInArrow(counted, schema)
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toArrow()  # a row for each bucket at most
    )
    counts = np.zeros((2, BUCKETS), np.float64)
    at = rows.column("bucket").to_numpy()
    counts[0, at], counts[1, at] = rows.column("raw").to_numpy(), rows.column("target").to_numpy()
    if counts[1].sum() == 0:
        return np.zeros(BUCKETS)
    shares = (counts + 1) / (counts.sum(axis=1, keepdims=True) + BUCKETS)
    return np.log(shares[1]) - np.log(shares[0])


def weigh(docs: DataFrame, ratios: np.ndarray, length_exponent: float = 0.0) -> DataFrame:
    """doc_id, n_grams and log_weight for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # one number for each bucket
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("n_grams", T.LongType()), T.StructField("log_weight", T.DoubleType())]
    )

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            sizes, weights = [], []
            for text in batch.column(1):
                found = buckets_of(text.as_py().encode("utf-8"))
                sizes.append(len(found))
                weights.append(float(table[found].sum() / len(found) ** length_exponent) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(weights, pa.float64())], schema.names
            )

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(weighed, schema)


def kth_largest(df: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a column of whole numbers, by counting in narrowing cells; None if there is none."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return None
    above = 0
    while low < high:
        width = max(1, -(-(high - low + 1) // CELLS))
        cell = F.floor((F.col(column) - F.lit(low)) / F.lit(width))
        inside = df.where(F.col(column).between(low, high))
        counts = {r["cell"]: r["n"] for r in inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}
        for place in sorted(counts, reverse=True):
            if above + counts[place] >= k:
                break
            above += counts[place]
        else:
            return low
        low, high = low + place * width, min(high, low + (place + 1) * width - 1)
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    good,
    share: float | None = None,
    target_rows: int = TARGET_ROWS,
    length_exponent: float = 0.0,
    seed: int = 29,
) -> DataFrame:
    """doc_id, n_grams, log_weight, gumbel_key and kept for each row.

    ``labels`` has doc_id and whatever ``good`` reads. The sample holds ``share`` of the documents with text; by
    default the share of good rows among the labels.
    """
    weights = weigh(docs, fit(docs, target_ids(labels, good, target_rows)), length_exponent)
    uniform = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = settled(weights.withColumn("gumbel_key", F.floor((F.col("log_weight") - F.log(-F.log(uniform))) * UNITS)))
    if share is None:
        good_rows, all_rows = labels.agg(F.count(F.when(good, 1)), F.count("*")).first()
        share = good_rows / all_rows if all_rows else 1.0
    usable = keyed.where(F.col("gumbel_key").isNotNull())
    least = kth_largest(usable, "gumbel_key", round(share * usable.count()))
    kept = F.coalesce(F.col("gumbel_key") >= least, F.lit(False)) if least is not None else F.lit(False)
    return keyed.select("doc_id", "n_grams", "log_weight", (F.col("gumbel_key") / UNITS).alias("gumbel_key"), kept.alias("kept"))
