"""Hard negatives with exact integer scores, multiplied in a residue number system.

Components are floored multiples (``floor(scale * x)``), so a score is an integer. Both matrices are reduced modulo
several small primes to symmetric remainders, multiplied in float32 prime by prime, and put together by Chinese
remaindering (mixed radix). The primes are as large as the number of components allows for float32 to stay exact in any
order of summation, and as many as the largest possible score of the two blocks asks for. Scores past 52 bits raise an
OverflowError; nothing is rounded.

Rows are packed into blocks of matrices. Anchors are dealt to blocks by their id, and every block of anchors meets every
block of rows: copies of the anchor blocks go to the slots that the row blocks are dealt to (and of the row blocks to groups of anchor
blocks, where there are many), so that a task works on one pair of blocks at a time and no side passes the driver. Each pair of blocks gives its own first rows for each anchor (for
each anchor and positive in the second pass), and the first of those are taken by ranking, which cuts in the map tasks.

Order is by score descending, then by smaller id. Positives are an anchor's first ``positives`` other rows of its label;
negatives of a positive are the first ``negatives`` rows of another label whose score lies between ``low`` and ``high``
per cent of the positive's score.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part; shorter
vectors end in zeros, and an empty one is all zeros; of rows that repeat an id the smallest by (label, vector) counts;
an anchor without positives, or a positive without negatives, has no rows; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.llm.common import bounded_batches
from ledgerlens.operators.small import settled

EXACT_FLOAT32 = 1 << 24
LARGEST_SCORE = 1 << 52
# Columns multiplied at once; the remainders of several such parts are added as whole numbers.
PART_COLUMNS = 256
BLOCK_ANCHORS = 512
ANCHORS_AT_ONCE = 128
BLOCK_ROWS = 4096
# Blocks of anchors that one slot of rows meets; more of them are met by copies of the rows.
GROUP_BLOCKS = 512

BLOCK = "ids binary, labels binary, matrix binary, width int"
FOUND = "anchor_id long, positive_id long, positive_score long, other_id long, score long"


def primes_for(columns: int, bound: int) -> list[int]:
    """Primes, largest first, whose product is over ``2 * bound`` and whose remainders stay exact over the columns."""
    largest = 2 * math.isqrt((EXACT_FLOAT32 - 1) // max(1, min(columns, PART_COLUMNS))) + 1
    out, product, candidate = [], 1, largest + 1
    while product <= 2 * bound:
        candidate -= 1
        if candidate < 3:
            raise OverflowError("too few primes for scores of this size")
        if all(candidate % d for d in range(2, math.isqrt(candidate) + 1)):
            out.append(candidate)
            product *= candidate
    return out


def remainders(matrix: np.ndarray, prime: int) -> np.ndarray:
    """Remainders between -prime/2 and prime/2 of whole numbers held as float64."""
    left = np.fmod(matrix, prime)
    half = prime // 2
    left[left > half] -= prime
    left[left < -half] += prime
    return left.astype(np.float32)


def exact_scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as float64, as int64: rows by anchors."""
    if not rows.size or not anchors.size:
        return np.zeros((len(rows), len(anchors)), np.int64)
    sums = [sum(map(int, np.abs(m).max(axis=0).tolist())) for m in (rows, anchors)]
    bound = max(1, min(sums[0] * int(np.abs(anchors).max()), sums[1] * int(np.abs(rows).max())))
    if bound >= LARGEST_SCORE:
        raise OverflowError(f"scores may reach {bound}, beyond 52 bits")
    primes = primes_for(rows.shape[1], bound)
    digits: list[np.ndarray] = []
    for i, prime in enumerate(primes):
        left, right = remainders(rows, prime), remainders(anchors, prime)
        residue = np.zeros((len(rows), len(anchors)), np.int64)
        for at in range(0, rows.shape[1], PART_COLUMNS):
            part = slice(at, at + PART_COLUMNS)
            residue += (left[:, part] @ right[:, part].T).astype(np.int64)
        residue %= prime
        # Mixed radix: take off the digits that are known, and divide by their primes.
        for j, digit in enumerate(digits):
            residue = (residue - digit) * pow(primes[j], -1, prime) % prime
        digits.append(residue)
    value, weight = np.zeros_like(digits[0]), 1
    whole = math.prod(primes)
    # The last digit decides the sign: the upper half of the range stands for negative numbers.
    last = digits[-1]
    below = math.prod(primes[:-1])
    for digit, prime in zip(digits[:-1], primes[:-1], strict=True):
        value += digit * weight
        weight *= prime
    middle = primes[-1] // 2
    negative = (last > middle) | ((last == middle) & (value > (whole // 2 - middle * below)))
    return value + (last - np.where(negative, primes[-1], 0)) * below


def first_of(scores: np.ndarray, anchors: np.ndarray, take: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of each anchor's first ``take`` rows, one turn after the other: (anchors, rows).

    ``scores`` has a row for each anchor, columns in the order of ids, and the lowest number where a row is out.
    """
    out = np.iinfo(np.int64).min
    for _ in range(take):
        best = scores.argmax(axis=1)
        there = np.flatnonzero(scores[np.arange(len(scores)), best] != out)
        if not len(there):
            return
        yield anchors[there], best[there]
        scores[there, best[there]] = out


def _packed(rows: DataFrame, extra: str = "") -> DataFrame:
    """One row for each Arrow batch: ids, labels and the matrix (float64) in the order of ids, then ``extra`` lists."""
    names = [part.split()[0] for part in extra.split(",")] if extra else []

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                ids = np.asarray(batch.column(0))
                order = np.argsort(ids, kind="stable")
                lists = batch.column(2)
                lengths = np.asarray(lists.value_lengths())
                matrix = np.zeros((len(ids), max(1, int(lengths.max(initial=0)))))
                held = np.arange(matrix.shape[1]) < lengths[:, None]
                matrix[held] = np.asarray(lists.flatten())
                arrays = [[ids[order].tobytes()], [np.asarray(batch.column(1))[order].tobytes()], [matrix[order].tobytes()]]
                columns = [pa.array(a, pa.binary()) for a in arrays] + [pa.array([matrix.shape[1]], pa.int32())]
                taken = [batch.column(3 + i).take(pa.array(order)) for i in range(len(names))]
                columns += [pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t) for t in taken]
                yield pa.RecordBatch.from_arrays(columns, ["ids", "labels", "matrix", "width", *names])

    return rows.mapInArrow(pack, BLOCK + (f", {extra}" if extra else ""))


def _meetings(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of anchors with every block of rows, both written tables.

    Rows are dealt to slots, and anchors to groups, of which there is more than one only for very many anchors; copies
    of each side go to all cells of its row or column.
    """
    slots = max(1, min(blocks.count(), 4 * blocks.sparkSession.sparkContext.defaultParallelism))
    groups = max(1, math.ceil(anchors.count() / GROUP_BLOCKS))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    named = [F.col(c).alias(f"a_{c}") for c in anchors.columns]
    copied = anchors.select(dealt(groups).alias("band"), every(slots).alias("slot"), *named)
    rows = blocks.select("*", dealt(slots).alias("slot"), every(groups).alias("band"))
    return rows.join(copied, ["slot", "band"]).drop("slot", "band")


def _block(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[f"{prefix}{n}"], np.int64) for n in ("ids", "labels"))
    return ids, labels, np.frombuffer(row[f"{prefix}matrix"], np.float64).reshape(len(ids), row[f"{prefix}width"])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(row, ids, labels, anchor ids, anchor labels, places, scores) of some anchors of a block at a time."""
    for batch in batches:
        for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            ids, labels, matrix = _block(row)
            a_ids, a_labels, a_matrix = _block(row, "a_")
            width = min(matrix.shape[1], a_matrix.shape[1])
            for at in range(0, len(a_ids), ANCHORS_AT_ONCE):
                places = np.arange(at, min(at + ANCHORS_AT_ONCE, len(a_ids)))
                scores = exact_scores(a_matrix[places, :width], matrix[:, :width])
                yield row, ids, labels, a_ids[places], a_labels[places], places, scores


def _found(columns: list[np.ndarray]) -> pa.RecordBatch:
    names = [c.split()[0] for c in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)


def _first(found: DataFrame, by: list[str], take: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), "other_id"))
    return found.withColumn("place", place).where(F.col("place") <= take)


def floored(x: Column) -> Column:
    """The largest whole number up to ``x``, as double; floor() gives a long, which large components would leave."""
    whole = x - x % 1
    return F.when(whole > x, whole - 1.0).otherwise(whole)


def usable(vectors: DataFrame, label: Column | str = "label", scale: float = 256.0) -> DataFrame:
    """(vec_id, label, vector of whole numbers as double) of the rows that take part, one for each id."""
    real = F.col("embedding").cast("array<double>")
    fine = F.forall(real, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x * scale) < float("inf")), F.lit(False)))
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), real.alias("vector"), fine.alias("fine"))
    rows = rows.where("vec_id is not null and label is not null and fine").drop("fine")
    rows = rows.withColumn("vector", F.transform("vector", lambda x: floored(x * scale)))
    repeated = settled(rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id"))
    if repeated.isEmpty():
        return rows
    one = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return rows.join(repeated, "vec_id", "left_anti").unionByName(one.select("vec_id", "row.label", "row.vector"))


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``rows`` as given by :func:`usable`."""
    spark = rows.sparkSession
    bounded_batches(spark)
    blocks = settled(_packed(rows))
    picked = settled(rows.where(is_anchor))
    parts = max(1, math.ceil(picked.count() / BLOCK_ANCHORS))
    anchors = settled(_packed(picked.repartition(parts, "vec_id")))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, labels, a_ids, a_labels, places, scores in _scored(batches):
            scores[(a_labels[:, None] != labels) | (a_ids[:, None] == ids)] = np.iinfo(np.int64).min
            held = scores.copy()
            for at, best in first_of(scores, np.arange(len(a_ids)), positives):
                zero = np.zeros(len(at))
                yield _found([a_ids[at], zero, zero, ids[best], held[at, best]])

    found = _meetings(blocks, anchors).mapInArrow(near, FOUND)
    best = _first(found, ["anchor_id"], positives).groupBy("anchor_id").agg(
        F.collect_list(F.struct("score", "other_id")).alias("kept")
    )
    paired = picked.join(best.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    known = paired.select("vec_id", "label", "vector", F.col("kept.other_id").alias("p_ids"), F.col("kept.score").alias("p_scores"))
    known = settled(_packed(known.repartition(parts, "vec_id"), "p_ids array<array<bigint>>, p_scores array<array<bigint>>"))

    def hard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, labels, a_ids, a_labels, places, scores in _scored(batches):
            out = np.iinfo(np.int64).min
            scores[a_labels[:, None] == labels] = out
            for turn in range(positives):
                has = np.array([i for i, p in enumerate(places) if len(row["a_p_ids"][p]) > turn], np.int64)
                if not len(has):
                    break
                p_ids = np.array([row["a_p_ids"][places[i]][turn] for i in has], np.int64)
                p_scores = np.array([row["a_p_scores"][places[i]][turn] for i in has], np.int64)
                # In whole numbers: low * p <= 100 * s <= high * p.
                lowest = np.array([-(-low * p // 100) for p in p_scores.tolist()], np.int64)
                highest = np.array([high * p // 100 for p in p_scores.tolist()], np.int64)
                window = scores[has]
                window[(window < lowest[:, None]) | (window > highest[:, None])] = out
                held = window.copy()
                for at, best in first_of(window, np.arange(len(has)), negatives):
                    yield _found([a_ids[has[at]], p_ids[at], p_scores[at], ids[best], held[at, best]])

    found = _meetings(blocks, known).mapInArrow(hard, FOUND)
    return _first(found, ["anchor_id", "positive_id", "positive_score"], negatives).select(
        "anchor_id",
        "positive_id",
        F.col("place").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
