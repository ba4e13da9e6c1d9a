"""Reproducible samples, splits, folds, weights and minority oversampling.

Every choice is a hash of the row's id, so it does not depend on partitioning, order or retries, and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.neighbours import neighbour_lists
from ledgerlens.operators.ordered import numbered
from ledgerlens.operators.small import bounded, settled

SEED = 42
HASH_SPAN = 2**32


def id_hash(key: Column, seed: int | str = SEED) -> Column:
    """Eight hexadecimal digits of the seeded id."""
    return F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8)


def id_number(key: Column, seed: int | str = SEED) -> Column:
    """The same digits as a whole number below 2**32."""
    return F.conv(id_hash(key, seed), 16, 10).cast("bigint")


def hash_below(key: Column, fraction: float, seed: int | str = SEED) -> Column:
    """True for about ``fraction`` of all ids."""
    if fraction >= 1:
        return F.lit(True)
    return id_hash(key, seed) < F.lit(f"{int(fraction * HASH_SPAN):08x}")


def hash_sample(df: DataFrame, fraction: float, key: str = "transaction_id", seed: int = SEED) -> DataFrame:
    return df.where(hash_below(F.col(key), fraction, seed))


def sample_rows(df: DataFrame, n: int, key: str = "transaction_id", seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): the lowest hashes, as a distributed top-n."""
    return df.orderBy(id_hash(F.col(key), seed), key).limit(n)


def stratified_split(
    df: DataFrame, fraction: float = 0.2, key: str = "transaction_id", label: str = "is_fraud", seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: each class gives about ``fraction`` of its rows to the test set.

    The hash does not look at the class, so each class is split in the same proportion, with no shuffle.
    """
    known = df.where(F.col(label).isNotNull())
    in_test = hash_below(F.col(key), fraction, seed)
    return known.where(~in_test), known.where(in_test)


def exact_stratified_split(
    df: DataFrame, fraction: float = 0.2, key: str = "transaction_id", label: str = "is_fraud", seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """As :func:`stratified_split`, with exactly the rounded share of each class in the test set."""
    known = df.where(F.col(label).isNotNull())
    sizes = bounded(known.groupBy(label).agg(F.round(F.count("*") * fraction).alias("_cut")))
    placed = settled(numbered(known, key, [label], seed).join(sizes, label))
    in_test = F.col("row_number") <= F.col("_cut")
    return placed.where(~in_test).select(*df.columns), placed.where(in_test).select(*df.columns)


def with_fold(df: DataFrame, folds: int = 3, key: str = "transaction_id", seed: int = SEED) -> DataFrame:
    """Add ``fold``, spread alike over the classes because the hash does not look at them."""
    return df.withColumn("fold", F.pmod(id_number(F.col(key), f"fold{seed}"), F.lit(folds)).cast("int"))


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """``(label, rows, weight)`` with weights that give every class the same total."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows").alias("t"), F.count("*").alias("k"))
    share = total.select((F.col("t") / F.col("k"))).scalar()
    return counts.withColumn("weight", F.round(share / F.col("rows"), 6))


def with_class_weight(df: DataFrame, positive_weight: float, label: str = "is_fraud") -> DataFrame:
    """Add ``weight``: ``positive_weight`` for positives, 1 for the rest."""
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0)))


def smote(
    df: DataFrame,
    columns: list[str],
    key: str = "transaction_id",
    label: str = "is_fraud",
    neighbours: int = 5,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``df`` and synthetic positives up to parity, with ``is_synthetic``.

    A synthetic row lies between a positive and one of its nearest positives, at a point both picked by hash. Each
    positive seeds the same number of rows, the lowest-numbered ones one more. A positive gets the vectors of its
    neighbours first; the synthetic rows are then made where it lies, so only positives are shuffled.
    """
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    counted = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    plain = df.select(key, *columns, label, F.lit(0).alias("is_synthetic"))
    missing = counted["neg"] - counted["pos"]
    if missing <= 0 or counted["pos"] < 2:
        return plain
    each, extra = divmod(missing, counted["pos"])

    positives = settled(df.where(F.col(label) == 1).select(key, vector.alias("vec")))
    near = neighbour_lists(positives, key, "vec", neighbours)
    copies = F.lit(each) + F.when(F.col("row_number") <= extra, 1).otherwise(0)
    others = positives.select(F.col(key).alias("other"), F.col("vec").alias("other_vec"))
    around = (
        near.select(key, F.posexplode("near").alias("place", "entry"))
        .select(key, "place", F.col("entry.id").alias("other"))
        .join(others, "other")
        .groupBy(key)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "other_vec"))), lambda x: x["other_vec"]).alias("vectors"))
    )
    seeds = numbered(positives, key).where(copies > 0).join(around, key)
    picked = F.concat_ws("/", F.col(key), F.col("copy"))
    drawn = seeds.select(
        key, "vec", "vectors", F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("copy")
    ).select(
        key,
        "vec",
        "copy",
        F.get("vectors", F.pmod(id_number(picked, f"n{seed}"), F.size("vectors")).cast("int")).alias("other_vec"),
        (id_number(picked, f"u{seed}") / F.lit(float(HASH_SPAN))).alias("share"),
    )
    types = dict(df.dtypes)
    ends = [(F.get("vec", F.lit(i)), F.get("other_vec", F.lit(i))) for i in range(len(columns))]
    synthetic = drawn.select(
        F.concat_ws("~", F.col(key), F.col("copy")).alias(key),
        *[(a + F.col("share") * (b - a)).alias(c) for c, (a, b) in zip(columns, ends)],
        F.lit(1).cast(types[label]).alias(label),
        F.lit(1).alias("is_synthetic"),
    )
    as_double = [F.col(c).cast("double").alias(c) for c in columns]
    return plain.select(key, *as_double, label, "is_synthetic").unionByName(synthetic)
