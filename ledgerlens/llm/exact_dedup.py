"""Exact deduplication with an extendible-hash index kept in shared files.

Every text is lower-cased (A-Z only) and hashed to a 64-bit key. The index holds one entry for each distinct raw text
of a key, so copies are counted in the map tasks and a text that a third of the rows repeat is one entry for each task.
A directory maps the leading bits of a key to a bucket: it starts at the depth the number of keys asks for, and while a
bucket is overfull the directory doubles, splitting that bucket by one more bit. The entries are written bucket by
bucket. Only keys that two or more rows share are looked at again: their texts are fetched, dealt to the owner of the
bucket, and rows are put together by comparing the bytes of the texts, so two texts that collide in one key form a
chain of two groups.

Defined results: a null text is the empty text; a null ``doc_id`` is below every other id (``keep_id`` is null only if
all ids of a group are); rows that repeat one doc_id and one text share one result, and ``keep_rows`` keeps one of
them; an empty table gives an empty table; columns other than doc_id and text pass through ``keep_rows`` untouched.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ascii_lower, fresh, whole_text
from ledgerlens.operators.small import settled

BUCKET_KEYS = 2048
KEY_BITS = 64


def _raw(text: Column, raw_bits: int) -> Column:
    """A hash of the text as given."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - raw_bits)


def _key(normal: Column | str, key_bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(normal), 64 - key_bits)


def _leading(depth: Column, key_bits: int) -> Column:
    """The first ``depth`` of the ``key_bits`` bits of a key, as a number."""
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftrightunsigned", F.col("key"), F.lit(key_bits) - depth)
    )


def directory(keys: DataFrame, bucket_keys: int = BUCKET_KEYS, key_bits: int = KEY_BITS) -> tuple[DataFrame, list[int]]:
    """The directory ``(local_depth, prefix, bucket)`` over a written table of distinct keys, and the depths in use.

    A bucket holds the keys with one prefix of ``local_depth`` bits, at most ``bucket_keys`` of them unless the key has
    no bits left; it is named by the first key of its range. A slot of the doubled directory that points to a bucket of
    less depth is not written out: a key finds its bucket by its prefix of each depth in use, usually one or two.
    """
    n = keys.count()
    depth = min(key_bits, max(0, math.ceil(math.log2(max(1, n) / bucket_keys))))

    def counted(inside: DataFrame) -> DataFrame:
        prefix = _leading(F.lit(depth), key_bits)
        return settled(
            inside.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n")).withColumn("local_depth", F.lit(depth))
        )

    level = counted(keys)
    leaves, depths = [], [depth]
    while depth < key_bits:
        over = level.where(F.col("n") > bucket_keys).select("prefix")
        if over.isEmpty():
            break
        leaves.append(level.where(F.col("n") <= bucket_keys))
        keys = keys.join(over, _leading(F.lit(depth), key_bits) == F.col("prefix"), "left_semi")
        depth += 1
        depths.append(depth)
        level = counted(keys)
    buckets = reduce(DataFrame.unionByName, leaves, level)
    first = F.when(F.col("local_depth") == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftleft", F.col("prefix"), F.lit(key_bits) - F.col("local_depth"))
    )
    return buckets.select("local_depth", "prefix", first.alias("bucket")), depths


def build_index(
    docs: DataFrame, bucket_keys: int = BUCKET_KEYS, key_bits: int = KEY_BITS, raw_bits: int = KEY_BITS
) -> tuple[DataFrame, DataFrame]:
    """``(entries, index)``, both written tables.

    ``entries``: a row for each document (doc_id, raw, key, text_sha256). ``index``: a row for each distinct raw hash
    of a key (bucket, key, raw, rows).
    """
    normal = docs.select("doc_id", _raw(whole_text(), raw_bits).alias("raw"), ascii_lower(whole_text()).alias("normal"))
    entries = settled(
        normal.select(
            "doc_id",
            "raw",
            _key("normal", key_bits).alias("key"),
            F.sha2("normal", 256).alias("text_sha256"),
        )
    )
    raws = settled(entries.groupBy("key", "raw").agg(F.count("*").alias("rows")))
    buckets, depths = directory(settled(raws.select("key").distinct()), bucket_keys, key_bits)
    tried = raws.select("*", F.explode(F.array(*[F.lit(d) for d in depths])).alias("local_depth"))
    placed = tried.withColumn("prefix", _leading(F.col("local_depth"), key_bits)).join(buckets, ["local_depth", "prefix"])
    index = placed.select("bucket", "key", "raw", "rows").hint("rebalance", "bucket")
    return entries, settled(index)


def exact_duplicates(
    docs: DataFrame, bucket_keys: int = BUCKET_KEYS, key_bits: int = KEY_BITS, raw_bits: int = KEY_BITS
) -> DataFrame:
    """One row for each document: doc_id, raw, text_sha256, keep_id, group_size, kept.

    ``raw`` is the hash of the text as given; with doc_id it names the row for ``keep_rows``. Texts that collide in it
    are told apart by their keys, and texts that collide in both by their bytes.
    """
    entries, index = build_index(docs, bucket_keys, key_bits, raw_bits)
    shared = index.groupBy("bucket", "key").agg(F.sum("rows").alias("n")).where("n > 1").select("bucket", "key")
    wanted = settled(index.join(shared, ["bucket", "key"]).select("raw", "bucket", "key"))
    fetched = (
        docs.select("doc_id", _raw(whole_text(), raw_bits).alias("raw"), ascii_lower(whole_text()).alias("normal"))
        .withColumn("key", _key("normal", key_bits))
        .join(wanted, ["raw", "key"])
        .select("doc_id", "raw", "bucket", "key", "normal")
    )
    groups = fetched.groupBy("bucket", "key", "normal").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    # A chain of one needs no bytes any more: every row with the key is in the group.
    chain = groups.groupBy("bucket", "key").agg(
        F.count("*").alias("chain"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    )
    chain = settled(chain)
    single = chain.where("chain = 1").select("key", "keep_id", "group_size")
    collided = chain.where("chain > 1").select("key")
    found = entries.join(single, "key", "left").select(
        "doc_id",
        "raw",
        "text_sha256",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "key",
    )
    if not collided.isEmpty():
        rows = fetched.join(collided, "key", "left_semi")
        sets = groups.join(collided, "key", "left_semi").drop("bucket")
        chained = rows.join(sets, ["key", "normal"]).select(
            "doc_id", "raw", F.sha2("normal", 256).alias("text_sha256"), "keep_id", "group_size", "key"
        )
        found = found.join(collided, "key", "left_anti").unionByName(chained)
    return found.drop("key").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def keep_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns unchanged."""
    found = settled(exact_duplicates(docs, **options))
    raw, key_id, key_raw = fresh(docs, "raw", "dropped_id", "dropped_raw")
    named = docs.withColumn(raw, _raw(whole_text(), options.get("raw_bits", KEY_BITS)))
    dropped = found.where(~F.col("kept")).select(F.col("doc_id").alias(key_id), F.col("raw").alias(key_raw)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(key_id)) & (F.col(raw) == F.col(key_raw))
    left = named.join(dropped, same, "left_anti")
    repeated = settled(
        found.where("kept")
        .groupBy(F.col("doc_id").alias(key_id), F.col("text_sha256").alias("sha"))
        .agg(F.count("*").alias("n"), F.min("raw").alias(key_raw))
        .where("n > 1")
        .drop("n", "sha")
    )
    if repeated.isEmpty():
        return left.select(*docs.columns)
    sha = fresh(named, "sha")[0]
    ids = repeated.select(key_id).distinct()
    same_id = F.col("doc_id").eqNullSafe(F.col(key_id))
    doubled = left.join(ids, same_id, "left_semi").withColumn(sha, F.sha2(ascii_lower(whole_text()), 256))
    doubled = doubled.dropDuplicates(["doc_id", sha])
    return left.join(ids, same_id, "left_anti").select(*docs.columns).unionByName(doubled.select(*docs.columns))
