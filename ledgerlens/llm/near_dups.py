"""Near-duplicate components by a multi-index Hamming join of b-bit MinHash signatures.

A document's set is its distinct five-word shingles. Equal sets form a class, and only classes are compared. A class
has a signature of 80 symbols of 14 bits, one for each MinHash function. The signature is split into 16 chunks of five
symbols; by the pigeonhole principle two signatures that differ in at most 31 symbols agree in some chunk up to one
symbol, so a class is entered under every chunk with each one of its symbols left out (80 keys of four symbols) and
such pairs always share a key. Pairs at the similarity limit differ in 20 symbols on average; one that shares no key at
all has a probability of about 1e-7.

Links are confirmed on the full sets, in two waves that never list all pairs of a group:

1. Every key has a centre: the class that meets most others over all its keys, which is the original where a group are
   edited copies of one text. A class is compared with the centres of its keys, and the nearest is confirmed.
2. Keys whose classes are still in different components compare the classes of different components, in blocks, inside
   the tasks. What passes the size bound and a longer signature (640 symbols of 8 bits) is confirmed as well, once for
   the first key that a pair shares.

In both waves the longer signature tells how near two classes are. Pairs within the limit are confirmed by the leading
bytes of their sets, and what those leave by the full sets. All three are made once, and only for classes that share a
key with another; keys travel with nothing but the class.

So a group of copies is linked through its centres, and no link between different components is lost.

Defined results: a null text, or one without words, has an empty set and is linked with nothing; a text with fewer
than five words is one shingle; null ids count as larger than any other id (``component_id`` is null only if no id of
the component is given); rows that repeat one doc_id and one text stay or go together; an empty table gives an empty
table; columns other than doc_id and text pass through ``keep_rows`` untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import bounded_batches, fresh, text_key, whole_text
from ledgerlens.llm.components import component_labels
from ledgerlens.llm.word_hash import mix, shingles, words
from ledgerlens.operators.small import bounded, settled

SHINGLE_WORDS = 5
SIMILARITY = 75  # in hundredths
SYMBOLS, CHUNKS, SYMBOL_BITS = 80, 16, 14
CHUNK_SYMBOLS = SYMBOLS // CHUNKS
# Of the longer signature. A pair at the similarity limit is farther apart with a probability below 1e-6.
LONG_SYMBOLS, MAX_DISTANCE = 640, 216
BLOCK_ROWS = 2048
_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(0, 2**63, LONG_SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, LONG_SYMBOLS, dtype=np.uint64)


def shingle_set(text: str, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    return np.unique(shingles(words(text.encode("utf-8"))[0], width))


def _lowest(members: np.ndarray, functions: int) -> np.ndarray:
    """The mixed minima of the first so many MinHash functions over a set that is not empty."""
    lowest = np.full(functions, np.uint64(2**64 - 1))
    for begin in range(0, len(members), 256):
        part = members[begin : begin + 256, None] * _MULTIPLY[:functions] + _ADD[:functions]
        np.minimum(lowest, part.min(axis=0), out=lowest)
    return mix(lowest)


def signature(members: np.ndarray) -> np.ndarray:
    """The b-bit MinHash symbols of a set that is not empty."""
    return (_lowest(members, SYMBOLS) & np.uint64((1 << SYMBOL_BITS) - 1)).astype("<u2")


def long_signature(members: np.ndarray) -> np.ndarray:
    """The symbols of the longer signature."""
    return (_lowest(members, LONG_SYMBOLS) >> np.uint64(56)).astype(np.uint8)


def signatures(column: pa.Array) -> np.ndarray:
    """A column of signatures as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, SYMBOLS)


def long_signatures(column: pa.Array) -> np.ndarray:
    """A column of longer signatures as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, LONG_SYMBOLS)


def index_keys(symbols: np.ndarray) -> np.ndarray:
    """Keys of signatures (a row each): every chunk with each of its symbols left out."""
    out = []
    wide = symbols.astype(np.int64).reshape(len(symbols), CHUNKS, CHUNK_SYMBOLS)
    for chunk in range(CHUNKS):
        for left_out in range(CHUNK_SYMBOLS):
            key = np.full(len(symbols), chunk * CHUNK_SYMBOLS + left_out, np.int64)
            for i in range(CHUNK_SYMBOLS):
                if i != left_out:
                    key = (key << SYMBOL_BITS) | wide[:, chunk, i]
            out.append(key)
    return np.stack(out, axis=1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x, dtype=np.uint64).view(np.int64))


SET_FIELDS = [
    T.StructField("n_shingles", T.LongType()),
    T.StructField("c", T.LongType()),
    T.StructField("sig", T.BinaryType()),
]


def describe_sets(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, t1, t2, n_shingles, class ``c`` (a hash of the set) and ``sig`` for each row, written."""
    slim = docs.select("doc_id", *text_key(), whole_text().alias("text"))
    schema = T.StructType([*slim.drop("text").schema, *SET_FIELDS])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, signatures = [], [], []
            for text in batch.column(3):
                members = shingle_set(text.as_py(), width)
                sizes.append(len(members))
                names.append(int(mix(np.array([mix(members).sum() + np.uint64(len(members))], np.uint64))[0]))
                signatures.append(signature(members).tobytes() if len(members) else b"")
            own = [pa.array(sizes, pa.int64()), _signed(np.array(names, np.uint64)), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], *own], schema.names)

    return settled(slim.mapInArrow(described, schema))


def _key_rows(classes: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("c", T.LongType())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2048):
                part = batch.slice(begin, 2048)
                keys = index_keys(signatures(part.column(1)))
                names = np.repeat(part.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(names)], schema.names)

    return classes.select("c", "sig").mapInArrow(keyed, schema)


def _with_distance(pairs: DataFrame, shapes: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity, with the distance of their longer signatures, up to MAX_DISTANCE."""
    one = shapes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("long").alias("sa"))
    two = shapes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("long").alias("sb"))
    both = pairs.join(one, "a").join(two, "b")
    both = both.where(100 * F.least("na", "nb") >= similarity * F.greatest("na", "nb"))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b", "distance")])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = (long_signatures(batch.column(2)) != long_signatures(batch.column(3))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(far, pa.int64())], schema.names)

    return both.select("a", "b", "sa", "sb").mapInArrow(measured, schema).where(F.col("distance") <= MAX_DISTANCE)


def may_share(one: np.ndarray, two: np.ndarray, similarity: int) -> bool:
    """Whether sets with these 16-bit ends of their members can reach the similarity; never false if they do."""
    found = np.zeros((2, 1 << 16), bool)
    found[0, one] = found[1, two] = True
    shared = min(int(found[0, two].sum()), int(found[1, one].sum()))
    return 100 * shared >= similarity * (len(one) + len(two) - shared)


def reach(one: np.ndarray, two: np.ndarray, similarity: int) -> bool:
    """Whether two full sets reach the similarity."""
    merged = np.concatenate([one, two])
    merged.sort(kind="stable")
    shared = int((merged[1:] == merged[:-1]).sum())
    return 100 * shared >= similarity * (len(one) + len(two) - shared)


def _full_sets(names: DataFrame, docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """c, row number ``u``, longer signature, leading two bytes of each member, and members of the classes in ``names``.

    Written, and read by both waves of links. Texts of other classes are not looked at again. Rows of ``docs`` that
    repeat an id and a text give a class several rows here; the one with the least number counts.
    """
    texts = bounded(classes.join(names, "c").select("c", F.col("t1").alias("c1"), F.col("t2").alias("c2"), "first_text_id"))
    own = docs.select("doc_id", *text_key(), whole_text().alias("text"))
    same = (F.col("t1") == F.col("c1")) & (F.col("t2") == F.col("c2")) & F.col("doc_id").eqNullSafe(F.col("first_text_id"))
    held = own.join(texts, same).select("c", "text")
    binary = [T.StructField(n, T.BinaryType()) for n in ("long", "ends", "members")]
    set_schema = T.StructType([T.StructField("c", T.LongType()), *binary])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch.column(1)]
            longs = [long_signature(x).tobytes() for x in sets]
            ends = [(x >> np.uint64(48)).astype(np.uint16).tobytes() for x in sets]
            columns = [pa.array(x, pa.binary()) for x in (longs, ends, [x.tobytes() for x in sets])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], set_schema.names)

    return settled(held.mapInArrow(members, set_schema).withColumn("u", F.monotonically_increasing_id()))


def _numbered(pairs: DataFrame, numbers: DataFrame) -> DataFrame:
    """Pairs (a, b) with the row numbers (ua, ub) of their sets, written."""
    one, two = (numbers.withColumnsRenamed({"c": x, "u": f"u{x}"}) for x in ("a", "b"))
    return settled(pairs.join(one, "a").join(two, "b").select("a", "b", "ua", "ub"))


def _confirmed(pairs: DataFrame, numbers: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs that reach the similarity on their full sets, written.

    The leading bytes bound what two sets can share, so pairs meet with those first, and with their full sets only where
    the bound leaves them.
    """
    possible = _compared(_numbered(pairs, numbers), sets.select("u", "ends"), np.uint16, lambda x, y: may_share(x, y, similarity))
    linked = _compared(possible, sets.select("u", "members"), np.uint64, lambda x, y: reach(x, y, similarity))
    return linked.select("a", "b")


def _compared(pairs: DataFrame, sets: DataFrame, kind: type, good: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """The pairs (a, b, ua, ub) whose sets pass a test, written. ``sets`` has u and one binary column."""
    name = sets.columns[1]
    # Only sets that a pair still needs move.
    used = bounded(pairs.select(F.col("ua").alias("u")).unionByName(pairs.select(F.col("ub").alias("u"))).distinct())
    sets = sets.join(used, "u", "left_semi")
    both = pairs.join(sets.withColumnsRenamed({"u": "ua", name: "ma"}), "ua").join(
        sets.withColumnsRenamed({"u": "ub", name: "mb"}), "ub"
    )
    schema = T.StructType([T.StructField(x, T.LongType()) for x in ("a", "b", "ua", "ub")])

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(batch.column(4), batch.column(5), strict=True)
            passed = [good(*(np.frombuffer(m.as_buffer(), dtype=kind) for m in pair)) for pair in columns]
            keep = pa.array(passed, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in range(4)], schema.names)

    return settled(both.select("a", "b", "ua", "ub", "ma", "mb").mapInArrow(tested, schema))


def first_shared(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The first key that index symbols share with those of others (a row each): chunk and symbol left out, as a number."""
    same = (others == one).reshape(len(others), CHUNKS, CHUNK_SYMBOLS)
    chunk = (same.sum(axis=2) >= CHUNK_SYMBOLS - 1).argmax(axis=1)
    inside = same[np.arange(len(others)), chunk]
    return chunk * CHUNK_SYMBOLS + np.where(inside.all(axis=1), 0, inside.argmin(axis=1))


def _cross_pairs(rows: DataFrame, similarity: int) -> DataFrame:
    """Pairs of classes that share a key, differ in component, and pass the size bound and the distance.

    ``rows`` has key, a pair of blocks (one, two), own block, c, label, n, sig, long. A task goes through its sorted units one
    by one; a unit holds at most two blocks of about BLOCK_ROWS rows. A pair is given by the first key it shares.
    """
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def pairs_of(unit: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        c, label, n, block = (unit.column(k).to_numpy() for k in ("c", "label", "n", "block"))
        slot = unit.column("key")[0].as_py() >> (SYMBOL_BITS * (CHUNK_SYMBOLS - 1))
        within = unit.column("one")[0].as_py() == unit.column("two")[0].as_py()
        sig = signatures(unit.column("sig"))
        longs = long_signatures(unit.column("long"))
        left, right = [], []
        for i in range(len(c)):
            fits = (label != label[i]) & (100 * np.minimum(n, n[i]) >= similarity * np.maximum(n, n[i]))
            other = np.flatnonzero(fits & (c > c[i]) & ((block == block[i]) if within else (block != block[i])))
            if len(other):
                other = other[(longs[other] != longs[i]).sum(axis=1) <= MAX_DISTANCE]
            if len(other):
                other = other[first_shared(sig[i], sig[other]) == slot]
            left.append(np.full(len(other), c[i]))
            right.append(c[other])
        return np.concatenate(left), np.concatenate(right)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def units(last: bool) -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            names = np.stack([whole.column(k).to_numpy() for k in ("key", "one", "two")], axis=1)
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            ends = [*cuts.tolist(), *([len(names)] if last else [])]
            begin = 0
            for end in ends:
                if end - begin > 1:
                    a, b = pairs_of(whole.slice(begin, end - begin))
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema.names)
                begin = end
            held[:] = whole.slice(begin).to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                yield from units(last=False)
        if held:
            yield from units(last=True)

    return rows.select("key", "one", "two", "block", "c", "label", "n", "sig", "long").mapInArrow(compared, schema)


def near_components(docs: DataFrame, width: int = SHINGLE_WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, t1, t2 (hashes of the text), n_shingles, class ``c`` and component_id for each row."""
    bounded_batches(docs.sparkSession)
    described = describe_sets(docs, width)
    classes = settled(
        described.where("n_shingles > 0")
        .groupBy("c")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.max("n_shingles").alias("n"),
            F.min(F.struct("t1", "t2", F.col("doc_id").alias("first_text_id"), "sig")).alias("one"),
        )
        .select("c", "first_id", "n", "one.*")
    )
    keys = _key_rows(classes)
    # Keys with one class are done; the rest keep their rows for both waves.
    several = settled(keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1"))
    shared = settled(keys.join(several, "key"))
    met = settled(shared.groupBy("c").agg(F.sum("rows").alias("met")))
    centres = settled(shared.join(met, "c").groupBy("key").agg(F.max(F.struct("met", "c")).alias("centre")))
    stars = shared.join(centres, "key").select(F.col("c").alias("a"), F.col("centre.c").alias("b"))
    stars = stars.where("a <> b").distinct()
    sets = _full_sets(met.select("c"), docs, classes, width)
    numbers = settled(sets.groupBy("c").agg(F.min("u").alias("u")))
    shapes = settled(classes.select("c", "n", "sig").join(numbers, "c").join(sets.select("u", "long"), "u").drop("u"))
    near = _with_distance(stars, shapes, similarity).groupBy("a").agg(F.min(F.struct("distance", "b")).alias("best"))
    links = _confirmed(near.select("a", "best.b"), numbers, sets, similarity)
    labels = component_labels(links)

    labels = settled(labels)
    placed = shared.join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn(
        "label", F.coalesce("label", "c")
    )
    mixed = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    mixed = settled(mixed.where("low <> high").select("key", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks")))
    rows = placed.select("key", "c", "label").join(mixed, "key").join(shapes, "c")
    block = F.pmod(F.xxhash64("c"), F.col("blocks"))
    pairs_of_blocks = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.struct(F.least(block, other).alias("one"), F.greatest(block, other).alias("two")),
    )
    units = rows.select("key", "c", "label", "n", "sig", "long", block.alias("block"), F.inline(pairs_of_blocks))
    dealt = units.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    second = settled(_cross_pairs(dealt, similarity))
    if not second.isEmpty():
        links = links.unionByName(_confirmed(second, numbers, sets, similarity))
        labels = component_labels(links)

    named = classes.select("c", "first_id").join(labels.withColumnRenamed("node", "c"), "c", "left")
    named = named.withColumn("label", F.coalesce("label", "c"))
    ids = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_class = settled(named.join(ids, "label").select("c", "label", "component_id"))
    return described.join(by_class, "c", "left").select(
        "doc_id",
        "t1",
        "t2",
        "n_shingles",
        "c",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "label",
    )


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the row with the smallest id of its component) for each row."""
    found = near_components(docs, **options)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component (smallest id, then smallest hash of the text), columns unchanged."""
    found = settled(near_components(docs, **options).where("n_shingles > 0"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
    first = found.groupBy("label").agg(F.min(order).alias("first"))
    gone = found.join(first, "label").where(order != F.col("first"))
    key_id, key_1, key_2 = fresh(docs, "gone_id", "gone_t1", "gone_t2")
    gone = settled(gone.select(F.col("doc_id").alias(key_id), F.col("t1").alias(key_1), F.col("t2").alias(key_2)).distinct())
    one, two = text_key()
    same = F.col("doc_id").eqNullSafe(F.col(key_id)) & (one == F.col(key_1)) & (two == F.col(key_2))
    return docs.join(gone, same, "left_anti")
