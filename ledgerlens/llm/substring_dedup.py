"""Exact substring deduplication with suffix arrays.

Every byte that lies in a string of ``length`` bytes which also starts at another place is taken out; both places are
judged on the input. Suffix arrays of whole corpora do not fit a task, so windows are first dealt to shards by content:

* A window belongs to the gram (144 bytes) in it with the smallest hash, the leftmost if equal. Equal windows belong to
  equal grams at equal offsets. Neighbouring windows of one gram make a *context*; a text is a row of contexts, about
  one for every 130 bytes, told apart by 128-bit digests.
* A context whose gram occurs once is unique. One whose digest occurs twice is repeated as a whole. Both are settled
  by counting, however hot; what is left are different contexts around one gram.
* Those are fetched and grouped to shards of bounded size by gram. A shard's suffix array (Larsson-Sadakane) and
  common prefixes (Kasai) tell which windows repeat inside it.
* A gram with very many different contexts is salted over several shards. Their windows that are unique inside a shard
  are then merged: a shard publishes sorted arrays of window digests, one for each range of digests; the arrays of one
  range meet in one task, and every digest is looked up in them by binary search.

Defined results: a null text is the empty text, and texts shorter than ``length`` lose nothing; equal texts are equal
strings, so all copies of a long enough text are taken out whole; matches never cross texts; null ids and repeated rows
keep a row each; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import bounded_batches, text_key, whole_text
from ledgerlens.llm.spans import ARROW_SPANS, SPANS, cut_texts, merged
from ledgerlens.llm.suffix_array import common_prefixes, suffix_array
from ledgerlens.llm.word_hash import mix
from ledgerlens.operators.small import settled

LENGTH = 400
SHARD_BYTES = 1 << 20
SHARD_CONTEXTS = 2048
PIECE = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_rng = np.random.default_rng(5551212)
_TABLES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64)
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_held: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _held or len(_held[base]) < n:
        steps = np.full(max(n, 1 << 18), np.uint64(base))
        steps[0] = 1
        _held[base] = np.multiply.accumulate(steps)
    return _held[base]


class Digests:
    """Digests of any stretches of one byte string, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int):
        factor = _FACTORS[which]
        self.down = _powers(pow(factor, -1, 1 << 64), len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[which][data] * _powers(factor, len(data) + 1)[: len(data)], out=self.sums[1:])

    def of(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[begins]) * self.down[begins] + (ends - begins).astype(np.uint64))


def gram_bytes(length: int) -> int:
    return max(1, length * 36 // 100)


def contexts(data: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """The contexts of a text: first window start, number of windows, gram digest, and two digests of the bytes."""
    n = len(data)
    gram = gram_bytes(length)
    reach = length - gram + 1  # grams in a window
    empty = np.zeros(0, np.int64)
    if n < length:
        return {k: empty for k in ("start", "windows", "gram", "h1", "h2")}
    digests = [Digests(data, 0), Digests(data, 1)]
    begins = np.arange(n - gram + 1)
    grams = digests[0].of(begins, begins + gram)
    owner = np.empty(n - length + 1, np.int64)
    for base in range(0, len(owner), PIECE):
        part = grams[base : min(len(grams), base + PIECE + reach - 1)]
        key = (part & ~_PLACE) | np.arange(len(part)).astype(np.uint64)
        blocks = -(-len(part) // reach)
        padded = np.full(blocks * reach, np.uint64(2**64 - 1))
        padded[: len(part)] = key
        square = padded.reshape(blocks, reach)
        forward = np.minimum.accumulate(square, axis=1).ravel()
        backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        size = len(part) - reach + 1
        lowest = np.minimum(backward[:size], forward[reach - 1 : reach - 1 + size])
        owner[base : base + size] = (lowest & _PLACE).astype(np.int64) + base
    start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    windows = np.diff(np.append(start, len(owner)))
    end = start + windows - 1 + length
    return {
        "start": start,
        "windows": windows,
        "gram": grams[owner[start]].view(np.int64),
        "h1": digests[0].of(start, end).view(np.int64),
        "h2": digests[1].of(start, end).view(np.int64),
    }


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def _context_rows(docs: DataFrame, length: int, count_only: bool) -> DataFrame:
    """Grams with counts, or contexts (g, h1, h2, t1, t2, start, windows) of all texts; a batch names no context twice."""
    names = ("g", "n") if count_only else ("g", "h1", "h2", "t1", "t2", "start", "windows")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], axis=1)
            parts, held = [], 0

            def rows() -> pa.RecordBatch:
                columns = [np.concatenate([p[i] for p in parts]) for i in range(len(parts[0]))]
                if count_only:
                    columns = list(np.unique(columns[0], return_counts=True))
                return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], list(names))

            for row, text in enumerate(batch.column(0)):
                own = contexts(np.frombuffer(text.as_py().encode("utf-8"), dtype=np.uint8), length)
                n = len(own["start"])
                if not n:
                    continue
                if count_only:
                    parts.append([own["gram"]])
                else:
                    key = [np.full(n, keys[row, i]) for i in range(2)]
                    parts.append([own["gram"], own["h1"], own["h2"], *key, own["start"], own["windows"]])
                held += n
                if held >= 50_000:
                    yield rows()
                    parts, held = [], 0
            if parts:
                yield rows()

    slim = docs.select(whole_text().alias("text"), *text_key()).where(F.octet_length("text") >= length)
    return slim.mapInArrow(found, _longs(*names))


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted contexts: ``wanted`` has t1, t2 and a list of (g, salt, shards, h1, h2, many, start, size)."""
    plain = [*_longs("g", "salt", "h1", "h2", "shards"), T.StructField("many", T.BooleanType())]
    schema = T.StructType([*plain, T.StructField("raw", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, seen = [], set()
            for text, rows in zip(batch.column(0), batch.column(1), strict=True):
                raw = text.as_py().encode("utf-8")
                for r in rows.as_py():
                    if (r["h1"], r["h2"]) not in seen:
                        seen.add((r["h1"], r["h2"]))
                        bytes_ = raw[r["start"] : r["start"] + r["size"]]
                        out.append((r["g"], r["salt"], r["h1"], r["h2"], r["shards"], r["many"], bytes_))
                if len(out) >= 4096:
                    yield _batch(out, schema)
                    out = []
            if out:
                yield _batch(out, schema)

    texts = docs.select(*text_key(), whole_text().alias("text"))
    return texts.join(wanted, ["t1", "t2"]).select("text", "rows").mapInArrow(cut, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    columns = [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema.names)


def _shard_repeats(strings: list[bytes], many: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which windows of a shard's strings occur again: (string, offset, repeated, first of its class) of each window."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    order, place = suffix_array(data)
    prefix = common_prefixes(data, order, place, starts, length)
    string = np.repeat(np.arange(len(strings)), sizes)
    offset = np.arange(len(data)) - starts[string]
    owned = offset + length <= sizes[string]
    at = np.flatnonzero(owned[order])
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(bool), empty.astype(bool)
    # Between two owned suffixes the common prefix is the least of those on the way.
    least = np.minimum.reduceat(prefix[: at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
    same = least >= length
    same[0] = False
    classes = np.cumsum(~same) - 1
    position = order[at]
    several = np.bincount(classes) > 1
    held_often = np.zeros(len(several), bool)
    held_often[classes[many[string[position]]]] = True
    return string[position], offset[position], (several | held_often)[classes], ~same


# A window that a shard publishes: its digests, its context and offset, and whether it needs an answer.
PUBLISHED = np.dtype([("f1", "<u8"), ("f2", "<u8"), ("h1", "<i8"), ("h2", "<i8"), ("at", "<i8"), ("open", "?")])


def _resolved(rows: DataFrame, length: int) -> DataFrame:
    """Work through shards: rows of kind 0 are repeated window ranges (begin, end) of a context; rows of kind 1 are the
    sorted digests that a shard of a salted gram publishes for one range of digests (``part``)."""
    schema = T.StructType([*_longs("kind", "h1", "h2", "begin", "end", "g", "part"), T.StructField("packed", T.BinaryType())])

    def worked(shard: list[tuple]) -> Iterator[pa.RecordBatch]:
        unique: dict[tuple, tuple] = {(r[2], r[3]): r for r in shard}
        kept = list(unique.values())
        if len(kept) < 2 and kept[0][1] < 0:
            return
        strings = [r[6] for r in kept]
        many = np.array([r[5] for r in kept])
        string, offset, repeated, first = _shard_repeats(strings, many, length)
        h = np.array([(r[2], r[3]) for r in kept], dtype=np.int64)
        hit = repeated & ~many[string]
        place = np.lexsort((offset[hit], string[hit]))
        s, o = string[hit][place], offset[hit][place]
        if len(s):
            new = np.append(True, (s[1:] != s[:-1]) | (o[1:] != o[:-1] + 1))
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(s)) - 1
            zero = np.zeros(len(begin), np.int64)
            columns = [zero, h[s[begin], 0], h[s[begin], 1], o[begin], o[end] + 1, zero, zero]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(begin), pa.binary())], schema.names)
        if kept[0][1] >= 0 and first.any():  # a salted gram has its shards to itself
            string, offset, repeated = string[first], offset[first], repeated[first]
            data = np.frombuffer(b"".join(strings), dtype=np.uint8)
            sizes = np.array([len(x) for x in strings], dtype=np.int64)
            begins = (np.cumsum(sizes) - sizes)[string] + offset
            out = np.empty(len(begins), PUBLISHED)
            out["f1"], out["f2"] = (Digests(data, i).of(begins, begins + length) for i in range(2))
            out["h1"], out["h2"], out["at"], out["open"] = h[string, 0], h[string, 1], offset, ~repeated
            out = out[np.argsort(out["f1"], kind="stable")]
            parts = max(16, kept[0][4] // 8)
            part = ((out["f1"] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            packed = [piece.tobytes() for piece in np.split(out, at[1:])]
            zero = np.zeros(len(at), np.int64)
            columns = [zero + 1, zero, zero, zero, zero, zero + kept[0][0], part[at]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(packed, pa.binary())], schema.names)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, group = [], 0, None
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                if row[:2] != group:
                    if size >= SHARD_BYTES or shard and (row[1] >= 0 or shard[-1][1] >= 0):
                        yield from worked(shard)
                        shard, size = [], 0
                    group = row[:2]
                shard.append(row)
                size += len(row[6])
        if shard:
            yield from worked(shard)

    dealt = rows.repartition("g", "salt").sortWithinPartitions("g", "salt")
    return dealt.mapInArrow(stream, schema)


def _merge_shards(published: DataFrame) -> DataFrame:
    """(h1, h2, begin, end) of windows that are unique in their shard but found in another one.

    A shard publishes a window once, so a digest that binary search finds more than once comes from several shards.
    """
    schema = _longs("h1", "h2", "begin", "end")

    def looked_up(arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(arrays)
        key = mix(rows["f1"]) ^ rows["f2"]
        shelf = np.sort(key)
        places = np.searchsorted(shelf, key, side="right") - np.searchsorted(shelf, key, side="left")
        found = rows[(places > 1) & rows["open"]]
        if len(found):
            columns = [found["h1"], found["h2"], found["at"], found["at"] + 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema.names)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, group = [], None
        for batch in batches:
            for g, part, packed in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if (g, part) != group and arrays:
                    yield from looked_up(arrays)
                    arrays = []
                group = (g, part)
                arrays.append(np.frombuffer(packed, dtype=PUBLISHED))
        if arrays:
            yield from looked_up(arrays)

    dealt = published.select("g", "part", "packed").repartition("g", "part").sortWithinPartitions("g", "part")
    return dealt.mapInArrow(stream, schema)


def repeated_spans(docs: DataFrame, length: int = LENGTH, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """t1, t2 (hashes of a text) and ``cut``: its byte spans that are covered by repeated windows."""
    bounded_batches(docs.sparkSession)
    grams = _context_rows(docs, length, True).groupBy("g").agg(F.sum("n").alias("n")).where("n > 1").select("g")
    held = settled(_context_rows(docs, length, False).join(settled(grams), "g", "left_semi"))
    # A context is a place in a text; copies of a text are one text here.
    places = held.groupBy("g", "h1", "h2", "t1", "t2", "start", "windows").agg(F.count("*").alias("copies"))
    kinds = settled(
        places.groupBy("g", "h1", "h2").agg(
            F.sum("copies").alias("n"), F.min(F.struct("t1", "t2", "start", "windows")).alias("one")
        )
    )
    different = settled(kinds.groupBy("g").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    shards = F.ceil(F.col("kinds") / shard_contexts)
    wanted = (
        kinds.join(different, "g")
        .select(
            "one.t1",
            "one.t2",
            F.struct(
                "g",
                F.when(shards > 1, F.pmod("h1", shards)).otherwise(-1).cast("long").alias("salt"),
                shards.cast("long").alias("shards"),
                "h1",
                "h2",
                (F.col("n") > 1).alias("many"),
                "one.start",
                (F.col("one.windows") - 1 + length).alias("size"),
            ).alias("row"),
        )
        .groupBy("t1", "t2")
        .agg(F.collect_list("row").alias("rows"))
    )
    resolved = settled(_resolved(_fetched(docs, settled(wanted)), length))
    ranges = resolved.where("kind = 0").select("h1", "h2", "begin", "end")
    published = resolved.where("kind = 1")
    if not published.isEmpty():
        ranges = ranges.unionByName(_merge_shards(published))
    whole = kinds.where("n > 1").select(
        "h1", "h2", F.lit(0).cast("long").alias("begin"), F.col("one.windows").alias("end")
    )
    found = settled(whole.unionByName(ranges))
    spans = held.join(found, ["h1", "h2"]).select(
        "t1",
        "t2",
        F.struct(
            (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end") - 1 + length).alias("end")
        ).alias("span"),
    )
    lists = spans.groupBy("t1", "t2").agg(F.collect_set("span").alias("spans"))
    schema = T.StructType([*_longs("t1", "t2"), T.StructField("cut", SPANS)])

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = []
            for one in batch.column(2).to_pylist():
                cuts.append([{"begin": b, "end": e} for b, e in merged([(s["begin"], s["end"]) for s in one])])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cuts, ARROW_SPANS)], schema.names)

    return lists.mapInArrow(folded, schema)


def dedup_substrings(
    docs: DataFrame, length: int = LENGTH, with_text: bool = False, shard_contexts: int = SHARD_CONTEXTS
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the bytes kept_text) for each row."""
    spans = settled(repeated_spans(docs, length, shard_contexts))
    rows = docs.select("doc_id", *text_key(), whole_text().alias("text")).join(spans, ["t1", "t2"], "left")
    return cut_texts(rows.select("doc_id", "text", "cut"), with_text)
