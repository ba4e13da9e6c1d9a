"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text (each byte shifts the hash and adds a random number of that byte; the last 12
bytes decide here), and a chunk ends where the hash falls below a limit, on average every 16 bytes and never inside a
character. Where no end comes within 64 bytes, the chunk ends at the smallest hash of those (the last of equal ones), so
texts that repeat a short pattern are cut at the same place of the pattern everywhere. An insertion moves only the chunk
ends near it.

What is looked up is a window: a chunk and as many after it as reach 96 bytes together. Single chunks of 16 bytes repeat
by accident, windows hardly ever. A window is told apart by 95 bits of digest. Of equal windows the first (smallest
doc_id, then place) stays, and the bytes of all others are taken out; every chunk that goes is left at an earlier place.

Texts are read once. A batch of texts settles its own copies: it sends one row for each different window, and only the
places of further copies. Rows meet by digest, sorted, and a pass over the sorted rows lets repeated ones out. So a
window that a third of all texts share is one row for each batch, no group is held, and rows that nothing repeats are
shuffled once and written nowhere. The list of spans of one document is bounded by its own length. Lists go to the
texts by broadcast where they were counted to be few (``BROADCAST_SPANS``); beyond that the texts are shuffled once.

Defined results: a null text is the empty text; a null doc_id comes after all others; rows that repeat one doc_id and
one text are one document and get the same result; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import text_key, whole_text
from ledgerlens.llm.spans import ARROW_SPANS, SPANS, cut_texts, merged
from ledgerlens.llm.word_hash import mix
from ledgerlens.operators.small import settled

MEAN_CHUNK = 16
MAX_CHUNK = 64
REACH = 12
MIN_RUN = 96
_rng = np.random.default_rng(987654321)
_GEAR = _rng.integers(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)
_BYTES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64)
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
WINDOWS_HELD = 500_000
BROADCAST_SPANS = 1_000_000  # 16 bytes each


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte; doubling the reach five times covers the 32 bytes that count."""
    h = _GEAR[data]
    for reach in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[reach:] += h[:-reach] << np.uint32(reach)
        h = longer
    return h


def chunk_ends(data: np.ndarray, mean_chunk: int = MEAN_CHUNK, max_chunk: int = MAX_CHUNK) -> np.ndarray:
    """Ends of the chunks of a text, the last of which is the end of the text."""
    if not len(data):
        return np.zeros(0, np.int64)
    h = gear_hashes(data) << np.uint32(32 - REACH)  # what older bytes add is shifted out
    inside = np.append((data[1:] & 0xC0) == 0x80, False)  # not before a continuation byte
    cut = (h < np.uint32(2**32 // mean_chunk)) & ~inside
    cut[-1] = True
    ends = np.flatnonzero(cut) + 1
    begins = np.concatenate([[0], ends[:-1]])
    long = ends - begins > max_chunk
    if not long.any():
        return ends
    h[inside] = 2**32 - 1
    more = []
    for begin, end in zip(begins[long].tolist(), ends[long].tolist(), strict=True):
        while end - begin > max_chunk:
            begin += max_chunk - int(h[begin : begin + max_chunk][::-1].argmin())  # the last of equal ones
            more.append(begin)
    return np.sort(np.concatenate([ends, more]))


def windows(data: np.ndarray, ends: np.ndarray, min_run: int = MIN_RUN) -> tuple[np.ndarray, ...]:
    """Begin, end and two digests (64 and 31 bits) of every window of consecutive chunks."""
    begins = np.concatenate([[0], ends[:-1]])
    last = np.searchsorted(ends, begins + min_run)
    begins, ends = begins[last < len(ends)], ends[last[last < len(ends)]]
    out = []
    for table, factor in zip(_BYTES, _FACTORS, strict=True):
        up, down = (_powers(factor, len(data) + 1), _powers(pow(factor, -1, 1 << 64), len(data) + 1))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=sums[1:])
        out.append(mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64)))
    return begins, ends, out[0].view(np.int64), (out[1] >> np.uint64(33)).astype(np.int64)


_held: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _held or len(_held[base]) < n:
        steps = np.full(max(n, 1 << 18), np.uint64(base))
        steps[0] = 1
        _held[base] = np.multiply.accumulate(steps)
    return _held[base]


def _ranks(ids: pa.Array, t1: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Order of the documents of a batch (null ids last), and the rank of each, the same for equal ones."""
    rows = pa.table({"id": ids, "t1": t1})
    order = pc.sort_indices(rows, [("id", "ascending"), ("t1", "ascending")], null_placement="at_end").to_numpy()
    codes = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()[order]
    keys = t1.to_numpy(zero_copy_only=False)[order]
    new = np.append(False, (codes[1:] != codes[:-1]) | (keys[1:] != keys[:-1])) if len(order) else np.zeros(0, bool)
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return order, ranks


def _window_rows(docs: DataFrame, mean_chunk: int, min_run: int) -> DataFrame:
    """w, place, size, t1, doc_id: each different window of a batch, and the places of its copies there.

    ``place`` is the second digest and the begin, ``size`` the length, with 1 in its last bit if the batch holds copies.
    Copies meet nobody: ``place`` is negative, and ``w`` spreads them, as one text may be a third of all rows. Fields that change from row to row
    stand together, since rows of one document are written one after the other and compress well then.
    """
    fields = [T.StructField("w", T.LongType()), T.StructField("place", T.LongType()), T.StructField("size", T.IntegerType())]
    schema = T.StructType([*fields, T.StructField("t1", T.LongType()), docs.schema["doc_id"]])

    def windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order, ranks = _ranks(batch.column(2), batch.column(1))
            keys = batch.column(1).to_numpy(zero_copy_only=False)

            def rows(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
                owner, w, c, begin, size = (np.concatenate(x) for x in zip(*parts, strict=True))
                by = np.lexsort((c, w))  # stable: equal windows stay in the order of documents and places
                owner, w, c, begin, size, rank = owner[by], w[by], c[by], begin[by], size[by], ranks[owner[by]]
                starts = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (c[1:] != c[:-1])))
                runs = np.diff(np.append(starts, len(w)))
                copy = (rank != np.repeat(rank[starts], runs)) | (begin != np.repeat(begin[starts], runs))
                size = size << 1
                size[starts] |= np.logical_or.reduceat(copy, starts)
                kept = copy.copy()
                kept[starts] = True
                back = np.lexsort((begin[kept], rank[kept]))  # by document again
                owner, w, c, begin, size, copy = (x[kept][back] for x in (owner, w, c, begin, size, copy))
                place = np.where(copy, -1 - begin, c << 32 | begin)
                spread = mix((keys[owner] + begin + rank[kept][back] * 1_000_003).view(np.uint64)).view(np.int64)
                columns = [np.where(copy, spread, w), place, size.astype(np.int32), keys[owner]]
                columns = [*[pa.array(x) for x in columns], batch.column(2).take(pa.array(owner))]
                return pa.RecordBatch.from_arrays(columns, schema.names)

            parts, held, before = [], 0, -1
            for row in order.tolist():
                if ranks[row] == before:
                    continue  # the same document again
                before = ranks[row]
                data = np.frombuffer(batch.column(0)[row].as_py().encode("utf-8"), dtype=np.uint8)
                begins, ends, w, c = windows(data, chunk_ends(data, mean_chunk), min_run)
                if len(w):
                    parts.append((np.full(len(w), row), w, c, begins, ends - begins))
                    held += len(w)
                if held >= WINDOWS_HELD:
                    yield rows(parts)
                    parts, held = [], 0
            if parts:
                yield rows(parts)

    return docs.select(whole_text().alias("text"), text_key()[0], "doc_id").mapInArrow(windowed, schema)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of windows that have several places, and whether a row is the first, from rows sorted by window and place.

    Between batches only the first row of the last window is held, and whether it has been let out.
    """
    first, is_out = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if first is not None:
            rows = pa.concat_tables([first, rows])
        w, place, size, t1 = (rows.column(n).to_numpy() for n in ("w", "place", "size", "t1"))
        ids = pc.dictionary_encode(rows.column("doc_id").combine_chunks(), null_encoding="encode").indices.to_numpy()
        copy, c = place < 0, place >> 32
        starts = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (c[1:] != c[:-1]) | copy[1:]))
        at = np.repeat(starts, np.diff(np.append(starts, len(w))))
        other = (ids != ids[at]) | (t1 != t1[at]) | (place != place[at])
        out = other.copy()
        out[starts] = np.logical_or.reduceat(other | copy | (size & 1 > 0), starts)
        last_out = bool(out[starts[-1]]) or (is_out and starts[-1] == 0)
        if is_out:
            out[0] = False
        taken = rows.filter(pa.array(out))
        begin = np.where(copy, -1 - place, place & 0xFFFFFFFF)[out]
        first, is_out = rows.slice(starts[-1], 1), last_out
        columns = [taken.column("doc_id"), taken.column("t1"), pa.array(begin), pa.array(begin + (size[out] >> 1))]
        columns += [pa.array(~(other | copy)[out])]
        yield from pa.table(columns, ["doc_id", "t1", "begin", "end", "is_first"]).to_batches()


def spans_of(spans: list[tuple[int, int, bool]]) -> tuple[int, list[tuple[int, int]]]:
    """Bytes in repeated windows, given as (begin, end, is_first), and what is taken out: those that are not the first."""
    covered = merged([(b, e) for b, e, _ in spans])
    return sum(e - b for b, e in covered), merged([(b, e) for b, e, is_first in spans if not is_first])


def repeated_spans(docs: DataFrame, mean_chunk: int = MEAN_CHUNK, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, t1, n_repeated (bytes in repeated windows) and ``cut`` (spans to take out) of documents with such windows."""
    doc_id = docs.schema["doc_id"]
    key = T.StructField("t1", T.LongType())
    places = T.StructType([doc_id, key, *SPANS.elementType.fields, T.StructField("is_first", T.BooleanType())])
    dealt = _window_rows(docs, mean_chunk, min_run).repartition("w")
    order = ["w", F.shiftright("place", 32), F.col("doc_id").asc_nulls_last(), "t1", "place"]
    flagged = dealt.sortWithinPartitions(*order).mapInArrow(_repeated, places)
    lists = flagged.groupBy("doc_id", "t1").agg(F.collect_set(F.struct("begin", "end", "is_first")).alias("spans"))
    schema = T.StructType([doc_id, key, T.StructField("n_repeated", T.LongType()), T.StructField("cut", SPANS)])

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, cuts = [], []
            for spans in batch.column(2).to_pylist():
                repeated, cut = spans_of([(s["begin"], s["end"], s["is_first"]) for s in spans])
                sizes.append(repeated)
                cuts.append([{"begin": b, "end": e} for b, e in cut])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(cuts, ARROW_SPANS)], schema.names
            )

    return lists.mapInArrow(folded, schema)


def dedup_chunks(docs: DataFrame, mean_chunk: int = MEAN_CHUNK, min_run: int = MIN_RUN, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text), n_repeated for each row."""
    spans = settled(repeated_spans(docs, mean_chunk, min_run)).withColumnsRenamed({"doc_id": "span_id", "t1": "span_t1"})
    n_spans = spans.agg(F.sum(F.size("cut") + 2)).first()[0] or 0
    spans = F.broadcast(spans) if n_spans <= BROADCAST_SPANS else spans
    rows = docs.select("doc_id", text_key()[0], whole_text().alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("t1") == F.col("span_t1"))
    joined = rows.join(spans, same, "left")
    return cut_texts(joined.select("doc_id", "text", "cut", F.coalesce("n_repeated", F.lit(0)).alias("n_repeated")), with_text)
