"""Benchmark decontamination: an FM-index for each shard of documents, searched for all windows of the benchmark.

Words are lower-cased (A-Z only) runs of digits, letters and non-ASCII characters. A benchmark item gives its windows
of ten consecutive words, or one window if it is shorter. Each task cuts its documents into shards of bounded size,
numbers their words by the benchmark's vocabulary, indexes the stretches that are long enough to hold a window
(nothing else can match), searches all windows backward at once, locates them, and merges the hits into spans.

The benchmark is made distinct and read in blocks of bounded size. Up to BLOCKS_A_PASS blocks are broadcast and searched
in one pass over the documents, one step after the other; then the result is written and their broadcasts are dropped, so
a task and the driver hold that many blocks at most. The documents are not shuffled. A block passes the driver.

Defined results: a null or wordless text has no words, hits or items; an item without words is never found; an item
with a null id is searched and counted as a hit but has no name to list; items that share an id are one item; repeated
rows and null doc_ids keep a row each; empty tables give empty or clean results; all columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import fresh
from ledgerlens.llm.fm_index import FmIndex
from ledgerlens.llm.spans import ARROW_SPANS, SPANS, merged
from ledgerlens.operators.small import settled

WINDOW = 10
SHARD_WORDS = 500_000
BLOCK_BYTES = 8 << 20
BLOCKS_A_PASS = 4
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass
class Phrases:
    """Windows of one block of the benchmark, as word numbers from 1."""

    vocabulary: dict[bytes, int]
    names: list[str]
    # For each length: the distinct windows, and for each of them its items (offsets into a list).
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode("utf-8").lower()) if text else []


def phrases_of(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Phrases:
    vocabulary: dict[bytes, int] = {}
    names = sorted({name for name, _ in items if name is not None})
    place = {name: i for i, name in enumerate(names)}
    found: dict[int, dict[tuple, set[int]]] = {}
    for name, text in items:
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        if not numbers:
            continue
        length = min(window, len(numbers))
        for i in range(len(numbers) - length + 1):
            owners = found.setdefault(length, {}).setdefault(tuple(numbers[i : i + length]), set())
            if name is not None:
                owners.add(place[name])
    windows = {}
    for length, by_window in found.items():
        sizes = np.array([len(o) for o in by_window.values()])
        owners = np.array([i for o in by_window.values() for i in sorted(o)], dtype=np.int64)
        windows[length] = (np.array(list(by_window), np.int32), np.concatenate([[0], np.cumsum(sizes)]), owners)
    return Phrases(vocabulary, names, windows)


def _search_shard(words: list[list[bytes]], phrases: Phrases) -> tuple[list[list[tuple[int, int]]], list[list[str]]]:
    """Merged spans of hit words, and names of the found items, for each document of a shard."""
    lookup = phrases.vocabulary.get
    # A zero before, between and after the documents; words outside the vocabulary are zero as well.
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes
    numbers = np.zeros(int(sizes.sum()) + len(words) + 1, np.int32)
    for start, size, own in zip(starts.tolist(), sizes.tolist(), words, strict=True):
        if size:
            numbers[start : start + size] = np.fromiter(map(lookup, own, repeat(0)), np.int32, size)
    spans: list[list[tuple[int, int]]] = [[] for _ in words]
    items: list[list[str]] = [[] for _ in words]
    if not phrases.windows:
        return spans, items
    inside = np.diff((numbers > 0).astype(np.int8), prepend=0, append=0)
    begins, ends = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
    long = ends - begins >= min(phrases.windows)
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return spans, items
    lengths = ends - begins + 1  # with the zero that ends the stretch
    origin = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    index = FmIndex(numbers[origin], len(phrases.vocabulary) + 2)
    edges = np.zeros(len(numbers) + 1, np.int32)
    pairs = []
    for length, (windows, offsets, owners) in phrases.windows.items():
        which, low, high = index.search(windows)
        counts = high - low
        rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        at = origin[index.locate(rows)]
        np.add.at(edges, at, 1)
        np.add.at(edges, at + length, -1)
        document = np.searchsorted(starts, at, side="right") - 1
        seen = np.unique(document * len(windows) + np.repeat(which, counts))
        document, which = seen // len(windows), seen % len(windows)
        n = offsets[which + 1] - offsets[which]
        item = owners[np.repeat(offsets[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        pairs.append(np.repeat(document, n) * len(phrases.names) + item)
    hit = np.diff((np.cumsum(edges) > 0).astype(np.int8), prepend=0, append=0)
    for begin, end in zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist(), strict=True):
        k = int(np.searchsorted(starts, begin, side="right")) - 1
        spans[k].append((begin - int(starts[k]), end - int(starts[k])))
    for pair in np.unique(np.concatenate(pairs)).tolist():
        items[pair // len(phrases.names)].append(phrases.names[pair % len(phrases.names)])
    return spans, items


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    names: tuple[str, str, str] = ("n_words", "spans", "items"),
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with the number of words, the merged spans of hit words (begin, end), and the sorted ids of found items."""
    spark = docs.sparkSession
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("text").isNotNull()).distinct()
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    out = docs.withColumns(
        {
            names[0]: F.lit(0).cast("long"),
            names[1]: F.array().cast(SPANS),
            names[2]: F.array().cast("array<string>"),
        }
    )
    schema = T.StructType([*docs.schema, T.StructField(names[0], T.LongType()), T.StructField(names[1], SPANS), T.StructField(names[2], T.ArrayType(T.StringType()))])
    text_at, kept = docs.columns.index("text"), len(docs.columns)
    held = []
    for block in range(blocks):
        if len(held) == BLOCKS_A_PASS:
            out = settled(out)
            for past in held:
                past.destroy()  # nothing reads them again: the written table has no other lineage
            held = []
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(phrases_of([tuple(r) for r in own], window))
        held.append(shared)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts, spans, items, waiting, held = [], [], [], [], 0

                def flush() -> None:
                    found = _search_shard(waiting, shared.value)
                    spans.extend(found[0])
                    items.extend(found[1])

                for text in batch.column(text_at):
                    words = words_of(text.as_py())
                    counts.append(len(words))
                    waiting.append(words)
                    held += len(words)
                    if held >= shard_words:
                        flush()
                        waiting, held = [], 0
                flush()
                if blocks > 1:
                    before = [[(s["begin"], s["end"]) for s in x] for x in batch.column(kept + 1).to_pylist()]
                    spans = [merged([*a, *b]) for a, b in zip(spans, before, strict=True)]
                    items = [sorted({*a, *b}) for a, b in zip(items, batch.column(kept + 2).to_pylist(), strict=True)]
                named = [[{"begin": b, "end": e} for b, e in s] for s in spans]
                columns = [batch.column(i) for i in range(kept)]
                columns += [pa.array(counts, pa.int64()), pa.array(named, ARROW_SPANS), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        out = out.mapInArrow(search, schema)
    return out


def span_words(spans: str = "spans"):
    """Number of words in merged spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark; columns unchanged."""
    names = tuple(fresh(docs, "n_words", "spans", "items"))
    found = find_leaks(docs, benchmark, names, **options)
    return found.where(F.size(names[1]) == 0).select(*docs.columns)


def cut_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with every span taken out of its text, from the first hit word to the last; columns unchanged."""
    names = tuple(fresh(docs, "n_words", "spans", "items"))
    found = find_leaks(docs, benchmark, names, **options)
    columns_out = docs.columns
    text_at, spans_at = columns_out.index("text"), found.columns.index(names[1])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for row, spans in enumerate(batch.column(spans_at).to_pylist()):
                if spans:
                    raw = texts[row].encode("utf-8")
                    places = [m.span() for m in WORD.finditer(raw.lower())]
                    parts, at = [], 0
                    for span in spans:
                        parts.append(raw[at : places[span["begin"]][0]])
                        at = places[span["end"] - 1][1]
                    texts[row] = b"".join([*parts, raw[at:]]).decode("utf-8")
            kept = [pa.array(texts, pa.string()) if i == text_at else batch.column(i) for i in range(len(columns_out))]
            yield pa.RecordBatch.from_arrays(kept, columns_out)

    return found.mapInArrow(cut, docs.schema)
