"""Phrase collocation mining by partitioning the corpus (SON).

Texts are lower-cased (A-Z only), split at ``.,;:!?`` and line ends into pieces, and those at spaces and tabs into words.
Each task mines its shards of the corpus completely in memory, language by language: a phrase is locally frequent if its
share of the wanted support is at least the shard's share of the bytes of that language. A phrase that reaches the
support anywhere reaches that share in one shard at least, so the union of the locally frequent phrases misses none;
all of them are then counted over all shards, which is exact. A few tasks mine first, then four times as many, in the
end all of them, and each sends only what no earlier wave has found: a phrase that is frequent nearly everywhere is not
sent by every shard. The last wave mines the whole corpus, so the earlier ones decide the amount of rows and nothing
else, and cost a third more mining. Single words are counted outright. Pairs are mined among
frequent words, and three and more words where neighbours form frequent pairs: with very many shards a local share is below one
occurrence, and what has not been ruled out by shorter phrases is then all that there is to count.

Phrases travel as 64-bit keys (language and words), counted in the shard before any shuffle. What a pass has to count
goes to the tasks as a bit filter of at most ``FILTER_BYTES``, whatever the number of phrases; a key that passes it by
accident is counted like any other and goes when the support is applied, so the size of the filter decides the amount
of shuffled rows and nothing else. Words of a phrase are spelled out in the end, for frequent phrases only, by one shard.

Every phrase is scored at each cut into a first part and a rest, floor(1000 * a * n / (l * r)), in decimals of 38 digits;
its lowest score counts. A phrase goes if a longer one that contains it is as frequent (``absorbed`` per cent or more).

Defined results: a null text is empty and a null language is ``und``; repeated rows count as often as they stand there;
ties of score and count go to the phrase that is first in UTF-8 byte order; an empty table, or one without a phrase
that often, gives an empty table; other columns are not read. Two phrases are taken for one where their 64-bit keys are
the same: among m frequent phrases and d different ones at all, about m * d / 2^64 such cases are to be expected.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.llm.common import bounded_batches, whole_text
from ledgerlens.llm.word_hash import LOWER, mix, words
from ledgerlens.operators.small import settled

MAX_WORDS = 5
SUPPORT = 100
SHARD_BYTES = 24 << 20
WINDOW_BYTES = 1 << 20
FILTER_BYTES = 32 << 20
BLOCK_BITS = 1 << 15
PROBED = 1 << 18
SALTS = 64
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BREAK = re.compile(b"[" + re.escape(BREAKS) + b"]")
_SEPARATORS = re.compile(b"[ \t" + re.escape(BREAKS) + b"]+")
_WORD = re.compile(b"[^ \t]+")
# Classes of bytes: 0 stands between words, runs of 1 are words, runs of 2 end a piece.
CLASSES = np.ones(256, np.uint8)
CLASSES[[0x20, 0x09]] = 0
CLASSES[list(BREAKS)] = 2

Counted = tuple[np.ndarray, np.ndarray]


def language_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.sha256(lang.encode("utf-8")).digest()[:8], "little") | 1)


def word_places(raw: bytes, lang: str) -> tuple[np.ndarray, np.ndarray]:
    """A key for each word of a text of one language, and 0 where a piece ends; and the bytes where those begin."""
    seed, out, at = language_key(lang), [], 0
    begins = [np.zeros(0, np.int32)]
    while at < len(raw):
        found = _SEPARATORS.search(raw, at + WINDOW_BYTES)  # all of them: a run of breaks has one 0
        end = found.end() if found else len(raw)
        window = raw[at:end]
        hashes, starts = words(window, CLASSES)
        keys = mix(hashes + seed) | np.uint64(1)
        keys[CLASSES[np.frombuffer(window, np.uint8)[starts]] == 2] = 0
        out.append(keys)
        begins.append((starts + at).astype(np.int32))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate(begins)


def word_keys(raw: bytes, lang: str) -> np.ndarray:
    return word_places(raw, lang)[0]


def longer_keys(keys: np.ndarray, first: np.ndarray, places: np.ndarray, width: int) -> Counted:
    """Keys and places of the phrases that go on to ``width`` words, from those of one word less."""
    inside = places + width - 1 < len(keys)
    places, first = places[inside], first[inside]
    after = keys[places + width - 1]
    goes_on = after != 0
    return mix(first[goes_on] * _FACTOR + after[goes_on]), places[goes_on]


class Filter:
    """A blocked bit filter: the leading bits of a key name a block, the last ones three bits in it."""

    def __init__(self, bits: bytes) -> None:
        self.bits = np.frombuffer(bits, np.uint8)
        self.block_bits = (len(bits) * 8 // BLOCK_BITS).bit_length() - 1

    @staticmethod
    def probes(keys: np.ndarray) -> list[np.ndarray]:
        return [(keys >> np.uint64(15 * i)).astype(np.int64) & (BLOCK_BITS - 1) for i in range(3)]

    def holds(self, keys: np.ndarray) -> np.ndarray:
        parts = [self._holds(keys[at : at + PROBED]) for at in range(0, len(keys), PROBED)]
        return np.concatenate(parts) if parts else np.zeros(0, bool)

    def _holds(self, keys: np.ndarray) -> np.ndarray:
        block = (keys >> np.uint64(64 - self.block_bits)).astype(np.int64) if self.block_bits else np.int64(0)
        held = np.ones(len(keys), bool)
        for probe in self.probes(keys):
            at = block * BLOCK_BITS + probe
            held &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return held


def key_filter(keys: DataFrame, n: int, most: int = FILTER_BYTES) -> bytes:
    """The bits of a filter over ``n`` keys, set in tasks block by block; at most ``most`` bytes reach the driver."""
    block_bits = 0
    while (BLOCK_BITS << block_bits) < 16 * n and (BLOCK_BITS << (block_bits + 1)) // 8 <= most:
        block_bits += 1
    block = F.shiftrightunsigned("key", 64 - block_bits) if block_bits else F.lit(0).cast("long")

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, place = np.unique(np.asarray(batch.column(0)), return_inverse=True)
            bits = np.zeros((len(blocks), BLOCK_BITS // 8), np.uint8)
            for probe in Filter.probes(np.asarray(batch.column(1)).view(np.uint64)):
                np.bitwise_or.at(bits, (place, probe >> 3), (1 << (probe & 7)).astype(np.uint8))
            columns = [pa.array(blocks, pa.int64()), pa.array([b.tobytes() for b in bits], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "bits"])

    out = np.zeros((1 << block_bits, BLOCK_BITS // 8), np.uint8)
    dealt = keys.select(block.alias("block"), "key").repartition("block").sortWithinPartitions("block")
    for row in dealt.mapInArrow(filled, "block long, bits binary").collect():
        out[row["block"]] |= np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def joined(one: bytes, other: bytes) -> bytes:
    """A filter that holds whatever either filter holds, by accident too; as large as the larger one."""
    blocks = [np.frombuffer(bits, np.uint8).reshape(-1, BLOCK_BITS // 8) for bits in (one, other)]
    most = max(map(len, blocks))
    # A block of a smaller filter stands for all those of the larger one whose keys begin alike.
    one_bits, other_bits = [np.repeat(b, most // len(b), axis=0) for b in blocks]
    return (one_bits | other_bits).tobytes()


def mined(keys: np.ndarray, low: int, high: int, shorter: Filter, is_frequent: Callable) -> list[np.ndarray]:
    """Locally frequent phrases of ``low`` to ``high`` words; ``shorter`` holds the frequent ones of ``low - 1``.

    Each list is sorted. A phrase is tried only where both phrases of one word less in it are left.
    """
    places = np.flatnonzero(keys).astype(np.int32)
    level, out = keys[places], []
    for width in range(1, high + 1):
        if width > 1:
            alive = np.zeros(len(keys) + 1, bool)
            alive[places] = True
            both = alive[places + 1]
            level, places = longer_keys(keys, level[both], places[both], width)
        if width == low - 1:
            left = shorter.holds(level)
        elif width >= low:
            found, n = np.unique(level, return_counts=True)
            frequent = found[is_frequent(n)]
            out.append(frequent)
            at = np.minimum(np.searchsorted(frequent, level), max(0, len(frequent) - 1))
            left = frequent[at] == level if len(frequent) else np.zeros(len(level), bool)
        else:
            continue
        level, places = level[left], places[left]
    return out


def counted(keys: np.ndarray, low: int, high: int, wanted: Filter | None) -> list[Counted]:
    """Keys of ``low`` to ``high`` words that pass the filter, or all, with their occurrences."""
    places = np.flatnonzero(keys).astype(np.int32)
    level, out = keys[places], []
    for width in range(1, high + 1):
        if width > 1:
            level, places = longer_keys(keys, level, places, width)
        if width >= low:
            out.append(np.unique(level[wanted.holds(level)] if wanted else level, return_counts=True))
    return out


def spelled(raw: bytes, lang: str, wanted: Filter, tag: np.uint64) -> list[tuple[int, str]]:
    """Key and words of each phrase of two words or more whose key, xor the tag, passes the filter."""
    keys, begins = word_places(raw, lang)
    begins = np.append(begins, np.int32(len(raw)))
    places = np.flatnonzero(keys).astype(np.int32)
    level, out = keys[places], []
    for width in range(2, MAX_WORDS + 1):
        level, places = longer_keys(keys, level, places, width)
        held = wanted.holds(level ^ tag)
        found, first = np.unique(level[held], return_index=True)
        for key, at in zip(found.tolist(), places[held][first].tolist(), strict=True):
            phrase = raw[begins[at] : begins[at + width]].translate(LOWER.tobytes())
            out.append((key, b" ".join(_WORD.findall(phrase)).decode("utf-8")))
    return out


def shard_tag(raw: bytes) -> np.uint64:
    """A number that names a shard by its bytes."""
    return np.uint64(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little"))


def _parts(raw: bytes) -> Iterator[bytes]:
    """A text, or a very long one cut where pieces end."""
    at = 0
    while len(raw) - at > SHARD_BYTES // 4:
        found = _BREAK.search(raw, at + SHARD_BYTES // 4)
        if not found:
            break
        yield raw[at : found.end()]
        at = found.end()
    yield raw[at:]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(language, bytes of the language in all shards, texts of one shard and language).

    What follows a shard is held until it is half a shard, or goes with it: nearly all phrases of a small rest would be
    locally frequent.
    """
    held: dict[str, list[bytes]] = {}
    rest: dict[str, list[bytes]] = {}
    totals: dict[str, int] = {}
    size = 0

    def out(shard: dict[str, list[bytes]]) -> Iterator[tuple[str, int, bytes]]:
        while shard:
            lang, parts = shard.popitem()
            raw = b"\n".join(parts)
            del parts
            yield lang, totals[lang], raw

    for batch in batches:
        for lang, total, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            totals[lang] = total
            for part in _parts(raw):
                (held if size < SHARD_BYTES else rest).setdefault(lang, []).append(part)
                size += len(part)
                if size >= SHARD_BYTES * 3 // 2:
                    yield from out(held)
                    held, rest = rest, {}
                    size = sum(len(p) for parts in held.values() for p in parts)
    for lang, parts in rest.items():
        held.setdefault(lang, []).extend(parts)
    del rest
    yield from out(held)


def _steps(tasks: int) -> list[int]:
    """Every how many tasks one mines, wave by wave: one to three tasks, then four times as many, then all."""
    steps = [1]
    while 4 * steps[-1] <= tasks:
        steps.append(4 * steps[-1])
    return steps[::-1]


def _run(docs: DataFrame, schema: str, work: Callable[[str, int, bytes], Iterator[pa.RecordBatch]]) -> DataFrame:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, total, raw in _shards(batches):
            yield from work(lang, total, raw)

    return docs.mapInArrow(over, schema)


def _sliced(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Batches of at most a quarter of a million rows; keys become signed."""
    whole = pa.RecordBatch.from_pydict({n: c.view(np.int64) for n, c in columns.items()})
    for at in range(0, whole.num_rows, 1 << 18):
        yield whole.slice(at, 1 << 18)


def frequent_phrases(docs: DataFrame, support: int, max_words: int) -> tuple[list[DataFrame], Callable[..., DataFrame]]:
    """Written tables (key, f, tag) of the frequent words, pairs, and longer phrases; and a function that spells them.

    The table of words also holds the number of all words of a language, below the key of the language. The tag names
    one shard that holds the phrase: that shard alone spells it. Should shards be cut in another way when they are read
    again, what no shard has spelled is spelled by all that hold it.
    """
    spark = docs.sparkSession

    def share(raw: bytes, total: int) -> Callable[[np.ndarray], np.ndarray]:
        least = -(-support * len(raw) // max(1, total))
        return lambda n: n >= least

    tables: list[DataFrame] = []
    shorter = None
    task = F.spark_partition_id()
    tasks = (docs.select(task.alias("task")).agg(F.max("task")).first()[0] or 0) + 1
    groups = [(1, 1), (2, 2), (3, max_words)][: min(3, max_words)]
    for low, high in groups:
        wanted = None
        if low > 1:
            held = spark.sparkContext.broadcast(shorter)
            candidates = bytes(BLOCK_BITS // 8)
            for step in _steps(tasks):
                known = spark.sparkContext.broadcast(candidates)

                def local(lang, total, raw, low=low, high=high, held=held, known=known):
                    found = np.concatenate(mined(word_keys(raw, lang), low, high, Filter(held.value), share(raw, total)))
                    yield from _sliced({"key": found[~Filter(known.value).holds(found)]})

                wave = docs if step == 1 else docs.where(task % step == 0)
                new = settled(_run(wave, "key long", local).distinct())
                # Room for later waves: filters of one size are as sparse joined as one filter of all keys.
                room = max(new.count() * (1 if step == 1 else 4), len(candidates) // 2)
                candidates = joined(candidates, key_filter(new, room))
            wanted = spark.sparkContext.broadcast(candidates)

        def exact(lang, total, raw, low=low, high=high, wanted=wanted):
            keys = word_keys(raw, lang)
            found = counted(keys, low, high, Filter(wanted.value) if wanted else None)
            if low == 1:
                found.append((np.array([language_key(lang)]), np.array([np.count_nonzero(keys)])))
            columns = {c: np.concatenate([f[i] for f in found]) for i, c in enumerate(("key", "n"))}
            yield from _sliced({**columns, "tag": np.full(len(columns["key"]), shard_tag(raw))})

        sums = _run(docs, "key long, n long, tag long", exact).groupBy("key").agg(
            F.sum("n").alias("f"), F.min("tag").alias("tag")
        )
        tables.append(settled(sums.where(F.col("f") >= support)))
        if high < max_words:
            shorter = key_filter(tables[-1].select("key"), tables[-1].count())

    def spell(keys: DataFrame, tagged: bool = True) -> DataFrame:
        wanted = spark.sparkContext.broadcast(key_filter(keys, keys.count()))

        def work(lang, total, raw):
            tag = shard_tag(raw) if tagged else np.uint64(0)
            found = spelled(raw, lang, Filter(wanted.value), tag)
            key = np.array([k for k, _ in found], np.uint64).view(np.int64)
            columns = [pa.array(key), pa.array([lang] * len(found), pa.string()), pa.array([p for _, p in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "lang", "phrase"])

        found = _run(docs, "key long, lang string, phrase string", work)
        return found.groupBy("key").agg(F.min("lang").alias("lang"), F.min("phrase").alias("phrase"))

    def phrases(frequent: DataFrame) -> DataFrame:
        """``frequent`` (key, f, tag) with lang and phrase."""
        named = settled(spell(frequent.select(F.col("key").bitwiseXOR(F.col("tag")).alias("key"))).join(frequent, "key"))
        lost = settled(frequent.join(named, "key", "left_anti"))
        if lost.isEmpty():
            return named
        return named.unionByName(spell(lost.select("key"), tagged=False).join(lost, "key"))

    return tables, phrases


def phrase_keys(phrases: DataFrame) -> DataFrame:
    """Adds n_words, lang_key and, for each cut after k words, ``cuts`` (k, first, rest) with the keys of both parts."""
    names = [*phrases.columns, "n_words", "lang_key", "cuts"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in phrases.schema)
    cut = pa.list_(pa.struct([("k", pa.int32()), ("first", pa.int64()), ("rest", pa.int64())]))

    def chain(keys: np.ndarray) -> np.ndarray:
        out = keys[:1]
        for key in keys[1:]:
            out = mix(out * _FACTOR + key)
        return out.view(np.int64)[0]

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, langs, lists = [], [], []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                keys = word_keys(phrase.encode("utf-8"), lang)
                sizes.append(len(keys))
                langs.append(np.int64(language_key(lang).view(np.int64)))
                lists.append(
                    [{"k": k, "first": chain(keys[:k]), "rest": chain(keys[k:])} for k in range(1, len(keys))]
                )
            columns = [*batch.columns, pa.array(sizes, pa.int32()), pa.array(langs, pa.int64()), pa.array(lists, cut)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return phrases.mapInArrow(cuts, f"{fields}, n_words int, lang_key long, cuts array<struct<k: int, first: bigint, rest: bigint>>")


def collocations(
    docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS, absorbed: int = 100, top: int = 2000
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases of 2 to ``max_words`` words with ``support`` occurrences."""
    bounded_batches(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    slim = docs.select(lang.alias("lang"), whole_text().cast("binary").alias("raw"))
    size = F.octet_length("raw").cast("long")  # and a line end after each text, or part of a very long one
    totals = settled(slim.groupBy("lang").agg(F.sum(size + 1 + F.floor(size / WINDOW_BYTES)).alias("total")))
    tables, phrases_of = frequent_phrases(slim.join(totals, "lang").select("lang", "total", "raw"), support, max_words)
    frequent = tables[0]
    for more in tables[1:]:
        frequent = frequent.unionByName(more)
    long = tables[1].unionByName(tables[2]) if len(tables) > 2 else tables[1]
    phrases = settled(phrase_keys(phrases_of(long).select("key", "lang", "phrase", F.col("f").alias("a"))))
    cut = phrases.select("key", "lang_key", "a", "n_words", F.inline("cuts"))

    def lookup(key: str, value: str) -> DataFrame:
        return frequent.select(F.col("key").alias(key), F.col("f").alias(value))

    def exact(name: str) -> F.Column:
        return F.col(name).cast("decimal(19,0)")

    scored = (
        cut.join(lookup("first", "l"), "first")
        .join(lookup("rest", "r"), "rest")
        .join(lookup("lang_key", "n"), "lang_key")
        .withColumn("over", F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n"))
        .withColumn("under", exact("l") * exact("r"))
        .withColumn("score", F.expr("`over` div `under`"))
    )
    lowest = scored.groupBy("key").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("cut"))
    ends = F.array(F.when(F.col("k") == F.col("n_words") - 1, F.col("first")), F.when(F.col("k") == 1, F.col("rest")))
    inner = cut.where("n_words > 2").select(F.explode(ends).alias("key"), "a").where("key is not null")
    longest = inner.groupBy("key").agg(F.max("a").alias("longer"))
    kept = (
        phrases.join(lowest, "key")
        .join(longest, "key", "left")
        .where(F.coalesce(F.col("longer") * 100 < F.col("a") * absorbed, F.lit(True)))
        .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.n").alias("n"), "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Each of the salted parts keeps its own first rows, so no task sorts a language.
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))
    first = salted.withColumn("place", part).where(F.col("place") <= top)
    whole = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = first.withColumn("rank", whole).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
