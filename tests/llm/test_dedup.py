"""Exact, near, substring and chunk deduplication against brute force."""

import hashlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import chunk_dedup, exact_dedup, near_dups, substring_dedup
from ledgerlens.llm.components import component_labels
from ledgerlens.llm.spans import merged, remaining
from ledgerlens.llm.suffix_array import common_prefixes, suffix_array
from tests.llm.helpers import documents, lower, same_rows, sentence, texts


def _exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t or "")].append(i)
    out = []
    for i, t in rows:
        own = groups[lower(t or "")]
        keep = max((x for x in own if x is not None), default=None)
        digest = hashlib.sha256(lower(t or "").encode()).hexdigest()
        out.append((i, digest, keep, len(own), i == keep))
    return out


@pytest.mark.parametrize("options", [{}, {"bucket_keys": 2}, {"bucket_keys": 2, "key_bits": 2}])
def test_exact_groups(spark, options):
    found = exact_dedup.exact_duplicates(documents(spark), **options)
    rows = found.select("doc_id", "text_sha256", "keep_id", "group_size", "kept").collect()
    assert same_rows(rows, _exact(texts()))


@pytest.mark.parametrize("options", [{"raw_bits": 3}, {"raw_bits": 1, "key_bits": 2, "bucket_keys": 2}])
def test_texts_that_collide_in_the_raw_hash_stay_single_rows(spark, options):
    rows = [(i, f"text {i % 40}" if i % 3 else f"TEXT {i % 40}") for i in range(200)]
    found = exact_dedup.exact_duplicates(documents(spark, rows), **options)
    out = found.select("doc_id", "text_sha256", "keep_id", "group_size", "kept").collect()
    assert same_rows(out, _exact(rows))
    kept = exact_dedup.keep_rows(documents(spark, rows), **options).collect()
    assert sorted(lower(r.text) for r in kept) == sorted({lower(t) for _, t in rows})


def test_directory_doubles_until_no_bucket_is_overfull(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) as key").unionByName(spark.range(500).selectExpr("id as key"))
    keys = keys.distinct().cache()
    buckets, depths = exact_dedup.directory(keys, 64, 64)
    assert len(depths) > 40  # the small numbers share their leading bits
    tried = keys.crossJoin(buckets)
    prefix = F.when(F.col("local_depth") == 0, 0).otherwise(F.expr("shiftrightunsigned(key, 64 - local_depth)"))
    placed = tried.where(F.col("prefix") == prefix).groupBy("bucket", "local_depth").count().collect()
    assert max(r["count"] for r in placed) <= 64
    assert sum(r["count"] for r in placed) == keys.count()


def test_keep_rows_keeps_one_of_each_text_and_all_columns(spark):
    docs = documents(spark)
    kept = exact_dedup.keep_rows(docs)
    assert kept.columns == docs.columns
    assert sorted(lower(r.text or "") for r in kept.collect()) == sorted({lower(t or "") for _, t in texts()})


@pytest.mark.parametrize(
    "operator",
    [
        exact_dedup.exact_duplicates,
        exact_dedup.keep_rows,
        near_dups.near_duplicates,
        near_dups.keep_rows,
        substring_dedup.dedup_substrings,
        chunk_dedup.dedup_chunks,
    ],
)
def test_empty_tables(spark, operator):
    assert operator(documents(spark, [])).count() == 0


def _sets(rows):
    out = []
    for _, t in rows:
        words = lower(t or "").split()
        n = min(5, len(words))
        out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    return out


def _components(rows, sets):
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    return [root(i) for i in range(len(rows))]


def _near(rows):
    sets = _sets(rows)
    roots = _components(rows, sets)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if roots[k] == roots[i] and rows[k][0] is not None]
        component = min(ids, default=doc_id)
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


def _family(n, edits, seed):
    rng = np.random.default_rng(seed)
    base = sentence(100, seed).split(" ")
    out = []
    for k in range(n):
        own = list(base)
        for at in rng.choice(100, edits, replace=False):
            own[at] = f"edit{k}x{at}"
        out.append(" ".join(own))
    return out


def test_near_components(spark):
    rows = texts()
    for k, family in enumerate([_family(40, 1, 11), _family(40, 2, 12), _family(40, 3, 13), _family(30, 5, 14)]):
        rows += [(1000 * (k + 1) + i, t) for i, t in enumerate(family)]
    assert same_rows(near_dups.near_duplicates(documents(spark, rows)).collect(), _near(rows))


def test_near_components_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 4)
    rows = [(i, t) for i, t in enumerate(_family(60, 3, 21) + _family(20, 2, 22))]
    assert same_rows(near_dups.near_duplicates(documents(spark, rows)).collect(), _near(rows))


def test_near_keep_rows(spark):
    docs = documents(spark)
    kept = near_dups.keep_rows(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {1, 5, 6, 7, 8, 11, 13, 14, 15, 16, 17, 18} <= set(ids)
    assert not {2, 3, 4, 9} & set(ids)


def test_signatures_within_the_guarantee_share_a_key():
    rng = np.random.default_rng(3)
    symbols = near_dups.SYMBOLS
    for _ in range(300):
        one = rng.integers(0, 1 << near_dups.SYMBOL_BITS, symbols).astype(np.uint16)
        two = one.copy()
        at = rng.choice(symbols, 2 * near_dups.CHUNKS - 1, replace=False)
        two[at] ^= 1
        keys = near_dups.index_keys(np.stack([one, two]))
        assert set(keys[0]) & set(keys[1])
    assert keys.min() >= 0


def test_leading_bytes_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for n in (1, 3, 40, 900, 5000):
        for share in (0.5, 0.8, 0.86, 0.95):
            one = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            two = np.unique(np.concatenate([one[: int(len(one) * share)], rng.integers(0, 2**63, n, dtype=np.uint64)[: int(n * (1 - share))]]))
            exact = 100 * len(np.intersect1d(one, two)) >= 75 * len(np.union1d(one, two))
            assert near_dups.reach(one, two, 75) == exact
            if exact:
                ends = [(x >> np.uint64(48)).astype(np.uint16) for x in (one, two)]
                assert near_dups.may_share(*ends, 75)


def test_first_shared_key():
    rng = np.random.default_rng(9)
    one = rng.integers(0, 3, near_dups.SYMBOLS).astype(np.uint16)
    others = rng.integers(0, 3, (50, near_dups.SYMBOLS)).astype(np.uint16)
    others[:, :5] = one[:5] ^ np.eye(5, dtype=np.uint16)[rng.integers(0, 5, 50)]
    others[::2, 20:25] = one[20:25]
    keys, own = near_dups.index_keys(others), near_dups.index_keys(one[None])[0]
    for row, slot in zip(keys, near_dups.first_shared(one, others).tolist(), strict=True):
        assert np.flatnonzero(row == own)[0] == slot


def test_component_labels_of_a_long_chain(spark):
    links = spark.range(60).selectExpr("id + 1 as a", "id as b").unionByName(spark.sql("select 100L as a, 101L as b"))
    labels = {r.node: r.label for r in component_labels(links).collect()}
    assert labels == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def _brute_substrings(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    starts = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (i, _), r in zip(rows, raws, strict=True):
        spans = merged([(k, k + length) for k in range(len(r) - length + 1) if starts[r[k : k + length]] > 1])
        left = remaining(r, spans)
        out.append((i, len(r), len(r) - len(left), len(spans), hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "shard_contexts"), [(400, 2048), (50, 2048), (50, 2)])
def test_substrings(spark, length, shard_contexts):
    common = sentence(80, 7)
    rows = texts() + [(100 + i, sentence(20, 30 + i) + common + sentence(20, 60 + i)) for i in range(12)]
    rows += [(200, "ab" * 400), (201, "x" * 1500), (202, sentence(100, 8) * 2)]
    found = substring_dedup.dedup_substrings(documents(spark, rows), length, shard_contexts=shard_contexts)
    assert same_rows(found.collect(), _brute_substrings(rows, length))


def test_substrings_on_both_sides_of_400_bytes_and_past_a_piece(spark):
    sizes = [300, 350, 390, 398, 399, 400, 401, 402, 450, 800]  # 51 words are 300 to 400 bytes
    rows = []
    for k, n in enumerate(sizes):
        passage = sentence(130, 2000 + k)[:n]
        rows += [(2 * k, f"{sentence(20, 2100 + k)}<{passage}>{sentence(20, 2200 + k)}")]
        rows += [(2 * k + 1, f"{sentence(20, 2300 + k)}({passage}){sentence(20, 2400 + k)}")]
    long = sentence(80_000, 2500)
    edge = substring_dedup.PIECE
    assert len(long) > edge + 3000
    rows += [(100, long), (101, long[edge - 2500 : edge + 2500]), (102, long[-400:]), (103, long[:399])]
    found = substring_dedup.dedup_substrings(documents(spark, rows)).collect()
    assert same_rows(found, _brute_substrings(rows, 400))
    removed = {r.doc_id: r.n_removed for r in found}
    assert [removed[2 * k + d] for k in range(len(sizes)) for d in (0, 1)] == [n if n >= 400 else 0 for n in sizes for _ in (0, 1)]
    assert [removed[i] for i in range(100, 104)] == [5400, 5000, 400, 0]


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for n, letters in ((1, 1), (200, 1), (700, 2), (2000, 4)):
        data = rng.integers(97, 97 + letters, n).astype(np.uint8)
        data = np.concatenate([data, data[: n // 3]])
        starts = np.arange(0, len(data), 97)
        order, place = suffix_array(data)
        raw = data.tobytes()
        assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))
        prefixes = common_prefixes(data, order, place, starts, 50)
        for k in range(1, len(order)):
            x, y = raw[order[k - 1] :], raw[order[k] :]
            same = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
            assert prefixes[k] == min(50, same)


def test_suffix_array_sorts_once_a_round(monkeypatch):
    sorts = []
    for name in ("argsort", "lexsort"):
        def counted(key, *args, known=getattr(np, name), **options):
            sorts.extend([len(key)] if isinstance(key, np.ndarray) else [len(k) for k in key])
            return known(key, *args, **options)

        monkeypatch.setattr(np, name, counted)
    data = np.frombuffer(b"".join(sentence(60, 3).encode() + bytes([i]) for i in range(9)), dtype=np.uint8)
    order, place = suffix_array(data)
    raw = data.tobytes()
    assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))
    assert (place[order] == np.arange(len(raw))).all()
    # From prefixes of 7 bytes to ones of the longest repeat in doubling steps, one key each, and fewer suffixes each time.
    assert len(sorts) <= 2 + np.ceil(np.log2(len(sentence(60, 3).encode()) / 7))
    assert sorts == sorted(sorts, reverse=True)


def _plain_ends(raw):
    """Chunk ends byte by byte."""
    def hash_after(i):
        return sum(int(chunk_dedup._GEAR[raw[i - k]]) << (k + 20) for k in range(min(12, i + 1))) & 0xFFFFFFFF

    inside = [i + 1 < len(raw) and raw[i + 1] & 0xC0 == 0x80 for i in range(len(raw))]
    hashes = [hash_after(i) for i in range(len(raw))]
    ends, begin = [], 0
    while begin < len(raw):
        cut = next((i for i in range(begin, len(raw)) if i + 1 == len(raw) or hashes[i] < 2**28 and not inside[i]))
        while cut + 1 - begin > 64:
            least = min((2**32 - 1 if inside[i] else hashes[i], -i) for i in range(begin, begin + 64))
            begin = 1 - least[1]
            ends.append(begin)
        ends.append(cut + 1)
        begin = cut + 1
    return ends


def _brute_chunks(rows):
    """Windows told apart by their bytes, all places of each in one set."""
    places, owns = defaultdict(set), []
    for i, t in rows:
        raw = (t or "").encode()
        ends = _plain_ends(raw)
        own = [(b, next((e for e in ends if e - b >= 96), None)) for b in [0, *ends[:-1]]]
        owns.append([(b, e, (i is None, i or 0, raw, b)) for b, e in own if e])
        for b, e, place in owns[-1]:
            places[raw[b:e]].add(place)
    out = []
    for (i, t), own in zip(rows, owns, strict=True):
        raw = (t or "").encode()
        repeated, gone = set(), set()
        for b, e, place in own:
            if len(places[raw[b:e]]) > 1:
                repeated |= set(range(b, e))
                if place != min(places[raw[b:e]]):
                    gone |= set(range(b, e))
        left = bytes(x for at, x in enumerate(raw) if at not in gone)
        runs = sum(at - 1 not in gone for at in gone)
        out.append((i, len(raw), len(gone), runs, hashlib.sha256(left).hexdigest(), len(repeated)))
    return out


def test_chunks(spark):
    common = sentence(80, 7)
    rows = [r for r in texts() if r[0] is not None]
    rows += [(100 + i, sentence(20, 30 + i) + common + sentence(20, 60 + i)) for i in range(12)]
    rows += [(None, "alone " + sentence(60, 77))]
    found = chunk_dedup.dedup_chunks(documents(spark, rows)).collect()
    assert same_rows(found, _brute_chunks(rows))
    removed = {r.doc_id: r.n_removed for r in found}
    assert all(removed[100 + i] > 300 for i in range(1, 12))


@pytest.mark.parametrize("held", [1, 500_000])
def test_chunks_of_copies_in_one_batch_and_in_many(spark, monkeypatch, held):
    common, other = sentence(60, 8), "漢字 " * 80
    rows = [(i, f"{sentence(12, i)} {common if i % 3 else other} {sentence(9, 99 + i)}") for i in range(40)]
    rows += [(i, common) for i in range(200, 230)] + [(300, common)] * 20 + [(None, other), (None, other), (400, "ab" * 400)]
    monkeypatch.setattr(chunk_dedup, "WINDOWS_HELD", held)
    frame = documents(spark, rows).repartition(6)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # windows cross batches of the sorted pass
    try:
        assert same_rows(chunk_dedup.dedup_chunks(frame).collect(), _brute_chunks(rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_gear_hash_remembers_32_bytes_and_chunks_resist_shifts():
    data = np.frombuffer(("héllo " + sentence(400, 9)).encode(), dtype=np.uint8)
    rolled, hashes = 0, chunk_dedup.gear_hashes(data)
    for value, byte in zip(hashes.tolist(), data.tolist(), strict=True):
        rolled = ((rolled << 1) + int(chunk_dedup._GEAR[byte])) & 0xFFFFFFFF
        assert value == rolled
    shifted = np.concatenate([np.frombuffer(b"inserted", dtype=np.uint8), data])
    ends, later = set(chunk_dedup.chunk_ends(data)), {e - 8 for e in chunk_dedup.chunk_ends(shifted)}
    assert {e for e in ends if e > 32} <= later


def _longest_shared_run(passage, left, right):
    """Bytes of the longest run of chunks within a passage that another text, which holds it too, also has."""
    own, other = ((f + passage + f[::-1]).encode() for f in (left, right))
    pieces = []
    for raw in (own, other):
        ends = chunk_dedup.chunk_ends(np.frombuffer(raw, dtype=np.uint8)).tolist()
        pieces.append(list(zip([0, *ends], ends, strict=False)))
    shared = {other[b:e] for b, e in pieces[1]}
    begin, end = len(left.encode()), len((left + passage).encode())
    best, run = 0, 0
    for b, e in pieces[0]:
        run = run + e - b if b >= begin and e <= end and own[b:e] in shared else 0
        best = max(best, run)
    return best


def test_passages_of_51_words_hold_a_long_run(spark):
    passages = [sentence(51, 1000 + k) for k in range(300)]
    passages += ["therble " * 51, "spam and eggs are here. " * 11, "漢字 " * 51]
    assert all(
        _longest_shared_run(p, sentence(30, 5000 + k)[k % 40 :], sentence(30, 9000 + k)[k % 37 :]) >= chunk_dedup.MIN_RUN
        for k, p in enumerate(passages)
    )
    rows = [(2 * k + d, f"{sentence(20, 300 + 2 * k + d)} {p} {sentence(20, 700 + 2 * k + d)}") for k, p in enumerate(passages[:100]) for d in (0, 1)]
    removed = {r.doc_id: r.n_removed for r in chunk_dedup.dedup_chunks(documents(spark, rows)).collect()}
    assert all(removed[2 * k + 1] >= 0.6 * len(passages[k].encode()) for k in range(100))
