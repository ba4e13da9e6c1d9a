"""Collocations, archives and hard negatives against plain versions."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from base64 import b32encode
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import collocations, hard_negatives, warc
from tests.llm.helpers import documents, lower

# ---- collocations


def plain_collocations(rows, support, max_words, top, absorbed=100):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            held = counts.setdefault(lang, Counter())
            for m in range(1, max_words + 1):
                for i in range(len(words) - m + 1):
                    held[tuple(words[i : i + m])] += 1
    out = []
    for lang, held in counts.items():
        found = []
        for phrase, a in held.items():
            if len(phrase) < 2 or a < support:
                continue
            cuts = [
                (1000 * a * total[lang] // (held[phrase[:k]] * held[phrase[k:]]), k, held[phrase[:k]], held[phrase[k:]])
                for k in range(1, len(phrase))
            ]
            inside = any(
                len(x) > len(phrase) and b >= support and 100 * b >= absorbed * a
                and any(x[i : i + len(phrase)] == phrase for i in range(len(x) - len(phrase) + 1))
                for x, b in held.items()
            )
            if not inside:
                score, _, left, right = min(cuts)
                found.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def phrase_rows(seed=1, n=120):
    rng = random.Random(seed)
    vocabulary = "New york city of the É ß 漢字 a b c".split()
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ".", ", ", "\n", "\t"]) for _ in range(rng.randint(0, 40))]
        rows.append((rng.choice(["en", "fr", None, "und", ""]), rng.choice([" ", "  "]).join(words)))
    return [*rows, ("en", None), ("en", ""), (None, "..."), ("en", "x " * 3000), ("fr", "a b c a b c " * 200), ("en", "\x00 \x00")]


@pytest.mark.parametrize("partitions", [2, 7])
def test_collocations_equal_a_plain_count(spark, partitions):
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, lang, text, "k", 1) for i, (lang, text) in enumerate(rows)], "n long, lang string, text string, key string, a int")
    found = collocations.collocations(docs.repartition(partitions), support=12, max_words=5, top=40)
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows, 12, 5, 40)


def test_collocations_with_lower_absorption_and_fewer_words(spark):
    rows = phrase_rows(5, 60)
    docs = spark.createDataFrame([(lang, text) for lang, text in rows], "lang string, text string")
    found = collocations.collocations(docs, support=8, max_words=3, absorbed=60, top=25)
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows, 8, 3, 25, absorbed=60)


def test_collocations_of_awkward_tables(spark):
    assert collocations.collocations(documents(spark, []), support=2).count() == 0
    found = collocations.collocations(documents(spark), support=3)
    rows = [("en", r["text"]) for r in documents(spark).collect()]
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows, 3, 5, 2000)


def test_scores_past_64_bits_are_exact(spark):
    big = spark.createDataFrame([(3 * 10**9, 10**14, 10**10, 7 * 10**9)], "a long, n long, l long, r long")
    parts = [F.col(c).cast("decimal(19,0)") for c in "anlr"]
    row = big.select((F.lit(1000).cast("decimal(4,0)") * parts[0] * parts[1]).alias("o"), (parts[2] * parts[3]).alias("u"))
    assert row.selectExpr("o div u").first()[0] == 1000 * 3 * 10**9 * 10**14 // (10**10 * 7 * 10**9)


def test_shards_are_cut_where_pieces_end():
    raw = b"a b. c d" * 3_000_000
    parts = list(collocations._parts(raw))
    assert len(parts) > 2 and b"".join(parts) == raw and all(p.endswith(b".") for p in parts[:-1])


@pytest.mark.parametrize("rows", [0, 3, 12, 16, 21, 27, 100])
def test_no_shard_is_a_small_rest(monkeypatch, rows):
    monkeypatch.setattr(collocations, "SHARD_BYTES", 1000)
    table = pa.table({"lang": ["en"] * rows, "total": [100 * rows] * rows, "raw": [b"%0100d" % i for i in range(rows)]})
    shards = [raw.split(b"\n") for _, _, raw in collocations._shards(iter(table.to_batches(max_chunksize=7)))]
    assert sorted(sum(shards, [])) == [b"%0100d" % i for i in range(rows)]
    assert all(min(5, rows) <= len(shard) <= 15 for shard in shards)


@pytest.mark.parametrize("pad", range(6))
def test_phrases_are_spelled_right_behind_runs_of_breaks(pad):
    raw = b"x" * pad + b" " + b"..\n, " * (collocations.WINDOW_BYTES // 3) + b"late words come. last ones"
    everything = collocations.Filter(b"\xff" * 4096)
    found = collocations.spelled(raw, "en", everything, np.uint64(0))
    assert sorted(p for _, p in found) == ["last ones", "late words", "late words come", "words come"]
    assert all(collocations.word_keys(p.encode(), "en").all() for _, p in found)


def test_collocations_of_long_texts_equal_a_plain_count(spark):
    rows = [("en", "early words, ... " * 90_000 + "late words come!?\n" * 30), (None, "... " * 300_000 + "a b c. " * 20)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = collocations.collocations(docs, support=20)
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows, 20, 5, 2000)


def test_a_filter_holds_all_its_keys(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 20_000, dtype=np.int64)
    held = collocations.Filter(collocations.key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), len(keys)))
    assert held.holds(keys.view(np.uint64)).all()
    assert held.holds(rng.integers(0, 2**63, 20_000, dtype=np.uint64)).mean() < 0.05
    small = collocations.Filter(collocations.key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), len(keys), 4096))
    assert small.holds(keys.view(np.uint64)).all()


@pytest.mark.parametrize("sizes", [(20_000, 300), (300, 20_000), (0, 5_000)])
def test_joined_filters_hold_what_either_holds(spark, sizes):
    rng = np.random.default_rng(5)
    bits = []
    for size in sizes:
        keys = spark.createDataFrame([(int(k),) for k in rng.integers(-(2**63), 2**63, size, dtype=np.int64)], "key long")
        bits.append(collocations.key_filter(keys, size))
    others = rng.integers(0, 2**64, 500_000, dtype=np.uint64)
    one, other = (collocations.Filter(b).holds(others) for b in bits)
    both = collocations.Filter(collocations.joined(*bits))
    assert (one | other).any() and both.holds(others)[one | other].all()
    assert both.holds(others).mean() < 0.05 and len(both.bits) == max(map(len, bits))


def test_waves_of_mining_end_with_all_tasks():
    assert [collocations._steps(n) for n in (1, 3, 4, 7, 32, 64)] == [[1], [1], [4, 1], [4, 1], [16, 4, 1], [64, 16, 4, 1]]


def test_a_phrase_frequent_everywhere_is_not_sent_by_every_shard(spark, monkeypatch):
    rows = [("en", f"common words stand here. own{i} part{i}") for i in range(72)]
    late = [("fr", "only in one place")] * 40  # in task 18, which the last wave alone mines
    parts = [spark.createDataFrame(r, "lang string, text string").repartition(n) for r, n in ((rows, 18), (late, 1))]
    sent, run = [], collocations._run

    def counting(docs, schema, work):
        made = run(docs, schema, work)
        if schema == "key long":
            sent.append(made.count())
        return made

    monkeypatch.setattr(collocations, "_run", counting)
    found = collocations.collocations(parts[0].unionByName(parts[1]), support=32)
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows + late, 32, 5, 2000)
    assert sum(sent) < 60  # 12 phrases; six of them stand in each of 18 shards


def test_a_filter_looks_keys_up_in_bounded_memory():
    keys = np.arange(1 << 22, dtype=np.uint64)
    everything = collocations.Filter(b"\xff" * 4096)
    tracemalloc.start()
    assert everything.holds(keys).all()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < len(keys) * 8


# ---- archives


def plain_pages(rows):
    firsts = {}
    for key, _, html in rows:
        if key is not None:
            firsts[html or ""] = min(key, firsts.get(html or "", key))
    out = []
    for key, _, html in rows:
        raw, first = (html or "").encode(), firsts.get(html or "")
        digest = b32encode(hashlib.sha1(raw).digest()).decode()
        refers = first if first is not None and key != first else None
        out.append((key, len(raw), digest, "response" if refers is None else "revisit", refers))
    return sorted(map(repr, out))


PAGES = [
    (1, "http://a/ü ?q=1", "<p>é 漢</p>"), (2, None, "<p>é 漢</p>"), (3, "x\r\nWARC-Type: metadata", None), (4, "http://b", ""),
    (5, "http://c", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "http://d", "only"), (7, "http://e", "z" * 3_000_000),
    (8, "http://e", "a\r\n\r\nb"), (8, "http://e", "a\r\n\r\nb"), (9, "http://e", "a\r\n\r\nb"), (-3, "http://f", "neg"), (None, "u", ""),
]


def written(spark, rows):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, key string, first int")
    folder = warc.archive_folder(spark)
    return warc.write_archives(pages, folder), folder


def read_back(records):
    def key(c):
        return F.when(F.col(c) != "urn:page:", F.expr(f"url_decode(replace({c}, 'urn:page:', ''))")).cast("long")

    rows = records.select(key("record_id"), "payload_length", "payload_digest", "record_type", key("refers_to")).collect()
    return sorted(map(repr, map(tuple, rows)))


def test_archives_come_back_whole(spark):
    files, folder = written(spark, PAGES)
    records, gaps = warc.read_archives(files, folder)
    assert read_back(records) == plain_pages(PAGES)
    assert gaps.count() == 0
    bodies = {r["record_id"]: r["payload"] for r in records.where("record_type = 'response'").collect()}
    assert bytes(bodies["urn:page:7"]) == b"z" * 3_000_000 and bytes(bodies["urn:page:1"]) == "<p>é 漢</p>".encode()


def test_small_payloads_can_be_stored_each_time(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    folder = warc.archive_folder(spark)
    records, _ = warc.read_archives(warc.write_archives(pages, folder, min_payload=3), folder)
    assert sorted(r["record_id"][-1] for r in records.where("record_type = 'revisit'").collect()) == ["4"]


def test_no_pages_no_records(spark):
    files, folder = written(spark, [])
    records, gaps = warc.read_archives(files, folder)
    assert files.count() == records.count() == gaps.count() == 0


def one(key, payload, packed=True):
    record = warc.record_bytes(str(key), f"http://h/{key}", payload, None, "d")
    return warc.member(record) if packed else record


def walked(data):
    return list(warc.Archive(pa.BufferReader(data), len(data)).walk())


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_after_every_kind_of_damage(packed):
    rng = random.Random(7)
    parts = [one(i, bytes(rng.randrange(256) for _ in range(rng.choice([0, 10, 3000]))), packed) for i in range(30)]
    data = b"".join(parts)
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    for seed in range(40):
        rng = random.Random(seed)
        victim = rng.randrange(len(parts) - 1)
        begin, end = starts[victim], starts[victim + 1]
        kind = seed % 4
        at = rng.randrange(begin, end)
        if kind == 0:  # a flipped byte
            broken = data[:at] + bytes([data[at] ^ 0x55]) + data[at + 1 :]
        elif kind == 1:  # bytes lost
            broken = data[:at] + data[min(end, at + 5) :]
        elif kind == 2:  # foreign bytes between records, with a false mark
            broken = data[:begin] + b"\x1f\x8b\x08 junk WARC/1.1 junk" + data[begin:]
        else:  # cut off inside the last record
            broken = data[: starts[-2] + 7]
        found = walked(broken)
        assert [(a, b) for a, b, _ in found] == list(zip([0, *[b for _, b, _ in found]][:-1], [b for _, b, _ in found]))
        assert found[-1][1] == len(broken)
        # A plain record's headers have no checksum: a flipped byte there may leave it whole, under another id.
        named = [re.fullmatch(r"urn:page:(\d+)", x["record_id"]) for _, _, x in found if isinstance(x, dict)]
        ids = {int(m[1]) for m in named if m}
        harmed = {2: set(), 3: {29}}.get(kind, {victim})
        assert ids >= set(range(30)) - harmed
        if kind >= 2:
            assert [x for _, _, x in found if isinstance(x, str)]


def test_reader_of_foreign_files(spark, tmp_path):
    """Plain records and members in one file, an empty file, a file without any record."""
    (tmp_path / "a.warc").write_bytes(one(1, b"x", False) + one(2, b"y") + b"junk" + one(3, b"z", False))
    (tmp_path / "b.warc").write_bytes(b"")
    (tmp_path / "c.warc").write_bytes(b"nothing here" * 10)
    files = spark.createDataFrame([("a.warc",), ("b.warc",), ("c.warc",)], "file string")
    records, gaps = warc.read_archives(files, str(tmp_path))
    assert sorted(r["record_id"][-1] for r in records.collect()) == ["1", "2", "3"]
    assert sorted((r["file"], r["end"] - r["begin"]) for r in gaps.collect()) == [("a.warc", 4), ("c.warc", 120)]


def test_checks_name_their_reason():
    record = one(1, b"payload", False)
    cases = {
        "wrong content length": record.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 1", 1),
        "wrong block digest": record.replace(b"payload\r\n", b"paYload\r\n"),
        "no content length": re.sub(rb"(msgtype=response\r\nContent-Length: )\d+", rb"\1many", record),
        "broken header line": record.replace(b"WARC-Date: d", b"WARC-Date d"),
    }
    for reason, data in cases.items():
        with pytest.raises((warc.Damaged, EOFError)) as caught:
            warc.parse_record(data)
        assert str(caught.value) in (reason, "wrong content length")
    assert zlib.decompress(warc.member(record), 31) == record


# ---- hard negatives


def plain_negatives(rows, every, positives=5, negatives=5, low=80, high=100):
    held = {}
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        held[key] = min(held[key], (label, whole)) if key in held else (label, whole)
    out = []
    for anchor, (label, mine) in held.items():
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(mine, v)), k, tag == label) for k, (tag, v) in held.items() if k != anchor)
        for p, positive, _ in [s for s in scored if s[2]][:positives]:
            fits = [(s, k) for s, k, same in scored if not same and low * -p <= 100 * -s <= high * -p]
            out += [(anchor, positive, r, k, -p, -s) for r, (s, k) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def vectors(n, seed, width=7):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(3, width))
    rows = [(i, (centres[rng.integers(3)] + rng.normal(size=width) * 0.4).tolist(), int(rng.integers(3))) for i in range(n)]
    rows += [(n + i, rows[3][1], rows[3][2]) for i in range(40)]  # one common vector
    odd = [(None, rows[0][1], 1), (n + 50, None, 1), (n + 60, [1.0, None], 1), (n + 70, [float("nan")] * width, 1)]
    odd += [(n + 80, [float("inf")] * width, 0), (n + 90, [], 2), (n + 100, [0.5, -0.25], 1), (n + 110, [0.0] * width, None)]
    return [*rows, *odd, (20, rows[5][1], 0), (20, rows[6][1], 2), (20, rows[6][1], 2)]


def negatives_of(spark, rows, every=10, partitions=3, **options):
    table = spark.createDataFrame([(*r, 1, "s") for r in rows], "vec_id long, embedding array<double>, label int, score int, ids string")
    usable = hard_negatives.usable(table.repartition(partitions))
    return sorted(map(tuple, hard_negatives.hard_negatives(usable, F.col("vec_id") % every == 0, **options).collect()))


def test_hard_negatives_equal_a_plain_search(spark):
    rows = vectors(260, 4)
    assert negatives_of(spark, rows) == plain_negatives(rows, 10)


def test_hard_negatives_with_other_numbers(spark):
    rows = vectors(120, 9, width=3)
    found = negatives_of(spark, rows, every=4, positives=2, negatives=3, low=50, high=95)
    assert found == plain_negatives(rows, 4, 2, 3, 50, 95)


def test_hard_negatives_of_few_rows(spark):
    assert negatives_of(spark, []) == []
    assert negatives_of(spark, [(0, [1.0], 1)]) == []
    assert negatives_of(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) == [(0, 1, 1, 2, 65536, 58880)]


@pytest.mark.parametrize("width", [1, 64, 300, 2000])
@pytest.mark.parametrize("size", [2, 1000, 200_000])
def test_remainders_give_exact_scores(width, size):
    rng = np.random.default_rng(width * 7 + size)
    rows, anchors = (rng.integers(-size, size + 1, (n, width)).astype(float) for n in (9, 4))
    want = rows.astype(object) @ anchors.astype(object).T
    assert (hard_negatives.exact_scores(rows, anchors).astype(object) == want).all()
    top = np.full((1, width), float(size))
    assert hard_negatives.exact_scores(top, -top)[0, 0] == -width * size * size


def test_scores_beyond_the_range_are_refused():
    with pytest.raises(OverflowError):
        hard_negatives.exact_scores(np.array([[2.0**40]]), np.array([[2.0**40]]))


def test_floored_is_the_floor(spark):
    values = [-1e-20, -0.3, -5.3, 0.0, 2.0, -2.0, 1e300, -2.0000000000000004, 0.99]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", hard_negatives.floored(F.col("x")).alias("y"))
    assert all(r["y"] == math.floor(r["x"]) for r in rows.collect())
