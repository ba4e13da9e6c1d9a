"""Decontamination, language, quality, URL filters and the pipeline."""

import math
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import decontaminate, importance, language_id, url_templates
from ledgerlens.llm.fm_index import FmIndex
from ledgerlens.llm.queries import QUERIES, SQL, URL_RULES
from tests.llm.helpers import documents, lower, same_rows, sentence, texts

ITEMS = [
    (1, sentence(30, 41)),
    (2, "one two three"),
    (3, None),
    (4, "... !!"),
    (None, sentence(15, 42)),
    (5, sentence(12, 43)),
    (5, sentence(12, 44)),
    (10, "É é ß"),
]


def _leaky():
    own = [(300 + k, f"{sentence(30, 90 + k)} {ITEMS[k][1]} {sentence(30, 95 + k)}") for k in (0, 4, 5, 6)]
    half = " ".join(ITEMS[0][1].split()[5:17])
    return texts() + own + [(310, f"x {half}. {half.upper()} y"), (311, " ".join(ITEMS[0][1].split()[:9]))]


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def _brute_leaks(rows, items):
    out = []
    for i, t in rows:
        words, hit, names = _words(t), set(), set()
        for name, text in items:
            own = _words(text)
            n = min(10, len(own))
            for w in {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else ():
                for at in range(len(words) - n + 1):
                    if tuple(words[at : at + n]) == w:
                        hit.update(range(at, at + n))
                        names |= {str(name)} if name is not None else set()
        out.append((i, len(words), len(hit), ",".join(sorted(names))))
    return out


@pytest.mark.parametrize("options", [{}, {"block_bytes": 200}, {"shard_words": 50}])
def test_leaks(spark, options):
    rows = _leaky()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_leaks(documents(spark, rows), items, ("w_", "s_", "i_"), **options)
    got = found.select("doc_id", "w_", decontaminate.span_words("s_"), F.array_join("i_", ",")).collect()
    assert same_rows(got, _brute_leaks(rows, ITEMS))


def test_blocks_of_a_benchmark_stay_bounded(spark, monkeypatch):
    sizes, passes, phrases_of, settled = [], [], decontaminate.phrases_of, decontaminate.settled
    monkeypatch.setattr(decontaminate, "phrases_of", lambda own, window: sizes.append(len(own)) or phrases_of(own, window))
    monkeypatch.setattr(decontaminate, "settled", lambda df: passes.append(len(sizes)) or settled(df))
    items = [(k, sentence(20, 600 + k)) for k in range(9)]
    hot = spark.createDataFrame([*items, *[items[0]] * 500], "item_id long, text string")
    rows = [(k, f"x {text} y") for k, (_, text) in enumerate(items)] + [(99, "clean")]
    found = decontaminate.find_leaks(documents(spark, rows), hot, ("w_", "s_", "i_"), block_bytes=150).collect()
    assert same_rows([(r.doc_id, r.i_) for r in found], [*[(k, [str(k)]) for k in range(9)], (99, [])])
    assert sum(sizes) == 9 and passes == list(range(4, len(sizes), 4)) and passes


def test_leaks_go_and_clean_rows_stay(spark):
    rows = _leaky()
    docs = documents(spark, rows)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = decontaminate.drop_leaks(docs, items)
    assert clean.columns == docs.columns
    wanted = [(i, t) for (i, t), (_, _, hit, _) in zip(rows, _brute_leaks(rows, ITEMS), strict=True) if not hit]
    assert same_rows(clean.select("doc_id", "text").collect(), wanted)
    cut = decontaminate.cut_leaks(docs, items)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert next(r.text for r in cut.collect() if r.doc_id == 310) == "x  y"  # the two passages touch
    assert decontaminate.drop_leaks(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.drop_leaks(documents(spark, []), items).count() == 0


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(5)
    text = rng.integers(0, 4, 500)
    index = FmIndex(text, 5)
    for length in (1, 2, 5):
        phrases = np.array([[int(x) for x in rng.integers(0, 5, length)] for _ in range(60)])
        which, low, high = index.search(phrases)
        found = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high, strict=True)}
        for k, phrase in enumerate(phrases.tolist()):
            places = [i for i in range(len(text) - length + 1) if text[i : i + length].tolist() == phrase]
            assert found.get(k, []) == places


def _tongue(lang, n, seed):
    letters = {"aa": "abcdeé", "bb": "vwxyzü", "cc": "klmno漢"}[lang]
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_language_accuracy_on_held_out_rows(spark):
    rows = [(i, _tongue(("aa", "bb", "cc")[i % 3], 5 + i % 200, i), ("aa", "bb", "cc")[i % 3]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.predict(docs.withColumn("held", language_id.held_out()), net).collect()
    assert [r.held for r in found] == [zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found]
    held = [r for r in found if r.held]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    again = language_id.fit(docs.where(~language_id.held_out()))
    assert all((p == q).all() for p, q in zip(net.parameters(), again.parameters(), strict=True))


def test_a_language_of_few_texts_with_many_copies_is_learnt(spark):
    rows = [(_tongue("aa", 40, i), "aa") for i in range(60)] + [(_tongue("bb", 40, i % 3), "bb") for i in range(1500)]
    assert language_id.fit(spark.createDataFrame(rows, "text string, lang string"), fit_rows=20, epochs=1).languages == ["aa", "bb"]


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    windows = rng.integers(97, 120, (6, 40)).astype(np.uint8)
    net = language_id.train(windows, list("ababab"), epochs=1)
    wanted = np.array([0, 1, 0, 1, 0, 1])
    for p in net.parameters():
        p[...] = p.astype(np.float64)
    grads = net.step(windows, wanted)

    def loss():
        return -np.log(net.probabilities(windows)[np.arange(6), wanted].astype(np.float64)).mean()

    for p, g in zip(net.parameters(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 1e-2
        up = loss()
        p[at] = old - 1e-2
        down = loss()
        p[at] = old
        assert math.isclose((up - down) / 2e-2, g[at], rel_tol=0.1, abs_tol=2e-3)


def test_language_of_awkward_rows(spark):
    docs = documents(spark)
    net = language_id.fit(docs.select("text", "lang"))
    found = language_id.predict(docs, net, ("lp_", "sc_")).collect()
    assert all((r.lp_ == "und") == (re.search(r"[^\W\d_]", r.text or "") is None) for r in found)
    assert language_id.fit(docs.where("false")) is None
    assert {r.lp_ for r in language_id.predict(docs, None, ("lp_", "sc_")).collect()} == {"und"}
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(i or 0 for i, t in texts() if re.search(r"[^\W\d_]", t or ""))


def test_texts_whose_language_cannot_be_told_are_dropped(spark):
    letters = {"aa": "abcdef", "bb": "uvwxyz", "cc": "klmnop"}

    def window(lang, seed):
        rng = random.Random(seed)
        return "".join(rng.choice(letters[lang] + " ") for _ in range(language_id.WINDOW))

    rows = [(i, window(lang, i), lang) for i in range(450) for lang in [("aa", "bb", "cc")[i % 3]]]
    mixed = [(1000 + i, "".join(window(lang, 900 + i) for lang in letters), ("aa", None)[i % 2]) for i in range(10)]
    docs = spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string")
    kept = corpus_pipeline.keep_languages(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == list(range(450))
    assert language_id.keep_identified(docs, min_score=0.0).count() == 460


def test_resampling_prefers_target_text(spark):
    rng = random.Random(8)
    rows = [(i, sentence(60, i) if i % 2 else "".join(rng.choice("#$%& q") for _ in range(300))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(200)], "doc_id long, quality int")
    found = importance.resample(documents(spark, rows), labels, F.col("quality") == 1).collect()
    kept = [r.doc_id for r in found if r.kept]
    assert len(kept) == 200 and sum(i % 2 for i in kept) >= 190
    messy = importance.resample(documents(spark), labels, F.col("quality") == 1, share=1.0).collect()
    assert len(messy) == len(texts())
    assert all(r.kept == (r.n_grams > 0) for r in messy)
    assert importance.resample(documents(spark, []), labels, F.col("quality") == 1).count() == 0
    assert importance.resample(documents(spark), labels.limit(0), F.col("quality") == 1).where("kept").count() > 0


def test_log_weights_equal_plain_sums(spark):
    docs = documents(spark)
    ids = spark.createDataFrame([(1,), (16,)], "doc_id long")
    counts = np.zeros((2, importance.BUCKETS))
    for i, t in texts():
        own = importance.buckets_of((t or "").encode())
        np.add.at(counts[0], own, 1)
        if i in (1, 16):
            np.add.at(counts[1], own, 1)
    shares = (counts + 1) / (counts.sum(axis=1, keepdims=True) + importance.BUCKETS)
    ratios = np.log(shares[1]) - np.log(shares[0])
    assert np.allclose(importance.fit(docs, ids), ratios)


def test_kept_rows_equal_a_plain_sort_of_summed_ratios(spark):
    rows = [(i, sentence(5 + i % 60, 50 + i % 90)) for i in range(150)] + [(150, None), (151, ""), (152, "...")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int")
    docs = documents(spark, rows)
    ratios = importance.fit(docs, labels.where("quality = 1").select("doc_id"))
    uniform = "(pmod(xxhash64(29, doc_id), 4503599627370496) + 0.5d) / 4503599627370496d"
    noise = {r.doc_id: r.g for r in docs.selectExpr("doc_id", f"-ln(-ln({uniform})) as g").collect()}
    keys = {}
    for i, t in rows:
        own = importance.buckets_of((t or "").encode())
        if len(own):
            keys[i] = float(sum(ratios[b] for b in own)) + noise[i]
    found = importance.resample(docs, labels, F.col("quality") == 1, share=0.4).collect()
    assert all(abs(r.gumbel_key - keys[r.doc_id]) < 1e-4 if r.doc_id in keys else r.gumbel_key is None for r in found)
    best = sorted(keys, key=lambda i: -keys[i])[: round(0.4 * len(keys))]
    assert sorted(r.doc_id for r in found if r.kept) == sorted(best)
    halved = importance.weigh(docs, ratios, length_exponent=0.5).where("doc_id = 7").first()
    assert abs(halved.log_weight * halved.n_grams**0.5 - (keys[7] - noise[7])) < 1e-9


def test_more_than_200_languages_are_learnt(spark):
    rows = [(f"l{k}", f"{sentence(6, 900 + k)} {j}") for k in range(230) for j in range(2)]
    net = language_id.fit(spark.createDataFrame(rows, "lang string, text string"), epochs=1)
    assert sorted(net.languages) == sorted(f"l{k}" for k in range(230))


@pytest.mark.parametrize("k", [1, 2, 7, 100, 5000])
def test_kth_largest(spark, k):
    values = [((i * 7919) % 1009) * 10**6 - 5 * 10**8 for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert importance.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


URLS = [
    (1, "http://a.Example.NET/en/1"), (2, "https://example.net/EN/1"), (3, "http://example.com/de/x?y"),
    (4, "http://notexample.com/de/"), (5, "http://x.org/fr/1#q"), (6, "http://x.org"), (7, "nothing"), (8, None),
    (9, "://"), (10, "http://net/"), (11, "http://h.example.com?://x/de/"), (None, "http://a.b.c/d/e/f/g"), (12, ""),
    (13, "http://example.net:80/en/"), (13, "http://example.net:80/en/"),
]


def test_urls_against_sql(spark, tmp_path):
    pages = [*URLS, *[(100 + i, f"http://h{i % 3}.com/{'abc'[i % 3]}/{i}/x{i % 2}") for i in range(300)]]
    labels = [(100 + i, 1, int(i % 3 == 1)) for i in range(300)]
    labels += [(1, None, None), (100, 0, 0), (100, 0, 0)]
    for name, rows, schema in (
        ("pages", pages, "page_id long, url string"),
        ("labels", labels, "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    duck = duckdb.connect()
    for name in ("pages", "labels"):
        duck.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    found = QUERIES["op9_url_filters"](spark, str(tmp_path))
    expected = duck.sql(SQL["op9_url_filters"]).df()
    assert same_rows(
        [tuple(r) for r in found.collect()],
        [tuple(None if pd.isna(v) else v for v in r) for r in expected[found.columns].astype(object).itertuples(index=False)],
    )
    verdicts = {r.page_id: (r.rule, r.verdict) for r in found.collect()}
    assert verdicts[1] == ("example.net/en/", "allow") and verdicts[2] == ("net/", "block")
    assert verdicts[3] == ("example.com/de/", "block") and verdicts[4][0] is None and verdicts[6][0] is None
    assert any(v == (None, "block") for i, v in verdicts.items() if i and i >= 100)


def test_a_bad_section_is_blocked_however_many_siblings_it_has(spark):
    urls = [f"http://big.com/{name}/x" for name in ["spam", *[f"clean{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)]] for _ in range(50)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int("/spam/" in u)) for i, u in enumerate(urls)], "page_id long, bad int")
    for r in url_templates.filter_urls(pages, labels, []).collect():
        assert (r.verdict == "block") == ("/spam/" in r.path)
        assert r.template.startswith("/spam/") == ("/spam/" in r.path)


def test_deep_sections_are_told_apart(spark):
    urls = [f"http://deep.com/en/shop/{name}/x/{k}" for name in ("spam", "news") for k in range(50)]
    urls += [f"http://deep.com/en/shop/mix/a/b/{name}/{k}/z/" for name in ("bad", "good") for k in range(50)]
    urls += [f"http://deep.com/en/shop/mix/a{end}" for end in ("", "/") for _ in range(20)] + ["http://deep.com/en/shop/new/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = [(i, int("spam" in u or "bad" in u)) for i, u in enumerate(urls[:-1])]
    labels = spark.createDataFrame(labels, "page_id long, bad int")
    found = url_templates.filter_urls(pages, labels, []).collect()
    assert len(found) == len(urls)
    assert all((r.verdict == "block") == ("spam" in r.path or "bad" in r.path) for r in found)
    names = {r.path: r.template for r in found}
    assert names["/en/shop/spam/x/1"] == "/*/*/spam" and names["/en/shop/news/x/1"] == "/*/*/news"
    assert names["/en/shop/mix/a/b/bad/1/z/"].endswith("/bad") and names["/en/shop/mix/a/b/good/1/z/"].endswith("/good")
    assert names["/en/shop/mix/a"] == names["/en/shop/mix/a/"]


def test_urls_without_labels_or_pages(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, bad int")
    found = url_templates.filter_urls(pages, labels, URL_RULES).collect()
    assert len(found) == len(URLS) and all(r.rule or r.verdict == "allow" for r in found)
    assert url_templates.filter_urls(pages.limit(0), labels, []).count() == 0


def test_queries_against_sql_on_the_small_tables(spark, data):
    duck = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels"):
        duck.sql(f"create view {name} as select * from '{data}/{name}.parquet'")
    for name, sql in SQL.items():
        found = QUERIES[name](spark, data)
        expected = duck.sql(sql).df()[found.columns].astype(object)
        assert same_rows([tuple(r) for r in found.collect()], list(expected.itertuples(index=False, name=None))), name


def test_pipeline(spark, tmp_path):
    rows = _leaky()
    documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(ITEMS, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = [(i, t) for i, t in rows if re.search(r"[^\W\d_]", t or "")]
    best = {}
    for i, t in left:
        if lower(t) not in best or (i or -1) > (best[lower(t)] or -1):
            best[lower(t)] = i
    left = sorted({(i, t) for i, t in left if best[lower(t)] == i}, key=lambda r: (r[0] is None, r[0] or 0))
    kept, sets = [], []
    for i, t in left:  # no chains among these rows: the first of a group stays
        words = lower(t).split()
        n = min(5, len(words))
        own = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
        if not any(100 * len(own & s) >= 75 * len(own | s) for s in sets):
            kept.append((i, t))
            sets.append(own)
    clean = [i for (i, _, hit, _) in _brute_leaks(kept, ITEMS) if not hit]
    assert sorted(r.doc_id or 0 for r in found) == sorted(i or 0 for i in clean)
    assert all(r.round_trip for r in found)
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language_id"
