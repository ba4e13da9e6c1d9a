"""The queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import chunk_dedup, collocations, decontaminate, exact_dedup, hard_negatives, importance, language_id, near_dups, pieces, substring_dedup, token_counts, url_templates, warc
from ledgerlens.llm.common import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    "op1_exact_dedup",
    f"""
with n as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from n group by t)
select n.doc_id, g.keep_id, cast(g.group_size as bigint) as group_size, n.doc_id = g.keep_id as kept,
 sha256(n.t) as text_sha256
from n join g on n.t = g.t""",
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = token_counts.prefix_tables(table(spark, sf_dir, "documents"), path, with_steps=False)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), "fit_chars")


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


URL_RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]


def _url_sql() -> str:
    def level(k: int) -> str:
        parent = ", ".join(["host", *[f"t{i}" for i in range(1, k)]])
        return f"""
c{k} as (select {parent}, s{k}, sum(labelled) as nc, sum(bad) as bc from tree{k - 1} group by all),
w{k} as (select {parent}, count(*) as children, sum(nc) as np, sum(bc) as bp from c{k} group by all),
d{k} as (select {parent}, s{k}, children, nc::double as nc, np::double as np, bp::double as bp,
  bc::double * (np::double - nc::double) - (bp::double - bc::double) * nc::double as gap
  from c{k} join w{k} using ({parent})),
n{k} as (select {parent}, s{k},
  case when children <= {url_templates.MAX_CHILDREN}
    and gap * gap * np > {url_templates.Z_SQUARED}::double * nc * (np - nc) * bp * (np - bp) then s{k} else '*' end as t{k}
  from d{k}),
tree{k} as (select tree{k - 1}.*, n{k}.t{k} from tree{k - 1} join n{k} using ({parent}, s{k})),"""

    def segment(k: int) -> str:
        return f"coalesce(parts[{k + 1}], '')"

    third = f"case when len(parts) > 4 then '**' else {segment(3)} end"
    cut = ", ".join(
        f"case when regexp_matches({s}, '[0-9]') then '*' else {s} end as s{k}"
        for k, s in ((1, segment(1)), (2, segment(2)), (3, third))
    )
    fits = " ".join(
        f"when (host = '{r.partition('/')[0]}' or ends_with(host, '.{r.partition('/')[0]}'))"
        f" and starts_with(path, '/{r.partition('/')[2]}') then {{{i}}}"
        for i, (r, _) in sorted(enumerate(URL_RULES), key=lambda x: -len(x[1][0]))
    )
    rule = fits.format(*[f"'{r}'" for r, _ in URL_RULES])
    verdict = fits.format(*[f"'{v}'" for _, v in URL_RULES])
    weight = f"{url_templates.PRIOR_WEIGHT}::double"
    return f"""
with u0 as (select page_id, case when instr(coalesce(url, ''), '://') > 0
  then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
u1 as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as h from u0),
u2 as (select page_id, translate(h, '{UPPER}', '{LOWER}') as host,
  regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') as path from u1),
u3 as (select *, string_split(path, '/') as parts from u2),
u as (select page_id, host, path, {cut} from u3),
known as (select doc_id as page_id, max(case when toxic = 1 or quality = 0 then 1 else 0 end) as bad
  from labels group by doc_id),
tree0 as (select host, s1, s2, s3, count(bad) as labelled, coalesce(sum(bad), 0) as bad
  from u left join known using (page_id) group by all),
prior as (select sum(bad)::double / sum(labelled) as p from tree0),{level(1)}{level(2)}{level(3)}
shares as (select host, t1, t2, t3, (sum(bad)::double + {weight} * p) / (sum(labelled)::double + {weight}) as purity
  from tree3, prior group by host, t1, t2, t3, p)
select page_id, host, path, case {rule} end as rule,
  coalesce(case {verdict} end, case when purity > {url_templates.BLOCK_SHARE}::double then 'block' else 'allow' end)
    as verdict,
  concat_ws('/', '', t1, t2, t3) as template, round(purity, 9) as purity
from u join tree3 using (host, s1, s2, s3) join shares using (host, t1, t2, t3)"""


@query("op9_url_filters", _url_sql())
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.coalesce(bad, F.lit(0)).alias("bad"))
    return url_templates.filter_urls(table(spark, sf_dir, "pages"), labels, URL_RULES)


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = language_id.fit(docs.where(~language_id.held_out()).select("text", "lang"))
    texts = docs.select("doc_id", "text", language_id.held_out().alias("held_out"))
    return language_id.predict(texts, net).drop("text")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '{u}', '{l}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(
    u=UPPER, l=LOWER
)


@query(
    "op2_decontamination",
    f"""
with dw as (select doc_id, {_WORDS} as w from documents),
bw as (select item_id, {_WORDS} as w from benchmark),
items as (select item_id, w, least(10, len(w)) as n from bw where len(w) > 0),
windows as (select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as g
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from items)),
lengths as (select distinct n from windows),
grams as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, lengths where len(w) >= n)),
found as (select doc_id, item_id, n, i from grams join windows using (n, g)),
hits as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from found) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from dw left join hits using (doc_id) left join named using (doc_id)""",
)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).drop("text")
    hit = decontaminate.span_words()
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query("op8_near_dedup")
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_quality_resampling")
def op3_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), good)


@query("op10_chunk_dedup")
def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.dedup_chunks(table(spark, sf_dir, "documents"))


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


@query(
    "op11_collocations",
    rf"""
with d as (select coalesce(lang, 'und') as lang, string_split_regex(
  translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]') as pieces from documents),
p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from (select lang, unnest(pieces) as piece from d)),
n as (select lang, sum(len(w)) as n from p group by lang),
g as (select lang, m, array_to_string(w[i : i + m - 1], ' ') as phrase, count(*) as a
  from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from p, (select unnest(range(1, 6)) as m) where len(w) >= m)
  group by all having count(*) >= 100),
cuts as (select lang, phrase, m, a, k, array_to_string(w[1 : k], ' ') as first, array_to_string(w[k + 1 :], ' ') as rest
  from (select *, string_split(phrase, ' ') as w, unnest(range(1, m)) as k from g where m > 1)),
scored as (select c.*, x.a as l, y.a as r, n.n, (1000::hugeint * c.a * n.n) // (x.a::hugeint * y.a) as score
  from cuts c join g x on x.lang = c.lang and x.phrase = c.first join g y on y.lang = c.lang and y.phrase = c.rest
  join n on n.lang = c.lang),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (select lang, part, max(a) as a from (select lang, first as part, a from cuts where k = m - 1
  union all select lang, rest, a from cuts where k = 1) group by all),
kept as (select b.* from best b left join longer x on x.lang = b.lang and x.part = b.phrase
  where x.a is null or 100 * x.a < 100 * b.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
  a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from kept qualify rank <= 2000""",
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), support=100, max_words=5, absorbed=100, top=2000)


@query(
    "op13_hard_negatives",
    """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c as (select vec_id, label, unnest(v) as x, unnest(range(len(v))) as i from e),
s as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, sum(a.x * b.x)::bigint as score
  from c a join c b on a.i = b.i where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id group by all),
p as (select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, other_id) as int) as rank,
  other_id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5""",
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings"), label, scale=256.0)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100)


@query(
    "op12_warc",
    """
with p as (select page_id, coalesce(html, '') as t from pages),
h as (select page_id, t, sha1(t) as x, min(page_id) over (partition by t) as first from p),
d as (select *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  cast((cast('0x' || substr(x, cast(i // 4 * 5 + 1 as bigint), 5) as int) >> cast(15 - 5 * (i % 4) as int)) & 31 as int) + 1, 1)), '')
  as payload_digest from h)
select page_id, strlen(t) as payload_bytes, payload_digest,
  case when page_id is not distinct from first then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from first then first end as refers_to
from d""",
)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives, and read back from them."""
    pages = table(spark, sf_dir, "pages")
    folder = warc.archive_folder(spark)
    records, _ = warc.read_archives(warc.write_archives(pages, folder, min_payload=0), folder)

    def page(column: str) -> Column:
        key = F.url_decode(F.regexp_replace(column, "^urn:page:", ""))
        return F.when(key != "", key).cast(pages.schema["page_id"].dataType)

    return records.select(
        page("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )
