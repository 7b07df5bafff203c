"""The registered queries of this subpackage: each applies its operator to its whole table and derives digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import decontaminate, fuzzy_lines, jaccard_join, language, packing, pii, secret_scan, substrings, token_files, variants, vectors, warc, whitening
from cohortloom.runtime import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _n(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@_query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    spans = "secret_spans"
    base = secret_scan.spans_text(spans, secret_scan.KINDS[:3])
    return found.select(
        "doc_id",
        *[_n(spans, k).alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.spans_text(spans).alias("spans"),
    )


# Windows of ten words of each item, a document's words with their positions, and the words that some window covers.
# DuckDB's lower() folds more than A-Z, so translate() does it.
_OP9_SQL = r"""
with folded as (
  select 'd' as side, doc_id as id, row_number() over () as row_id, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
  union all
  select 'b', item_id, row_number() over (), translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark
), listed as (
  select side, id, row_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from folded
), windows as (
  select distinct item, n, win from (
    select id as item, least(len(words), 10) as n,
      unnest([array_to_string(words[k:k + 9], ' ') for k in range(1, greatest(len(words) - 9, 1) + 1)]) as win
    from listed where side = 'b' and len(words) > 0)
), sizes as (select distinct n from windows),
runs as (
  select row_id, n, unnest(range(1, len(words) - n + 2)) as k, words
  from listed cross join sizes where side = 'd' and len(words) >= n
), matched as (
  select row_id, k, r.n, w.item from (
    select row_id, n, k, array_to_string(words[k:k + n - 1], ' ') as win from runs) r
  join windows w on w.win = r.win and w.n = r.n
), covered as (
  select row_id, count(distinct p) as n_hit from (
    select row_id, unnest(range(k, k + n)) as p from (select distinct row_id, k, n from matched)) group by row_id
), items as (
  select row_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct row_id, cast(item as varchar) as item from matched where item is not null) group by row_id
)
select l.id as doc_id, cast(len(l.words) as bigint) as n_words, cast(coalesce(c.n_hit, 0) as bigint) as n_hit,
  cast(coalesce(i.n_items, 0) as bigint) as n_items, sha256(coalesce(i.ids, '')) as items_sha256,
  coalesce(c.n_hit, 0) > 0 as contaminated
from listed l left join covered c using (row_id) left join items i using (row_id) where l.side = 'd'
"""


@_query("op9_decontamination", _OP9_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan_benchmark(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query("op10_personal_data")
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan_personal_data(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    base = secret_scan.spans_text("pii_spans", pii.BASE_KINDS)
    return found.select(
        "doc_id",
        *[_n("pii_spans", k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.spans_text("pii_spans").alias("spans"),
    )


@_query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"]
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = 49407  # the end of text of this vocabulary
    contents = token_files.write_token_files(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end
    )
    counts = token_files.count_tokens(spark, contents, end)
    return counts.join(contents, ["path", "ordinal"]).select("doc_id", "n_tokens", "terminated")


# DuckDB has no base-32, so the 20 bytes of the digest are spelled five bits at a time; an id that may be
# missing is a double, whose nulls read as Spark's do
_OP1_SQL = r"""
with plain as (
  select page_id, coalesce(encode(html), ''::blob) as payload from pages
), hashed as (
  select page_id, octet_length(payload) as bytes, sha1(payload) as hex from plain
), spelled as (
  select page_id, bytes, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      cast((('0x' || substr(hex, 10 * (k // 8) + 1, 10))::bigint >> (35 - 5 * (k % 8))) & 31 as integer) + 1, 1)
    for k in range(0, 32)], '') as payload_digest from hashed
), grouped as (
  select *, max(page_id) over (partition by payload_digest) as response from spelled
)
select page_id, cast(bytes as bigint) as payload_bytes, payload_digest,
  case when page_id = response then 'response' else 'revisit' end as record_type,
  cast(case when page_id <> response then response end as double) as refers_to
from grouped
"""


@_query("op1_warc_archives", _OP1_SQL)
def op1_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(_table(spark, sf_dir, "pages"))
    records = warc.read_archives(spark, archives).select(
        "record_type",
        F.col("page_key").cast("long").alias("page_id"),
        F.col("refers_to_key").cast("long").alias("refers_to"),
        "payload_digest",
        F.octet_length("payload").cast("long").alias("stored_bytes"),
    )
    records = materialize(records, "records")
    # a revisit has no payload of its own: its length is that of the record it refers to, which must have its digest
    referred = records.filter("record_type = 'response' and page_id is not null").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("stored_bytes").alias("referred_bytes")
    ).distinct()
    return records.join(referred, ["refers_to", "payload_digest"], "left").select(
        "page_id",
        F.coalesce("stored_bytes", "referred_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


# cosines of all pairs in double precision, and the least id that links reach
_OP8_SQL = r"""
with recursive given as (
  select vec_id, case when embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0 then embedding::double[] end as v from embeddings
), links as (
  select a.vec_id as a, b.vec_id as b from given a join given b
    on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9
), reached as (
  select vec_id as node, vec_id as root from given
  union
  select l.b, r.root from reached r join links l on l.a = r.node
), counted as (
  select a as vec_id, count(*) as n_links from links group by a
), least as (
  select node as vec_id, min(root) as component_id from reached group by node
)
select g.vec_id, cast(coalesce(c.n_links, 0) as bigint) as n_links, l.component_id, g.vec_id = l.component_id as kept
from given g left join counted c using (vec_id) join least l using (vec_id)
"""


@_query("op8_vector_dedup", _OP8_SQL)
def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(_table(spark, sf_dir, "embeddings"))


@_query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.linked_documents(_table(spark, sf_dir, "documents"))
    return linked.select(F.col("id").alias("doc_id"), F.col("root.id").alias("class_id"), "n_links")


@_query("op5_line_dedup")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fuzzy_lines.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_removed",
        F.length("text").cast("long").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


@_query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify_languages(docs, F.col("text"), F.col("lang"), F.col("source"), carry=["doc_id", "lang"])
    return found.select(
        "doc_id", F.col("lang").alias("declared"), "language", F.round("confidence", 6).alias("confidence"), "accepted"
    )


@_query("language_of_pages")
def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator of op7 where all its evidence is at hand: markup, address suffix and host."""
    html = F.col("html")
    found = language.identify_languages(
        _table(spark, sf_dir, "pages"),
        language.markup_text(html),
        language.markup_language(html),
        language.address_host(F.col("url")),
        carry=["page_id"],
    )
    return found.withColumn("confidence", F.round("confidence", 6))


@_query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation as long)"))


# the least id of every window of 13 words, and the words that a window with a smaller one covers
_OP12_SQL = r"""
with listed as (
  select row_number() over () as row_id, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), windows as (
  select row_id, doc_id, k, array_to_string(words[k:k + 12], ' ') as win
  from (select row_id, doc_id, words, unnest(range(1, len(words) - 11)) as k from listed)
), least as (
  select win, min(doc_id) as least from windows group by win
), covered as (
  select row_id, list(distinct p) as gone from (
    select w.row_id, unnest(range(k, k + 13)) as p from windows w join least l using (win) where l.least < w.doc_id)
  group by row_id
), left_over as (
  select l.doc_id, len(l.words) as n_words, coalesce(len(c.gone), 0) as n_removed,
    case when c.gone is null then l.words
      else list_transform(list_filter(range(1, len(l.words) + 1), lambda p: not list_contains(c.gone, p)),
        lambda p: l.words[p]) end as kept
  from listed l left join covered c using (row_id)
)
select doc_id, cast(n_words as bigint) as n_words, cast(n_removed as bigint) as n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) as kept_sha256 from left_over
"""


@_query("op12_substring_dedup", _OP12_SQL)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.drop_repeated_passages(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# the checksum goes byte by byte with the table of its polynomial; near words meet with a letter masked or left out
_OP13_SQL = r"""
with recursive steps as (
  select i, 0 as step, i as c from range(256) t(i)
  union all
  select i, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where step < 8
), crc as (
  select list(c order by i) as tab from steps where step = 8
), runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as run
    from documents) group by doc_id, run
), octets as (
  select *, hex(encode(concat(doc_id, ':', run))) as h from runs where length(run) >= 5
), checked as (
  select run, n, xor(list_reduce(
    list_transform(range(0, length(h) // 2), lambda k: cast('0x' || substr(h, 2 * k + 1, 2) as bigint)),
    lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1]), cast(4294967295 as bigint)), 4294967295) as h
  from octets cross join crc
), spoiled as (
  select n, case when h % 97 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word from checked
), words as (
  select word, cast(sum(n) as bigint) as n from spoiled where length(word) >= 5 group by word having sum(n) >= 3
), places as (
  select word, n, unnest(range(1, length(word) + 1)) as i from words
), masked as (
  select word, n, left(word, i - 1) || '*' || substr(word, i + 1) as pattern from places
), shorter as (
  select distinct word, n, left(word, i - 1) || substr(word, i + 1) as less from places
), near as (
  select a.word, a.n, b.word as other, b.n as m from masked a join masked b using (pattern) where a.word <> b.word
  union all
  select w.word, w.n, s.word, s.n from words w join shorter s on s.less = w.word
  union all
  select s.word, s.n, w.word, w.n from words w join shorter s on s.less = w.word
), best as (
  select word, any_value(n) as n, count(*) as n_near, max(m) as m,
    first(other order by m desc, other) as other from near group by word
), forms as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.m >= 2 * w.n then b.other end as form,
    case when b.m >= 2 * w.n then b.m end as form_n
  from words w left join best b using (word)
), ways as (
  select word, word as at from forms
  union all
  select y.word, f.form from ways y join forms f on f.word = y.at where f.form is not null
), roots as (
  select y.word, y.at as root from ways y join forms f on f.word = y.at where f.form is null
)
select f.word, f.form, r.root, f.n, cast(f.n_near as bigint) as n_near, cast(f.form_n as double) as form_n
from forms f join roots r using (word)
"""


@_query("op13_spelling_variants", _OP13_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(_table(spark, sf_dir, "documents"))
