"""The thin queries over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.llm import quality_model, quality_rules, secret_scan
from cohortica.llm.byte_bpe import decode_documents, encode_documents
from cohortica.llm.cross_tokenizer import aligned_table
from cohortica.llm.decontaminate import contaminated
from cohortica.llm.files import new_folder
from cohortica.llm.kd_shards import kd_shards
from cohortica.llm.mixing import mixed_rates
from cohortica.llm.near_duplicates import near_duplicates
from cohortica.llm.repeated_passages import repeated_passages
from cohortica.llm.spelling import spelling_variants
from cohortica.llm.token_files import token_table
from cohortica.llm.warc_zstd import read_archives, with_revisits, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


OP10_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), g as (
  select html, max(page_id) as largest from p group by html
)
select page_id, cast(strlen(p.html) as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 +
    ((cast('0x' || substr(h, cast(5 * (i // 4) + 1 as bigint), 5) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31) as bigint), 1)), '')
    as payload_digest,
  case when page_id = largest then 'response' else 'revisit' end as record_type,
  case when page_id <> largest then largest end as refers_to
from p join g on p.html = g.html
"""


@query("op10_warc_zstd", OP10_SQL)
def op10_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    archives = write_archives(with_revisits(table(spark, sf_dir, "pages")), folder)
    return read_archives(spark, folder, archives)


OP4_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as text from documents
), w as (
  select doc_id, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from d
), g as (
  select doc_id, i, array_to_string(words[i : i + 4], ' ') as gram
  from (select doc_id, words, unnest(range(1, len(words) - 3)) as i from w)
), twice as (
  select doc_id, i from g qualify count(*) over (partition by doc_id, gram) > 1
), covered as (
  select doc_id, count(distinct p) as n
  from (select doc_id, unnest(range(i, i + 5)) as p from twice) group by doc_id
), m as (
  select w.doc_id, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(covered.n, 0) as bigint) as n_repeat_words,
    cast(len(lines) as bigint) as n_lines,
    cast(length(regexp_replace(text, '[^!]', '', 'g')) as bigint) as n_exclaims,
    cast(length(regexp_replace(text, '[^A-Z]', '', 'g')) as bigint) as n_upper
  from w left join covered on w.doc_id = covered.doc_id
), f as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    cast(case when n_words < 10 then 1 else 0 end
      + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
      + case when 100 * n_symbols > 15 * n_words then 4 else 0 end
      + case when 100 * n_dup_lines > 50 * n_lines then 8 else 0 end
      + case when 2 * n_exclaims > n_words then 16 else 0 end
      + case when n_words >= 10 and 10 * n_upper > 7 * word_chars then 32 else 0 end
      + case when n_words >= 10 and (word_chars < 2 * n_words or word_chars > 12 * n_words) then 64 else 0 end
      as bigint) as failures
  from m
)
select *, failures = 0 as kept from f
"""


@query("op4_rule_ledger", OP4_SQL)
def op4_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.withColumns(
        {"base_failed": ~quality_rules.passes("base-1"), "kept": quality_rules.passes()}
    )


@query("op3_kd_shards")
def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kd_shards(table(spark, sf_dir, "documents"), shards=8)
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.secrets_by_document(docs)
    count = lambda test: F.coalesce(F.size(F.filter("all", test)), F.lit(0)).cast("long")
    kind = lambda name: count(lambda x: x["kind"] == name)
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id",
        kind("assign").alias("n_assign"), kind("access").alias("n_access"), kind("hex").alias("n_hex"),
        F.sha2(secret_scan.joined("base"), 256).alias("base_sha256"),
        secret_scan.joined("all").alias("spans"),
        count(lambda x: x["verdict"] == "live").alias("n_live"),
        count(lambda x: x["verdict"] == "copied").alias("n_copied"),
    )


@query("op5_boosted_quality")
def op5_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select(
        "doc_id", quality_model.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


OP8_SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') as words
  from documents
), s as (
  select distinct doc_id, shingle from (select doc_id, unnest(
    case when len(words) >= 4 then list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))
      when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as shingle from w)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), links as (
  select a, b from common join n x on a = x.doc_id join n y on b = y.doc_id where 100 * c >= 80 * (x.n + y.n - c)
), both_ways as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id as a, doc_id as b from documents
  union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a
), least as (
  select a, min(b) as component_id from reach group by a
)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join n on d.doc_id = n.doc_id join least on d.doc_id = least.a
"""


@query("op8_superminhash", OP8_SQL)
def op8_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


@query("op2_bm25_wand")
def op2_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_soft_mixing")
def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_chained_passages")
def op7_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), exact=True)


OP13_SQL = r"""
with recursive t as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab
), runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run
    from documents) group by doc_id, run
), hexed as (
  select run, n, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as x from runs where length(run) >= 6
), hashed as (
  select run, n, xor(4294967295, list_reduce(
    list_prepend(cast(4294967295 as bigint), list_transform(range(length(x) // 2), lambda i: cast('0x' || substr(x, cast(2 * i + 1 as bigint), 2) as bigint))),
    lambda c, b: xor(c >> 8, tab[cast(xor(c, b) & 255 as bigint) + 1]))) as h
  from hexed, t
), w as (
  select word, cast(sum(n) as bigint) as n from (
    select n, case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
    from hashed) where length(word) >= 6 group by word having sum(n) >= 5
), cut as (
  select word, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select word, unnest(range(length(word))) as i from w)
), near as (
  select a.word, b.word as other from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select c.word, c.rest from cut c join w on c.rest = w.word
  union select c.rest, c.word from cut c join w on c.rest = w.word
), best as (
  select near.word, other, w.n as form_n, count(*) over (partition by near.word) as n_near,
    row_number() over (partition by near.word order by w.n desc, other) as r
  from near join w on near.other = w.word
), forms as (
  select w.word, w.n, case when form_n >= 5 * w.n then other end as form, coalesce(n_near, 0) as n_near,
    case when form_n >= 5 * w.n then form_n end as form_n
  from w left join best on w.word = best.word and r = 1
), way as (
  select word, word as root, form as next from forms
  union all select way.word, forms.word, forms.form from way join forms on way.next = forms.word
)
select forms.word, form, root, n, n_near, form_n from forms join way on forms.word = way.word and way.next is null
"""


@query("op13_pivotal_spelling", OP13_SQL)
def op13_pivotal_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def byte_bpe_digests(docs: DataFrame, ranks: str) -> DataFrame:
    """Ids of every text and, from the ids alone, its bytes, as checksums."""
    rows = decode_documents(encode_documents(docs, ranks), ranks)
    return rows.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


@query("op12_cross_tokenizer")
def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_table(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
    )
