"""The operators applied to the test tables with production parameters, beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.llm import (
    bpe,
    conversations,
    exact_dedup,
    html_text,
    language,
    manifest,
    mixing,
    quality,
    simhash,
    token_counts,
    topk,
    url_filter,
    wavelet,
)
from layerloom.llm.common import settled, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that has the same result."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


#: What is masked before training: addresses, long hexadecimal secrets, long numbers.
MASKS = {
    r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+": "<email>",
    r"\b[0-9a-f]{32,}\b": "<secret>",
    r"\+?\d[\d ().-]{7,}\d": "<number>",
}


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after masking personal data, updated from the stored trees of all texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    how = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    grown = settled(token_counts.recounted(docs, *how, keep=True).select("doc_id", "text", "tree"), "trees")
    return token_counts.recounted(grown, *how, masks=MASKS, tree=F.col("tree"))


@query()
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digested(bpe.encoded(docs, ranks, public_tokenizers.PATTERN), ranks)


def digested(encoded: DataFrame, rank_file: str) -> DataFrame:
    """Counts and digests of the ids and of the bytes that they decode to."""
    found = encoded.select("doc_id", "ids", bpe.id_array(F.col("ids")).alias("numbers"))
    return bpe.decoded(found, "numbers", rank_file).select(
        "doc_id",
        F.size("numbers").cast("bigint").alias("n_tokens"),
        F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    r"""with articles as (
           select page_id, url, regexp_extract(coalesce(html, ''),
                      '<article>(.*?)(</article>|$)', 1, 's') as body from pages),
       blocks as (
           select page_id, url, list_filter(list_transform(
                      string_split_regex(body, '</?(?:p|h1)>'),
                      lambda b: trim(regexp_replace(regexp_replace(replace(replace(replace(
                          regexp_replace(regexp_replace(b, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
                          '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'),
                          '\s+', ' ', 'g'))), lambda b: b <> '') as blocks
           from articles)
       select page_id, url, array_to_string(blocks, chr(10) || chr(10)) as text,
              length(array_to_string(blocks, chr(10) || chr(10))) as n_chars
       from blocks"""
)
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extracted(pages)


@query()
def op4_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs)


@query(
    """with vectors as (
           select vec_id, list_transform(embedding,
                      lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
           from embeddings
           where vec_id is not null and embedding is not null and len(list_filter(embedding,
                 lambda x: x is null or not isfinite(x))) = 0),
       pairs as (
           select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(
                      list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
           from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
           where q.vec_id % 100 = 0)
       select query_id, cast(rank as integer) as rank, vec_id, score
       from (select *, row_number() over (partition by query_id order by score desc, vec_id)
                    as rank from pairs)
       where rank <= 10"""
)
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.nearest(vectors, F.col("vec_id") % 100 == 0, k=10, scale=1024)


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    filters = language.fitted(docs.filter(~held_out))
    predicted = language.identified(docs.select("doc_id", "text"), filters)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), shingle_words=3, radius=3)
    return groups.select("doc_id", simhash.hex_print(F.col("print")).alias("fingerprint"), "component_id")


URL_RULES = [
    url_filter.rule("block", "net/"),
    url_filter.rule("allow", "example.net/en/"),
    url_filter.rule("block", "example.com/de/"),
    url_filter.rule("allow", "org/fr/"),
]


@query(
    """with parts as (
           select page_id,
                  translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
           from pages),
       rules as (select * from (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                 ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) r(verdict, h, p)),
       hits as (
           select page_id, parts.host, parts.path, arg_max(h || p, length(h || p)) as rule,
                  arg_max(verdict, length(h || p)) as verdict
           from parts join rules on (parts.host = h or ends_with(parts.host, '.' || h))
                                and starts_with(parts.path, p)
           group by all)
       select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
       from parts left join hits using (page_id, host, path)"""
)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query()
def op9_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = wavelet.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return wavelet.read_documents(spark, path)


@query(
    """with texts as (select doc_id, coalesce(text, '') as text from documents)
       select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
              doc_id = max(doc_id) over same as kept, sha256(text) as text_sha256
       from texts window same as (partition by text)"""
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


@query()
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    found = quality.quality(docs, table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut of their sentence ends, doubled, or given to the user."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(case == 1, "").when(case == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    copies = F.when(case == 0, 0).when(case == 3, 2).otherwise(1)
    rows = turns.select(
        "conv_id", "turn", F.when(case == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    )
    return rows.drop("copy")


@query()
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversations.with_empty(turns, conversations.repaired(damaged(turns)))


#: Unsigned crc32 of a decimal number, bit by bit, for DuckDB.
CRC32_MACRO_BODY = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(n, ''),
        lambda d: cast(ascii(d) as bigint))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)"""

MANIFEST_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    fields = ["cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text]
    return f"sha256({' || '.join(map(_field_sql, fields))})"


@query(
    f"""with recursive docs as (
           select *, coalesce(':' || source, '-') as tree, {_leaf_sql("text")} as leaf,
                  cast(doc_id as varchar) as n from documents),
       leaves as (
           select *, row_number() over (partition by tree order by doc_id, leaf) - 1 as i,
                  count(*) over (partition by tree) as size,
                  case when coalesce({CRC32_MACRO_BODY} % 2 = 0, false)
                       then {_leaf_sql("replace(text, chr(10), '')")} else leaf end as presented
           from docs),
       nodes as (
           select tree, 0 as level, i, size, leaf as digest from leaves
           union all
           select tree, level + 1, i // 3, (size + 2) // 3, sha256(string_agg(digest, '' order by i))
           from nodes where size > 1 group by tree, level, i // 3, size),
       subroots as (
           select tree, digest, row_number() over (order by tree) - 1 as i, count(*) over () as size
           from nodes where size = 1),
       tops as (
           select 0 as level, i, size, digest from subroots
           union all
           select level + 1, i // 3, (size + 2) // 3, sha256(string_agg(digest, '' order by i))
           from tops where size > 1 group by level, i // 3, size),
       runs as (
           select tree, level, i // 3 as p, list(digest order by i) as run
           from nodes where size > 1 group by all),
       top_runs as (
           select level, i // 3 as p, list(digest order by i) as run
           from tops where size > 1 group by all),
       folds as (
           select tree, i as leaf_no, 0 as level, i, size, presented as digest, '' as proof from leaves
           union all
           select f.tree, leaf_no, f.level + 1, f.i // 3, (size + 2) // 3,
                  sha256(array_to_string(run[1:f.i % 3], '') || digest || array_to_string(run[f.i % 3 + 2:3], '')),
                  proof || array_to_string(run[1:f.i % 3], '') || array_to_string(run[f.i % 3 + 2:3], '')
           from folds f join runs r on r.tree = f.tree and r.level = f.level and r.p = f.i // 3),
       top_folds as (
           select f.tree, leaf_no, 0 as level, s.i, s.size, f.digest, proof
           from folds f join subroots s using (tree) where f.size = 1
           union all
           select tree, leaf_no, f.level + 1, f.i // 3, (size + 2) // 3,
                  sha256(array_to_string(run[1:f.i % 3], '') || digest || array_to_string(run[f.i % 3 + 2:3], '')),
                  proof || array_to_string(run[1:f.i % 3], '') || array_to_string(run[f.i % 3 + 2:3], '')
           from top_folds f join top_runs r on r.level = f.level and r.p = f.i // 3)
       select doc_id, leaf, s.digest as subroot, t.digest as root, sha256(proof) as proof_sha256,
              f.digest as folded_root, f.digest = t.digest as verified
       from leaves l join top_folds f on f.tree = l.tree and f.leaf_no = l.i
                     join subroots s on s.tree = l.tree join tops t on t.size = 1
       where f.size = 1"""
)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    number = F.col("doc_id").cast("string").cast("binary")
    touched = F.coalesce(F.crc32(number) % 2 == 0, F.lit(False))
    others = [F.col(name) for name in MANIFEST_FIELDS if name != "text"]
    changed = manifest.digest_of([*others, F.translate("text", "\n", "")])
    untouched = manifest.digest_of([F.col(name) for name in MANIFEST_FIELDS])
    presented = F.when(touched, changed).otherwise(untouched)
    return manifest.proven(manifest.built(docs, MANIFEST_FIELDS, presented=presented), "presented")
