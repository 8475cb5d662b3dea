"""The registered queries ``opN_<name>``: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import table
from ebbtide.llm.near_dup import near_duplicates
from ebbtide.llm.nearest import nearest_vectors
from ebbtide.llm.phrases import mine_phrases
from ebbtide.llm.personal_data import KINDS, find_personal_data, span_list
from ebbtide.llm.decontamination import find_contamination
from ebbtide.llm.language_id import fit, held_out, identify
from ebbtide.llm.lm_scoring import score_texts
from ebbtide.llm.packing import pack_documents
from ebbtide.llm.sharding import shard_records
from ebbtide.llm.substring_dedup import repeated_spans
from ebbtide.llm.token_counts import count_tokens
from ebbtide.llm.url_filter import judge_urls
from ebbtide.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_token_counts")
def op1(spark: SparkSession, d: str) -> DataFrame:
    return count_tokens(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_packing")
def op3(spark: SparkSession, d: str) -> DataFrame:
    pieces = pack_documents(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op4_personal_data")
def op4(spark: SparkSession, d: str) -> DataFrame:
    found = find_personal_data(table(spark, d, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(span_list(F.filter("spans", lambda s: s["kind"].isin(*KINDS))), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


@query("op8_sharding")
def op8(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    text = F.coalesce(docs["text"], F.lit(""))
    size = (F.octet_length(text) + F.lit(8)).cast("long")
    placed = shard_records(docs, "doc_id", {"size": size, "text_crc32": F.crc32(text.cast("binary"))})
    return placed.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


ALLOW = [("org", "/"), ("com", "/fr/")]
BLOCK = [("example.org", "/es/"), ("example.org", "/en/1"), ("com", "/de/")]


def rules(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    one = [F.struct(F.lit(host).alias("host"), F.lit(path).alias("path")) for host, path in pairs]
    return spark.range(1).select(F.inline(F.array(*one)))


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' or host like '%.{host}') and starts_with(path, '{path}')"


_LONGEST_FIRST = sorted(ALLOW + BLOCK, key=lambda r: -len(r[0] + r[1]))
_RULE = " ".join(f"when {_fits(h, p)} then '{h}{p}'" for h, p in _LONGEST_FIRST)
_BLOCKING = ", ".join(f"'{h}{p}'" for h, p in BLOCK)


@query(
    "op7_url_filters",
    f"""
with parts as (select page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) path from pages),
ruled as (select *, case {_RULE} end as "rule" from parts)
select page_id, host, path, "rule", case when "rule" in ({_BLOCKING}) then 'block' else 'allow' end verdict from ruled""",
)
def op7(spark: SparkSession, d: str) -> DataFrame:
    return judge_urls(table(spark, d, "pages"), rules(spark, ALLOW), rules(spark, BLOCK))


@query("op6_language_id")
def op6(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    texts = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), "text")
    return identify(texts, fit(docs)).drop("text")


@query("op10_decontamination")
def op10(spark: SparkSession, d: str) -> DataFrame:
    found = find_contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op9_nearest")
def op9(spark: SparkSession, d: str) -> DataFrame:
    return nearest_vectors(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op2_near_duplicates")
def op2(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(table(spark, d, "documents"), words=2)


@query("op5_substring_dedup")
def op5(spark: SparkSession, d: str) -> DataFrame:
    return repeated_spans(table(spark, d, "documents"))


@query(
    "op12_phrases",
    r"""
with pieces as (select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce("text", ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') ws from pieces),
grams as (select lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) g
  from words, (values (1), (2), (3), (4)) t(m)),
found as materialized (select lang, m, g, count(*) a from grams group by all having m = 1 or count(*) >= 30),
parts as materialized (select lang, m, g, a, string_split(g, ' ') w from found where m > 1),
cuts as (select lang, m, g, a, k, array_to_string(w[1:k], ' ') g1, array_to_string(w[k + 1:], ' ') g2
  from parts, (values (1), (2), (3)) t(k) where k < m),
left_sides as (select c.*, p.a l from cuts c join found p on p.lang = c.lang and p.g = c.g1),
both_sides as (select c.*, p.a r from left_sides c join found p on p.lang = c.lang and p.g = c.g2),
scored as (select *, (2000000::hugeint * a) // (l + r) score from both_sides
  qualify row_number() over (partition by lang, g order by score, k) = 1),
runs as (select lang, a, array_to_string(w[i:i + s - 1], ' ') g from parts, (values (2), (3)) t(s), (values (1), (2), (3)) u(i)
  where s < m and i + s - 1 <= m),
inside as (select lang, g, max(a) longer from runs group by all),
kept as (select s.* from scored s left join inside i on s.lang = i.lang and s.g = i.g
  where i.g is null or 100::hugeint * longer < 80::hugeint * a),
totals as (select lang, sum(a) n from found where m = 1 group by lang)
select lang, row_number() over (partition by lang order by score desc, a desc, g)::bigint "rank", g phrase, a::bigint a,
  l::bigint l, r::bigint r, n::bigint n, score::bigint score from kept join totals using (lang)
qualify "rank" <= 2000""",
)
def op12(spark: SparkSession, d: str) -> DataFrame:
    return mine_phrases(table(spark, d, "documents"))


@query("op13_whitening")
def op13(spark: SparkSession, d: str) -> DataFrame:
    return whiten(table(spark, d, "embeddings"))


@query("op11_lm_scores")
def op11(spark: SparkSession, d: str) -> DataFrame:
    return score_texts(table(spark, d, "documents"))
