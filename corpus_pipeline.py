"""A training-data pipeline over ``documents``: each stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import table
from ebbtide.llm.decontamination import find_contamination
from ebbtide.llm.language_id import UNKNOWN, fit, identify
from ebbtide.llm.near_dup import near_duplicates
from ebbtide.llm.packing import pack_documents
from ebbtide.llm.personal_data import mask_personal_data
from ebbtide.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language is taken as identified from this score on.
SURE = 0.4


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written with a row number of their own, so that repeated ids don't mix."""
    return written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), name)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in an identified language; null texts, those without a letter and doubtful ones go.

    Where no row has a label to learn from, all documents stay: nothing can be told of them. Repeated rows
    and null ids are judged like others, an empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    net = fit(docs)
    if net is None:
        return docs
    found = identify(docs, net)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= SURE)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five-word shingles, similarity 0.8): the one of smallest id.

    Of rows that share that id, the first stays; a null id counts as the largest.
    """
    rows = _numbered(docs, "near")
    judged = near_duplicates(rows.select("row", "text"), id_col="row")
    groups = judged.select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select("row", "doc_id").join(groups, "row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = ids.groupBy("component_id").agg(F.min_by("row", order).alias("row")).select("row")
    return rows.join(first, "row", "left_semi").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a passage of a benchmark item.

    Null and empty texts hold none and stay; repeated rows and ids are judged each; without benchmark items
    or documents nothing goes.
    """
    rows = _numbered(docs, "clean")
    found = find_contamination(rows.select("row", "text"), table(spark, sf_dir, "benchmark"), id_col="row")
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("row"))
    return rows.join(hit, "row", "left_anti").select(*COLUMNS)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; ``n_chars`` follows (null where the text is). All rows stay."""
    masked = mask_personal_data(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 4096 tokens: a row per piece, with its ids.

    A null or empty text is its end token alone; repeated rows are packed each; an empty table gives no rows.
    """
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language),
    ("near-duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("personal data", mask),
    ("packing", pack),
]

#: SQL can express neither the network nor the tokenizer; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read back before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
