"""A corpus pipeline of four stages over ``documents``; each stage's rows are written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import langid, neardup, packing, quality
from skyledger.llm.common import stored, table

def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under column names that no operator adds, and those names by the old ones."""
    names = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what passes the base rules and lies within the bands of its language, script and length, which are fitted to all of
    the stage's input. Null, empty and short texts go; repeated rows are judged alike."""
    rows, names = _renamed(docs)
    vocabularies = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    judged = quality.rules(rows, names["text"], names["lang"], *vocabularies)
    return judged.where("kept").select(*names.values()).toDF(*names)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that are like the other texts of a language that the stage's own input teaches. Texts without letters, or
    unlike any of these languages, go; so do all texts where no row has a language to learn from."""
    return langid.plausible(docs, "text", langid.train(docs.where(~langid.held_out("doc_id")), "text", "lang"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates; rows that repeat its id are that document, and
    rows without an id are in no group. Texts without words are like nothing else and stay."""
    kept = neardup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept_doc_id"))
    return docs.join(kept.distinct(), F.col("doc_id").eqNullSafe(F.col("_kept_doc_id")), "left_semi").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens; null texts count as empty, repeated rows are packed each."""
    packed = packing.pack(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), pattern=public_tokenizers.PATTERN)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "class_k")


STAGES = [("quality rules", quality_rules), ("language ID", language_id), ("near-duplicates", near_duplicates), ("packing", pack)]

#: SQL can't express the tokenisers and profiles that the stages use.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
