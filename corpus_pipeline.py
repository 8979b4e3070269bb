"""From documents to packed training sequences: quality rules, near duplicates, repeated passages, packing.

Each stage takes the documents that the one before kept, and its decisions take effect: rejected documents go, one document
of each group of near copies stays, repeated passages are cut out of the texts, and what is left is packed.

Every stage takes any table with doc_id and text (null or empty texts, repeated rows and ids, null ids, an empty table, other
columns of any name and type); its docstring says what becomes of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidespan.llm import ngram_join, packing, quality, substring_dedup, tables
from tidespan.llm.queries import BYTE_RANKS, BYTE_SPECIAL


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and the classifier, which is fitted on labelled rows among them.

    Null and empty texts have fewer than twenty words and go. Equal rows get the same verdict, so all or none of them stay. Rows
    without id are judged like others, but train nothing. An empty table leaves an empty one.
    """
    return quality.passing(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked by shingles of five words at a similarity of 0.8 or more.

    Texts without words are linked with nothing and stay. A null id is smaller than all others. Rows that repeat an id that stays
    for their own group all stay (the next stage cuts the repeats). An empty table leaves an empty one.
    """
    return ngram_join.one_of_each_group(docs, 5, (8, 10))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of twenty words or more that an earlier document holds; ``n_chars`` follows.

    Rows that keep no word, because all of theirs stand elsewhere or because they had none (null and empty texts), go: packed,
    they would be lone end ids. What is left of a text stays however short. Of equal rows one keeps its words. An
    empty table leaves an empty one.
    """
    out = substring_dedup.deduplicated(docs, 20).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, ids included, with their place in sequences of 2048 tokens (``packing.sequences`` joins them).

    Null and empty texts are a lone end id; every row of a repeated one has its own place. An empty table gives no piece.
    """
    return packing.packed_documents(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, BYTE_SPECIAL, 0, 2048, ids=True)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("best_fit_packing", best_fit_packing)]

#: The classifier, the tokenizer and the packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = tables.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
