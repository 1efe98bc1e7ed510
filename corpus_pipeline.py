"""A corpus pipeline of the operators in fedspark.llm: documents in, encoded documents out.

Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fedspark.llm import bpe, language_id, line_dedup, mixing, queries, simhash
from fedspark.llm.common import materialize, read_table

#: A prediction below this is no language; clean prose of a learned language lies far above.
LEAST_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents without a letter or with no language that was learned go; a null lang becomes
    the predicted one."""
    out = language_id.identify(docs, language_id.train(docs))
    out = out.where((F.col("__lang") != language_id.UNKNOWN) & (F.col("__score") >= LEAST_SCORE))
    return out.select(*(F.coalesce("lang", "__lang").alias(c) if c == "lang" else F.col(c) for c in docs.columns))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of near-equal lines the first of the corpus stays; documents that lose every line go."""
    out = line_dedup.without_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: each document as often as the mix takes it."""
    return mixing.repeat(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: ids and round trip of every document that is left. Fewer words are remembered than in the
    query: a pipeline's workers share their executor with the stages around."""
    return bpe.digests(docs, queries.WORD_TOKENIZER, cache_words=30_000)


STAGES = [("language_id", known_language), ("line_dedup", distinct_lines), ("simhash_near_dedup", distinct_documents), ("mixing", mixed), ("bpe", encoded)]

#: SQL can express neither XXH64, linear classifiers nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
