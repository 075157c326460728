"""Documents to packed training sequences, stage by stage.

Each stage is written to the shared folder and read back as the documents of the next.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm import decontam, exactdup, language, neardup, packing
from saldo.llm.common import fresh
from saldo.llm.queries import tokenizer_path
from saldo.sources.scratch import settle

#: A text whose best language has no majority over the others is rejected, as is one without letters.
LEAST_SCORE = 0.5
#: So is one whose words are on average less familiar: letters struck at random, languages not learnt.
LEAST_FAMILIAR = 0.6


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a language; those without letters, without one ahead of all others, or of
    words that no learnt language has, go. Where nothing is labelled, no language is known and all go."""
    into = fresh(docs, "_language")
    found = language.judged(docs, language.fit(docs), into)
    clear = ((F.col(into)["lang_pred"] != language.UNKNOWN) & (F.col(into)["score"] >= LEAST_SCORE)
             & (F.col(into)["familiar"] >= LEAST_FAMILIAR))
    return found.filter(clear).drop(into)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents that are equal but for white space, the one with the smallest id."""
    return exactdup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 over shingles of five words."""
    return neardup.deduplicate(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sequences of power-of-two length; (doc_id, start, length, ids as bytes and their places)."""
    return packing.pieces(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: SQL cannot express word-first language ID, sketches, or the tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return settle(stage(spark, docs, sf_dir), name)
