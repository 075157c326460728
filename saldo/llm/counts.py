"""Token counts by source, language and tokenizer version, maintained by signed changes.

A batch of changes is folded to additive totals and committed under its name; the totals of a
corpus are the sum over committed batches. A batch that is given again is not counted again,
and one whose write was cut short has no effect and can be repeated.
"""

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm.common import importable
from saldo.llm.tokens import encoder

KEYS = ("source", "lang", "version")
SUMS = ("documents", "tokens")
_TOTALS = "source string, lang string, version string, documents bigint, tokens bigint"
_STATE = ("source", "lang", "version", "tokens")


def counted(docs: DataFrame, tokenizer: str, version: str, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", lang_col: str = "lang", revised_col: str | None = None) -> DataFrame:
    """(doc_id, source, lang, version, tokens) of whole texts, a row for each; a null text has no tokens.

    With `revised_col`, a text that a row is to get, also `revised`: its tokens, NULL where the
    row stays as it is. Both counts stand in one row, so revising needs no key: rows without id
    and rows that repeat one are revised like others.
    """

    def count(batches):
        for batch in batches:
            encode = encoder(tokenizer).encode
            n = [len(encode(t.as_py() or "")) // 4 for t in batch.column(3)]
            again = [None if t.as_py() is None else len(encode(t.as_py())) // 4 for t in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(n, pa.int64()), pa.array(again, pa.int64())],
                ["doc_id", "source", "lang", "tokens", "revised"])

    revised = F.col(f"`{revised_col}`") if revised_col else F.lit(None)
    read = importable(docs).select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"),
        revised.cast("string").alias("revised"))
    out = read.mapInArrow(count, "doc_id bigint, source string, lang string, tokens bigint, revised bigint")
    return out.select("doc_id", "source", "lang", F.lit(version).alias("version"), "tokens", *(["revised"] if revised_col else []))


def _image(sign: int, prefix: str):
    return F.struct(F.lit(sign).cast("bigint").alias("documents"), *[
        (F.col(prefix + c) * sign if c == "tokens" else F.col(prefix + c)).alias(c) for c in _STATE])


def inserts(state: DataFrame) -> DataFrame:
    """Signed rows of new documents."""
    return state.select(_image(1, "").alias("row")).select("row.*")


def deletes(state: DataFrame) -> DataFrame:
    """Signed rows of documents that go; `state` is as they were counted."""
    return state.select(_image(-1, "").alias("row")).select("row.*")


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed rows of documents whose count, group or version changes: minus before, plus after."""
    return deletes(before).unionByName(inserts(after))


def commit(changes: DataFrame, ledger: str, batch: str) -> bool:
    """Adds the totals of signed rows to the ledger as `batch`; False if it was there already.

    Each batch has a folder of its own. It counts once its write has ended, which Spark marks
    by a file written last; what a failed write left is written over. A hot group is folded in
    each task. Null sources, languages and versions are groups; null counts are 0. A batch
    without changes is committed and adds nothing.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
        raise ValueError(f"not a name for a batch: {batch!r}")
    path = f"{ledger}/batch-{batch}"
    if _committed(changes.sparkSession, path):
        return False
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in SUMS]
    totals = changes.groupBy(*KEYS).agg(*sums)
    totals.write.mode("overwrite").parquet(path)
    return True


def _committed(spark: SparkSession, path: str) -> bool:
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def committed(spark: SparkSession, ledger: str) -> list[str]:
    """Folders of the committed batches."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/batch-*")
    store = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().toString() for s in store.globStatus(pattern) or []]
    return sorted(p for p in found if _committed(spark, p))


def rollup(spark: SparkSession, ledger: str) -> DataFrame:
    """(source, lang, version, documents, tokens): totals over committed batches, without
    groups that have no document left."""
    folders = committed(spark, ledger)
    if not folders:
        return spark.createDataFrame([], _TOTALS)
    sums = [F.sum(c).alias(c) for c in SUMS]
    totals = spark.read.schema(_TOTALS).parquet(*folders).groupBy(*KEYS).agg(*sums)
    return totals.filter((F.col("documents") != 0) | (F.col("tokens") != 0))
