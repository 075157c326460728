"""Exact duplicates by recipes of content-defined chunks.

Texts are equal if they are identical after each run of white space became one blank. A text
is cut after a sentence or clause mark that follows at least `CHUNK_LEAST` characters, so equal
stretches are cut alike wherever they stand. Each chunk content has one verified identifier,
and texts are equal if the ordered lists of their identifiers (the recipes) are. A chunk content
is moved once, whatever the number of its copies; from then on only identifiers move.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import bounded, fresh, whole, without
from saldo.sources.scratch import settle

CHUNK_LEAST, CHUNK_MOST = 512, 4096
#: A chunk ends after a mark and a blank, at the longest length, or with the text.
CHUNK = (f"(?s).{{{CHUNK_LEAST},{CHUNK_MOST}}}?(?<=[.!?;,|] )"
         f"|.{{{CHUNK_LEAST},{CHUNK_MOST}}}|.+")
# Runs of white space that are not one blank already.
_WHITE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"

Hash = Callable[[Column], Column]


def hash64(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def normalise(text: str) -> Column:
    return F.regexp_replace(whole(text), _WHITE, " ")


def _chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = docs.select(F.col(f"`{id_col}`").alias("doc_id"), normalise(text_col).alias("norm"))
    return norm.withColumn("chunks", F.regexp_extract_all("norm", F.lit(CHUNK), 0))


def ambiguous(docs: DataFrame, hash_of: Hash = hash64, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(hash, chunk, variant) of every hash that stands for more than one chunk content.

    Verifies the identifiers: distinct contents are brought together by hash, each once for
    every task. Usually there are no rows, and no second pass over the texts.
    """
    chunks = _chunked(docs, id_col, text_col).select(F.explode("chunks").alias("chunk"))
    distinct = chunks.select(hash_of(F.col("chunk")).alias("hash"), "chunk").distinct()
    shared = settle(distinct.groupBy("hash").count().filter("count > 1").select("hash"), "shared-hashes")
    if shared.isEmpty():
        return shared.select("hash", F.lit("").alias("chunk"), F.lit(0).alias("variant"))
    order = Window.partitionBy("hash").orderBy("chunk")
    told_apart = distinct.join(shared, "hash", "left_semi")
    return settle(told_apart.withColumn("variant", F.row_number().over(order)), "told-apart")


def recipes(docs: DataFrame, hash_of: Hash = hash64, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(row, doc_id, text_sha256, recipe) of each row, settled: `row` numbers the rows.

    An identifier is the hash of the chunk, and where contents share a hash, the hash and the
    number of the content among them.
    """
    variants = ambiguous(docs, hash_of, id_col, text_col)
    chunked = _chunked(docs, id_col, text_col)
    sha = F.sha2("norm", 256).alias("text_sha256")
    row = F.monotonically_increasing_id().alias("row")
    if variants.isEmpty():
        hashes = F.transform("chunks", lambda c: hash_of(c)).alias("recipe")
        return settle(chunked.select(row, "doc_id", sha, hashes), "recipes")
    numbered = chunked.select(row, "doc_id", sha, "chunks")  # before the chunks become rows
    placed = numbered.select("row", "doc_id", "text_sha256", F.posexplode_outer("chunks").alias("place", "chunk"))
    named = placed.withColumn("hash", hash_of(F.col("chunk"))).join(variants, ["hash", "chunk"], "left")
    one = F.struct("place", "hash", F.coalesce("variant", F.lit(0)).cast("bigint").alias("variant"))
    parts = F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), one)))
    recipe = F.flatten(F.transform(parts, lambda p: F.array(p["hash"], p["variant"])))
    grouped = named.groupBy("row", "doc_id", "text_sha256").agg(recipe.alias("recipe"))
    return settle(grouped, "recipes")


def classes(docs: DataFrame, hash_of: Hash = hash64, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of `docs`.

    Null and empty texts are equal. Of equal texts the row with the smallest id stays, ids
    before none; of rows that share that id too, exactly one. A recipe that a third of all
    rows have is folded in each task, and the join back is one that Spark splits. No rows give
    no rows; other columns are not read.
    """
    rows = recipes(docs, hash_of, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    groups = rows.groupBy("recipe").agg(first.alias("first"), F.count("*").alias("group_size"))
    return rows.join(groups, "recipe").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns.

    Only ids move to where the rows are. Ids that occur both among rows that stay and rows
    that go (repeated ids) are told apart by their text, in a branch of their own.
    """
    decided = settle(classes(docs, id_col=id_col, text_col=text_col), "exact-classes")
    known = decided.filter(F.col("doc_id").isNotNull())
    per_id = known.groupBy("doc_id").agg(F.bool_or("kept").alias("some"), F.bool_and("kept").alias("all"))
    leaving = settle(per_id.filter("not all").select("doc_id", "some"), "leaving")
    present = docs.filter(F.col(f"`{id_col}`").isNotNull())
    stays = without(present, leaving.select("doc_id"), id_col)
    unknown, key = fresh(docs, "_unclear"), fresh(docs, "_key")
    unclear = leaving.filter("some").select(F.col("doc_id").alias(unknown))
    nameless = decided.filter(F.col("doc_id").isNull())
    if unclear.isEmpty() and nameless.isEmpty():
        return stays
    mixed = present.join(bounded(unclear), F.col(f"`{id_col}`") == F.col(unknown), "left_semi")
    mixed = mixed.unionByName(docs.filter(F.col(f"`{id_col}`").isNull()))
    sha = F.sha2(normalise(text_col), 256)
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    mixed = mixed.withColumn(key, F.concat_ws(":", name, sha)).dropDuplicates([key])
    keys = decided.filter("kept").select(
        F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_sha256").alias(key))
    return stays.unionByName(mixed.join(keys, key, "left_semi").drop(key))
