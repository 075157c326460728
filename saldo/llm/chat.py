"""Chat formatting by perspective rotation: each speaker in turn is the assistant.

A dialogue of several speakers is rendered once for each of them: their turns as those of the
assistant, all others as turns of named users. The mask lists where the text of the assistant
stands, on which alone a model is trained. System turns are context for every perspective.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import bounded, whole
from saldo.sources.scratch import settle

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM, NOBODY = "system", "unknown"
#: The rendering of a dialogue of more turns is stored in parts, so that no group of rows is unbounded.
PART_TURNS = 64


def _rows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv_id, turn, speaker, text), repeated rows once."""
    return turns.select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(NOBODY)).alias("speaker"),
        whole(text_col).alias("text"),
    ).distinct()


def parts(turns: DataFrame, part_turns: int = PART_TURNS, **columns: str) -> DataFrame:
    """(conv_id, part, turns): turns of a part in order, repeated rows once; the number of a turn gives its part."""
    rows = _rows(turns, **columns).withColumn(
        "part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(0)).cast("bigint"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "speaker", "text")))
    return rows.groupBy("conv_id", "part").agg(ordered.alias("turns"))


def _header(turn: Column, perspective: Column) -> Column:
    name = F.when(turn["speaker"] == SYSTEM, SYSTEM).when(turn["speaker"] == perspective, "assistant")
    return F.concat(F.lit(BEGIN), F.coalesce(name, F.concat(F.lit("user name="), turn["speaker"])), F.lit("\n"))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS, **columns: str) -> DataFrame:
    """(conv_id, part, perspective, rendered, mask, n_turns, n_masked), each part a text of its own.

    For texts of bounded length; `rotate_dialogues` gives whole dialogues. One row for each part of a dialogue and each speaker in it but the system; `mask` is an
    array of (start, end) in code points of `rendered`, end exclusive, the end mark included.
    Rows without a conversation are one conversation of their own, without a turn they come
    first, without a role they are by `unknown`; a null text is empty; turns of one number are
    ordered by speaker and text. A part of system turns only gives no row, and no rows give
    none; other columns are not read.
    """
    grouped = parts(turns, part_turns, **columns)
    speakers = F.array_sort(F.array_distinct(F.filter(F.col("turns.speaker"), lambda s: s != SYSTEM)))
    rotated = grouped.select("conv_id", "part", "turns", F.explode(speakers).alias("perspective"))
    who = F.col("perspective")
    pieces = F.transform("turns", lambda t: F.concat(_header(t, who), t["text"], F.lit(END)))
    spans = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_header(turn, who))
        end = begin + F.length(turn["text"]) + len(END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        mask = F.when(turn["speaker"] == who, F.concat(state["mask"], span)).otherwise(state["mask"])
        return F.struct(end.alias("at"), mask.alias("mask"))

    first = F.struct(F.lit(0).alias("at"), spans.alias("mask"))
    mask = F.aggregate("turns", first, step, lambda state: state["mask"])
    masked = F.aggregate("mask", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return rotated.select(
        "conv_id", "part", "perspective", F.concat_ws("", pieces).alias("rendered"), mask.alias("mask"),
        F.size("turns").cast("bigint").alias("n_turns"),
    ).withColumn("n_masked", masked.cast("bigint"))


def _dialogue_parts(rows: DataFrame, part_turns: int) -> DataFrame:
    """(conv_id, part, turns): the turns of a dialogue by their place in it, `part_turns` to a part.

    Turns are dealt by range, so one dialogue may lie in many blocks; its turns are counted block by block.
    """
    order = ["turn", "speaker", "text"]
    before, block = Window.partitionBy("conv_id").orderBy("block"), Window.partitionBy("conv_id", "block").orderBy(*order)
    counts = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    # Only dialogues that cross blocks have earlier turns: one row a block at most.
    earlier = counts.withColumn("earlier", F.sum("n").over(before) - F.col("n")).filter("earlier > 0")
    earlier = settle(earlier.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "earlier"), "earlier-turns")
    place = F.coalesce("earlier", F.lit(0)) + F.col("place") - 1
    placed = rows.withColumn("place", F.row_number().over(block)).join(
        bounded(earlier), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")), "left")
    placed = placed.withColumn("part", F.floor(place / part_turns).cast("bigint"))
    return placed.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("turns"))


def rotate_dialogues(turns: DataFrame, part_turns: int = PART_TURNS, **columns: str) -> DataFrame:
    """(conv_id, part, perspective, rendered, mask, n_turns, n_masked) of whole dialogues.

    The parts of a dialogue and perspective in order, put together, are the one rendering of all
    turns, and `mask` gives places in that: only what is stored is split. Each speaker of the
    dialogue but the system has every part. Odd rows are taken as by `rotate`.
    """
    rows = _rows(turns, **columns).repartitionByRange("conv_id", "turn", "speaker", "text")
    rows = settle(rows.withColumn("block", F.spark_partition_id()), "turns")
    grouped = settle(_dialogue_parts(rows, part_turns), "dialogue-parts")
    voices = settle(rows.filter(F.col("speaker") != SYSTEM).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct(), "voices")
    who = F.col("perspective")
    rotated = grouped.join(bounded(voices), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    # Where parts begin: sums of `part_turns` parts, then parts within them.
    length = F.aggregate("turns", F.lit(0).cast("bigint"), lambda n, t: (
        n + F.length(_header(t, who)) + F.length(t["text"]) + len(END)))
    sizes = settle(rotated.select("conv_id", "perspective", "part", F.floor(F.col("part") / part_turns).alias("group"),
                                  length.alias("size")), "part-sizes")
    dialogue, inner = ["conv_id", "perspective"], ["conv_id", "perspective", "group"]
    groups = sizes.groupBy(*inner).agg(F.sum("size").alias("size")).withColumn(
        "before", F.sum("size").over(Window.partitionBy(*dialogue).orderBy("group")) - F.col("size")).filter("before > 0")
    groups = settle(groups.select(F.col("conv_id").alias("_conv"), F.col("perspective").alias("_who"),
                                  F.col("group").alias("_group"), "before"), "part-groups")
    within = F.sum("size").over(Window.partitionBy(*inner).orderBy("part")) - F.col("size")
    begins = sizes.withColumn("within", within).join(
        bounded(groups), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("perspective") == F.col("_who"))
        & (F.col("group") == F.col("_group")), "left").select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("perspective").alias("_who"),
        (F.col("within") + F.coalesce("before", F.lit(0))).alias("begin")).filter("begin > 0")
    begins = settle(begins, "part-begins")
    placed = rotated.join(bounded(begins), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
                          & (who == F.col("_who")), "left")

    spans = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_header(turn, who))
        end = begin + F.length(turn["text"]) + len(END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        mask = F.when(turn["speaker"] == who, F.concat(state["mask"], span)).otherwise(state["mask"])
        return F.struct(end.alias("at"), mask.alias("mask"))

    first = F.struct(F.coalesce("begin", F.lit(0).cast("bigint")).alias("at"), spans.alias("mask"))
    pieces = F.transform("turns", lambda t: F.concat(_header(t, who), t["text"], F.lit(END)))
    return placed.select(
        "conv_id", "part", "perspective", F.concat_ws("", pieces).alias("rendered"),
        F.aggregate("turns", first, step, lambda state: state["mask"]).alias("mask"),
        F.size("turns").cast("bigint").alias("n_turns"),
    ).withColumn("n_masked", F.aggregate("mask", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]))
