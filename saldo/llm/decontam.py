"""Benchmark passages in documents, also with other numbers, names and units.

Texts are brought to two forms. The named form has typed placeholders for numbers, names and
units. Names are told by their letter case, so the plain form has lower-case words and
placeholders for numbers only: there, neither letter case nor white space matters. Windows of
the words of a form are hash-joined. Matches on one diagonal (same distance between the places in
document and item) are one passage; there each value of an item must stand for one value of
the document throughout, else windows with that value do not count. Windows of the plain form that
are mostly numbers are matched with the numbers themselves.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import bounded, whole, without
from saldo.sources.scratch import settle

WINDOW = 8
#: Items of fewer words are found as they are only, whole and with their own numbers: a template of
#: them would fit too much. So are windows with more placeholders.
SHORTEST, MOST_SLOTS = 5, 4
#: A document holds an item if it has half of the item's windows of a form, or this many.
COVERAGE, ENOUGH = 0.5, 13

NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"
# The repeats are possessive: others hold a stack frame each, and long runs overflow it. Patterns begin with
# a character that is rare and looked up fast: a blank, a mark.
_NAMES = r"\s(?<=[\p{Ll},;]\s)\s*+(\p{Lu}\p{L}*+(?:\s++\p{Lu}\p{L}*+)*+)"
_NUMBERS = r"\p{Nd}++(?:[.,:/]\p{Nd}++)*+"
# Units that count as such after a number.
_UNITS = ("\u0002\\s{1,2}+(km|cm|mm|m|kg|mg|g|t|lb|lbs|oz|l|ml|s|ms|min|h|hours?|minutes?|seconds?|days?|"
          "weeks?|months?|years?|miles?|feet|ft|inch(?:es)?|meters?|metres?|grams?|litres?|liters?|"
          r"dollars?|euros?|cents?|percent|usd|eur|gbp)(?!\p{L})")
_SPLIT = "[^\\p{L}\\p{Nd}\u0001\u0002\u0003]+"

NAMED, PLAIN = "named", "plain"
FORMS = (NAMED, PLAIN)


def _unmarked(text: Column) -> Column:
    """The text without characters that stand for placeholders."""
    return F.translate(text, NAME + NUMBER + UNIT, "   ")


def _marked(text: Column) -> tuple[Column, Column, Column]:
    """The text after names, then numbers, then units were replaced; each placeholder is a word.

    Each step reads the one before once: inside of lambda functions nothing that is read twice is shared.
    """
    named = F.regexp_replace(text, _NAMES, f" {NAME} ")
    lowered = F.lower(F.regexp_replace(named, _NUMBERS, f" {NUMBER} "))
    united = F.regexp_replace(lowered, _UNITS, f"{NUMBER} {UNIT} ")
    return named, lowered, united


def literal_words(text: Column) -> Column:
    """Words and numbers of the text in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(_NUMBERS + r"|\p{L}+"), 0)


def _is_number(word: Column) -> Column:
    return F.substring(word, 1, 1).rlike(r"\p{Nd}")


def template(text: Column, form: str = NAMED) -> Column:
    """Words of the text in lower case, with the placeholders of the form.

    Those of the plain form are at the places of `literal_words`.
    """
    text = _unmarked(text)
    if form == PLAIN:
        marked = F.regexp_replace(F.lower(text), _NUMBERS, f" {NUMBER} ")
    else:
        marked = _marked(text)[2]
    return F.array_remove(F.split(marked, _SPLIT), "")


def _windows(text: Column, words: Column, sizes: list[int], form: str, item: bool) -> Column:
    """(at, window, literal) of all windows of these sizes: their places and hashes.

    Windows that are mostly placeholders have none in the named form. In the plain form they are
    `literal`: hashed with their values. An item has no other hash of them; a document has both,
    which is cheaper than telling the windows apart.
    """
    def hashed(hashes: Column, starts: Column, size: int, literal: bool) -> Column:
        return F.transform(starts, lambda i: F.struct(
            i.alias("at"), F.xxhash64(F.lit(form), F.lit(literal), *[F.get(hashes, i + j) for j in range(size)]).alias("window"),
            F.lit(literal).alias("literal")))

    def of_size(v: Column, size: int) -> Column:
        most, last = min(MOST_SLOTS, size // 2) if size >= SHORTEST else 0, F.size(v["h"]) - size
        every = F.sequence(F.lit(0), last)
        if not item and form == NAMED:
            return F.when(last >= 0, hashed(v["h"], every, size, False)).otherwise(none)
        # The first and the last of `most` + 1 placeholders in a row, if one window holds both.
        runs = F.filter(F.transform(v["spots"], lambda a, j: F.struct(a.alias("a"), F.get(v["spots"], j + most).alias("z"))),
                        lambda r: r["z"] - r["a"] < size)
        slotted = F.array_distinct(F.flatten(F.transform(runs, lambda r: F.filter(
            F.sequence(r["z"] - (size - 1), r["a"]), lambda i: (i >= 0) & (i <= last)))))
        found = hashed(v["h"], F.array_except(every, slotted) if item else every, size, False)
        if form == PLAIN:
            # The values are looked up only in texts that have such windows.
            values = F.transform(literal_words(_unmarked(text)), lambda w: F.xxhash64(w))
            valued = F.flatten(F.transform(F.array(values), lambda l: hashed(l, slotted, size, True)))
            found = F.when(F.size(v["spots"]) > most, F.concat(found, valued)).otherwise(found)
        return F.when(last >= 0, found).otherwise(none)

    none = F.array().cast("array<struct<at:int,window:bigint,literal:boolean>>")

    def parts(w: Column) -> Column:
        spots = F.filter(F.transform(w, lambda x, i: F.when(x <= UNIT, i)), lambda i: i.isNotNull())
        return F.struct(F.transform(w, lambda x: F.xxhash64(x)).alias("h"), *(
            [spots.alias("spots")] if item or form == PLAIN else []))

    # What is read again and again is bound to a variable, else each window would make it anew.
    bound = F.transform(F.array(words), parts)
    return F.element_at(F.transform(bound, lambda v: F.concat(*[of_size(v, size) for size in sizes])), 1)


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, literal, form, size, item_id, item_at, windows): windows of the items, settled.

    Items shorter than a window are a window of their own. `windows` counts those of an item
    in a form.
    """
    items = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), whole(text_col).alias("text"), *[
        template(whole(text_col), form).alias(form) for form in FORMS])
    items = settle(items.distinct(), "items")
    found = []
    for form in FORMS:
        for size in range(SHORTEST if form == NAMED else 1, WINDOW + 1):
            mine = items.filter(F.size(form) == size if size < WINDOW else F.size(form) >= WINDOW)
            placed = mine.select("item_id", F.explode(_windows(F.col("text"), F.col(form), [size], form, True)).alias("w"))
            found.append(placed.select("item_id", F.col("w.at").alias("item_at"), "w.window", "w.literal",
                                       F.lit(form).alias("form"), F.lit(size).alias("size")))
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    counts = every.groupBy("item_id", "form").agg(F.count_distinct("item_at").alias("windows"))
    return settle(every.join(counts, ["item_id", "form"]), "item-windows")


def matches(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_at, item_id, form, size, item_at, literal, windows) of all equal windows.

    The windows of the items are broadcast if they are counted and few, else both sides are
    shuffled by window; then all windows of the documents move.
    """
    kinds = sorted((r["form"], r["size"]) for r in windows.select("form", "size").distinct().collect())  # at most eight
    held = bounded(windows)
    found = None
    for form in FORMS:
        sizes = [s for f, s in kinds if f == form] or [WINDOW]
        words = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), whole(text_col).alias("text")).select(
            "doc_id", F.explode(_windows(F.col("text"), template(F.col("text"), form), sizes, form, False)).alias("w"))
        placed = words.select("doc_id", F.col("w.at").alias("doc_at"), "w.window")
        one = placed.join(held.filter(F.col("form") == form), "window").select(
            "doc_id", "doc_at", "item_id", "form", "size", "item_at", "literal", "windows")
        found = one if found is None else found.unionByName(one)
    return found


def _slots(text: Column) -> Column:
    """(form, at, kind, value) of each placeholder: its place among the words of the form, its text."""
    text = _unmarked(text)
    named, lowered, united = _marked(text)
    values = F.create_map(
        F.lit(NAME), F.transform(F.regexp_extract_all(text, F.lit(_NAMES), 1), lambda v: F.regexp_replace(v, r"\s+", " ")),
        F.lit(NUMBER), F.regexp_extract_all(named, F.lit(_NUMBERS), 0),
        F.lit(UNIT), F.regexp_extract_all(lowered, F.lit(_UNITS), 1))

    def of(v: Column) -> Column:
        def kind(mark: str) -> Column:
            spots = F.filter(F.transform(v["w"], lambda w, i: F.struct(i.alias("at"), w.alias("kind"))),
                             lambda s: s["kind"] == mark)
            return F.transform(spots, lambda s, i: F.struct(
                F.lit(NAMED).alias("form"), s["at"].alias("at"), s["kind"].alias("kind"),
                F.get(v["v"][mark], i).alias("value")))
        numbers = F.filter(F.transform(v["l"], lambda w, i: F.struct(
            F.lit(PLAIN).alias("form"), i.alias("at"), F.lit(NUMBER).alias("kind"), w.alias("value"))),
            lambda s: _is_number(s["value"]))
        return F.concat(kind(NAME), kind(NUMBER), kind(UNIT), numbers)

    words = F.filter(F.split(united, _SPLIT), lambda w: w != "")
    return F.element_at(F.transform(F.array(F.struct(
        words.alias("w"), values.alias("v"), literal_words(text).alias("l"))), of), 1)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_windows, coverage, n_slots, changed), one row for each item a document holds.

    An item is held if it is in either form; the figures are those of the form that covers more.
    `n_windows` counts the item's windows in consistent passages, `n_slots` the placeholders
    compared there, and `changed` those whose values differ: above 0, the item was given other
    values. Documents without id are searched, their id is null; rows that repeat an id count as one.
    Null and empty texts hold nothing; no documents or no items give no rows; other columns
    are not read.
    """
    windows = item_windows(benchmark, item_col, item_text)
    found = matches(docs, windows, id_col, text_col).withColumn("shift", F.col("doc_at") - F.col("item_at"))
    found = settle(found, "window-matches")
    items = settle(benchmark.select(
        F.col(f"`{item_col}`").alias("item_id"), F.explode(_slots(whole(item_text))).alias("slot"))
        .select("item_id", "slot.*").distinct(), "item-slots")
    # Only documents with placeholders in such windows are read again.
    inside = (F.col("at") >= F.col("item_at")) & (F.col("at") < F.col("item_at") + F.col("size"))
    placed = found.filter("not literal").join(bounded(items), ["item_id", "form"]).filter(inside).select(
        "doc_id", "item_id", "form", "shift", "kind", F.lower("value").alias("of_item"), F.col("at").alias("item_spot"),
        (F.col("at") + F.col("shift")).alias("at")).distinct()
    placed = settle(placed, "placed-slots")
    wanted = settle(placed.select(F.col("doc_id").alias("_id")).distinct(), "slot-docs")
    read = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), whole(text_col).alias("text"))
    values = read.join(bounded(wanted), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select(
        "doc_id", F.explode(_slots(F.col("text"))).alias("slot")).select(
        F.col("doc_id").alias("_id"), F.col("slot.form").alias("_form"), F.col("slot.at").alias("_at"),
        F.col("slot.kind").alias("_kind"), F.lower("slot.value").alias("of_doc"))
    paired = placed.join(values, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("at") == F.col("_at"))
                         & (F.col("form") == F.col("_form")) & (F.col("kind") == F.col("_kind")))
    per_value = settle(paired.groupBy("doc_id", "item_id", "form", "shift", "kind", "of_item").agg(
        F.count_distinct("of_doc").alias("values"), F.collect_set("item_spot").alias("spots"),
        F.max(F.col("of_doc") != F.col("of_item")).alias("differs")), "values")
    # Places of an item are few, so are those of them that are held against a passage.
    broken = per_value.filter("values > 1").groupBy("doc_id", "item_id", "form", "shift").agg(
        F.flatten(F.collect_list("spots")).alias("broken")).select(
        F.col("doc_id").alias("_id"), F.col("item_id").alias("_item"), F.col("form").alias("_form"),
        F.col("shift").alias("_shift"), "broken")
    within = F.exists(F.coalesce("broken", F.array().cast("array<int>")), lambda at: (
        (at >= F.col("item_at")) & (at < F.col("item_at") + F.col("size"))))
    counted = found.join(
        broken, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("item_id") == F.col("_item"))
        & (F.col("form") == F.col("_form")) & (F.col("shift") == F.col("_shift")), "left").filter(
        F.col("literal") | ~within)
    # Words put in or left out move the diagonal: what an item has on several counts together.
    per_form = counted.groupBy("doc_id", "item_id", "form").agg(
        F.count_distinct("item_at").alias("n_windows"), F.first("windows").alias("windows"))
    compared = per_value.filter("values = 1").groupBy("doc_id", "item_id", "form").agg(
        F.sum(F.size("spots")).alias("slots"), F.sum(F.when(F.col("differs"), F.size("spots")).otherwise(0)).alias("changed")).select(
        F.col("doc_id").alias("_id"), F.col("item_id").alias("_item"), F.col("form").alias("_form"), "slots", "changed")
    per_form = per_form.join(compared, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("item_id") == F.col("_item"))
                             & (F.col("form") == F.col("_form")), "left")
    share = F.col("n_windows") / F.col("windows")
    held = per_form.filter((share >= COVERAGE) | (F.col("n_windows") >= ENOUGH)).select(
        "doc_id", "item_id", F.struct(share.alias("coverage"), "n_windows", F.coalesce("slots", F.lit(0)).alias("n_slots"),
                                      F.coalesce("changed", F.lit(0)).alias("changed")).alias("best"))
    return held.groupBy("doc_id", "item_id").agg(F.max("best").alias("best")).select(
        "doc_id", "item_id", "best.n_windows", "best.coverage", "best.n_slots", "best.changed")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that hold no item; rows without id stay."""
    held = leaks(docs, benchmark, id_col, text_col).select("doc_id").distinct()
    return without(docs, settle(held, "contaminated"), id_col)
