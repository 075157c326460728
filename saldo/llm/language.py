"""Language of a text: known words first, character n-grams of falling length for others.

A word the model knows scores by its log frequency in each language. Another word scores by the
mean over its n-grams of the longest length of which the model knows any. A text takes the
language with the largest sum.
"""

import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import fresh, importable
from saldo.sources.scratch import settle

UNKNOWN = "und"
LONGEST = 5
#: Fitting reads about this many documents of each language, chosen by a hash of their texts.
SAMPLE_DOCS = 2_000
#: The model has at most this many words, and n-grams of each length, of each language.
MODEL_ROWS = 30_000
#: Texts that a word or n-gram must occur in: one text cannot make its own words familiar.
_LEAST_TEXTS = 2

_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 200_000


def _has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def words_of(text: str) -> list[str]:
    """Runs of letters, lower case."""
    return [w for w in _WORD.findall(text.lower()) if _has_letter(w)]


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i: i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    """Log frequencies: `entries` are words, and n-grams with their length before them.

    The driver holds them as plain columns; a worker makes what it looks up from them.
    """

    languages: list[str]
    entries: pa.Array
    table: np.ndarray

    @cached_property
    def _rows(self) -> list[dict[str, int]]:
        """Rows of the words, then of the n-grams of each length; a worker holds each entry once."""
        out: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        for row, entry in enumerate(self.entries):
            entry = entry.as_py()
            if entry[1:2] == "|":
                out[int(entry[0])][entry[2:]] = row
            else:
                out[0][entry] = row
        return out

    def evidence(self, word: str) -> tuple[np.ndarray | None, float]:
        """Log frequency in each language, and how familiar the word is: 1 if known, else by its longest n-grams."""
        row = self._rows[0].get(word)
        if row is not None:
            return self.table[row], 1.0
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            known = [r for r in map(self._rows[n].get, grams(word, n)) if r is not None]
            if known:
                return np.add.reduce(self.table[known]) / len(known), n / (LONGEST + 1)
        return None, 0.0

    def predict(self, text: str | None, seen: "Seen") -> tuple[str, float, float]:
        """Language, its posterior share, and the mean familiarity of the words; `seen` keeps the evidence of words."""
        counts = Counter(_WORD.findall(text.lower())) if text else {}
        if not self.languages or not any(_has_letter(w) for w in counts):
            return UNKNOWN, 0.0, 0.0
        sums = np.fromiter(counts.values(), np.float64, len(counts)) @ seen.evidence(counts)
        total, (familiar, words) = sums[:-2], sums[-2:]
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum()), float(familiar / words)


class Seen:
    """Evidence of the words met so far, a row each; emptied when it holds `_CACHE` words.

    Two columns follow those of the languages: how familiar the word is, and 1 if it is one.
    """

    def __init__(self, model: Model):
        self._model = model
        self._forget()

    def _forget(self) -> None:
        self._places: dict[str, int] = {}
        self._table = np.zeros((1024, len(self._model.languages) + 2))

    def evidence(self, words: Collection[str]) -> np.ndarray:
        if len(self._places) >= _CACHE:
            self._forget()
        at = [self._places.get(w) for w in words]
        if None in at:
            at = [self._add(w) if i is None else i for w, i in zip(words, at)]
        return self._table[at]

    def _add(self, word: str) -> int:
        place = self._places[word] = len(self._places)
        if place == len(self._table):
            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
        if _has_letter(word):
            found, familiar = self._model.evidence(word)
            if found is not None:
                self._table[place, :-2] = found
            self._table[place, -2:] = familiar, 1.0
        return place


def _counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, word, n, texts): occurrences and texts that have the word, added up in each task first."""

    def count(batches):
        for batch in batches:
            seen: Counter = Counter()
            texts: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                of_text = Counter((lang, w) for w in words_of(text.as_py()))
                seen.update(of_text)
                texts.update(of_text.keys())
            if seen:
                (langs, words), n = zip(*seen), list(seen.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64()),
                     pa.array([texts[key] for key in seen], pa.int64())], ["lang", "word", "n", "texts"])

    read = importable(docs).select(F.col(f"`{lang}`").cast("string"), F.col(f"`{text}`").cast("string"))
    return read.mapInArrow(count, "lang string, word string, n bigint, texts bigint")


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text",
        sample_docs: int = SAMPLE_DOCS, model_rows: int = MODEL_ROWS) -> Model:
    """Model from the rows with a language and a text; from none, one that knows no language.

    The sample is bounded for each language: of `n` documents a share of sample_docs / n, by a
    hash of the text, so a larger table does not make fitting dearer than one more scan.
    """
    rows = labelled.filter(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    sizes = rows.groupBy(F.col(f"`{lang_col}`").alias("lang")).count().collect()  # one row a language
    if not sizes:
        return Model([], pa.array([], pa.string()), np.zeros((0, 0)))
    shares = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, sample_docs / r["count"]))])
    place = F.pmod(F.xxhash64(F.col(f"`{text_col}`")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(place < F.element_at(shares, F.col(f"`{lang_col}`").cast("string")))
    counted = _counts(sample, lang_col, text_col).groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    lengths = F.array(*[F.lit(n) for n in range(1, LONGEST + 1)])
    spans = F.flatten(F.transform(lengths, lambda n: F.when(F.length(padded) >= n, F.transform(
        F.sequence(F.lit(1), F.length(padded) - n + 1),
        lambda i: F.concat(n.cast("string"), F.lit("|"), F.substring(padded, i, n)),
    )).otherwise(F.array().cast("array<string>"))))
    gram = counted.select("lang", F.explode(spans).alias("entry"), "n", "texts").groupBy("lang", "entry").agg(
        F.sum("n").alias("n"), F.sum("texts").alias("texts")).withColumn("kind", F.substring("entry", 1, 1))
    word = counted.select("lang", F.col("word").alias("entry"), "n", "texts", F.lit("0").alias("kind"))
    entries = word.unionByName(gram)
    group = Window.partitionBy("lang", "kind")
    # The sums are over all entries, the cut to the most frequent comes after.
    ranked = entries.withColumn("total", F.sum("n").over(group)).withColumn(
        "rank", F.row_number().over(group.orderBy(F.desc("n"), "entry")))
    kept = ranked.filter((F.col("rank") <= model_rows) & (F.col("texts") >= _LEAST_TEXTS))
    kept = settle(kept.select("lang", "kind", "entry", "n", "total"), "language-model")
    languages = sorted(r["lang"] for r in sizes)
    totals = {(r["lang"], r["kind"]): r["total"] for r in kept.groupBy("lang", "kind").agg(F.max("total").alias("total")).collect()}
    # One row an entry, its numbers as columns of Arrow: rows of Python would take ten times the memory.
    numbers = [F.max(F.when(F.col("lang") == lang, F.col("n"))).alias(f"n{i}") for i, lang in enumerate(languages)]
    found = kept.groupBy("entry").agg(*numbers).toArrow()
    entries = found.column("entry").combine_chunks()
    kinds = pc.if_else(pc.equal(pc.utf8_slice_codeunits(entries, 1, 2), "|"), pc.utf8_slice_codeunits(entries, 0, 1), "0").dictionary_encode()
    table = np.empty((len(entries), len(languages)))
    for i, lang in enumerate(languages):
        of_kind = np.array([totals.get((lang, kind), 1) for kind in kinds.dictionary.to_pylist()], np.float64)
        total = of_kind[kinds.indices.to_numpy()]
        n = found.column(f"n{i}").to_numpy()
        # What a language lacks counts as half an occurrence among all it has.
        table[:, i] = np.log(np.where(np.isnan(n), 0.5, n) / total)
    return Model(languages, entries, table)


def judged(docs: DataFrame, model: Model, into: str, text_col: str = "text") -> DataFrame:
    """`docs` with a struct of lang_pred, score and familiar in the new column `into`.

    `familiar` is the mean over the words of a text: 1 for a word of the model, else the length of
    its longest known n-grams by one more than the longest. It does not grow with the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MODEL_ROWS

    @F.pandas_udf("lang_pred string, score double, familiar double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        seen = Seen(shared.value)
        for batch in batches:
            yield pd.DataFrame([shared.value.predict(t, seen) for t in batch], columns=["lang_pred", "score", "familiar"])

    return importable(docs).withColumn(into, judge(F.col(f"`{text_col}`").cast("string")))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score, which replace columns of these names; all others stay.

    `und` with score 0 where the text is null or has no letter, or the model knows no language.
    """
    into = fresh(docs, "_found")
    found = judged(docs, model, into, text_col)
    return found.withColumns({c: F.col(into)[c] for c in ("lang_pred", "score")}).drop(into)
