"""Secrets in texts, found through an inverted index of trigrams.

From each rule's pattern follows a Boolean query of trigrams that every match must contain: an
alternative of conjunctions. The index lists, for each trigram that a query asks for, the
documents that have it; lists are intersected for each conjunction, and only documents that
satisfy a query are searched with its pattern. A rule without mandatory trigrams searches all.
"""

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import bounded, whole
from saldo.sources.scratch import settle


@dataclass(frozen=True)
class Rule:
    """`least` characters of group `group` make a match of `pattern` a finding."""

    kind: str
    pattern: str
    least: int
    group: int = 0


# Kinds in the order in which spans of one start are listed, and their patterns.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),  # as runs of 1 or more, of which short ones are dropped
)

_GAP = None  # in a sequence of characters: anything
_MOST_ALTERNATIVES = 256

Clause = tuple[str, ...]


def _alternatives(parsed) -> list[tuple]:
    """Sequences of characters and gaps, one of which every match follows."""
    out = [()]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            own = [(chr(value).lower(),)]
        elif name == "SUBPATTERN":
            own = _alternatives(value[3])
        elif name == "BRANCH":
            own = [a for branch in value[1] for a in _alternatives(branch)]
        elif name == "MAX_REPEAT":
            least, most, item = value
            inner = _alternatives(item)
            if least == 0:
                own = [(), *inner] if most == 1 else [(_GAP,)]
            else:
                own = [a if (least, most) == (1, 1) else (*a, _GAP) for a in inner]
        elif name == "AT":
            continue
        else:
            own = [(_GAP,)]
        if len(out) * len(own) > _MOST_ALTERNATIVES:
            own = [(_GAP,)]
        out = list(dict.fromkeys(a + b for a, b in product(out, own)))
    return out


def trigram_query(pattern: str) -> list[Clause] | None:
    """Conjunctions of lower-case trigrams of which any match satisfies one; None if there is none."""
    clauses = set()
    for sequence in _alternatives(re._parser.parse(pattern)):
        runs = "".join("\0" if c is _GAP else c for c in sequence).split("\0")
        grams = {r[i: i + 3] for r in runs for i in range(len(r) - 2)}
        if not grams:
            return None
        clauses.add(tuple(sorted(grams)))
    return sorted(clauses)


def index(docs: DataFrame, trigrams: Sequence[str], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, trigram) of the lower-cased texts, for the trigrams that some query asks for."""
    wanted = F.array(*[F.lit(t) for t in sorted(trigrams)])
    # A text is lowered once and then searched for each trigram.
    present = F.element_at(F.transform(
        F.array(F.lower(whole(text_col))), lambda low: F.filter(wanted, lambda t: F.contains(low, t))), 1)
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.explode(present).alias("trigram"))


def candidates(docs: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc_id, kinds): which indexed rules may match. Ids that repeat share their kinds."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    clauses = [(kind, number, gram, len(clause)) for kind, query in queries.items() if query
               for number, clause in enumerate(query) for gram in clause]
    spark = docs.sparkSession
    schema = "kind string, clause int, trigram string, size int"
    asked = spark.createDataFrame(clauses, schema)  # as many rows as the rules have trigrams
    postings = index(docs, {c[2] for c in clauses}, id_col, text_col)
    met = (
        postings.join(F.broadcast(asked), "trigram")
        .groupBy("doc_id", "kind", "clause", "size").agg(F.count_distinct("trigram").alias("met"))
        .filter(F.col("met") == F.col("size"))
    )
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))  # at most the rules


def spans_of(text: Column, rule: Rule) -> Column:
    """Findings of one rule as an array of (start, end), in code points, end exclusive.

    Matches are leftmost and do not overlap, so they and the texts between them, in turn, are
    the whole text, and their lengths give the places.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    lengths = F.transform(F.regexp_extract_all(text, pattern, 0), F.length)
    values = F.transform(F.regexp_extract_all(text, pattern, rule.group), F.length)
    steps = F.arrays_zip(gaps.alias("gap"), lengths.alias("length"), values.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("found"))

    def step(state: Column, one: Column) -> Column:
        begin = state["at"] + one["gap"]
        end = begin + F.coalesce(one["length"], F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"))
        hit = F.coalesce(one["value"], F.lit(-1)) >= rule.least
        found = F.when(hit, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(steps, start, step, lambda state: state["found"])


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, findings), one row for each row of `docs`; findings are (start, order, kind, end).

    Findings are sorted by start, then in the order of the rules. Null texts are empty; rows
    without id and rows that repeat one are searched like others. No rows give no rows; other
    columns are not read. Only ids of candidates move; texts move if those ids are too many
    to broadcast.
    """
    found = settle(candidates(docs, rules, id_col, text_col), "candidates")
    indexed = {r.kind for r in rules if trigram_query(r.pattern)}
    read = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), whole(text_col).alias("text"))
    keyed = found.select(F.col("doc_id").alias("_id"), "kinds")
    joined = read.join(bounded(keyed), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")

    def of(order: int, rule: Rule) -> Column:
        asked = F.col("text").rlike(rule.pattern)
        if rule.kind in indexed:
            asked = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)) & asked
        spans = F.when(asked, spans_of(F.col("text"), rule)).otherwise(none)
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"),
            s["end"].alias("end")))

    every = F.array_sort(F.concat(*[of(i, r) for i, r in enumerate(rules)]))
    return joined.select("doc_id", every.alias("findings"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the findings of each kind, all spans as one text, and its SHA-256."""
    listed = F.array_join(F.transform("findings", lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return scanned.select("doc_id", *[count(r.kind) for r in RULES], listed.alias("spans")).select(
        "doc_id", *[f"n_{r.kind}" for r in RULES], F.sha2("spans", 256).alias("base_sha256"), "spans")
