"""Licence notices and identifier tags in texts.

An Aho-Corasick automaton finds notice phrases among the words of a text, and identifier tags in
the text itself. What follows a tag is an expression of identifiers with `or`, `and` and `with`;
a shunting-yard parser brings it to postfix order, and its value says how far the licence reaches.
"""

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import importable

# The base phrases with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notices, as words, with their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "boost software license": "boost",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "reserved",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
# Tags before an expression.
TAGS = ("spdx-license-identifier:", "license-expression:")

# How far a licence reaches, from free to closed.
REACH = ("public-domain", "permissive", "weak-copyleft", "copyleft", "network-copyleft", "noncommercial", "unknown")
# Beginnings of identifiers (up to a dash or the end), their label and reach.
FAMILIES = {
    "0bsd": ("bsd", "public-domain"), "cc0": ("cc0", "public-domain"), "unlicense": ("unlicense", "public-domain"),
    "mit": ("mit", "permissive"), "apache": ("apache", "permissive"), "bsd": ("bsd", "permissive"),
    "isc": ("isc", "permissive"), "zlib": ("zlib", "permissive"), "bsl": ("boost", "permissive"),
    "cc-by": ("cc-by", "permissive"), "cc-by-sa": ("cc-by-sa", "copyleft"), "cc-by-nc": ("cc-by-nc", "noncommercial"),
    "lgpl": ("lgpl", "weak-copyleft"), "mpl": ("mpl", "weak-copyleft"), "epl": ("epl", "weak-copyleft"),
    "gpl": ("gpl", "copyleft"), "gfdl": ("gfdl", "copyleft"), "agpl": ("agpl", "network-copyleft"),
}
# Beginnings of exceptions that let other code link to a copyleft work.
LINKING = ("classpath-exception", "gcc-exception", "llvm-exception", "linux-syscall-note", "bison-exception",
           "autoconf-exception", "font-exception", "openjdk-assembly-exception")

#: Share of doubt that a notice, and a parsed expression, leaves.
_DOUBT_NOTICE, _DOUBT_TAG = 0.5, 0.05

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = bytes.maketrans(_UPPER, _LOWER)
_TO_WORDS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in _TO_LOWER)
_TOKEN = re.compile(r"[()]|[a-z0-9.+:_-]+|\S")
#: Where an expression ends: the line, or the comment around it.
_END = re.compile(r"[\r\n]|\*/|-->|['\"]")
_RANK = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str] | None:
    """Identifiers and operators of a lower-case expression in postfix order; None if it is malformed."""
    out: list[str] = []
    held: list[str] = []
    operand = False  # whether the token before ends an operand
    for token in _TOKEN.findall(expression):
        if token == "(":
            if operand:
                return None
            held.append(token)
        elif token == ")":
            if not operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif token in _RANK:
            if not operand:
                return None
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[token]:
                out.append(held.pop())
            held.append(token)
            operand = False
        else:
            if operand or not token[0].isalnum():
                return None
            out.append(token)
            operand = True
    if not operand or "(" in held:
        return None
    return out + held[::-1]


@cache
def family(identifier: str) -> tuple[str, str]:
    """Label and reach of an identifier; an unknown one is its own label."""
    name = identifier.removesuffix("+")
    while name:
        if name in FAMILIES:
            return FAMILIES[name]
        name = name.rpartition("-")[0]
    return identifier.removesuffix("+"), REACH[-1]


def evaluate(order: list[str]) -> tuple[list[str], str] | None:
    """Labels and reach of a postfix expression; None if `with` does not join a licence and an exception.

    Of `or` the reader may choose the freer side, of `and` both hold. An exception for linking
    makes a copyleft licence weak; others leave it as it is.
    """
    stack: list[tuple[int, str | None]] = []  # reach, and the identifier if it is one alone
    labels: set[str] = set()
    exceptions: set[str] = set()
    for token in order:
        if token not in _RANK:
            stack.append((REACH.index(family(token)[1]), token))
            continue
        (right, second), (left, first) = stack.pop(), stack.pop()
        if token == "with":
            if first is None or second is None:
                return None
            labels.add(family(first)[0])
            exceptions.add(second)
            linking = second.startswith(LINKING) and REACH[left] in ("copyleft", "network-copyleft")
            stack.append((REACH.index("weak-copyleft") if linking else left, None))
        else:
            labels.update(family(t)[0] for t in (first, second) if t is not None)
            stack.append((min(left, right) if token == "or" else max(left, right), None))
    reach, alone = stack.pop()
    if alone is not None:
        labels.add(family(alone)[0])
    return sorted(labels), REACH[reach]


@cache
def _automaton(of: str):
    import ahocorasick

    found = ahocorasick.Automaton()
    if of == "phrases":
        for phrase in {**NOTICES, **BASE}:
            found.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
    else:
        for tag in TAGS:
            found.add_word(tag, tag)
    found.make_automaton()
    return found


def notices(text: bytes) -> tuple[int, list[tuple[str, str, int, int]]]:
    """Number of words, and (kind, label, first word, end) of every place of a phrase."""
    words = text.translate(_TO_WORDS).split()
    # Each byte is a character here: the phrases are ASCII, and other words need not be read.
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found, at, passed = [], 0, 0
    for end, (phrase, n) in _automaton("phrases").iter(joined):
        passed += joined.count(" ", at, end)  # the words that end before this blank
        at = end
        kind = "base" if phrase in BASE else "notice"
        found.append((kind, BASE.get(phrase) or NOTICES[phrase], passed - n, passed))
    return len(words), found


def tagged(text: bytes) -> list[tuple[int, str, str | None, list[str]]]:
    """(place, expression, reach, labels) after each tag; no reach and labels if it is malformed."""
    low = text.translate(_TO_LOWER).decode("utf-8", "replace")
    out = []
    for end, _ in _automaton("tags").iter(low):
        stop = _END.search(low, end + 1)
        expression = low[end + 1: stop.start() if stop else len(low)].strip()
        order = postfix(expression)
        value = evaluate(order) if order else None
        out.append((end + 1, expression, value and value[1], value[0] if value else []))
    return out


_FOUND = ("doc_id bigint, n_words bigint, notices array<struct<kind:string,label:string,start:bigint,end:bigint>>, "
          "expressions array<struct<at:bigint,text:string,reach:string,labels:array<string>>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, notices, expressions) of every row.

    Places of notices are words from 0, their ends exclusive; overlapping ones all count. Places
    of expressions are characters. A null text is empty: no words, no notices. Rows without id
    or with a repeated one are scanned like others; other columns are not read. A malformed
    expression is listed without reach.
    """
    shape = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("notices", pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
        ("expressions", pa.list_(pa.struct([("at", pa.int64()), ("text", pa.string()), ("reach", pa.string()),
                                            ("labels", pa.list_(pa.string()))])))])
    spots, expressions = shape.field("notices").type, shape.field("expressions").type
    names = [[f.name for f in t.value_type] for t in (spots, expressions)]

    def find(batches):
        for batch in batches:
            counts, phrases, tags = [], [], []
            for value in batch.column(1):
                text = value.as_py() or b""
                n, found = notices(text)
                counts.append(n)
                phrases.append([dict(zip(names[0], f)) for f in found])
                tags.append([dict(zip(names[1], f)) for f in tagged(text)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(phrases, spots), pa.array(tags, expressions)],
                schema=shape)

    read = importable(docs).select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                                   F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return read.mapInArrow(find, _FOUND)


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def digest(found: DataFrame) -> DataFrame:
    """One flat row for each scanned one.

    `score` is the trust in the labels: each notice halves the doubt, each parsed expression
    leaves a twentieth. `reach` is the widest of the parsed expressions.
    """
    base = F.filter("notices", lambda n: n["kind"] == "base")
    starts = F.transform(base, lambda n: n["start"])
    labels = lambda of: F.transform(of, lambda n: n["label"])
    parsed = F.filter("expressions", lambda e: e["reach"].isNotNull())
    of_tags = F.flatten(F.transform(parsed, lambda e: e["labels"]))
    ranks = F.transform(parsed, lambda e: F.array_position(F.array(*map(F.lit, REACH)), e["reach"]))
    doubt = F.pow(F.lit(_DOUBT_NOTICE), F.size("notices")) * F.pow(F.lit(_DOUBT_TAG), F.size(parsed))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _joined(labels(base)).alias("base_labels"),
        _joined(F.concat(labels(F.col("notices")), of_tags)).alias("labels"),
        (1 - doubt).alias("score"),
        F.get(F.array(*map(F.lit, REACH)), (F.array_max(ranks) - 1).cast("int")).alias("reach"))
