"""Whole results of queries without SQL, against plain Python over all rows of their tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

from saldo.llm import language, queries, urls
from tests.llm.test_operators import FOLDER, tokenizer
from tests.llm.test_urls import purities


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def words(text):
    return [w for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if any(map(str.isalpha, w))]


def pieces(word, n):
    padded = f" {word} "
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def learn(texts):
    """{(lang, length): {entry: log frequency}} and what an absent entry has; length 0 is words."""
    counts, holders = defaultdict(Counter), defaultdict(Counter)
    for lang, text in texts:
        of_text = Counter(words(text))
        for word, n in of_text.items():
            counts[lang, 0][word] += n
            holders[lang, 0][word] += 1
    for (lang, _), found in list(counts.items()):
        for word, n in found.items():
            for length in range(1, language.LONGEST + 1):
                for piece in pieces(word, length):
                    counts[lang, length][piece] += n
                    holders[lang, length][piece] += holders[lang, 0][word]
    known, totals = defaultdict(dict), {}
    for key, found in counts.items():
        first = sorted(found, key=lambda e: (-found[e], e))[:language.MODEL_ROWS]
        known[key] = {e: found[e] for e in first if holders[key][e] >= 2}
        totals[key] = sum(found.values())
    return known, totals


def test_languages_equal_plain_python(spark):
    docs = table(spark, "documents").select("doc_id", "text", "lang").collect()
    known, totals = learn([(d.lang, d.text) for d in docs if d.lang is not None and d.text is not None and not held_out(d.doc_id)])
    langs = sorted({lang for lang, _ in known})
    of_length = [set().union(*(known[lang, n] for lang in langs)) for n in range(language.LONGEST + 1)]
    logs = lambda n, e: [math.log(known[lang, n].get(e, 0.5) / totals[lang, n]) for lang in langs]

    def evidence(word):
        if word in of_length[0]:
            return logs(0, word)
        for n in range(language.LONGEST, 0, -1):
            if found := [p for p in pieces(word, n) if p in of_length[n]]:
                return [sum(column) / len(found) for column in zip(*(logs(n, p) for p in found))]
        return [0.0] * len(langs)

    seen, expected = {}, {}
    for d in docs:
        sums = [0.0] * len(langs)
        of_text = Counter(words(d.text))
        for word, n in of_text.items():
            if word not in seen:
                seen[word] = evidence(word)
            sums = [s + n * e for s, e in zip(sums, seen[word])]
        best = max(sums)
        expected[d.doc_id] = (langs[sums.index(best)], 1 / sum(math.exp(s - best) for s in sums)) if of_text else ("und", 0.0)
    ours = queries.op1_language_id(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in ours) == sorted(expected) and len(ours) == len(docs)
    for r in ours:
        lang, score = expected[r.doc_id]
        assert (r.lang_pred, r.held_out) == (lang, held_out(r.doc_id)) and abs(r.score - score) < 1e-6


def test_token_totals_equal_a_recount(spark):
    library = tokenizer("byte_bpe_50k.json")
    toxic = {r.doc_id for r in table(spark, "labels").collect() if r.toxic == 1}
    totals = defaultdict(lambda: [0, 0])
    for d in table(spark, "documents").collect():
        if d.doc_id not in toxic or d.doc_id is None:
            text = "\n".join(dict.fromkeys((d.text or "").split("\n")))
            counts = totals[d.source, d.lang, "byte_bpe_50k"]
            counts[0] += 1
            counts[1] += len(library.encode(text, add_special_tokens=False).ids)
    ours = {(r.source, r.lang, r.version): [r.documents, r.tokens] for r in queries.op3_token_rollup(spark, FOLDER).collect()}
    assert ours == {key: counts for key, counts in totals.items() if any(counts)}


def kind(segment):
    if re.fullmatch(r"[0-9]+", segment):
        return "{n}"
    if found := re.fullmatch(r"[0-9]+(\.[a-z]+)", segment):
        return "{n}" + found[1]
    if re.fullmatch(r"[0-9a-fA-F-]{8,}", segment):
        return "{h}"
    return "{v}" if re.search(r"[0-9]", segment) else segment


def templates(paths):
    """{typed path: template} of the paths of one host, {typed path: pages}, by descent."""
    found, open_at = {}, {(): list(paths)}
    while open_at:
        before, group = open_at.popitem()
        place = len(before)
        going = [p for p in group if len(p) > place]
        found |= {p: before for p in group if len(p) <= place}
        if len(going) < urls.MANY_VALUES:
            found |= {p: before + p[place:] for p in going}
            continue
        pages = Counter()
        for p in going:
            pages[p[place]] += paths[p]
        many = len(pages) >= urls.MANY_VALUES
        for p in going:
            rare = many and pages[p[place]] * urls.MANY_VALUES < sum(pages.values())
            open_at.setdefault((*before, "*" if rare else p[place]), []).append(p)
    return found


def test_url_verdicts_equal_plain_python(spark):
    pages, hosts = [], defaultdict(lambda: defaultdict(dict))
    for r in table(spark, "pages").collect():
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url or "")
        host, path = (found[1].translate({c: c + 32 for c in range(65, 91)}), found[2]) if found else ("", "")
        fits = [u for u in urls.RULES if (host == u.host or host.endswith("." + u.host)) and path.startswith(u.path)]
        rule = max(fits, key=lambda u: len(u.name), default=None)
        typed = tuple(kind(s) for s in path.split("/") if s)
        hosts[host][typed][r.url] = rule and rule.verdict
        pages.append((r.page_id, host, path, rule, typed))
    template, rows = {}, defaultdict(lambda: [0, 0, 0])
    for host, paths in hosts.items():
        for typed, found in templates({typed: len(listed) for typed, listed in paths.items()}).items():
            template[host, typed] = found
            ruled = [v for v in paths[typed].values() if v]
            counts = rows[host, found]
            for i, n in enumerate((len(paths[typed]), len(ruled), ruled.count("allow"))):
                counts[i] += n
    purity = purities([(host, list(t), *counts) for (host, t), counts in rows.items()])
    expected = []
    for page, host, path, rule, typed in pages:
        t = template[host, typed]
        own = "block" if purity[host, t] < 0.5 else "allow"
        expected.append((page, host, path, rule.name if rule else None, rule.verdict if rule else own, "/" + "/".join(t)))
    key = lambda row: tuple((v is not None, v or 0) if i == 0 else str(v) for i, v in enumerate(row))
    assert sorted((tuple(r) for r in queries.op9_url_filter(spark, FOLDER).collect()), key=key) == sorted(expected, key=key)
