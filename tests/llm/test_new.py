"""Vector codes, licence scans and collocations: brute force, known values, odd rows."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saldo.llm import collocations, licenses, queries, vectorcodes
from tests.llm.test_operators import FOLDER, docs

VECTORS = "vec_id bigint, embedding array<float>, label int, code string, v int, part int, n int, error string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 1, 2, 3, "e") for i, v, label in rows], VECTORS)


def coded_by_hand(rows, parts=16, k=64, rounds=2):
    """{(vec_id, codes, error)} and the codebooks, by comparing everything."""
    kept = sorted(((i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v, _ in rows))
    x = np.array([v for _, v in kept], dtype=object).reshape(len(kept), parts, -1)
    books = [[tuple(x[j, p]) for j in range(min(k, len(kept)))] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for row in x[:, p]:
                groups.setdefault(nearest(row, books[p])[1], []).append(row)
            books[p] = [tuple(sum(r[j] for r in groups[e]) // len(groups[e]) for j in range(len(c))) if e in groups else c
                        for e, c in enumerate(books[p])]
    found = [[nearest(row[p], books[p]) for p in range(parts)] for row in x]
    return sorted((i, tuple(e for _, e in f), sum(d for d, _ in f)) for (i, _), f in zip(kept, found)), books


@pytest.mark.parametrize("spread", [0.5, 0.01, 30.0])
def test_codes_equal_brute_force(spark, spread):
    rng = np.random.default_rng(5)
    centers = rng.normal(0, spread, (20, 32))
    rows = [(i, (centers[rng.integers(20)] + rng.normal(0, spread / 8, 32)).astype(np.float32).tolist(), i % 3) for i in range(200)]
    rows += [(200 + i, rows[i][1], None) for i in range(40)]  # repeated vectors
    coded, books = vectorcodes.compress(vectors(spark, rows))
    expected, by_hand = coded_by_hand(rows)
    assert sorted((r.vec_id, tuple(r.codes), r.error) for r in coded.collect()) == expected
    assert books.entries.tolist() == [[list(c) for c in b] for b in by_hand]


def test_rings_and_stable_balls_change_nothing():
    rng = np.random.default_rng(6)
    for width in (1, 2, 7):
        x = rng.integers(-6, 6, (500, width))  # small numbers: many ties
        before = rng.integers(-6, 6, (40, width))
        home = vectorcodes.nearest(x, before)
        entries = before.copy()
        entries[:3] += 1
        radii = np.full(40, -1)
        np.maximum.at(radii, home, ((x - entries[home]) ** 2).sum(1))
        ball = vectorcodes.balls(entries, before, radii)
        assert vectorcodes.renearest(x, home, entries, ball).tolist() == vectorcodes.nearest(x, entries).tolist()
        assert ball.still.any() or width < 7
        assert width > 1 or (ball.count < 39).all()  # some pairs are never compared


def test_codes_of_odd_vectors(spark):
    good = [float(i) for i in range(16)]
    rows = [(5, good, None), (5, good, None), (None, [x + 1 for x in good], 1), (2, None, 1), (3, [None] + good[1:], 1),
            (4, [float("nan")] + good[1:], 1), (6, [float("inf")] + good[1:], 1), (7, [], 1), (8, good[:15], 1),
            (9, good + good, 2), (10, [-0.001] * 16, 2)]
    coded, books = vectorcodes.compress(vectors(spark, rows))
    found = vectorcodes.label_errors(coded)
    assert sorted(((r.vec_id, tuple(r.codes), r.error, r.label_error) for r in found.collect()), key=str) == sorted([
        (5, (0,) * 16, 0, 0), (5, (0,) * 16, 0, 0), (None, (3,) * 16, 0, 0), (10, (2,) * 16, 0, 0)], key=str)
    assert books.entries.shape == (16, 4, 1) and books.entries[0, 2] == -1
    none, books = vectorcodes.compress(vectors(spark, []))
    assert none.count() == 0 and books.entries.size == 0
    with pytest.raises(Exception, match="too large"):
        vectorcodes.compress(vectors(spark, [(1, [1e30] * 16, 1)]))


@pytest.mark.parametrize("text, labels, reach", [
    ("MIT", ["mit"], "permissive"), ("GPL-2.0-or-later", ["gpl"], "copyleft"), ("GPL-2.0+", ["gpl"], "copyleft"),
    ("MIT OR GPL-3.0-only", ["gpl", "mit"], "permissive"), ("MIT AND GPL-3.0-only", ["gpl", "mit"], "copyleft"),
    ("MIT or Apache-2.0 and AGPL-3.0-only", ["agpl", "apache", "mit"], "permissive"),
    ("(MIT or Apache-2.0) and AGPL-3.0-only", ["agpl", "apache", "mit"], "network-copyleft"),
    ("GPL-2.0-only WITH Classpath-exception-2.0", ["gpl"], "weak-copyleft"),
    ("GPL-2.0-only with Other-exception or Zlib-x", ["gpl", "zlib"], "permissive"),
    ("CC-BY-NC-4.0", ["cc-by-nc"], "noncommercial"), ("LicenseRef-x", ["licenseref-x"], "unknown"),
    ("0BSD", ["bsd"], "public-domain"),
])
def test_expressions(text, labels, reach):
    assert licenses.evaluate(licenses.postfix(text.lower())) == (labels, reach)


@pytest.mark.parametrize("text", ["", "mit or", "or mit", "(mit", "mit)", "mit apache-2.0", "()", "mit (isc)", "& x", "(mit or)"])
def test_malformed_expressions(text):
    assert licenses.postfix(text) is None


@pytest.mark.parametrize("text", ["(mit or isc) with x-exception", "mit with (a or b)"])
def test_with_joins_single_names(text):
    assert licenses.evaluate(licenses.postfix(text)) is None


def test_deep_expressions_need_no_stack():
    deep = "(" * 50_000 + "mit" + ")" * 50_000 + " or isc" * 50_000
    assert licenses.evaluate(licenses.postfix(deep)) == (["isc", "mit"], "permissive")


def notices_by_hand(text):
    """(n_words, n_base, first_word, last_word, base_labels, labels of notices)."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = lambda phrase: [i for i in range(len(words)) if words[i: i + len(phrase.split())] == phrase.split()]
    base = {p: at(p) for p in licenses.BASE}
    places = sorted(i for found in base.values() for i in found)
    own = {label for p, label in licenses.BASE.items() if base[p]}
    more = {label for p, label in licenses.NOTICES.items() if at(p)}
    return (len(words), len(places), places[0] if places else None, places[-1] if places else None,
            ",".join(sorted(own)), ",".join(sorted(own | more)))


def test_notices_equal_brute_force(spark):
    rng = random.Random(7)
    bits = ["MIT", "License", "gnu", "General", "public", "license", "apache", "cc", "by", "lesser", "É", "x y", "cc-by", "Bsd",
            "0", "permission is hereby granted, free of charge"]
    texts = ["".join(rng.choice(bits) + rng.choice([" ", "\n", "-", ", ", " ", "_", ""]) for _ in range(60)) for _ in range(200)]
    texts += [None, "", "license " * 20_000, "MIT License MIT License Apache License", "mit license", "cc by by cc by"]
    found = licenses.digest(licenses.scan(docs(spark, [(i, t, "en") for i, t in enumerate(texts)]))).orderBy("doc_id").collect()
    ours = [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in found]
    assert ours == [notices_by_hand(t) for t in texts]
    assert all((0 < r.score < 1) == bool(r.labels) for r in found)


def test_the_whole_table_is_scanned(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = queries.op12_license_scan(spark, FOLDER)
    ours = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in found.collect()}
    assert ours == {r.doc_id: notices_by_hand(r.text) for r in table.collect()}
    assert any(labels for *_, labels in ours.values())


def test_tags_in_texts(spark):
    rows = [(1, "/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */ x", "en"),
            (2, "# spdx-LICENSE-identifier: (MIT OR\nApache-2.0)", "en"),
            (3, "a\nLicense-Expression: MIT AND BSD-3-Clause\nMIT License", "en"), (None, "SPDX-License-Identifier:", "en"),
            (4, "İİ SPDX-License-Identifier: ISC", "en")]
    found = licenses.scan(docs(spark, rows))
    flat = {r.doc_id: r for r in licenses.digest(found).collect()}
    assert [(flat[i].labels, flat[i].reach) for i in (1, 2, 3, 4, None)] == [
        ("gpl", "weak-copyleft"), ("", None), ("bsd,mit", "permissive"), ("isc", "permissive"), ("", None)]
    assert flat[3].base_labels == "mit" and flat[3].score == pytest.approx(1 - 0.5 * 0.05)
    assert {r.doc_id: [e.at for e in r.expressions] for r in found.collect()}[4] == [27]
    assert licenses.scan(docs(spark, [])).count() == 0


def collocations_by_hand(rows, least=10, top=2000, longest=3, share=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", *w[i: i + s]) for s in range(1, longest + 1) for i in range(len(w) - s + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for (lang, *w), a in candidates.items():
        around = [b for (g, *v), b in candidates.items() if g == lang and len(v) > len(w)
                  and any(v[i: i + len(w)] == w for i in range(len(v)))]
        if any(100 * b >= share * a for b in around):
            continue
        s, _, left, right = min((1_000_000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]])
                                for k in range(1, len(w)))
        out.append((lang, -s, -a, " ".join(w).encode(), left, right))
    ranked, place = [], Counter()
    for lang, s, a, phrase, left, right in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, left, right, n[lang], -s))
    return ranked


def mined(df, **how):
    found = collocations.collocations(df, **how).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found)


@pytest.mark.parametrize("longest, top", [(3, 2000), (2, 2000), (4, 15)])
def test_collocations_equal_brute_force(spark, longest, top):
    rng = random.Random(8)
    words = ["the", "of", "in", "É", "x-y", "New", "york", "city", "a", " z", "\x1cq"]
    texts = [("".join(rng.choice(words[: rng.choice([3, 11])]) + rng.choice([" ", " ", " ", "\t", ". ", "\n", "  ", "\x0b"])
                      for _ in range(rng.choice([0, 5, 120]))), rng.choice(["en", "fr", None])) for _ in range(150)]
    texts += [(None, "en"), ("", None), ("go go " * 5000, "de"), ("New York City is big. " * 30, "en")]
    df = docs(spark, [(1, t, lang) for t, lang in texts])
    assert mined(df, longest=longest, top=top) == sorted(collocations_by_hand(texts, longest=longest, top=top))
    assert mined(docs(spark, [])) == []


def test_chunks_own_each_word_once(monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 200))) for _ in range(50)]
    found, own, row = collocations.chunks([t.encode() for t in texts])
    parts = [(c.decode().split(), n, r) for c, n, r in zip(found.to_pylist(), own, row)]
    assert [" ".join(w for c, n, r in parts if r == i for w in c[:n]) for i in range(50)] == texts
    lasts = {i for i, (_, _, r) in enumerate(parts) if i + 1 == len(parts) or parts[i + 1][2] != r}
    assert all(len(c) == n + (0 if i in lasts else 2) for i, (c, n, _) in enumerate(parts))
    assert len(parts) > 300
    # A passage gives the same chunks wherever it stands, but for its ends.
    passage = " ".join(rng.choice(words) for _ in range(100))
    sets = [set(collocations.chunks([f"{before} {passage}".encode()])[0].to_pylist()) for before in ("w1 w2", "w3")]
    assert len(sets[0] & sets[1]) >= 0.6 * len(sets[0])
    assert len(collocations.chunks([])[0]) == len(collocations.chunks([b"", b" .. "])[0]) == 0


def test_small_blocks_change_nothing(spark, monkeypatch):
    texts = [("a b c " * 40 + "d. a b", "en")] * 15 + [("x " * 3000, None)]
    df = docs(spark, [(1, t, lang) for t, lang in texts])
    expected = mined(df)
    batches = [pa.RecordBatch.from_arrays([pa.array([b"x" * n for n in sizes])], ["t"]) for sizes in ([], [1, 50, 2], [3, 3, 3, 90])]
    monkeypatch.setattr(collocations, "_BLOCK", 10)
    blocks = list(collocations._blocks(iter(batches), 0))
    assert [v for b in blocks for v in b.column(0).to_pylist()] == [v for b in batches for v in b.column(0).to_pylist()]
    assert len(blocks) == 3 and expected == sorted(collocations_by_hand(texts))


def test_bitmap_knows_every_phrase(spark):
    rows = [(lang, f"{p} é", 12) for lang in ("en", "zh-é") for p in range(3000)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, f bigint")
    crc = lambda text: zlib.crc32(text.encode())
    hashed = lambda lang, phrases: np.array([crc(lang) * collocations._FACTORS[0] + sum(
        crc(w) * f for w, f in zip(p.split(), collocations._FACTORS[1:])) for p in phrases])
    for most in (collocations._BITS, 1 << 15):  # with few bits, more seem frequent, none is lost
        known = collocations.bitmap(frame, most)
        for lang in ("en", "zh-é"):
            assert known.test(hashed(lang, [f"{p} é" for p in range(3000)])).all()
            assert known.test(hashed(lang, [f"other {p}" for p in range(1000)])).sum() < (150 if most > 1 << 15 else 400)


def test_scores_of_large_counts(spark):
    a, left, right = 10**14 + 7, 3 * 10**14 + 1, 5 * 10**15 + 9
    row = spark.range(1).select(collocations.score(F.lit(a), F.lit(left), F.lit(right)).alias("s")).first()
    assert row.s == 1_000_000 * a * a // (left * right)
    assert spark.range(1).select(collocations.score(F.lit(10), F.lit(10), F.lit(10)).alias("s")).first().s == 1_000_000


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_collocations"])
def test_new_queries_equal_sql(spark, name):
    from tests.oracle import mismatch
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.01/{table}.parquet'")
    assert mismatch(queries.QUERIES[name](spark, "/root/testdata/sf0.01"), db, queries.ORACLE_SQL[name]) is None


def test_leaks_in_long_runs_of_names_and_numbers(spark):
    from saldo.llm import decontam
    item = "what is the distance from Rome to Paris in 30 km of road today"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(1, "a, " + "Word Big " * 20_000 + item), (2, "1.1." * 300_000 + " " + item), (3, "x, " + "A" * 500_000), (4, "a" + " " * 300_000 + "B")]
    found = decontam.leaks(docs(spark, [(i, t, "en") for i, t in rows]), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 1)]


def test_token_rollup_of_odd_rows_equals_a_recount(spark, tmp_path):
    from saldo.llm import counts
    from tests.llm.test_operators import tokenizer
    rows = [(None, "a b\na b\nc", "en", "s"), (None, "x y", "en", "s"), (1, "p q\np q", "en", "s"), (1, "other words", "en", "s"),
            (2, "bad\nbad", "fr", "t"), (2, "more", "fr", "t"), (3, None, None, None), (4, "", "en", "s"), (5, "fine one", "en", "s")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 0, 1), (2, 0, 1), (4, 1, 0), (None, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    encode = tokenizer("byte_bpe_50k.json").encode
    expected = Counter()
    for doc, text, lang, source in rows:
        if doc != 2:
            text = "\n".join(dict.fromkeys((text or "").split("\n")))
            expected[source, lang, "documents"] += 1
            expected[source, lang, "tokens"] += len(encode(text, add_special_tokens=False).ids)
    found = queries.op3_token_rollup(spark, str(tmp_path)).collect()
    ours = Counter()
    for r in found:
        ours[r.source, r.lang, "documents"] += r.documents
        ours[r.source, r.lang, "tokens"] += r.tokens
    assert +ours == +expected and counts.KEYS == ("source", "lang", "version")


def test_stages_keep_the_columns_of_their_documents(spark):
    import corpus_pipeline
    from tests.llm.test_operators import ODD
    own = docs(spark).selectExpr("*", "7.0D AS score", "'own' AS lang_pred", "'f' AS _found", "'k' AS _key", "'u' AS _unclear",
                                 "'g' AS _gone", "'l' AS _language")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, own, FOLDER)
        assert kept.columns == own.columns, name
        rows = kept.collect()
        assert 0 < len(rows) <= len(ODD), name
        assert {(r.score, r.lang_pred, r._found, r._key, r._unclear, r._gone, r._language) for r in rows} == {
            (7.0, "own", "f", "k", "u", "g", "l")}, name


def test_language_stage_rejects_junk_and_keeps_clean_text(spark):
    import corpus_pipeline
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    junk = ["xq zvkj wqpt bnmf hjkl", "qwrt zxcv pqwz " * 5000, "これは 日本語 です", "!!! 123", "", None]
    made = table.limit(0).unionByName(spark.createDataFrame(
        [(-1 - i, t, "en", "junk", 0) for i, t in enumerate(junk)], table.schema))
    kept = corpus_pipeline.identify_language(spark, table.unionByName(made), FOLDER)
    ids = {r.doc_id for r in kept.collect()}
    assert not {i for i in ids if i < 0}
    assert ids == {r.doc_id for r in table.collect()}


def test_short_items_are_found_as_they_are(spark):
    from saldo.llm import decontam
    bench = spark.createDataFrame([(1, "Name Rome"), (2, "12 of 30"), (3, "eureka"), (4, ""), (5, "one two three four")],
                                  "item_id bigint, text string")
    rows = [(1, "they name, ROME as it is"), (2, "he ate 12 of 30 eggs"), (3, "he ate 13 of 30 eggs"), (4, "Eureka!"), (5, "eurekas"),
            (6, "one two, three\nfour"), (7, "one two three"), (8, "Name Paris")]
    found = decontam.leaks(docs(spark, [(i, t, "en") for i, t in rows]), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 2), (4, 3), (6, 5)]


@pytest.mark.parametrize("name", ["op2_chat_rotation", "op5_secret_scan", "op9_url_filter", "op10_exact_dedup"])
def test_native_queries_hold_no_python(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "ExistingRDD"):
        assert word not in plan
