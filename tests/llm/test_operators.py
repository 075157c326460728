"""The operators on small tables: brute force, round trips, and the odd cases each must settle."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saldo.llm import (chat, counts, decontam, exactdup, idfiles, language, neardup, packing, queries,
                       secret_scan, urls)
from saldo.llm.tokens import Encoder
from tests.llm import brute
from tests.oracle import mismatch

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, norm string, row int, kinds string"
LONG = "word " * 60_000
# Null ids and texts, white space, a very long text, a repeated row, a repeated id, extra columns.
ODD = [(1, "a b  c\td", "en"), (2, "a b c d", "en"), (3, None, "en"), (4, "", None), (5, " \n ", "en"),
       (6, LONG, "en"), (6, LONG, "en"), (7, "x y z", "fr"), (7, "other words here", "fr"),
       (None, "a b c d", "en"), (None, None, None), (8, "token = abcdef1 Password:'zz' " + "0a" * 14, "en")]


def docs(spark, rows=ODD):
    return spark.createDataFrame([(d, t, lang, "s", 0, "n", 1, "k") for d, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def table():
    return duckdb.connect().execute(f"SELECT doc_id, text, lang FROM '{FOLDER}/documents.parquet'").fetchall()


def tokenizer(name):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.tokenizer_path(name))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    ours, theirs = Encoder(queries.tokenizer_path(name), size=5), tokenizer(name)
    texts = ["", " ", "a  b", " a b ", "a\n b", "a b\nc", "É\u0301 e\u0301a İ", "I'll DON'T stop. Now!", "１２ 中文 x",
             "a <|endoftext|> b", "a\u3000b c", "x\u001c y z", "a.b c,d e-f 12 3.4"]
    rng = np.random.default_rng(1)
    texts += ["".join(rng.choice(list(" \n\tabé1.,'-中"), 25)) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_caches_words_not_their_single_uses(name):
    ours, theirs = Encoder(queries.tokenizer_path(name)), tokenizer(name)
    words = ["".join(w) for w in np.random.default_rng(4).choice(list("abcdeé"), (4000, 9))]
    words = sorted(set(words))
    once = " ".join(f"{w}{',.!'[i % 3]}" for i, w in enumerate(words))  # each with a mark, in one place
    long = f"a {'b' * 5000} c{'d' * 5000}\n{'e' * 5000} f"
    often = "Then, THEN then. then,\nThen éa, Éa éa\nthen " * 4
    for text in (once, long, often, often):
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids
    held = [w for kind in ours._young + ours._old for w in kind]
    assert len(held) <= len(words) * 1.05 + 30 and max(map(len, held)) <= 64
    assert {"Then,", "then.", "then"} <= ours._young[0].keys()


def test_a_worker_holds_each_entry_of_the_language_model_once():
    entries = ["cat", "chat", "1|c", "2|at", "3|cat", "5| cat "]
    model = language.Model(["en", "fr"], pa.array(entries), np.log(np.arange(1.0, 13).reshape(6, 2)))
    assert model.evidence("cat")[1] == 1.0 and model.evidence("qat")[1] == 2 / 6 and model.evidence("zz")[0] is None
    held = [d for v in vars(model).values() for d in (v if isinstance(v, list) else [v]) if isinstance(d, dict)]
    assert sum(map(len, held)) == len(entries)


def test_near_duplicates_equal_brute_force(spark, table):
    for words in (2, 5):
        found = neardup.classes(spark.read.parquet(f"{FOLDER}/documents.parquet"), words).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near_duplicates(
            [(d, t) for d, t, _ in table], words)


def test_near_duplicates_of_small_sets_and_chains(spark):
    rng = np.random.default_rng(2)
    vocabulary, rows = [f"w{i}" for i in range(40)], []
    for _ in range(60):
        base = list(rng.choice(vocabulary, rng.integers(1, 60)))
        for _ in range(6):
            rows.append((len(rows), " ".join(base)))
            base[rng.integers(len(base))] = str(rng.choice(vocabulary))
    found = neardup.classes(docs(spark, [(d, t, "en") for d, t in rows]), 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near_duplicates(rows, 2)


def test_large_components_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_LARGE", 3)
    monkeypatch.setattr(neardup, "_BLOCK", 4)
    rng = np.random.default_rng(3)
    base, rows = [f"w{i}" for i in range(60)], []
    for d in range(50):
        words = list(base)
        for at in rng.choice(60, rng.integers(0, 7), replace=False):
            words[at] = f"n{d}-{at}"
        rows.append((d, " ".join(words)))
    found = neardup.classes(docs(spark, [(d, t, "en") for d, t in rows]), 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near_duplicates(rows, 2)


def test_near_duplicates_odd_rows(spark):
    found = neardup.classes(docs(spark), 2).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found if r.doc_id not in (None, 6, 7)}
    assert by_id[2].component_id == 1 and not by_id[2].kept
    assert by_id[3].kept and by_id[5].component_id == 5 and by_id[4].n_shingles == 0
    assert [r.kept for r in found if r.doc_id is None] == [True, True]
    assert neardup.deduplicate(docs(spark), 2).count() == len(ODD) - 1
    assert neardup.classes(docs(spark, []), 2).count() == 0


@pytest.mark.parametrize("hash_of", [exactdup.hash64, lambda c: F.xxhash64(c) % 3, lambda c: F.lit(7).cast("bigint")])
def test_exact_duplicates_equal_brute_force(spark, table, hash_of):
    found = exactdup.classes(spark.read.parquet(f"{FOLDER}/documents.parquet"), hash_of).collect()
    ours = sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found)
    assert ours == brute.exact_duplicates([(d, t) for d, t, _ in table])


def test_exact_duplicates_odd_rows(spark):
    found = exactdup.classes(docs(spark)).collect()
    assert len(found) == len(ODD)
    assert sum(r.kept for r in found) == len({r.text_sha256 for r in found})
    assert {(r.keep_id, r.group_size) for r in found if r.doc_id in (1, 2)} == {(1, 3)}
    kept = exactdup.deduplicate(docs(spark))
    assert kept.columns == docs(spark).columns and kept.count() == sum(r.kept for r in found)
    assert exactdup.classes(docs(spark, [])).count() == 0


def test_packing_and_files_keep_every_id(spark):
    theirs = tokenizer("word_bpe_49k.json")
    found = packing.pieces(docs(spark), queries.tokenizer_path("word_bpe_49k.json"), longest=16).collect()
    assert len({r.sequence_id for r in found}) == len(found)
    assert all(r.length & (r.length - 1) == 0 and r.length <= 16 and len(r.ids) == 4 * r.length for r in found)
    one = sorted((r for r in found if r.doc_id == 8), key=lambda r: r.start)
    ids = np.frombuffer(b"".join(r.ids for r in one), "<u4").tolist()
    assert ids == theirs.encode(ODD[-1][1], add_special_tokens=False).ids + [1]
    assert [r.doc_tokens for r in found if r.doc_id == 3] == [1]
    theirs = tokenizer("byte_bpe_50k.json")
    back = idfiles.roundtrip(docs(spark), queries.tokenizer_path("byte_bpe_50k.json"), block_tokens=50).collect()
    back.sort(key=lambda r: r.start)
    assert [r.doc_id for r in back] == sorted((d for d, _, _ in ODD), key=lambda d: (d is not None, d))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(back, back[1:])) and back[0].start == 0
    texts = sorted(str(theirs.encode(t or "", add_special_tokens=False).ids + [2]) for _, t, _ in ODD)
    assert sorted(str(np.frombuffer(r.ids, "<u4").tolist()) for r in back) == texts
    for made in (packing.pieces, idfiles.roundtrip):
        assert made(docs(spark, []), queries.tokenizer_path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("rows", [ODD, None])
def test_packed_documents_equal_the_library(spark, tmp_path, rows):
    """Every document of the table and of the odd rows: pieces, sequences, and the buckets read back."""
    made = spark.read.parquet(f"{FOLDER}/documents.parquet") if rows is None else docs(spark, rows)
    packed = packing.pieces(made, queries.tokenizer_path("word_bpe_49k.json"))
    packing.write_buckets(packed, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets")).collect()
    assert sorted((r.sequence_id, r.ids) for r in back) == sorted((r.sequence_id, r.ids) for r in packed.collect())
    assert len({r.sequence_id for r in back}) == len(back)
    library, pieces, whole = tokenizer("word_bpe_49k.json"), sorted(back, key=lambda r: r.sequence_id), []
    for r in pieces:  # those of a document follow one another
        assert r.bucket == r.length == len(r.ids) // 4 and r.length.bit_count() == 1 and r.length <= 2048 and r.offset == 0
        if r.start == 0:
            whole.append((r.doc_id, r.doc_tokens, b""))
        doc, size, ids = whole[-1]
        assert (r.doc_id, r.doc_tokens, r.start) == (doc, size, len(ids) // 4)
        whole[-1] = (doc, size, ids + r.ids)
    expected = [(r.doc_id, np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
                for r in made.select("doc_id", "text").collect()]
    assert all(len(ids) == 4 * size for _, size, ids in whole)
    assert sorted(((d is not None, d or 0), ids) for d, _, ids in whole) == sorted(
        ((d is not None, d or 0), ids) for d, ids in expected)


def test_elias_fano():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 63, 64, 65, 1000):
        for top in (0, 1, n, 50 * n + 1, 10**9):
            values = np.sort(rng.integers(0, top + 1, n))
            code = idfiles.EliasFano.encode(values)
            assert code.decode().tolist() == values.tolist()
            if n:
                samples = code.samples()
                assert [code.select(i, samples) for i in range(n)] == values.tolist()
                assert len(code.low) + len(code.high) <= n * (3 + max(0, np.log2(top / n + 1))) / 8 + 3


def test_secrets(spark):
    assert secret_scan.trigram_query(r"[0-9a-f]+") is None
    assert secret_scan.trigram_query(r"AKIA[A-Z0-9]+") == [("aki", "kia")]
    assert len(secret_scan.trigram_query(secret_scan.RULES[0].pattern)) == 6
    texts = [t for _, t, _ in ODD[:-1]] + [
        ODD[-1][1], "secret=token: abcdefgh", "é API-key apiKEY: \"x.y=z/+\" AKIA" + "Q" * 16 + " AKIAQ",
        "passwd='" + "ab" * 20, "token=" * 5, "TOKEN : 'abcdef' password=123456,secret:a", "f" * 23 + "g" + "f" * 24]
    found = secret_scan.digest(secret_scan.scan(docs(spark, [(i, t, "en") for i, t in enumerate(texts)]))).collect()
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found} == {
        i: brute.secrets(t) for i, t in enumerate(texts)}
    assert secret_scan.scan(docs(spark)).count() == len(ODD)
    assert secret_scan.scan(docs(spark, [])).count() == 0


ITEM = "Yesterday in town Tom bought 12 apples for 30 euros and later Tom sold 12 apples at the small market"


def test_leaks(spark):
    rows = [(1, "Before it. " + ITEM + " After it."), (2, ITEM.replace("Tom", "Ann").replace("12", "7")),
            (3, ITEM.replace("12", "7", 1)), (4, "Nothing of it is in here, not a single window of words at all."),
            (5, None), (None, ITEM), (6, LONG)]
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "Two words"), (4, "just six words make this item")],
                                  "item_id bigint, text string")
    frame = docs(spark, [(d, t, "en") for d, t in rows])
    found = {r.doc_id: r for r in decontam.leaks(frame, items).collect()}
    assert set(found) == {1, 2, None}
    assert found[1].changed == 0 and found[2].changed > 0
    left = decontam.decontaminate(frame, items)
    assert left.columns == frame.columns and left.count() == len(rows) - 2
    assert decontam.leaks(docs(spark, []), items).count() == 0
    assert decontam.leaks(frame, items.limit(0)).count() == 0


def test_leaks_in_any_case_and_wrapping(spark):
    items = {1: "In the old harbour, Prime Minister Anna Brown met Lord Charles Green, Sir Peter Black, Dame Mary Stone "
                "and twelve quiet sailors near the grey wall",
             2: "Every spring the gardener of Lower Haven plants nine rows of beans behind the red barn"}
    texts = []
    for text in items.values():
        texts += [text, text.upper(), text.lower(), text.title(), text.replace(" ", "\n"), text.replace(" ", "  "),
                  "so it was said, " + text + ", and more", "SAID, " + text.upper() + " AND MORE", text.replace(" ", " \n\t"),
                  " ".join(text.split()[:5])]
    made = docs(spark, [(i, t, "en") for i, t in enumerate(texts)])
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.coverage for r in decontam.leaks(made, bench).collect()}
    assert set(found) == brute.verbatim(enumerate(texts), items.items(), decontam.WINDOW)
    assert len(found) == 18 and set(found.values()) == {1.0}


def test_leaks_of_short_items_of_many_numbers_and_of_long_edited_passages(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(198)]
    long = " ".join(words[:50] + ["12"] + words[50:120] + ["12"] + words[120:])
    items = [(1, "Compute 3 + 4 * 5 - 6 / 2 + 7"), (2, "Name the Prime Minister Of Great Britain"), (3, long)]
    rows = [(1, "Before. Compute 3 + 4 * 5 - 6 / 2 + 7. After."), (2, "Compute 3 + 4 * 5 - 6 / 2 + 8"),
            (3, "and, name the Prime Minister Of Great Britain or not"), (4, "NAME THE PRIME MINISTER OF GREAT BRITAIN"),
            (5, long.replace("12", "13", 1)), (6, long.replace("12", "13")), (7, "Name the Prime Minister"),
            (8, "1 Compute 3 + 4 * 5 - 6 / 2 + 7 8 9")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r for r in decontam.leaks(docs(spark, [(d, t, "en") for d, t in rows]), bench).collect()}
    assert set(found) == {(1, 1), (3, 2), (4, 2), (5, 3), (6, 3), (8, 1)}
    assert found[6, 3].coverage == 1.0 and found[6, 3].changed == 2
    # The windows that hold one of the two numbers do not count, the others do.
    assert found[5, 3].n_windows == 193 - 16


def test_urls(spark):
    texts = [None, "", "no scheme", "http://COM/", "https://www.Example.com/en/1?x", "ftp://a.example.com/en/1#x/y",
             "http://b.net/es/9/", "http://b.net/fr", "http://b.org/" + "a/" * 50, "x://y://z.com/q?://"]
    texts += [f"http://many.net/u/{i}a{chr(97 + i % 26)}" for i in range(60)]
    pages = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "page_id bigint, url string, host string")
    found = urls.judge(pages).collect()
    assert sorted(r.page_id for r in found) == list(range(len(texts)))
    for r in found:
        host, path, rule, verdict = brute.url_rule(texts[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (rule is None or r.verdict == verdict)
        assert r.verdict in ("allow", "block")
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_templates_go_by_values_and_not_by_repeated_pages(spark):
    names = [chr(97 + i % 26) * 3 + chr(97 + i // 26) for i in range(60)]
    texts = [f"http://a.net/u/{n}/{p}" for n in names for p in ("posts", "likes", "about")]
    texts += [f"http://b.net/{n}" for n in names] + [f"http://b.net/main/{n}" for n in names]
    texts += [f"http://x.net/{lang}/page" for lang in ("es", "fr", "en")]
    rows = [(i, t) for i, t in enumerate(texts)]
    once = {r.page_id: (r.verdict, r.template) for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    for i, t in rows[:180]:
        assert once[i][1] == "/u/*/" + t.rsplit("/", 1)[1]
    assert once[180][1] == "/*" and once[240][1] == "/main/*"
    twice = urls.judge(spark.createDataFrame(rows + rows, "page_id bigint, url string")).collect()
    assert len(twice) == 2 * len(rows) and all(once[r.page_id] == (r.verdict, r.template) for r in twice)


def test_url_templates_have_no_fixed_depth(spark):
    texts = [f"http://a.org/shop/en/cat/item/{kind}/{chr(97 + i % 26)}{chr(97 + i // 26)}" for kind in ("reviews", "casino")
             for i in range(40)] + ["http://a.org/" + "/".join("abcdefgh") + "/x", "http://a.org/shop"]
    rules = [urls.UrlRule("block", "a.org", f"/shop/en/cat/item/casino/{c}") for c in "abcdefghijklm"]
    rules += [urls.UrlRule("allow", "a.org", f"/shop/en/cat/item/reviews/{c}") for c in "abcdefghijklm"]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id bigint, url string")
    found = {texts[r.page_id]: r for r in urls.judge(pages, rules).collect()}
    for text in texts[:80]:
        kind = text.split("/")[-2]
        assert found[text].template == f"/shop/en/cat/item/{kind}/*"
        assert found[text].verdict == ("block" if kind == "casino" else "allow")
    assert found[texts[80]].template == "/a/b/c/d/e/f/g/h/x" and found[texts[81]].template == "/shop"


def test_language(spark, table):
    found = queries.op1_language_id(spark, FOLDER).collect()
    true = {d: lang for d, _, lang in table}
    held = [r for r in found if r.held_out]
    assert held and sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.97 * len(held)
    model = language.fit(docs(spark))
    rows = language.predict(docs(spark, ODD + [(9, "½ 12 !", "en")]), model).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in rows}[9] == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(ODD) + 1
    none = language.fit(docs(spark, []))
    assert {r.lang_pred for r in language.predict(docs(spark), none).collect()} == {"und"}


def test_chat(spark):
    turns = spark.createDataFrame([
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hé"), (1, 2, "bob", "hé"), (1, 70, "ann", None),
        (None, None, None, "x"), (2, 0, "system", "alone")], "conv_id bigint, turn bigint, role string, text string")
    found = {(r.conv_id, r.part, r.perspective): r for r in chat.rotate(turns).collect()}
    assert set(found) == {(1, 0, "ann"), (1, 0, "bob"), (1, 1, "ann"), (None, 0, "unknown")}
    one = found[1, 0, "bob"]
    assert one.rendered == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n"
                            "<|im_start|>assistant\nhé<|im_end|>\n")
    assert [one.rendered[a:b] for a, b in one.mask] == ["hé<|im_end|>\n"]
    assert chat.rotate(turns.limit(0)).count() == 0


@pytest.mark.parametrize("part_turns", [3, 64])
def test_long_and_sparse_dialogues_are_rendered_whole(spark, part_turns):
    rows = [(c, i * (7 if c == 2 else 1), "system" if i == 0 else ("ann" if i % 2 else "bob"), f"é{i}" * (i % 5))
            for c, n in ((1, 200), (2, 12), (None, 90)) for i in range(n)]
    rows += [(1, 100, "cy", "once"), (1, None, "ann", "first"), (2, 7, "ann", "é1"), (3, 0, "system", "alone")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {}
    for r in sorted(chat.rotate_dialogues(turns, part_turns).collect(), key=lambda r: r.part):
        one = found.setdefault((r.conv_id, r.perspective), [[], "", [], 0])
        one[0].append(r.part), one[2].extend(map(tuple, r.mask))
        one[1] += r.rendered
        one[3] += r.n_turns
    assert set(found) == {(1, "ann"), (1, "bob"), (1, "cy"), (2, "ann"), (2, "bob"), (None, "ann"), (None, "bob")}
    for (conv, who), (parts, rendered, mask, n) in found.items():
        mine = sorted({r[1:] for r in rows if r[0] == conv}, key=lambda r: (r[0] is not None, r))
        assert (rendered, mask) == brute.rotated(mine, who) and n == len(mine)
        assert parts == list(range(-(-len(mine) // part_turns)))
    assert chat.rotate_dialogues(turns.limit(0)).count() == 0


def test_rollup_is_idempotent_and_signed(spark, tmp_path):
    state = spark.createDataFrame([("s", "en", "v", 5), ("s", None, "v", 7), (None, "en", "v", 1)],
                                  "source string, lang string, version string, tokens bigint")
    ledger = f"file://{tmp_path}"
    assert counts.rollup(spark, ledger).count() == 0
    assert counts.commit(counts.inserts(state), ledger, "a")
    assert not counts.commit(counts.inserts(state), ledger, "a")
    assert counts.commit(counts.revisions(state.limit(1), state.limit(1).withColumn("tokens", F.lit(9).cast("bigint"))), ledger, "b")
    assert counts.commit(counts.deletes(state.filter("source is null")), ledger, "c")
    assert counts.commit(counts.inserts(state.limit(0)), ledger, "d")
    found = sorted(map(tuple, counts.rollup(spark, ledger).collect()), key=str)
    assert found == [("s", "en", "v", 1, 9), ("s", None, "v", 1, 7)]
    with pytest.raises(ValueError):
        counts.commit(state, ledger, "../x")


def test_pipeline_stages(spark):
    import corpus_pipeline
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    packed = corpus_pipeline.run(spark, FOLDER)
    assert 0 < packed.select("doc_id").distinct().count() < frame.count()
    odd = docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:4]:
        odd = stage(spark, odd, FOLDER)
        assert odd.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert odd.count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert mismatch(queries.QUERIES[name](spark, FOLDER), db, queries.ORACLE_SQL[name]) is None
