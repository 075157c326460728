"""The registered queries of this folder, and SQL for those that SQL can express."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm import (chat, collocations, counts, decontam, exactdup, idfiles, language, licenses, neardup,
                       packing, secret_scan, urls, vectorcodes)
from saldo.sources.scratch import new_folder, settle


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = language.fit(docs.filter(~held_out))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_chat_rotation(spark: SparkSession, folder: str) -> DataFrame:
    rotated = chat.rotate_dialogues(_table(spark, folder, "conversations"))
    mask = F.array_join(F.transform("mask", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rotated.withColumn("mask", mask)


def op3_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches: all documents; those with repeated lines counted anew without them; and
    those that labels call toxic deleted. The first batch is then given once more.

    Every row counts, also without an id or with a repeated one; a label holds for all rows of
    its id, and none for rows without id."""
    version = "byte_bpe_50k"
    path = tokenizer_path(f"{version}.json")
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    toxic = _table(spark, folder, "labels").filter("toxic = 1").select("doc_id").distinct()
    lines = F.split("text", "\n")
    fewer = F.when(F.size(F.array_distinct(lines)) < F.size(lines), F.array_join(F.array_distinct(lines), "\n"))
    state = settle(counts.counted(docs.withColumn("fewer", fewer), path, version, revised_col="fewer"), "counted")
    before = state.filter("revised IS NOT NULL")
    after = before.withColumn("tokens", F.col("revised"))
    latest = state.withColumn("tokens", F.coalesce("revised", "tokens"))
    ledger = new_folder(spark, "token-ledger")
    counts.commit(counts.inserts(state), ledger, "load")
    counts.commit(counts.revisions(before, after), ledger, "repeated-lines")
    counts.commit(counts.deletes(latest.join(toxic, "doc_id", "left_semi")), ledger, "toxic")
    counts.commit(counts.inserts(state), ledger, "load")
    return counts.rollup(spark, ledger)


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    cut = packing.pieces(docs, tokenizer_path("word_bpe_49k.json"))
    return cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset", "bucket")


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(_table(spark, folder, "documents")))


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.classes(_table(spark, folder, "documents"), words=2)


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    back = idfiles.roundtrip(docs, tokenizer_path("byte_bpe_50k.json"))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(_table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict", "template")


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdup.classes(_table(spark, folder, "documents"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = vectorcodes.compress(_table(spark, folder, "embeddings"))
    return vectorcodes.label_errors(settle(coded, "coded")).select(
        "vec_id", vectorcodes.hex_code(F.col("codes")).alias("code"), "error", "label_error",
        F.lit(books.sha256).alias("codebooks_sha256"))


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digest(licenses.scan(_table(spark, folder, "documents")))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_chat_rotation, op3_token_rollup, op4_packing, op5_secret_scan,
    op6_minhash_near_dedup, op7_token_files, op8_decontamination, op9_url_filter, op10_exact_dedup,
    op11_vector_codes, op12_license_scan, op13_collocations)}

_ROTATION_SQL = r"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS place FROM turns),
voices AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
said AS (
    SELECT p.conv_id, perspective, place, place // 64 AS part, speaker = perspective AS own,
           concat('<|im_start|>', CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                  ELSE 'user name=' || speaker END, chr(10)) AS head,
           concat(text, '<|im_end|>', chr(10)) AS body
    FROM placed p JOIN voices v ON p.conv_id IS NOT DISTINCT FROM v.conv_id),
ended AS (
    SELECT *, (sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective ORDER BY place))::BIGINT AS stop
    FROM said)
SELECT conv_id, part, perspective, string_agg(head || body, '' ORDER BY place) AS rendered,
       coalesce(string_agg(concat(stop - length(body), ':', stop), ',' ORDER BY place) FILTER (own), '') AS mask,
       count(*) AS n_turns, coalesce(sum(length(body)) FILTER (own), 0)::BIGINT AS n_masked
FROM ended GROUP BY conv_id, part, perspective
"""

_EXACT_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
           FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM n
"""

_NEAR_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words), 2)),
        lambda i: array_to_string(words[i : i + 1], ' '))) AS shingle FROM w WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
reached AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, lowest.b) AS component_id,
       d.doc_id = least(d.doc_id, lowest.b) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.a = d.doc_id
"""

_SECRETS_SQL = r"""
WITH rules(ord, kind, pattern, part, least) AS (VALUES
    (0, 'assign', '({keys})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    (1, 'access', 'AKIA[A-Z0-9]+', 0, 20), (2, 'hex', '[0-9a-f]{24,}', 0, 24)),
m AS (
    SELECT doc_id, ord, kind, least, list_transform(string_split_regex(text, pattern), lambda x: length(x)) AS gaps,
           list_transform(regexp_extract_all(text, pattern), lambda x: length(x)) AS hits,
           list_transform(CASE WHEN part = 2 THEN regexp_extract_all(text, pattern, 2)
                          ELSE regexp_extract_all(text, pattern) END, lambda x: length(x)) AS vals
    FROM documents CROSS JOIN rules),
placed AS (
    SELECT *, (list_sum(gaps[1:i]) + coalesce(list_sum(hits[1:i - 1]), 0))::BIGINT AS start
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m)),
found AS (
    SELECT doc_id, ord, kind, start, concat_ws(':', kind, start, start + hits[i]) AS span
    FROM placed WHERE vals[i] >= least),
per_doc AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, ord) AS spans
    FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per_doc USING (doc_id)
"""

# Letter by letter, as a flag for letter case folds more than A to Z.
_SECRETS_SQL = _SECRETS_SQL.replace("{keys}", "".join(
    f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key"))

_NEAREST = """SELECT vec_id, p, min_by(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT vec_id, x.p, e, list_sum(list_transform(list_zip(x.x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts x JOIN {books} b ON x.p = b.p) GROUP BY vec_id, p"""

_MEANS = """SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM {books} b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY i) AS c FROM (
        SELECT a.p, a.e, i, CAST(floor(sum(x.x[i]) / count(*)) AS BIGINT) AS mean
        FROM {assigned} a JOIN parts x USING (vec_id, p) CROSS JOIN range(1, 5) r(i) GROUP BY ALL) GROUP BY p, e
    ) m ON m.p = b.p AND m.e = b.e"""

_CODES_SQL = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, v[p * 4 + 1 : p * 4 + 4] AS x FROM kept CROSS JOIN range(16) r(p)),
c0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
       WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
a1 AS MATERIALIZED ({_NEAREST.format(books="c0")}), c1 AS MATERIALIZED ({_MEANS.format(books="c0", assigned="a1")}),
a2 AS MATERIALIZED ({_NEAREST.format(books="c1")}), c2 AS MATERIALIZED ({_MEANS.format(books="c1", assigned="a2")}),
a3 AS MATERIALIZED ({_NEAREST.format(books="c2")}),
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a3 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM c2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""

_PHRASES_SQL = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f AS MATERIALIZED (
    SELECT lang, size, phrase, count(*) AS f FROM (
        SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
        FROM pieces CROSS JOIN range(1, 4) r(size)) GROUP BY ALL),
words AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
split AS MATERIALIZED (
    SELECT lang, phrase, size, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail
    FROM candidates CROSS JOIN range(1, 3) k(k) WHERE k < size),
cuts AS (
    SELECT s.lang, s.phrase, s.size, a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
    FROM split s JOIN f x ON x.lang = s.lang AND x.phrase = s.head JOIN f y ON y.lang = s.lang AND y.phrase = s.tail),
scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS longer
    FROM candidates CROSS JOIN range(1, 3) r(i) WHERE size = 3 GROUP BY ALL),
ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
    FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN words USING (lang) WHERE rank <= 2000
"""

#: DuckDB SQL of the whole result: all pairs for near copies, every pattern on every text for secrets.
ORACLE_SQL = {"op2_chat_rotation": _ROTATION_SQL, "op5_secret_scan": _SECRETS_SQL, "op6_minhash_near_dedup": _NEAR_SQL, "op10_exact_dedup": _EXACT_SQL,
              "op11_vector_codes": _CODES_SQL, "op13_collocations": _PHRASES_SQL}
