"""Registered queries of the training-data operators over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import staged
from . import byte_bpe, conversations, decontamination, embedding_index, html_extract, language_id, manifest, near_dedup, pii, quality_classifier, quality_rules, toxicity, warc
from .frame import crc_part

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Key of the pseudonyms in the registered query; a deployment passes its own secret.
PSEUDONYM_KEY = "registered query"


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _in_part(parts: int, part: int):
    return F.coalesce(crc_part("doc_id", parts) == part, F.lit(False))


@_query("op1_language_id")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(crc_part("doc_id", 4) != 2).select("text", "lang"))
    return (language_id.identify(docs.select("doc_id", "text"), model)
            .select("doc_id", _in_part(4, 2).alias("held_out"), "lang_pred", "score"))


QUALITY_SQL = r"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, lang, source, i, list_slice(words, i, i + 2) AS gram FROM w, unnest(generate_series(1, len(words) - 2)) AS t(i)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
c AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM r, unnest([0, 1, 2]) AS t(d) GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS (SELECT doc_id, lang, source, base_failed, unnest(['a', 'b', 'c', 'd']) AS ratio, unnest([n_symbols / greatest(n_words, 1),
    word_chars / greatest(n_words, 1), n_dup_lines / greatest(n_lines, 1), n_repeat_words / greatest(n_words, 1)]) AS x FROM b),
p AS (SELECT * FROM v WHERE NOT base_failed),
q2 AS (SELECT lang, source, ratio, count(*) AS n, quantile_disc(x, 0.25) AS lo, quantile_disc(x, 0.75) AS hi FROM p GROUP BY ALL),
q1 AS (SELECT lang, ratio, count(*) AS n, quantile_disc(x, 0.25) AS lo, quantile_disc(x, 0.75) AS hi FROM p GROUP BY ALL),
q0 AS (SELECT ratio, quantile_disc(x, 0.25) AS lo, quantile_disc(x, 0.75) AS hi FROM p GROUP BY ALL),
f AS (SELECT q2.lang, q2.source, q2.ratio,
    CASE WHEN q2.n >= 200 THEN q2.lo WHEN q1.n >= 200 THEN q1.lo ELSE q0.lo END AS lo, CASE WHEN q2.n >= 200 THEN q2.hi WHEN q1.n >= 200 THEN q1.hi ELSE q0.hi END AS hi
    FROM q2 JOIN q1 ON q2.lang IS NOT DISTINCT FROM q1.lang AND q2.ratio = q1.ratio JOIN q0 ON q2.ratio = q0.ratio),
k AS (SELECT v.doc_id, bool_and(f.ratio IS NULL OR (x <= hi + greatest(3 * (hi - lo), CASE v.ratio WHEN 'a' THEN 0.1 WHEN 'b' THEN 2.0 WHEN 'c' THEN 0.5 ELSE 0.35 END)
    AND (v.ratio <> 'b' OR x >= lo - greatest(3 * (hi - lo), 2.0)))) AS inside
    FROM v LEFT JOIN f ON v.lang IS NOT DISTINCT FROM f.lang AND v.source IS NOT DISTINCT FROM f.source AND v.ratio = f.ratio GROUP BY v.doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept
FROM b JOIN k ON b.doc_id = k.doc_id"""


@_query("op2_quality_rules", QUALITY_SQL)
def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query("op3_pii")
def private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
CONTAMINATION_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS gram
    FROM b, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS gram FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS t(i)),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.gram = bw.gram),
hw AS (SELECT doc_id, count(DISTINCT i + o)::BIGINT AS n_hit FROM h, unnest(generate_series(0, n - 1)) AS t(o) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item_id)::BIGINT AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id"""


@_query("op4_decontamination", CONTAMINATION_SQL)
def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_matches(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


REVISIT_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON payload_digest = d AND payload_bytes >= 100"""


@_query("op5_warc", REVISIT_SQL)
def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.deduplicated_archives(_table(spark, sf_dir, "pages"), warc.archive_path(spark))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op6_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels.filter(crc_part("doc_id", 5) != 0))
    return toxicity.classify(docs, model).select("doc_id", _in_part(5, 0).alias("held_out"), "score", "predicted")


@_query("op7_byte_bpe")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(words, i, i + 4) AS shingle FROM w, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS t(i) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
j AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM j JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN c ON w.doc_id = c.a"""


@_query("op8_near_dedup", NEAR_SQL)
def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


@_query("op9_quality_classifier")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = staged(quality_classifier.features(docs), "quality-features")
    known = quality_classifier.labelled_features(measured.filter(crc_part("doc_id", 4) != 2), _table(spark, sf_dir, "labels"), "quality")
    model = quality_classifier.fit(known)
    return quality_classifier.score(measured, model).select("doc_id", _in_part(4, 2).alias("held_out"), "score", "predicted")


@_query("op10_html_extraction")
def extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def _crc(text: str) -> str:
    """SQL for the CRC-32 of a text of ASCII characters."""
    bits = "lambda x, y: xor(x >> 1, 3988292384 * (x & 1))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), "
            f"lambda a, c: list_reduce(list_prepend(xor(a, c), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {bits})))")


def _edit_table() -> str:
    """VALUES of all edits: code of the row, state before and after, cost, initials, inserted turns, what becomes of the row."""
    needed = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    rows = []
    for kind in "suax":
        for fault in "okd":
            for state in range(4):
                at, inserted = state, ""
                for n in range(3):
                    first = (f"'{kind}{fault}'", state)
                    if n:
                        inserted += f"\n{needed[at][0]}:"
                        at = needed[at][1]
                    text, more = "'" + inserted + "'", 5 * n + 5 * (fault == "k")
                    rows.append((*first, at, 5 * n + 2, f"'{'I' * n}D'", text, "'D'"))
                    if fault != "d":
                        role, to = needed[at]
                        rows.append((*first, to, more + 1, f"'{'I' * n}R'", text, f"'{role}'"))
                        if kind == role[0] or (kind == "s" and at == 0):
                            rows.append((*first, to if kind != "s" else 1, more, f"'{'I' * n}K'", text, "'K'"))
    return ", ".join("(" + ", ".join(map(str, r)) + ")" for r in rows)


REPAIR_SQL = rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f FROM conversations),
g AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM k, generate_series(1, CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM g),
n AS (SELECT *, left(role, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE 'sound' END AS fault FROM o),
a AS (SELECT *, coalesce(lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r NOT IN ('su', 'ua', 'au'), false) AS bad,
    CASE WHEN r IN ('s', 'u', 'a') THEN r ELSE 'x' END || CASE fault WHEN 'sound' THEN 'o' WHEN 'truncated' THEN 'k' ELSE 'd' END AS code FROM n),
e(code, s, t, cost, chars, ins, mode) AS (VALUES {_edit_table()}),
w AS (SELECT conv_id, 0::BIGINT AS i, 0 AS s, struct_pack(c := 0, a := '', o := '') AS b FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT w.conv_id, w.i + 1, e.t, min(struct_pack(c := w.b.c + e.cost, a := w.b.a || e.chars, o := w.b.o || e.ins || CASE e.mode WHEN 'D' THEN ''
        WHEN 'K' THEN chr(10) || a.role || ':' || a.text ELSE chr(10) || e.mode || ':' || a.text END))
    FROM w JOIN a ON w.conv_id IS NOT DISTINCT FROM a.conv_id AND a.i = w.i + 1 JOIN e ON e.code = a.code AND e.s = w.s GROUP BY w.conv_id, w.i, e.t),
z AS (SELECT conv_id, min(struct_pack(c := b.c + CASE s WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END, a := b.a || CASE s WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    o := b.o || CASE s WHEN 1 THEN chr(10) || 'user:' ELSE '' END || CASE WHEN s IN (1, 2) THEN chr(10) || 'assistant:' ELSE '' END)) AS b
    FROM (SELECT * FROM w QUALIFY i = max(i) OVER (PARTITION BY conv_id)) GROUP BY conv_id),
t AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal FROM a GROUP BY conv_id)
SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, z.b.c::BIGINT AS cost, z.b.a AS audit, sha256(substr(z.b.o, 2)) AS repaired_sha256
FROM z LEFT JOIN t ON z.conv_id IS NOT DISTINCT FROM t.conv_id"""


@_query("op13_conversation_repair", REPAIR_SQL)
def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.reports(conversations.repair(conversations.damage(_table(spark, sf_dir, "conversations"))))


MANIFEST_SQL = rf"""
WITH RECURSIVE c AS (SELECT doc_id, lang, {_crc("doc_id::VARCHAR")} % 3 = 0 AS altered,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
l AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(CASE WHEN altered THEN low ELSE text END) || ':' || CASE WHEN altered THEN low ELSE text END, '-')) AS other FROM c),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
u AS (SELECT lang, 0 AS level, pos, leaf AS digest FROM p
    UNION ALL
    SELECT lang, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY lang, level) AS n FROM u) WHERE n > 1 GROUP BY lang, level, pos // 8),
s AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, level AS height
    FROM (SELECT * FROM u QUALIFY level = max(level) OVER (PARTITION BY lang))),
v AS (SELECT 0 AS level, pos, subroot AS digest FROM s
    UNION ALL
    SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY level) AS n FROM v) WHERE n > 1 GROUP BY level, pos // 8),
r AS (SELECT digest AS root, level AS height FROM v ORDER BY level DESC LIMIT 1),
f AS (SELECT p.doc_id, p.lang, 0 AS step, p.pos, p.other AS digest, '' AS proof, s.pos AS lpos, s.height AS h FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang
    UNION ALL
    (WITH n AS (SELECT f.*, CASE WHEN step < h THEN f.pos ELSE lpos >> (3 * (step - h)) END AS own FROM f, r WHERE step < h + r.height),
    b AS (SELECT n.doc_id, n.lang, n.step, n.pos, n.lpos, n.h, n.digest, n.proof, n.own, u.pos AS q, u.digest AS d FROM n JOIN u ON n.step < n.h AND u.lang IS NOT DISTINCT FROM n.lang
        AND u.level = n.step AND u.pos // 8 = n.own // 8
        UNION ALL SELECT n.doc_id, n.lang, n.step, n.pos, n.lpos, n.h, n.digest, n.proof, n.own, v.pos, v.digest FROM n JOIN v ON n.step >= n.h AND v.level = n.step - n.h AND v.pos // 8 = n.own // 8)
    SELECT doc_id, lang, step + 1, pos // 8, sha256(string_agg(CASE WHEN q = own THEN digest ELSE d END, '' ORDER BY q)),
        proof || coalesce(string_agg(d, '' ORDER BY q) FILTER (q <> own), ''), lpos, h FROM b GROUP BY doc_id, lang, step, pos, lpos, h, digest, proof))
SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(f.proof) AS proof_sha256, f.digest AS folded_root, f.digest = r.root AS verified
FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN r JOIN f ON f.doc_id = p.doc_id AND f.step = f.h + r.height"""


@_query("op12_merkle_manifest", MANIFEST_SQL)
def merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return manifest.manifest(_table(spark, sf_dir, "documents"), altered={"text": F.coalesce(lower, F.col("text"))})


VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id"""


@_query("op11_embedding_dedup", VECTOR_SQL)
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_index.near_vectors(_table(spark, sf_dir, "embeddings"))
