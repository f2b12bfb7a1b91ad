"""Operators that shuffle: near-duplicates, archives, and the pipeline, against brute force."""

import glob
import gzip
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from test_llm_rows import LONG, brute_hits, reference_counts
from voxelry.llm import byte_bpe, near_dedup, pii, quality_rules, warc
from voxelry.session import stage_path


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def components(docs, percent=85):
    """doc_id -> (set size, smallest reachable id), by comparing all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, count):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 5)))
    texts = []
    for _ in range(count):
        base = [word() for _ in range(rng.choice((3, 7, 12, 60, 150)))]
        for _ in range(rng.choice((1, 2, 6))):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy))
    return texts


def test_near_duplicates_against_brute_force(spark):
    texts = near_copies(1, 150) + ["", None, " \n", "Word", "word", LONG, LONG + " end"]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("key", F.lit("clash")).withColumn("band", F.lit(1))
    want = components(docs)
    got = near_dedup.near_duplicates(frame).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)
    kept = near_dedup.deduplicate(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if c == i}


def test_a_large_group_meets_in_blocks(spark, monkeypatch):
    """Near copies of one text, many of which link to others only: cells of a key hold few members, the result is the same."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(150)] = f"x{rng.randrange(10 ** 6)}"
        docs.append((i, " ".join(copy)))
    want = {i: c for i, (_, c) in components(docs).items()}
    assert len(set(want.values())) > 5
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame).collect()} == want
    for bounds in ((16, near_dedup.BLOCK_BYTES), (near_dedup.BLOCK, 6000)):
        monkeypatch.setattr(near_dedup.across, "__defaults__", bounds)
        assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame).collect()} == want


def test_odd_rows_of_near_duplicates(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "A B C D E F")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_registers_estimate_similarity():
    rng = np.random.default_rng(3)
    for n, share in ((40, 0.9), (300, 0.85), (3000, 0.5), (20_000, 0.0)):
        errors = []
        for _ in range(30):
            common = int(n * share)
            a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[:0], rng.choice(a, common, replace=False), rng.integers(0, 2 ** 64, n - common, dtype=np.uint64)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            found = near_dedup.estimate(near_dedup.registers(a)[None], near_dedup.registers(b)[None], np.array([float(len(a))]), np.array([float(len(b))]))[0]
            errors.append(found - true)
        assert abs(np.mean(errors)) < 0.04 and np.max(np.abs(errors)) < 0.3, (n, share, np.mean(errors))


def test_archives_round_trip(spark):
    twice, small = "<p>same payload</p>" * 10, "tiny"
    rows = [(5, "http://a/1", twice), (3, "http://a/2\r\nX: y", twice), (9, "http://a/3", twice), (4, None, small), (6, "u", small), (7, "u", None),
            (8, "u", ""), (10, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n\r\n" + "é漢😀" * 50), (11, "u", LONG), (None, "u", twice),
            (3, "http://a/2\r\nX: y", twice)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("payload", F.lit("clash"))
    path = stage_path(spark, "warc-test")
    got = warc.deduplicated_archives(pages, path, file_records=3).collect()
    assert len(got) == len(rows)
    for r in got:
        html = {i: h for i, _, h in rows}[r.page_id] or ""
        raw = html.encode()
        assert r.payload_bytes == len(raw) and r.payload_digest == hashlib.sha256(raw).hexdigest()
        again = html == twice and r.page_id != 3
        assert (r.record_type, r.refers_to) == (("revisit", 3) if again else ("response", None)), r
    full = warc.read_archives(spark, path)
    payloads = {r.page_id: bytes(r.payload) for r in full.filter("record_type = 'response'").collect()}
    assert payloads[10] == rows[7][2].encode() and payloads[7] == b"" and payloads[11] == LONG.encode()
    assert full.filter("url = 'http://a/2 X: y'").count() == 2
    ids = {r.record_id for r in full.filter("record_type = 'response'").collect()}
    assert all(r.refers_to_record in ids for r in full.filter("record_type = 'revisit'").collect())
    for file in glob.glob(f"{path}/*.gz"):
        assert gzip.open(file).read().endswith(b"\r\n\r\n")
    empty = warc.deduplicated_archives(pages.limit(0), stage_path(spark, "warc-empty"))
    assert empty.count() == 0


def test_archives_are_resolved_again(spark):
    """Two crawls: the second has an earlier page of a payload, and a revisit of a page that no archive holds."""
    big = "<p>payload</p>" * 20
    first = warc.resolve_revisits(warc.digests(spark.createDataFrame([(5, "a", big), (6, "b", big), (7, "c", "x")], "page_id bigint, url string, html string")))
    lost = warc.digests(spark.createDataFrame([(8, "d", "gone" * 50)], "page_id bigint, url string, html string")).selectExpr(
        "page_id", "url", "CAST(NULL AS string) AS html", "payload_bytes", "payload_digest", "'revisit' AS record_type", "4L AS refers_to")
    second = warc.resolve_revisits(warc.digests(spark.createDataFrame([(2, "e", big)], "page_id bigint, url string, html string")))
    source, path = stage_path(spark, "warc-source"), stage_path(spark, "warc-again")
    columns = ["page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    warc.write_archives(first.select(*columns).unionByName(lost.select(*columns)).unionByName(second.select(*columns)), source)
    warc.rewrite_archives(spark, source, path)
    rows = {r.page_id: (r.record_type, r.refers_to, bytes(r.payload or b"").decode()) for r in warc.read_archives(spark, path).collect()}
    assert rows == {2: ("response", None, big), 5: ("revisit", 2, ""), 6: ("revisit", 2, ""), 7: ("response", None, "x"), 8: ("revisit", 4, "")}


def test_archive_files_are_bounded_by_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "x" * 5000), (2, "u", None), (3, "u", "y" * 100_000)], "page_id bigint, url string, html string")
    assert warc.records_a_file(pages) == 2000 and warc.records_a_file(pages, file_bytes=300_000) == 2 and warc.records_a_file(pages, file_bytes=10) == 1
    assert warc.records_a_file(pages.limit(0)) == 2000
    rows = warc.deduplicated_archives(pages, stage_path(spark, "warc"), file_records=1).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in rows) == [(1, 5000), (2, 0), (3, 100_000)]


def test_pipeline_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in quality_rules.quality_rules(docs).filter("kept").collect()}
    for i in good:
        words, *_, repeated = reference_counts(rows[i].text)
        assert words >= 50 and 100 * repeated <= 50 * words
    single = {i for i, (_, c) in components([(i, rows[i].text) for i in good], corpus_pipeline.SIMILAR).items() if c == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = set()
    for i in single:
        n, hit, _ = brute_hits(rows[i].text, items) if any(w in rows[i].text.lower() for w in (t.lower()[8:40] for _, t in items)) else (1, 0, [])
        if not (hit and 20 * hit >= n):
            clean.add(i)
    result = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    flagged = single - set(result)
    for i in flagged:
        n, hit, _ = brute_hits(rows[i].text, items)
        assert hit and 20 * hit >= n
    assert set(result) <= single and set(result) | flagged == single
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    texts = {r.doc_id: r.text for r in pii.pseudonymise(docs, "registered query").collect()}
    for i, r in result.items():
        ids = tik.encode_ordinary(texts[i])
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256(texts[i].encode()).hexdigest())
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_near_duplicate_stage_at_80_percent(spark):
    """Copies of 0.80 to 0.85 go too: exactly 0.80, 0.83, just below 0.80, and texts of the tables."""
    words = [f"w{i}" for i in range(400)]
    docs = [(1, " ".join(words[:94])), (2, " ".join(words[10:104])), (3, " ".join(words[200:294])), (4, " ".join(words[208:302])),
            (5, " ".join(words[300:394])), (6, " ".join(words[311:400] + ["x", "y", "z", "u", "v"]))]
    rows = docs + [(r.doc_id + 10, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    sets, gone = {i: shingles(t) for i, t in rows}, {}
    for i, a in sets.items():
        gone[i] = {j for j, b in sets.items() if j != i and (both := len(a & b)) and 100 * both >= 80 * (len(a) + len(b) - both)}
    single = set()
    for i in sorted(sets):
        reached, todo = {i}, [i]
        while todo:
            new = gone[todo.pop()] - reached
            reached |= new
            todo += new
        if min(reached) == i:
            single.add(i)
    assert 2 not in single and 4 not in single and 6 in single
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id for r in dict(corpus_pipeline.STAGES)["near-duplicates"](spark, frame, "").collect()} == single


def test_bands_follow_the_threshold():
    assert [near_dedup.band_rows(p) for p in (85, 80)] == [7, 6]
    rows, rng = near_dedup.band_rows(80), np.random.default_rng(11)
    bands = near_dedup.BUCKETS // rows
    for _ in range(4000):
        h = rng.integers(0, 2 ** 64, 220, dtype=np.uint64)
        a, b = (near_dedup.registers(np.sort(x)) for x in (h[:198], h[22:]))
        assert (a == b)[:bands * rows].reshape(bands, rows).all(axis=1).any()


def test_stages_keep_the_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for odd in (docs.limit(0), spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0)], docs.schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, odd, sf).columns == docs.columns, name


@pytest.mark.parametrize("name", ["op1_language_id", "op6_toxicity", "op9_quality_classifier", "op2_quality_rules", "op10_html_extraction"])
def test_whole_tables_come_back(spark, name):
    from voxelry.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    table = "pages" if name.startswith("op10") else "documents"
    assert QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/{table}.parquet").count()
