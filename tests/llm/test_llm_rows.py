"""Operators that work row by row or per group of rows, against plain Python and on odd rows."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from voxelry.llm import byte_bpe, decontamination, html_extract, language_id, pii, quality_classifier, quality_rules, toxicity
from voxelry.llm.frame import refuse

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 20_000
ODD = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4), (4, "one", "en", "a", 3), (4, "one", "en", "a", 3),
       (5, LONG, "en", "a", len(LONG)), (None, "no id here", "en", "a", 10), (6, "Grüße 漢字 😀 \x00 ünïcode", "de", "b", 9)]
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).cache()


def reference_counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + d for at in grams.values() if len(at) > 1 for i in at for d in range(3)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, odd, sf):
    rng = random.Random(3)
    made = [(i, "".join(rng.choice(["a", "b", "c", " ", " ", "\n", "#", "é"]) for _ in range(rng.randint(0, 200)))) for i in range(200)]
    frame = spark.createDataFrame(made, "doc_id bigint, text string").unionByName(odd.select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    frame = frame.unionByName(spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id") + 5000, "text").toDF("doc_id", "text"))
    got = quality_rules.counts(frame.withColumn("t", F.col("text")), "t").collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == reference_counts(r.text), r.doc_id


def test_quality_rules_of_groups(spark, odd):
    rng = random.Random(5)
    good = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(80)), "en", "s", 0) for i in range(300)]
    bad = [(1000 + i, t.replace(" ", "### "), "en", "s", 0) for i, (_, t, *_r) in enumerate(good[:20])]
    docs = spark.createDataFrame(good + bad, DOCS).unionByName(odd).withColumn("kept_by", F.lit(1))
    rows = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert all(rows[i].kept for i in range(300) if i not in (1, 2, 3, 4, 5, 6)) and not any(rows[1000 + i].kept for i in range(20))
    assert rows[5].base_failed and not rows[5].kept  # one line over and over
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(7, 300))
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0


def test_quality_fences_fall_back(spark):
    rows = [(i, "w" * (3 + i % 3) + (" word" * 60), "en" if i else None, f"s{i}", 0) for i in range(30)]
    fences = quality_rules.fences(quality_rules.sketches(quality_rules.counts(spark.createDataFrame([(a, " ".join(
        f"{c}{k}" for k, c in enumerate(b.split())), *r) for a, b, *r in rows], DOCS))), min_docs=100).collect()
    assert len(fences) == 30 and len({(r.repeat_share_high, r.mean_word_chars_low) for r in fences}) == 1


def test_language_of_odd_rows(spark, odd):
    train = spark.createDataFrame([("the of and that this", "en"), ("der die und nicht ein", "de"), (None, "en"), ("x", None)], "text string, lang string")
    model = language_id.train(train)
    assert model.langs == ["de", "en"]
    out = {r.doc_id: r for r in language_id.identify(odd.withColumn("score", F.lit("old")), model).collect()}
    assert all(out[k].lang_pred == "und" and out[k].score == 0 for k in (1, 2, 3))
    assert all(0 <= r.score <= 1 for r in out.values()) and out[5].lang_pred in ("de", "en")
    assert language_id.identify(odd, language_id.train(train.limit(0))).filter("lang_pred <> 'und'").count() == 0
    assert language_id.identify(odd.limit(0), model).count() == 0


def test_grams_do_not_depend_on_blocks(monkeypatch):
    text = "Straße und Bäume, " * 40
    whole = [sorted(zip(d.tolist(), b.tolist())) for d, b in language_id.Grams().blocks([text, None, "ab", text[::-1]])]
    monkeypatch.setattr(language_id, "BLOCK", 64)
    cut = [p for d, b in language_id.Grams().blocks([text, None, "ab", text[::-1]]) for p in zip(d.tolist(), b.tolist())]
    assert sorted(cut) == sorted(p for w in whole for p in w)


def test_language_held_out(spark, sf):
    from voxelry.llm.queries import QUERIES

    got = QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    held = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert held > 0.95


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def test_bpe_equals_the_library(tik):
    pairs = byte_bpe.BytePairs(byte_bpe.read_ranks(PATH), PATTERN)
    rng = random.Random(11)
    alphabet = "abcdefghijklmnopqrstuvwxyzABéüß etaoin  \n\t'sdté漢字😀0123456789.,!?-aaaa<|endoftext|>"
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        ids = pairs.encode(text)
        assert ids == tik.encode_ordinary(text) and pairs.decode(ids) == text.encode()
    for text in ("a" * 5000, "ab" * 3000, "xy" * 2000 + "z", "é" * 999, "<|endoftext|>"):
        assert pairs.encode(text) == tik.encode_ordinary(text)


def test_bpe_rows(spark, odd, tik):
    rows = byte_bpe.tokenise(odd.withColumn("ids", F.lit(0)), PATH, PATTERN).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.ids == tik.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    for r in byte_bpe.token_digests(odd.withColumnRenamed("doc_id", "k"), PATH, PATTERN, key="k").join(odd.withColumnRenamed("doc_id", "k"), "k").collect():
        ids = tik.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert byte_bpe.tokenise(odd.limit(0), PATH, PATTERN).count() == 0


def test_bpe_of_pieces_around_the_short_ones(tik):
    """Pieces up to a length are merged pair by pair, longer ones walked."""
    pairs, rng = byte_bpe.BytePairs(byte_bpe.read_ranks(PATH), PATTERN), random.Random(7)
    for n in range(byte_bpe.SHORT - 3, byte_bpe.SHORT + 4):
        for alphabet in ("abcdefghijklmnopqrstuvwxyz", "ab", "ethanios", "éßeü", "漢字"):
            for _ in range(40):
                piece = "".join(rng.choice(alphabet) for _ in range(n))
                assert pairs.encode(piece) == tik.encode_ordinary(piece)


def test_bpe_remembers_frequent_pieces(monkeypatch):
    """A full memo does not forget the pieces that come again and again, and stays bounded."""
    monkeypatch.setattr(byte_bpe, "MEMO", 16)
    calls = []
    memo = byte_bpe._Pieces(lambda piece: calls.append(piece) or (len(piece),))
    for n in range(200):
        assert memo["often"] == (5,) and memo[f"rare{n}"] == (len(f"rare{n}"),)
        assert len(memo) + len(memo.older) <= 32
    assert calls.count("often") == 1


def test_bpe_of_long_pieces_is_linear(tik):
    """Twice the length of one piece takes about twice the time, and the ids stay those of the library."""
    import time

    pairs, rng = byte_bpe.BytePairs(byte_bpe.read_ranks(PATH), PATTERN), random.Random(4)
    piece = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400_000))
    pairs.encode_piece(piece[:50_000])
    spent = []
    for n in (200_000, 400_000):
        start = time.process_time()
        pairs.encode_piece(piece[:n])
        spent.append(time.process_time() - start)
    assert spent[1] < 3 * spent[0] + 0.2
    assert list(pairs.encode_piece(piece[:20_000])) == tik.encode_ordinary(piece[:20_000])


def brute_hits(text, items):
    words = decontamination.words_of(text)
    hit, found = set(), set()
    for name, item in items:
        own = decontamination.words_of(item)
        size = min(13, len(own))
        for j in range(len(own) - size + 1 if own else 0):
            for i in range(len(words) - size + 1):
                if words[i:i + size] == own[j:j + size]:
                    hit.update(range(i, i + size))
                    found.add(str(name))
    return len(words), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark, odd):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "b", "c", "dd", "é"])
    items = [(k, " ".join(word() for _ in range(rng.randint(1, 25)))) for k in range(12)] + [(90, None), (91, "  "), (3, "dd dd é a b")]
    docs = [(i, " ".join([word() for _ in range(rng.randint(0, 60))] + items[i % 12][1].split()[:20] + [word() for _ in range(5)])) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").unionByName(odd.select("doc_id", "text").filter("doc_id <> 5"))
    frame = frame.withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (10 ** 9, 60):
        for r in decontamination.find_matches(frame, bench, block_chars=block, shard_words=40).collect():
            n, hit, found = brute_hits(r.text, items)
            assert (r.n_words, r.n_hit, r["items"]) == (n, hit, found)
            assert r.contaminated == (hit > 0 and 20 * hit >= n)
            for m in r.matches:
                own = [decontamination.words_of(t) for k, t in items if str(k) == m.item_id]
                words = decontamination.words_of(r.text)
                assert any(words[m.start:m.start + m.words] == o[m.item_start:m.item_start + m.words] for o in own)
    assert decontamination.find_matches(frame, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontamination.decontaminate(frame.limit(0), bench).columns == frame.columns
    with pytest.raises(ValueError):
        decontamination.find_matches(frame.withColumn("spans", F.lit(1)), bench)


def test_longest_match_is_reported(spark):
    item = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "x y " + " ".join(f"w{i}" for i in range(5, 35)) + " z"), (2, " ".join(f"w{i}" for i in range(12)))], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in decontamination.find_matches(docs, spark.createDataFrame([(7, item)], "item_id bigint, text string")).collect()}
    assert [tuple(m) for m in rows[1].matches] == [("7", 5, 2, 30)] and rows[1].n_hit == 30 and rows[2].n_hit == 0


def test_repeated_words_in_linear_time(spark, odd):
    """One word over and over in document and item: the work follows their words and not the product; hits as by brute force."""
    import time

    items = [(1, "a " * 4000), (2, "a " * 20 + "b"), (3, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu alpha beta")]
    docs = [(10, "a " * 32_000), (11, "a " * 12), (12, "a " * 13 + "b " + "a " * 30), (13, LONG)]
    found, spent = [], []
    for scale in (1, 2):
        own = decontamination.Items([k for k, _ in items], [t * scale if k == 1 else t for k, t in items])
        start = time.process_time()
        found.append(decontamination.search(own, [t * scale if k == 10 else t for k, t in docs]))
        spent.append(time.process_time() - start)
    assert spent[1] < 4 * spent[0] + 1
    got = [(row["n_words"], sum(b - a for a, b in row["spans"]), row["items"]) for row in found[0]]
    # the last cycle of the long text ends 10 words after its last window begins anew
    assert got[0] == (32_000, 32_000, [0, 1]) and got[1] == (12, 0, []) and got[3] == (240_000, 239_990, [2])
    assert [m[3] for m in found[0][0]["matches"]] == [4000, 20]
    assert brute_hits(docs[2][1], items)[1:] == (sum(b - a for a, b in found[0][2]["spans"]), [str(items[k][0]) for k in found[0][2]["items"]])
    frame = odd.filter("doc_id = 5").select("doc_id", "text")
    row = decontamination.find_matches(frame, spark.createDataFrame(items, "item_id bigint, text string")).first()
    assert (row.n_words, row.n_hit, row["items"]) == (240_000, 239_990, ["3"])


def test_longest_match_by_neighbours():
    rng = np.random.default_rng(6)
    for _ in range(60):
        text, item = rng.integers(0, 3, rng.integers(1, 40)), rng.integers(0, 3, rng.integers(1, 25))
        start, at, words = decontamination.longest_match(text, item)
        runs = {n for n in range(1, 26) for i in range(len(item) - n + 1) for j in range(len(text) - n + 1) if (item[i:i + n] == text[j:j + n]).all()}
        assert words == max(runs, default=0) and (text[at:at + words] == item[start:start + words]).all()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def test_pseudonyms(spark, odd):
    text = ("call +1 (017) 555-7713 or bob.smith42@mail7.example.com, cards 4111 1111 1111 1111 and 4111111111111111, not 1234567812345678; "
            "2020-02-29, 29.02.2020, 02/29/2020, no date 2021-02-30; IBAN DE89 3704 0044 0532 0130 00; 192.168.1.77, 300.1.2.3; 123-45-6789; v 2.0.")
    docs = spark.createDataFrame([(1, text, "en", "a", 1), (2, "again 4111-1111-1111-1111!", "en", "a", 1)], DOCS).unionByName(odd).withColumn("m", F.lit(1))
    out = pii.pseudonymise(docs, "key")
    rows = {r.doc_id: r.text for r in out.filter("n_private > 0").collect()}
    assert set(rows) == {1, 2} and out.columns == [*docs.columns, "n_private"]
    new = rows[1]
    assert len(new) == len(text) or "192.168" not in new
    for gone in ("555-7713", "bob.smith42", "4111 1111", "41111111", "2020-02-29", "29.02.2020", "3704 0044", "192.168.1.77", "123-45-6789"):
        assert gone not in new
    for stays in ("1234567812345678", "2021-02-30", "300.1.2.3", "v 2.0.", "@mail7.example.com", "+1 (", "IBAN DE"):
        assert stays in new
    spaced, plain, other = re.search(r"cards ([\d ]{19}) and (\d{16}),", new).groups() + (re.search(r"again ([\d-]{19})!", rows[2]).group(1),)
    assert luhn(plain) and spaced.replace(" ", "") == plain == other.replace("-", "")
    iban = re.search(r"IBAN (DE[\d ]+)", new).group(1).replace(" ", "").strip()
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    back = pii.pseudonymise(out.drop("n_private"), "key", invert=True)
    assert back.select(*docs.columns).exceptAll(docs).count() == 0
    assert pii.pseudonymise(docs, "other key").filter("doc_id = 1").first().text != new
    assert pii.pseudonymise(docs.limit(0), "key").count() == 0


def test_pseudonyms_beside_short_numbers_and_words(spark):
    """Valid numbers do not hide behind neighbours; the numbers between ! marks are meant to change, all else stays."""
    texts = ["!4111111111111111! 123", "!4111 1111 1111 1111! 07", "2 !4111111111111111!", "1234 !4111 1111 1111 1111!", "!4111 1111 1111 1111! 123",
             "12 !3782-822463-10005! 4", "!4111 1111 1111 1111! !5500 0000 0000 0004!", "!41111111 11111111! x", "!4111111111111111! !2020-02-29!",
             "4111 1111 1111 1112", "!ES9121000418450200051332! BIC", "!AT611904300234573201! EUR", "!ES91 2100 0418 4502 0005 1332! BANK",
             "!DE89 3704 0044 0532 0130 00! GENODEF1", "AB12 !DE89 3704 0044 0532 0130 00!", "!AT61 1904 3002 3457 3201! !4111 1111 1111 1111!",
             "!AT61 1904 3002 3457 3201! !2020-02-29!", "!GB82 WEST 1234 5698 7654 32! OK", "DE88370400440532013000"]
    many = [f"{t[:-4]} {i:04d} !4111 1111 1111 1111!" for i, t in enumerate(["1234 5678 9012"] * 40, 1000)]
    texts += [t for t in many if not luhn((t[-26:-7] + t[-6:-1]).replace(" ", "").replace("!", "")[:16])][:1]
    docs = spark.createDataFrame([(i, t.replace("!", "")) for i, t in enumerate(texts)], "doc_id bigint, text string")
    out = pii.pseudonymise(docs, "key").cache()
    got = {r.doc_id: r for r in out.collect()}
    for i, t in enumerate(texts):
        parts, new = t.split("!"), got[i].text
        assert len(new) == len(t.replace("!", "")) and got[i].n_private == len(parts) // 2, (t, new)
        at = 0
        for k, part in enumerate(parts):
            piece, at = new[at:at + len(part)], at + len(part)
            assert (piece != part) == (k % 2 == 1), (t, new)
            if k % 2 and part[0].isdigit() and len(part) > 12:
                assert luhn(re.sub("[ -]", "", piece)), (t, new)
    assert pii.pseudonymise(out.drop("n_private"), "key", invert=True).drop("n_private").exceptAll(docs).count() == 0


def test_runs_of_numbers_are_invertible(spark):
    """Numbers beside others, of which the permutation could make valid ones."""
    rng = random.Random(4)
    group = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = [(i, rng.choice((" ", "-")).join(group(rng.choice((4, 4, 4, 4, 3, 16, 1))) for _ in range(rng.randint(4, 9)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = pii.pseudonymise(docs, "key").cache()
    assert out.filter("n_private > 0").count() > 50
    assert pii.pseudonymise(out.drop("n_private"), "key", invert=True).drop("n_private").exceptAll(docs).count() == 0


def test_runs_of_any_length(spark):
    """Every card number of a run is found however long the run is, and equal numbers keep equal pseudonyms, alone and in runs."""
    card, other = "4111 1111 1111 1111", "5500-0000-0000-0004"
    texts = {1: card, 2: " ".join([card] * 20), 3: " ".join([card, other] * 400), 4: "-".join([other] * 20), 5: "9 " * 30_000 + "end",
             6: "7" * 100_000, 7: " ".join(["1234"] * 5000 + [card])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(7)
    out = pii.pseudonymise(docs, "key").cache()
    got = {r.doc_id: r for r in out.collect()}
    alone = got[1].text
    assert alone != card and luhn(alone.replace(" ", ""))
    assert got[2].text == " ".join([alone] * 20) and got[2].n_private == 20
    pair = got[3].text[:39]
    assert pair.startswith(alone) and got[3].text == " ".join([pair] * 400) and got[3].n_private == 800
    assert got[4].text == "-".join([pair[20:]] * 20) and got[4].n_private == 20
    assert len(got[5].text) == len(texts[5]) and (got[6].text, got[6].n_private) == (texts[6], 0)
    assert "1111 1111" not in got[7].text
    assert pii.pseudonymise(out.drop("n_private"), "key", invert=True).drop("n_private").exceptAll(docs).count() == 0


def test_permutations_are_one_to_one(spark):
    days = spark.range(pii.CYCLE).select(pii.permute_number(F.col("id"), pii.CYCLE_A, pii.CYCLE_B, "k", "d").alias("x"))
    assert days.agg(F.count_distinct("x"), F.min("x"), F.max("x")).first() == (pii.CYCLE, 0, pii.CYCLE - 1)
    texts = spark.range(100_000).select(pii.permute_text(F.lpad(F.col("id").cast("string"), 5, "0"), "k", "t").alias("x"))
    assert texts.agg(F.count_distinct("x"), F.min(F.length("x"))).first() == (100_000, 5)


def test_toxicity_learns_marked_words(spark, odd):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["tion", "er", "the", "an", "ou", "st"]) for _ in range(rng.randint(1, 3)))
    rows = []
    for i in range(600):
        words = [word() for _ in range(rng.randint(30, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["scoundrel", "wretched", "vermin"])
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    labels = docs.select("doc_id", "label")
    model = toxicity.fit(docs, labels.filter("doc_id < 400"))
    held = toxicity.classify(docs.filter("doc_id >= 400").withColumn("score", F.lit(9)), model).collect()
    assert np.mean([r.predicted == r.label for r in held]) > 0.95
    scored = toxicity.classify(odd, model)
    assert scored.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0 and scored.count() == len(ODD)
    assert toxicity.fit(docs, labels.filter("label = 0")) is None and toxicity.fit(docs.limit(0), labels) is None
    assert toxicity.sample(docs, labels, max_docs=7).groupBy("label").count().filter("count = 7").count() == 2
    assert toxicity.classify(odd, None).filter("score <> 0").count() == 0


def test_quadratic_discriminant(spark, odd):
    rng = np.random.default_rng(1)
    d = len(quality_classifier.FEATURES)
    a = rng.normal(size=(400, d)) @ np.diag(np.linspace(0.5, 1, d)) + 2
    b = rng.normal(size=(800, d)) * 2
    rows = [(i, x.tolist(), int(k)) for i, (x, k) in enumerate([(x, 1) for x in a] + [(x, 0) for x in b])]
    frame = spark.createDataFrame(rows, "doc_id bigint, features array<double>, label int")
    model = quality_classifier.fit(frame, shrink=0.1, pool=0.2)
    x = np.vstack([a, b])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    logs = []
    for part, n in ((b, 800), (a, 400)):
        z = (part - mean) / scale
        cov = np.cov(z.T, bias=True)
        cov = 0.9 * cov + 0.1 * np.diag(np.diag(cov))
        cov = 0.8 * cov + 0.2 * np.eye(d)
        diff = (x - mean) / scale - z.mean(axis=0)
        logs.append(math.log(n / 1200) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff))
    assert np.allclose(model.log_odds(x), logs[1] - logs[0], atol=1e-6)
    scored = quality_classifier.score(quality_classifier.features(odd.withColumn("score", F.lit("x"))), model)
    assert scored.filter("score < 0 OR score > 1 OR score IS NULL OR predicted <> int(score >= 0.7)").count() == 0 and scored.count() == len(ODD)
    assert quality_classifier.fit(frame.filter("label = 1")) is None
    assert quality_classifier.score(frame, None).filter("score <> 0.5").count() == 0


def test_classifiers_held_out(spark):
    from voxelry.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for name, column, least in (("op6_toxicity", "toxic", 0.94), ("op9_quality_classifier", "quality", 0.97)):
        held = QUERIES[name](spark, sf).join(labels, "doc_id").filter("held_out")
        assert held.agg(F.avg((F.col(column) == F.col("predicted")).cast("double"))).first()[0] > least, name


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<div class="site-header">Top menu</div><nav><ul><li><a href="/">Home</a></li></ul></nav><div id="content"><div class="post"><h1>Head &amp; line</h1>
<p>First, second, third, and some more words &eacute;, so that this counts.<p>Unclosed <b>bo</b>ld   text,
over lines, with 1 &lt; 2.<ul><li>one, two<li>three, four</ul><!-- <p>hidden</p> --><div class="ad-box">Buy!</div><form>Search <input></form></div></div>
<div class="comments"><p>A reader says, at length, with commas, many, many, many of them, more, than, the, article, has, in, all, of, its, text, so, far.</p></div>
<aside>Side, side, side</aside><div class="sidebar"><a href="x">link, link, link</a></div><footer>&copy; Foot</footer></body></html>"""


def test_main_text(spark):
    want = ("Head & line First, second, third, and some more words é, so that this counts. Unclosed bold text, over lines, with 1 < 2. "
            "one, two three, four")
    assert html_extract.extract(PAGE) == want
    deep = "<div>" * 20_000 + "deep, text" + "</div>" * 20_000
    rows = [(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, "u", "just text & more"), (4, "u", "just text & more"), (5, "u", deep),
            (6, "u", "<p>open <a href='x>broken"), (7, "u", "<script>only</script>"), (8, "u", "<article>" + "<p>word, word</p>" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    out = html_extract.main_text(pages)
    got = {r.page_id: r for r in out.collect()}
    assert out.count() == len(rows) and got[1].text == want
    assert [got[k].text for k in (2, 3, 7)] == ["", "", ""] and got[4].text == "just text & more" and got[5].text == "deep, text"
    assert got[6].text.startswith("open") and got[8].text.count("word, word") == 20_000 and all(r.n_chars == len(r.text) for r in got.values())


def test_wrappers_with_boilerplate_names():
    """Names and forms around the article do not drop it; boilerplate in and beside it still goes."""
    prose = "<p>" + "One, two, three, and so on, as prose goes. " * 4 + "</p>"
    plain = " ".join(["One, two, three, and so on, as prose goes."] * 4)
    rest = '<div class="comments"><p>Nice, nice, really, nice.</p></div><div class="ad-box">Buy!</div><nav>Menu</nav>'
    for open_, close in (('<div class="content has-sidebar">', "</div>"), ('<div class="post comments-open">', "</div>"), ('<div id="main-with-nav">', "</div>"),
                         ('<form id="aspnetForm">', "</form>"), ('<div class="comments-open"><article>', "</article></div>"), ('<div class="promo">', "</div>")):
        assert html_extract.extract(f"<html><body>{open_}{prose}{prose}{rest}{close}</body></html>") == f"{plain} {plain}", open_
    assert html_extract.extract('<body><div class="sidebar">Just this</div></body>') == "Just this"
    long_talk = '<div class="post-comments">' + prose * 4 + "</div>"
    assert html_extract.extract(f'<body><div class="x">{prose}</div>{long_talk}</body>') == plain
    beside = f"<body><div><h1>Title</h1><div>{prose}{prose}</div><h2>Part</h2><p>Short.</p><div>{prose}{prose}</div></div><form>Search</form></body>"
    assert html_extract.extract(beside) == f"Title {plain} {plain} Part Short. {plain} {plain}"


ARTICLE = "<p>The quick, brown fox jumps over the lazy dog, and so on, for a while, until it is long enough, really.</p>" * 3


@pytest.mark.parametrize("page, words", [
    ('<div style="overflow:hidden"><article>%s</article></div>', ""), ('<div data-hidden="false">%s</div>', ""), ('<p title="the hidden truth">Kept words.</p>%s', "Kept words."),
    ("<!-->%s", ""), ("<!--->%s", ""), ("<!-- gone -- > still gone -->%s", ""), ('<svg class="i"/>%s', ""), ("<svg><svg><text>in</text></svg><text>leak</text></svg>%s", ""),
    ('<svg><path d="m">%s', ""), ('<div data-role="nav" item-id="sidebar" data-class="ad">%s</div>', ""), ("<form><label>Name</label><button>Send</button></form>%s", ""),
    ("<p>Press <button>Enter</button> and <label>Name</label>, <math><mi>x</mi></math> here.</p>%s", "Press Enter and Name, x here."),
    ("<ul><li><button>Share</button></li></ul>%s", ""), ('<iframe src="x">%s', ""), ("<p class=\"a\" id='b>c'>One.</p>%s", "One."), ("<svg><foreignObject><div>in</div></foreignObject></svg>%s", "")])
def test_odd_pages_keep_the_article(page, words):
    article = html_extract.extract(ARTICLE)
    assert article.count("quick") == 3
    assert html_extract.extract(page % ARTICLE) == (words + " " + article).strip()


def test_stray_end_tags_are_linear():
    import time

    spent = []
    for n in (8000, 16_000):
        start = time.process_time()
        html_extract.parse("<div>" * n + "</section>" * n + "</b>" * n)
        spent.append(time.process_time() - start)
    assert spent[1] < 4 * spent[0] + 0.2


def test_no_text_is_lost_against_a_plain_tokeniser():
    """Random pages: all text of an <article> outside dropped elements, as html.parser's tokens tell it, is in the result, in order."""
    from html.parser import HTMLParser

    gone = {"svg", "nav", "form", "script", "style", "select", "aside"}

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.stack, self.words = [], []

        def handle_starttag(self, tag, attrs):
            self.stack += [tag] if tag not in ("br", "img") else []

        def handle_endtag(self, tag):
            if tag in self.stack:
                while self.stack.pop() != tag:
                    pass

        def handle_data(self, data):
            if not gone & set(self.stack):
                self.words += data.split()

    rng = random.Random(12)

    def inline(depth):
        word = f"w{rng.randrange(10 ** 6)}"
        kind = rng.randrange(12)
        if depth and kind < 5:
            tag = rng.choice(["b", "i", "span", "em", "a", "math", "code"])
            return f"<{tag} title='hidden nav' style=\"overflow:hidden\" data-role=ad>{word} {inline(depth - 1)}</{tag}>"
        return word + (" <img src=x>" if kind == 6 else " <svg class='i'/>" if kind == 7 else "<!-- no -->" if kind == 8 else " <svg><svg><path/></svg><text>no</text></svg>" if kind == 9
                       else "<br/>" if kind == 10 else "")

    def block(depth):
        body = " ".join(inline(3) for _ in range(rng.randint(1, 12))) + "."
        kind = rng.randrange(8)
        if kind == 0:
            return f"<ul><li>{body}</li><li>{inline(2)}</li></ul>"
        if kind == 1 and depth:
            return f"<div data-class='sidebar' item-id=ad>{block(depth - 1)}{block(depth - 1)}</div>"
        if kind == 2:
            return f"<nav>{body}</nav>"
        if kind == 3:
            return f"<h2>{body}</h2>"
        if kind == 4:
            return f"<blockquote><p>{body}</p></blockquote><script>var x = '<p>';</script>"
        return f"<p>{body}</p>"

    for _ in range(150):
        page = "<html><body><article>" + "".join(block(2) for _ in range(rng.randint(2, 9))) + f"<p>{'long text, ' * 20}</p></article></body></html>"
        plain = Plain()
        plain.feed(page)
        assert "".join(html_extract.extract(page).split()) == "".join(plain.words)


def test_pages_of_the_tables(spark, sf):
    """The pages' articles, cut out by their tags, without markup."""
    import html

    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    got = {r.page_id: r.text for r in html_extract.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1).replace("<br>", " ")
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)\b[^>]*>", article))
        assert got[r.page_id] == " ".join(b for b in blocks if b)


def test_helper_columns_are_refused(odd):
    with pytest.raises(ValueError):
        refuse(odd.withColumn("_LLM_x", F.lit(1)))
