"""Operators without SQL against versions in plain Python, one value at a time."""

import datetime
import hashlib
import math
import random

import numpy as np
import regex
import zstandard
from pyspark.sql import functions as F

from test_llm_rows import LONG
from voxelry.llm import language_id, near_dedup, pii, quality_rules, toxicity

KEY = "plain"


def draw(*parts):
    return int(hashlib.sha256("|".join([KEY, *map(str, parts)]).encode()).hexdigest()[:12], 16)


def moved_text(value, kind):
    left, right = value[:len(value) // 2], value[len(value) // 2:]
    for i in range(8):
        out = []
        for j, c in enumerate(left):
            d = draw(kind, i, j, right)
            for first, size in (("0", 10), ("A", 26), ("a", 26)):
                if 0 <= ord(c) - ord(first) < size:
                    c = chr((ord(c) - ord(first) + d % size) % size + ord(first))
                    break
            out.append(c)
        left, right = right, "".join(out)
    return left + right


def moved_number(value, a, b, kind):
    left, right = divmod(value, b)
    for i in range(8):
        if i % 2 == 0:
            left = (left + draw(kind, i, right) % a) % a
        else:
            right = (right + draw(kind, i, left) % b) % b
    return left * b + right


def only_digits(value):
    return "".join(c for c in value if c in "0123456789")


def refilled(mask, characters):
    rest = iter(characters)
    return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in mask)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def spans(run):
    """Valid card numbers from left to right: usual groupings first, then pieces in any grouping between them."""
    def scan(shapes, taken, whole):
        at, found = 0, []
        for i, c in enumerate(run):
            if i < at or not c.isdigit() or i and run[i - 1].isdigit():
                continue
            if any(a <= i < a + n for a, n in taken):
                continue
            stop = min([a for a, n in taken if a + n > i], default=len(run))
            parts = [m.group() for s in shapes if (m := regex.match(rf"(?:{s})(?![0-9A-Za-z])", run[i:stop]))]
            good = [p for p in parts if luhn(only_digits(p)) == 0]
            if good:
                found.append((i, len(good[0])))
                at = i + len(good[0])
            elif parts and whole:
                at = i + len(parts[0])
        return found

    usual = scan(pii._CARD_SHAPES, [], False)
    return sorted(usual + scan([pii._PIECE], usual, True))


def moved_run(run):
    """One number after the other, each permuted until the whole run shows the same numbers again."""
    places = spans(run)
    for a, n in places:
        while True:
            digits = only_digits(run[a:a + n])
            body = moved_text(digits[:-1], "card")
            check = next(c for c in "0123456789" if luhn(body + c) == 0)
            run = run[:a] + refilled(run[a:a + n], body + check) + run[a + n:]
            if spans(run) == places:
                break
    return run, len(places)


def remainder(plain):
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def moved_date(value):
    for form, kind in ((("%Y-%m-%d", "date-"),) if "-" in value else (("%d.%m.%Y", "date."),) if "." in value else (("%m/%d/%Y", "date/"), ("%d/%m/%Y", "date/d"))):
        try:
            day = datetime.datetime.strptime(value, form).date()
        except ValueError:
            continue
        cycle, place = divmod((day - datetime.date(2000, 1, 1)).days, 146097)
        return (datetime.date(2000, 1, 1) + datetime.timedelta(cycle * 146097 + moved_number(place, 189, 773, kind))).strftime(form)
    return value


def plain_pseudonym(value):
    kind = lambda name: regex.fullmatch(pii.PATTERNS[name], value)
    if kind("email"):
        name, host = value.split("@", 1)
        new = moved_text(name, "email") + "@" + host
    elif kind("iban"):
        plain = value.replace(" ", "")
        body = moved_text(plain[4:], "iban")
        check = f"{98 - remainder(plain[:2] + '00' + body):02}"
        new = refilled(value, plain[:2] + check + body) if remainder(plain) == 1 else value
    elif kind("date"):
        new = moved_date(value)
    elif kind("ip"):
        parts = [int(x) for x in value.split(".")]
        number = moved_number(int.from_bytes(bytes(parts), "big"), 65536, 65536, "ip") if max(parts) < 256 else 0
        new = ".".join(str(b) for b in number.to_bytes(4, "big")) if max(parts) < 256 else value
    elif kind("ssn"):
        new = refilled(value, moved_text(only_digits(value), "ssn"))
    elif regex.fullmatch("[0-9][0-9 -]*", value) and len(only_digits(value)) >= 13:
        return moved_run(value)
    elif kind("phone"):
        prefix = (m.group() if (m := regex.match(r"\+[0-9]{1,3}(?=[ .(-])|\+[0-9]", value)) else "")
        new = prefix + refilled(value[len(prefix):], moved_text(only_digits(value[len(prefix):]), "phone"))
    else:
        new = value
    return new, int(new != value)


def plain_text(text):
    count, out, at = 0, "", 0
    for m in regex.finditer(pii.ANY, text):
        new, n = plain_pseudonym(m.group())
        out, at, count = out + text[at:m.start()] + new, m.end(), count + n
    return out + text[at:], count


def test_pseudonyms_against_plain_python(spark):
    """Every text of a table, and made ones with values side by side."""
    rng = random.Random(6)
    values = ["4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", "3782 822463 10005", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "2024-02-29", "29.02.2023",
              "12/31/1999", "31/12/1999", "10.0.0.255", "300.1.1.1", "123-45-6789", "+49 30 1234567", "(415) 555-0132", "a.b@x.org", "12", "FOO", "4111 1111 1111 1112", "42"]
    made = [" ".join(rng.choice(values) for _ in range(rng.randint(1, 9))) for _ in range(150)] + [", ".join(values), "", "plain"]
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    made += [" ".join(digits(rng.choice((1, 3, 4, 4, 4, 4, 5, 6, 13, 16))) for _ in range(n)) for n in (20, 60, 90, 120)]  # runs of hundreds of digits
    made += ["4111 1111 1111 1111 " * 30 + "12ab", "4111-1111-1111-1111-" * 25, "1234567890" * 40]
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = list(enumerate([t for t in texts if t is not None] + made))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = {r.doc_id: (r.text, r.n_private) for r in pii.pseudonymise(frame, KEY).collect()}
    for i, text in rows:
        assert got[i] == plain_text(text), text
    assert sum(n for _, n in got.values()) > 500


def plain_grams(text):
    said = []
    for c in (text or "").lower():
        if c.isalpha():
            said.append(ord(c))
        elif said and said[-1] != 32:
            said.append(32)
    for size in language_id.ORDERS:
        for at in range(len(said) - size + 1):
            h = 0
            for c in said[at:at + size]:
                h = (h * 0x01000193 + c) % 2 ** 32
            yield ((h ^ size * 0x9E37) * 0x9E3779B1 % 2 ** 32) * language_id.BUCKETS >> 32


def test_language_posteriors_against_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r.doc_id, (r.text or "")[:1500], r.lang) for r in docs.collect()] + [(9000, "", "en"), (9001, None, "fr"), (9002, "12 !", "de"), (9003, "ß", None)]
    counts, texts = {}, {}
    for i, text, lang in rows:
        if i % 3 and text is not None and lang is not None:
            texts[lang] = texts.get(lang, 0) + 1
            own = counts.setdefault(lang, {})
            for g in plain_grams(text):
                own[g] = own.get(g, 0) + 1
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    model = language_id.train(frame.filter("doc_id % 3 <> 0"))
    got = {r.doc_id: r for r in language_id.identify(frame, model).collect()}
    names = sorted(texts)
    assert model.langs == names
    total = {x: sum(counts.get(x, {}).values()) + 0.5 * language_id.BUCKETS for x in names}
    for i, text, _ in rows:
        grams = list(plain_grams(text))
        logs = [math.log(texts[x] / sum(texts.values())) + sum(math.log((counts.get(x, {}).get(g, 0) + 0.5) / total[x]) for g in grams) / len(language_id.ORDERS) for x in names]
        if not grams:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        share = [math.exp(v - max(logs)) for v in logs]
        best = max(range(len(names)), key=lambda k: logs[k])
        assert got[i].lang_pred == names[best] or sorted(logs)[-1] - sorted(logs)[-2] < 1e-3
        assert abs(got[i].score - share[best] / sum(share)) < 1e-3


def test_toxicity_features_and_calibration_against_plain_python():
    rng = random.Random(2)
    toxic, plain = b"vile scum rotten filth", b"the quick brown fox jumps over the lazy dog again"
    distance = toxicity.Distance(plain, toxic)
    known = zstandard.ZstdCompressionDict(toxic + plain, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    base = zstandard.ZstdCompressionDict(plain, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    length = lambda w, d: len(zstandard.ZstdCompressor(compression_params=toxicity._parameters(), dict_data=d).compress(w))
    for _ in range(30):
        words = [rng.choice(["vile", "SCUM", "fox", "dog", "rotten", "again", "ünd"]) for _ in range(rng.randint(1, 60))]
        saved = []
        for at in range(0, len(words), 8):
            window = (" " + " ".join(words[at:at + 8]).lower() + " ").encode()
            saved.append(length(window, base) - length(window, known))
        over = [sum(s >= step for s in saved) for step in toxicity.STEPS]
        want = [sum(saved) / len(saved), max(saved), sum(sorted(saved)[-3:]) / min(3, len(saved)), *[o / len(saved) for o in over], *[math.log(1 + o) for o in over]]
        assert np.allclose(distance.features(" ".join(words)), want)
    assert (distance.features(None) == 0).all() and np.isfinite(distance.features(LONG)).all()

    # calibration: the same optimum by plain gradient descent
    data = np.random.default_rng(3)
    rows = data.standard_normal((400, 4)) * (1, 2, 5, 0.1) + 3
    labels = (rows @ (0.5, -0.2, 0.1, 2) + data.standard_normal(400) > 7.2).astype(float)
    centre, spread, weights, bias = toxicity.calibrate(rows, labels)
    x = np.hstack([(rows - rows.mean(axis=0)) / (rows.std(axis=0) + 1e-9), np.ones((400, 1))])
    w, penalty = np.zeros(5), np.array([1, 1, 1, 1, 1e-6])
    for _ in range(20_000):
        w += 0.005 * (x.T @ (labels - 1 / (1 + np.exp(-(x @ w)))) - penalty * w)
    assert np.allclose(np.append(weights, bias), w, atol=1e-4)


def test_toxicity_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(60)] + [(7, None), (None, "y")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1)], "doc_id bigint, label int")
    taken = lambda **bounds: toxicity.sample(docs, labels, **bounds).collect()
    assert sorted((r.doc_id, r.label) for r in taken()) == [(i, i % 2) for i in range(60)]
    assert sum(len(r.text) for r in taken(max_total=500)) <= 500 < sum(len(r.text) for r in taken())
    assert len(taken(max_docs=5)) == 10 and max(len(r.text) for r in taken(max_chars=20)) == 20


def test_small_sets_are_rarely_missed():
    """Share of pairs at the threshold that no band finds, by the size of the sets."""
    rng = np.random.default_rng(4)
    rows = near_dedup.band_rows(85)
    bands = near_dedup.BUCKETS // rows
    for size, shared, extra, trials, most in ((7, 6, 0, 8000, 4), (13, 12, 1, 4000, 1), (37, 34, 3, 3000, 1)):
        assert 100 * shared >= 85 * (size + extra)
        missed = 0
        for _ in range(trials):
            h = rng.integers(0, 2 ** 64, size + extra, dtype=np.uint64)
            a, b = near_dedup.registers(np.sort(h[:size])), near_dedup.registers(np.sort(np.concatenate([h[:shared], h[size:]])))
            missed += not (a == b)[:bands * rows].reshape(bands, rows).all(axis=1).any()
        assert missed <= most, (size, missed)


def test_sketch_fences_of_large_groups(spark):
    """Sketches of more values than they keep exactly: the fences stay within one per cent in rank."""
    frame = spark.range(40_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("x"))
    values = np.sort(np.array([r.x for r in frame.collect()]))
    sketch = frame.agg(F.kll_sketch_agg_double("x", 1024).alias("s"))
    for q in (0.25, 0.75):
        found = sketch.select(F.kll_sketch_get_quantile_double("s", F.lit(q)).alias("v")).first().v
        assert abs(np.searchsorted(values, found) / len(values) - q) < 0.01
