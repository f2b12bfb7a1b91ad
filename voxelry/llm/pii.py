"""Format-preserving pseudonyms of personal data: Feistel networks in DataFrame expressions, without UDFs, pandas or RDDs.

Numbers and dates that pass their check (Luhn, IBAN mod 97, octets up to 255, days of the calendar) are permuted under a key inside their own format:
a card number becomes another valid one with the same separators, a date another date in the same notation. A permutation never maps two
values to one, and equal values get equal pseudonyms in every document, so links survive. Numbers that fail their check are left alone; a valid
one beside a short number, a word in capitals or another value is still found.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .frame import OWN, refuse

ROUNDS = 8
#: Permutations of a number until the same numbers are found around it. The orbit returns, as the start itself has them; a step does so with a probability
#: above 0.1 even where every grouping competes, so 2 000 steps do not suffice once in 10^90. More are an error and no silent loss of the way back.
WALK = 2000
#: Patterns of the kinds, in the order in which they are tried at a place. A host name has at most 127 labels; that bound also keeps the
#: matcher's stack small on hostile texts.
_DATE = r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z/-])"
_IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_PHONE = (r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){1,4}"
          r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])")
#: Characters of an IBAN by country, of the registry of IBAN formats.
IBAN_SIZES = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
              22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
              26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
              31: "MT SC", 32: "LC", 33: "RU"}
_OF_COUNTRY = "(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
                               + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, names in IBAN_SIZES.items()) + ")(?![A-Za-z0-9])"
#: Usual groupings of card numbers, each with one separator; at a place the first that is valid counts.
_CARD_SHAPES = [r"[0-9]{13,19}", *(sep.join(f"[0-9]{{{n}}}" for n in sizes) for sep in (" ", "-")
                                  for sizes in ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (6, 13)))]
_CARD_SHAPE = "(?:" + "|".join(_CARD_SHAPES) + ")(?![0-9A-Za-z])"
#: Digits of a card number in any grouping: up to 19, with a blank or hyphen between any two.
_PIECE = r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
#: A group of a run with its separator; the most groups and characters (one more shows the end) of a usual grouping and of any other.
_GROUP = "[0-9]+[ -]?"
_USUAL_GROUPS, _USUAL_WIDTH = 5, 24
_ANY_GROUPS, _ANY_WIDTH = 19, 38
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){1,126}",
    # the length of a known country ends an IBAN; one of another length goes on at a blank only where nothing else begins
    "iban": rf"(?<![A-Za-z0-9])(?:{_OF_COUNTRY}|[A-Z]{{2}}[0-9]{{2}}(?:(?: (?!{_OF_COUNTRY}|{_CARD_SHAPE}|{_DATE}|{_IP}|{_SSN}|{_PHONE}))?[A-Z0-9]{{4}}){{2,7}}"
            rf"(?:(?: (?!{_DATE}|{_IP}|{_SSN}|{_PHONE}))?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9]))",
    "date": _DATE,
    "ip": _IP,
    "ssn": _SSN,
    "phone": _PHONE,
    # a run of at least 13 digits of any length, in which _card looks for numbers; whole groups, and none where something else begins. Possessive, so
    # that the matcher's stack does not grow with the run
    "card": rf"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++(?![A-Za-z])(?:[ -](?!{_DATE}|{_IP}|{_SSN}|{_PHONE})[0-9]++(?![A-Za-z]))*+",
}
ANY = "|".join(PATTERNS.values())
#: Days of the Gregorian cycle of 400 years, 189 x 773.
CYCLE, CYCLE_A, CYCLE_B = 146097, 189, 773


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _draw(key: str, *parts: Column | str) -> Column:
    """A number from 0 to 2^48 - 1 that depends on the key and the parts."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *columns), 256), 1, 12), 16, 10).cast("bigint")


def permute_text(value: Column, key: str, kind: str, invert: bool = False) -> Column:
    """Permutation of the strings of one character pattern: digits stay digits, small and large ASCII letters stay such, all else stays itself.

    A Feistel network on the two halves: a half is shifted, character by character, by amounts drawn from the other half.
    """
    def shifted(half: Column, other: Column, i: Column) -> Column:
        def one(c: Column, j: Column) -> Column:
            code = F.ascii(c)
            draw = _draw(key, kind, i, j, other)

            def turned(base: int, size: int) -> Column:
                step = draw % size
                return F.char(F.pmod(code - base + (-step if invert else step), F.lit(size)) + base)

            return (F.when(code.between(48, 57), turned(48, 10)).when(code.between(65, 90), turned(65, 26))
                    .when(code.between(97, 122), turned(97, 26)).otherwise(c))
        return F.array_join(F.transform(F.split(half, ""), one), "")

    cut = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut).alias("l"), F.substring(value, cut + 1, F.length(value)).alias("r"))
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if invert else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    if invert:
        step = lambda s, i: F.struct(shifted(s["r"], s["l"], i).alias("l"), s["l"].alias("r"))
    else:
        step = lambda s, i: F.struct(s["r"].alias("l"), shifted(s["l"], s["r"], i).alias("r"))
    return F.aggregate(rounds, start, step, lambda s: F.concat(s["l"], s["r"]))


def permute_number(value: Column, a: int, b: int, key: str, kind: str, invert: bool = False) -> Column:
    """Permutation of 0 .. a * b - 1: value = l * b + r, where l and r are shifted in turn, modulo their own size."""
    start = F.struct(F.floor(value / b).cast("bigint").alias("l"), F.pmod(value, F.lit(b)).cast("bigint").alias("r"))
    sign = -1 if invert else 1

    def step(s: Column, i: Column) -> Column:
        on_left = i % 2 == 0
        left = F.pmod(s["l"] + sign * (_draw(key, kind, i, s["r"]) % a), F.lit(a))
        right = F.pmod(s["r"] + sign * (_draw(key, kind, i, s["l"]) % b), F.lit(b))
        return F.struct(F.when(on_left, left).otherwise(s["l"]).cast("bigint").alias("l"), F.when(on_left, s["r"]).otherwise(right).cast("bigint").alias("r"))

    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if invert else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, step, lambda s: s["l"] * b + s["r"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(mask: Column, characters: Column) -> Column:
    """``mask`` with its letters and digits replaced, in order, by ``characters``."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def step(s: Column, c: Column) -> Column:
        slot = F.ascii(c).between(48, 57) | F.ascii(c).between(65, 90) | F.ascii(c).between(97, 122)
        return F.struct((s["at"] + slot.cast("int")).alias("at"),
                        F.concat(s["out"], F.when(slot, F.substring(characters, s["at"], F.lit(1))).otherwise(c)).alias("out"))

    return F.aggregate(F.split(mask, ""), start, step, lambda s: s["out"])


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum modulo 10; with ``doubled_last`` the last digit counts double, as before a check digit is appended."""
    parts = F.transform(F.reverse(F.split(digits, "")), lambda c, i: _once(
        c.cast("int"), lambda d: F.when(i % 2 == (0 if doubled_last else 1), 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)))
    return F.aggregate(parts, F.lit(0), lambda s, x: s + x) % 10


def mod_97(value: Column) -> Column:
    """Remainder of an IBAN's letters and digits after the first four were moved to the end; letters count 10 to 35."""
    moved = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda s, c: F.when(
        F.ascii(c) >= 65, (s * 100 + F.ascii(c) - 55) % 97).otherwise((s * 10 + F.ascii(c) - 48) % 97))


def _is_run(value: Column) -> Column:
    return value.rlike("^[0-9][0-9 -]*$") & (F.length(_digits(value)) >= 13)


def _groups(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(_GROUP), F.lit(0))


def _ahead(groups: Column, at: Column, n: Column, width: int) -> Column:
    return F.substring(F.array_join(F.slice(groups, at, n), ""), 1, width)


def _usual(groups: Column, at: Column) -> Column:
    """How many groups from ``at`` on are the first usual grouping that is valid; 0 if none is."""
    def best(text: Column) -> Column:
        shaped = F.filter(F.array(*[F.regexp_extract(text, f"^{x}(?![0-9A-Za-z])", 0) for x in _CARD_SHAPES]), lambda x: x != "")
        return _once(F.filter(shaped, lambda x: luhn_sum(_digits(x), False) == 0),
                     lambda ok: F.when(F.size(ok) > 0, F.size(_groups(F.get(ok, 0)))).otherwise(0))
    return _once(_ahead(groups, at, F.lit(_USUAL_GROUPS), _USUAL_WIDTH), best)


def _numbers(groups: Column) -> Column:
    """The valid card numbers of a run of digits as groups (``at``, ``n``) in ``found``: from left to right those of the usual groupings, then,
    between them, pieces of up to 19 digits in any grouping. ``marks`` has per group the size of the usual number that begins there, 0 where none
    does and -1 inside of one. Linear in the run."""
    def span(at: Column, n: Column) -> Column:
        return F.array(F.struct(at.cast("int").alias("at"), n.cast("int").alias("n")))

    none = F.lit([]).cast("array<struct<at:int,n:int>>")
    start = lambda at: F.struct(at.cast("int").alias("next"), none.alias("found"))
    state = lambda at, found: F.struct(at.cast("int").alias("next"), found.alias("found"))

    def usual_step(s: Column, i: Column) -> Column:
        return F.when(i < s["next"], s).otherwise(_once(_usual(groups, i), lambda k: F.when(
            k > 0, state(i + k, F.concat(s["found"], span(i, k)))).otherwise(s)))

    def pieces(gap: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            text = _ahead(groups, i, F.least(F.lit(_ANY_GROUPS), gap["b"] - i), _ANY_WIDTH)
            return F.when(i < s["next"], s).otherwise(_once(F.regexp_extract(text, f"^{_PIECE}", 0), lambda m: F.when(m == "", s).otherwise(
                _once(F.size(_groups(m)), lambda k: state(i + k, F.when(luhn_sum(_digits(m), False) == 0, F.concat(s["found"], span(i, k))).otherwise(s["found"]))))))
        return F.when(gap["a"] < gap["b"], F.aggregate(F.sequence(gap["a"], gap["b"] - 1), start(gap["a"]), step, lambda s: s["found"])).otherwise(none)

    def marked(gap: Column) -> Column:
        number = F.when(gap["k"] > 0, F.concat(F.array(gap["k"]), F.array_repeat(F.lit(-1), gap["k"] - 1))).otherwise(F.lit([]).cast("array<int>"))
        return F.concat(F.array_repeat(F.lit(0), gap["b"] - gap["a"]), number)

    def between(usual: Column) -> Column:
        ends = F.concat(F.array(F.lit(1)), F.transform(usual, lambda u: u["at"] + u["n"]))
        gaps = F.zip_with(ends, F.concat(usual, span(F.size(groups) + 1, F.lit(0))), lambda a, u: F.struct(a.alias("a"), u["at"].alias("b"), u["n"].alias("k")))
        return _once(gaps, lambda g: F.struct(F.array_sort(F.concat(usual, F.flatten(F.transform(g, pieces)))).alias("found"),
                                              F.flatten(F.transform(g, marked)).alias("marks")))

    return _once(F.aggregate(F.sequence(F.lit(1), F.size(groups)), start(F.lit(1)), usual_step, lambda s: s["found"]), between)


def _card(value: Column, key: str, invert: bool) -> Column:
    """A run of digits with its valid card numbers permuted, one after the other; the way back goes from right to left, so that it meets every number
    between the same neighbours. Were other numbers found around a permuted one, its permutation goes on until the same are. Only the few groups
    beside it can tell, so a run of any length takes time in proportion."""
    def permuted(part: Column) -> Column:
        def changed(digits: Column) -> Column:
            body = permute_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", invert)
            return _refill(part, _once(body, lambda b: F.concat(b, F.pmod(-luhn_sum(b, True), F.lit(10)).cast("string"))))
        return _once(_digits(part), changed)

    def moved(groups: Column, marks: Column, t: Column) -> Column:
        low = F.greatest(F.lit(1), t["at"] - (_USUAL_GROUPS - 1))
        place = t["at"] - low + 1
        width = t["at"] + t["n"] - low + _USUAL_GROUPS - 1

        def step(s: Column, _: Column) -> Column:
            def checked(near: Column) -> Column:
                same = F.forall(F.sequence(F.lit(1), place + t["n"] - 1), lambda i: _once(
                    F.get(marks, low + i - 2), lambda m: F.when(m < 0, True).otherwise(_usual(near, i) == m)))
                return F.struct(near.alias("near"), same.alias("done"))
            part = F.array_join(F.slice(s["near"], place, t["n"]), "")
            return F.when(s["done"], s).otherwise(_once(F.concat(
                F.slice(s["near"], F.lit(1), place - 1), _groups(permuted(part)), F.slice(s["near"], place + t["n"], F.lit(_USUAL_GROUPS))), checked))

        start = F.struct(F.slice(groups, low, width).alias("near"), F.lit(False).alias("done"))
        ended = lambda s: F.when(s["done"], s["near"]).otherwise(
            F.raise_error(F.lit("the numbers of a run were not found again")).cast("array<string>"))
        near = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, step, ended)
        return F.concat(F.slice(groups, F.lit(1), low - 1), near, F.slice(groups, low + width, F.size(groups)))

    def walked(groups: Column, n: Column) -> Column:
        order = F.reverse(n["found"]) if invert else n["found"]
        return F.aggregate(order, groups, lambda g, t: moved(g, n["marks"], t), lambda g: F.array_join(g, ""))

    return _once(_groups(value), lambda g: _once(_numbers(g), lambda n: walked(g, n)))


def _iban(value: Column, key: str, invert: bool) -> Column:
    def changed(plain: Column) -> Column:
        body = permute_text(F.substring(plain, F.lit(5), F.length(plain)), key, "iban", invert)
        country = F.substring(plain, 1, 2)
        whole = _once(body, lambda b: F.concat(country, F.lpad((98 - mod_97(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0"), b))
        return F.when(mod_97(plain) == 1, _refill(value, whole)).otherwise(value)
    return _once(F.replace(value, F.lit(" "), F.lit("")), changed)


def _date(value: Column, key: str, invert: bool) -> Column:
    """Month-first notation with slashes, day-first where only that is a date; the latter may coincide with one of the former after the permutation."""
    def through(form: str, kind: str) -> Column:
        def changed(day: Column) -> Column:
            shift = F.datediff(day, F.lit("2000-01-01").cast("date"))
            place = permute_number(F.pmod(shift, F.lit(CYCLE)).cast("bigint"), CYCLE_A, CYCLE_B, key, kind, invert)
            moved = F.floor(shift / CYCLE) * CYCLE + place
            return F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), moved.cast("int")), form)
        return _once(F.try_to_timestamp(value, F.lit(form)).cast("date"), changed)

    return F.coalesce(F.when(value.contains("-"), through("yyyy-MM-dd", "date-")).when(value.contains("."), through("dd.MM.yyyy", "date."))
                      .otherwise(F.coalesce(through("MM/dd/yyyy", "date/"), through("dd/MM/yyyy", "date/d"))), value)


def _ip(value: Column, key: str, invert: bool) -> Column:
    def changed(o: Column) -> Column:
        number = F.aggregate(o, F.lit(0).cast("bigint"), lambda s, x: s * 256 + x)
        moved = _once(permute_number(number, 65536, 65536, key, "ip", invert), lambda n: F.concat_ws(
            ".", *[(F.floor(n / 256 ** k) % 256).cast("bigint").cast("string") for k in (3, 2, 1, 0)]))
        return F.when(F.exists(o, lambda x: x > 255), value).otherwise(moved)
    return _once(F.transform(F.split(value, "\\."), lambda x: x.cast("bigint")), changed)


def pseudonym(value: Column, key: str, invert: bool = False) -> Column:
    """The pseudonym of a match of ``ANY``, or the match itself if its check fails. With ``invert`` the way back (the leading zeros of an octet are not restored)."""
    def kind(name: str) -> Column:
        return value.rlike(f"^(?:{PATTERNS[name]})$")

    def digits_only(skip: str) -> Column:
        # a phone number keeps its country code
        prefix = F.regexp_extract(value, skip, 0)
        rest = F.substring(value, F.length(prefix) + 1, F.length(value))
        return F.concat(prefix, _refill(rest, permute_text(_digits(rest), key, "phone", invert)))

    at = F.locate("@", value)
    return (F.when(kind("email"), F.concat(permute_text(F.substring(value, F.lit(1), at - 1), key, "email", invert), F.substring(value, at, F.length(value))))
            .when(kind("iban"), _iban(value, key, invert))
            .when(kind("date"), _date(value, key, invert))
            .when(kind("ip"), _ip(value, key, invert))
            .when(kind("ssn"), _refill(value, permute_text(_digits(value), key, "ssn", invert)))
            .when(_is_run(value), _card(value, key, invert))
            .when(kind("phone"), digits_only("^\\+[0-9]{1,3}(?=[ .(-])|^\\+[0-9]"))
            .otherwise(value))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", invert: bool = False) -> DataFrame:
    """``docs`` with ``n_private`` (values that were changed) and the text rewritten in place; all else stays as it is.

    Null and empty texts and those without a match are unchanged with 0; repeated rows are changed alike; the whole text is
    read. Everything happens inside a row: nothing is shuffled. ``key`` is the secret of the permutations.
    """
    refuse(docs, "n_private")
    col = F.col(f"`{text}`")
    gaps = F.split(col, ANY, -1)
    found = F.regexp_extract_all(col, F.lit(ANY), F.lit(0))
    changed = _once(found, lambda f: F.struct(f.alias("old"), F.transform(f, lambda m: pseudonym(m, key, invert)).alias("new")))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    staged = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.when(col.rlike(ANY), changed).alias(f"{OWN}m"))
    old, new = F.col(f"{OWN}m.old"), F.col(f"{OWN}m.new")
    joined = F.array_join(F.zip_with(gaps, new, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
    count = F.aggregate(F.zip_with(old, new, lambda a, b: F.when(a == b, 0).when(_is_run(a), F.size(_numbers(_groups(a))["found"])).otherwise(1).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    out = staged.select(*rest, F.when(F.col(f"{OWN}m").isNull(), col).otherwise(joined).alias(text), F.coalesce(count, F.lit(0)).cast("long").alias("n_private"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "n_private")
