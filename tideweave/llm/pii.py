"""Format-preserving pseudonyms for personal data, with SQL functions only.

Validated numbers and dates are replaced by a keyed permutation of their own format: a Feistel
network over the set of values that the format allows, walked until it lands inside the set, with
HMAC-SHA-256 as its round function. Equal
values get equal pseudonyms in every document, different values different ones, and nothing is
stored: the key is all that links them. E-mail addresses and quoted secrets are permuted character
by character within each character's class.

kind    validated by                              permuted
card    13 to 19 digits of a run, Luhn check      all digits but the check digit, which is made anew
ssn     area, group and serial in range           the valid numbers
phone   + and country code, (area) number, 3-3-4  the digits after the country code
ip      four octets of 0 to 255                   all 32-bit addresses
date    a day from 1900 to 2099                   those days; the written form stays
iban    length and check digits (mod 97)          letters and digits after the check digits, made anew
email   local part, @, domain with a dot          letters and digits of the local part
secret  quoted value after a name such as token   letters and digits

A text without a match is returned as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Cycle walking: sets are cut from products at most 1.002 times as large, so 24 turns always suffice in practice.
TURNS = 24

#: Begins where a run of its characters does and never gives any back, so that long runs take time in proportion.
EMAIL = r"(?<![A-Za-z0-9._%+-])[._%+-]*+[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
SECRET = r"""(?<=(?:token|secret|passwd|password|api_key|apikey)"?\s{0,3}[=:]\s{0,3}["'])[^"'\s]{8,}(?=["'])"""
ISO = r"(?<![\d.-])\d{4}-\d{2}-\d{2}(?![\d-])"
SLASH = r"(?<![\d/.])\d{2}[/.]\d{2}[/.]\d{4}(?![\d/])"
IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
#: In one piece, or in groups of four of which those after the first hold a digit (words in capitals may follow).
_GROUPS = r"(?: [A-Z0-9]{4})(?: (?=[A-Z]{0,3}\d)[A-Z0-9]{4}){2,6}(?: (?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?"
IBAN = rf"(?<![A-Za-z0-9])[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}|{_GROUPS})(?![A-Za-z0-9])"
_LOCAL = r"\d{3}[.-]\d{3}[.-]\d{4}|[2-9]\d{2} [2-9]\d{2} \d{4}"
PHONE = rf"(?<![\d-])(?<!\d )(?:1[ .-])?(?:{_LOCAL})(?![\d-]| \d)|(?<![\d-])\d{{3}}[.-]\d{{3}}[.-]\d{{4}}(?![\d-])|(?<!\d)(?:\+\d{{1,3}}[ .-]?)?\(\d{{3}}\)[ .-]?\d{{3}}[ .-]?\d{{4}}(?!\d)|\+\d{{1,3}}(?:[ .-]?\d{{2,4}}){{2,4}}(?!\d)"
#: What begins another value isn't taken into a run of digits.
_OTHER = r"(?!\d{4}-\d{2}-\d{2}(?!\d)|\d{2}[/.]\d{2}[/.]\d{4}(?!\d)|\d{1,3}(?:\.\d{1,3}){3}(?!\d)|\d{3}-\d{2}-\d{4}(?!\d)|\d{3}[.-]\d{3}[.-]\d{4}(?!\d))"
#: A run of up to two cards' digits: cards are looked for between its separators, as other numbers may stand beside them.
CARD = rf"(?<![\d-])\d(?:(?:[ -]{_OTHER})?\d){{12,37}}(?![\d-])"
ANY = "|".join((EMAIL, SECRET, IBAN, ISO, SLASH, IP, SSN, PHONE, CARD))
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email", "secret")
FIRST_DAY, DAYS = "1900-01-01", 73_049


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _mac(key: str, *message: Column) -> Column:
    """HMAC-SHA-256 of the parts of a message, in hexadecimal."""
    block = key.encode() if len(key.encode()) <= 64 else hashlib.sha256(key.encode()).digest()
    inner, outer = (bytes(x ^ y for x, y in zip(block.ljust(64, b"\0"), bytes([pad]) * 64, strict=True)) for pad in (0x36, 0x5C))
    text = F.concat_ws("\x1f", *(m.cast("string") for m in message)).cast("binary")
    return F.sha2(F.concat(F.lit(outer), F.unhex(F.sha2(F.concat(F.lit(inner), text), 256))), 256)


def _number(digest: Column, digits: int = 15) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def _feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: Column) -> Column:
    """struct(l, r) of the halves (below a and b) after rounds that shift one by a keyed hash of the other."""

    def step(s: Column, i: Column) -> Column:
        even = F.pmod(i, F.lit(2)) == 0
        half, other, size = (F.when(even, x).otherwise(y) for x, y in ((s["l"], s["r"]), (s["r"], s["l"]), (a, b)))
        moved = F.pmod(half + F.pmod(_number(_mac(key, kind, i, other)), size), size)
        return let(moved, lambda new: F.struct(F.when(even, new).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(new).alias("r")))

    rounds = F.array(*(F.lit(i) for i in range(ROUNDS)))
    return F.aggregate(rounds, F.struct(left.alias("l"), right.alias("r")), step)


def permute(value: Column, size: int, key: str, kind: str) -> Column:
    """A keyed permutation of 0 to ``size`` - 1 (up to 1e18)."""
    a = max(2, round(size**0.5))
    while a * a < size:
        a += 1
    b = -(-size // a)

    def once(x: Column) -> Column:
        quotient = ((x - F.pmod(x, F.lit(b))).cast("decimal(20,0)") / F.lit(b).cast("decimal(20,0)")).cast("long")
        found = _feistel(quotient, F.pmod(x, F.lit(b)), F.lit(a).cast("long"), F.lit(b).cast("long"), key, F.lit(kind))
        return let(found, lambda s: s["l"] * F.lit(b) + s["r"])

    if a * b == size:
        return once(value)
    turns = F.array(*(F.lit(i) for i in range(TURNS)))
    turn = lambda x, i: F.when((i > 0) & (x < size), x).otherwise(once(F.when(i == 0, value).otherwise(x)))
    return F.aggregate(turns, F.lit(-1).cast("long"), turn)


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the digit strings of one length, 2 to 36: Feistel over the two halves of the string."""
    n = F.length(digits)
    first = F.ceil(n / 2).cast("int")
    size = lambda k: F.pow(F.lit(10.0), k).cast("long")
    left, right = digits.substr(F.lit(1), first).cast("long"), digits.substr(first + 1, n - first).cast("long")
    found = _feistel(left, right, size(first), size(n - first), key, F.concat(F.lit(kind), n.cast("string")))
    show = lambda x, k: F.lpad(x.cast("string"), k, F.lit("0"))
    return let(found, lambda s: F.concat(show(s["l"], first), show(s["r"], n - first)))


def _made(valid: Column, text: Column, n: Column | None = None) -> Column:
    return F.struct(valid.alias("valid"), text.alias("text"), (F.lit(1) if n is None else n).alias("n"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _pour(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in order."""
    chars = F.split(form, "")
    is_digit = lambda c: F.ascii(c).between(48, 57)
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    step = lambda s, c: F.struct(
        F.concat(s["out"], F.when(is_digit(c), F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
        (s["at"] + F.when(is_digit(c), 1).otherwise(0)).alias("at"),
    )
    return F.aggregate(chars, start, step, lambda s: s["out"])


def luhn_sum(digits: Column, double_last: bool) -> Column:
    """The Luhn sum of a digit string; ``double_last``: the last digit is doubled (a check digit is to follow)."""
    n = F.length(digits)
    places = F.sequence(F.lit(1), n)

    def worth(i: Column) -> Column:
        d = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        doubled = F.pmod(n - i + (0 if double_last else 1), F.lit(2)) == 0
        return F.when(doubled, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(places, F.lit(0), lambda s, i: s + worth(i))


def _one_card(m: Column, key: str) -> Column:
    def made(new: Column) -> Column:
        check = F.pmod(10 - F.pmod(luhn_sum(new, True), F.lit(10)), F.lit(10))
        return _pour(m, F.concat(new, check.cast("string")))

    digits = _digits(m)
    return let(permute_digits(digits.substr(F.lit(1), F.length(digits) - 1), key, "card"), made)


def _card(m: Column, key: str) -> Column:
    """From left to right, the longest valid card that begins at each separator."""
    return let(F.regexp_extract_all(m, F.lit(r"\d+[ -]?"), F.lit(0)), lambda groups: _cards_among(groups, key))


def _cards_among(groups: Column, key: str) -> Column:
    n = F.size(groups)

    def joined(i: Column, j: Column) -> Column:
        return F.array_join(F.slice(groups, i + 1, j - i + 1), "")

    def is_card(text: Column) -> Column:
        digits = _digits(text)
        return F.when(F.length(digits).between(13, 19), F.pmod(luhn_sum(digits, False), F.lit(10)) == 0).otherwise(False)

    def step(s: Column, i: Column) -> Column:
        # The last group of the longest card, or nothing.
        ends = F.when(i >= s["next"], F.filter(F.sequence(F.least(i + 18, n - 1), i, F.lit(-1)), lambda j: is_card(joined(i, j))))
        end = F.coalesce(F.get(ends, F.lit(0)), F.lit(-1))
        return F.struct(
            F.when(end >= 0, F.array_append(s["spans"], F.struct(i.alias("a"), end.alias("b"))))
            .when(i >= s["next"], F.array_append(s["spans"], F.struct(i.alias("a"), F.lit(-1).alias("b"))))
            .otherwise(s["spans"])
            .alias("spans"),
            F.when(end >= 0, end + 1).otherwise(s["next"]).alias("next"),
        )

    start = F.struct(F.array().cast("array<struct<a:int,b:int>>").alias("spans"), F.lit(0).alias("next"))
    spans = F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda s: s["spans"])

    def made(spans: Column) -> Column:
        cards = F.size(F.filter(spans, lambda x: x["b"] >= 0))
        parts = F.transform(spans, lambda x: F.when(x["b"] >= 0, _one_card(joined(x["a"], x["b"]), key)).otherwise(F.get(groups, x["a"])))
        return _made(cards > 0, F.array_join(parts, ""), cards)

    return let(spans, made)


def _ssn(m: Column, key: str) -> Column:
    part = lambda at, n: F.substring(m, at, n).cast("long")
    area, group, serial = part(1, 3), part(5, 2), part(8, 4)
    valid = (area.between(1, 899) & (area != 666)) & (group > 0) & (serial > 0)
    rank = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1

    def made(new: Column) -> Column:
        serial2 = F.pmod(new, F.lit(9999)) + 1
        rest = ((new - serial2 + 1) / 9999).cast("long")
        area2 = (rest / 99).cast("long") + 1
        area2 = area2 + F.when(area2 >= 666, 1).otherwise(0)
        return _made(valid, F.format_string("%03d-%02d-%04d", area2, F.pmod(rest, F.lit(99)) + 1, serial2))

    return let(F.when(valid, permute(rank, 898 * 99 * 9999, key, "ssn")), made)


def _phone(m: Column, key: str) -> Column:
    country = F.regexp_extract(m, r"^(\+\d{1,3}(?=[ .(-])|1(?=[ .-]))", 1)
    country = F.when((country == "") & m.startswith("+"), F.substring(m, 1, 3)).otherwise(country)
    rest = m.substr(F.length(country) + 1, F.length(m))
    digits = _digits(rest)
    valid = F.length(digits).between(5, 16) & (F.length(_digits(m)) <= 15)
    return _made(valid, F.concat(country, _pour(rest, permute_digits(digits, key, "phone"))))


def _ip(m: Column, key: str) -> Column:
    octet = lambda i: F.get(F.split(m, r"\."), F.lit(i)).cast("long")
    valid = (octet(0) < 256) & (octet(1) < 256) & (octet(2) < 256) & (octet(3) < 256)
    value = ((octet(0) * 256 + octet(1)) * 256 + octet(2)) * 256 + octet(3)
    bits = lambda new, n: F.shiftright(new, n).bitwiseAND(F.lit(255)).cast("string")
    made = lambda new: _made(valid, F.concat_ws(".", *(bits(new, n) for n in (24, 16, 8, 0))))
    return let(F.when(valid, permute(value, 1 << 32, key, "ip")), made)


def _date(m: Column, key: str) -> Column:
    """ISO, or day and month (if the first is at most 12 and the second above 12, month and day) and year."""
    iso = m.rlike(r"^\d{4}-")
    month_first = F.substring(m, 4, 2).cast("int") > 12
    text = (
        F.when(iso, m)
        .when(month_first, F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2)))
        .otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    )
    first = F.lit(FIRST_DAY).cast("date")

    def made(new: Column) -> Column:
        shown = F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(
            F.concat(F.date_format(new, "dd"), F.substring(m, 3, 1), F.date_format(new, "MM"), F.substring(m, 6, 1), F.date_format(new, "yyyy"))
        )
        return _made(new.isNotNull(), shown)

    def moved(day: Column) -> Column:
        return F.when(day.between(0, DAYS - 1), F.date_add(first, permute(day.cast("long"), DAYS, key, "date").cast("int")))

    return let(F.datediff(F.try_to_date(text, "yyyy-MM-dd"), first), lambda day: let(moved(day), made))


#: The classes within which characters are permuted.
CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def permute_text(text: Column, key: str, kind: str, hexadecimal: bool = False) -> Column:
    """Feistel over the two halves of a text: each round shifts one half's characters within their classes by the other half."""
    classes = ("0123456789abcdef", CLASSES[2]) if hexadecimal else CLASSES

    def shifted(half: Column, digest: Column) -> Column:
        def char(c: Column, i: Column) -> Column:
            by = _number(F.sha2(F.concat(digest, i.cast("string")).cast("binary"), 256), 8)
            out = c
            for alphabet in classes:
                place = F.call_function("instr", F.lit(alphabet), c)
                moved = F.substring(F.lit(alphabet), (F.pmod(place - 1 + by, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))
                out = F.when(place > 0, moved).otherwise(out)
            return F.when(c == "", c).otherwise(out)

        return F.array_join(F.transform(F.split(half, ""), char), "")

    middle = (F.length(text) / 2).cast("int")
    start = F.struct(text.substr(F.lit(1), middle).alias("l"), text.substr(middle + 1, F.length(text)).alias("r"))

    def step(s: Column, i: Column) -> Column:
        even = F.pmod(i, F.lit(2)) == 0
        half, other = (F.when(even, x).otherwise(y) for x, y in ((s["l"], s["r"]), (s["r"], s["l"])))
        moved = let(_mac(key, F.lit(kind), i, other), lambda digest: shifted(half, digest))
        return let(moved, lambda new: F.struct(F.when(even, new).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(new).alias("r")))

    rounds = F.array(*(F.lit(i) for i in range(ROUNDS)))
    return F.aggregate(rounds, start, step, lambda s: F.concat(s["l"], s["r"]))


def _mod97(code: Column) -> Column:
    """The remainder by 97 of a code whose letters count 10 to 35."""

    def step(r: Column, c: Column) -> Column:
        letter = F.ascii(c) >= 65
        return F.when(c == "", r).otherwise(F.pmod(F.when(letter, r * 100 + F.ascii(c) - 55).otherwise(r * 10 + F.ascii(c) - 48), F.lit(97)))

    return F.aggregate(F.split(code, ""), F.lit(0), step)


def _iban(m: Column, key: str) -> Column:
    code = F.replace(m, F.lit(" "), F.lit(""))
    country, own = F.substring(code, 1, 2), code.substr(F.lit(5), F.length(code))
    valid = F.length(code).between(15, 34) & (_mod97(F.concat(own, F.substring(code, 1, 4))) == 1)

    def spread(whole: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
        blank = lambda c: (c == " ") | (c == "")
        step = lambda s, c: F.struct(
            F.concat(s["out"], F.when(blank(c), c).otherwise(F.substring(whole, s["at"], F.lit(1)))).alias("out"),
            (s["at"] + F.when(blank(c), 0).otherwise(1)).alias("at"),
        )
        return _made(valid, F.aggregate(F.split(m, ""), start, step, lambda s: s["out"]))

    def checked(new: Column) -> Column:
        check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return let(F.concat(country, check, new), spread)

    return let(F.when(valid, permute_text(own, key, "iban")), checked)


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return _made(F.lit(True), F.concat(permute_text(local, key, "email"), m.substr(F.length(local) + 1, F.length(m))))


def _secret(m: Column, key: str) -> Column:
    hexadecimal = m.rlike("^[0-9a-f]+$")
    return _made(F.lit(True), F.when(hexadecimal, permute_text(m, key, "hex", True)).otherwise(permute_text(m, key, "secret")))


def pseudonym(m: Column, key: str) -> Column:
    """struct(kind, text, n) of one match; kind is null and the text unchanged if it isn't valid, n is how many values it holds."""
    whole = lambda pattern: m.rlike(f"^(?:{pattern})$")
    forms = (
        ("email", m.contains("@") & whole(EMAIL), _email),
        ("date", whole(r"\d{4}-\d{2}-\d{2}") | whole(r"\d{2}[/.]\d{2}[/.]\d{4}"), _date),
        ("iban", whole(r"[A-Z]{2}\d{2}[A-Z0-9 ]+"), _iban),
        ("ip", whole(r"\d{1,3}(?:\.\d{1,3}){3}"), _ip),
        ("ssn", whole(r"\d{3}-\d{2}-\d{4}"), _ssn),
        ("card", whole(r"\d(?:[ -]?\d){12,37}"), _card),
        ("phone", m.startswith("+") | m.startswith("(") | whole(rf"(?:1[ .-])?(?:{_LOCAL})"), _phone),
        ("secret", F.lit(True), _secret),
    )
    def shown(name: str) -> Callable[[Column], Column]:
        return lambda r: F.struct(F.when(r["valid"], F.lit(name)).alias("kind"), F.when(r["valid"], r["text"]).otherwise(m).alias("text"), r["n"].alias("n"))

    found = None
    for name, shape, make in forms:
        made = let(make(m, key), shown(name))
        found = F.when(shape, made) if found is None else found.when(shape, made)
    return found


def pseudonymise(docs: DataFrame, key: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, text with pseudonyms, changed, and n_<kind> for each kind.

    Null text stays null with counts of 0. Repeated rows are treated alike; an empty table gives no
    rows; other columns are ignored. The key is a secret of the run: whoever has it can undo the
    pseudonyms, and the same key links values over runs.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    may = F.col("text").rlike(r"[0-9@]|[\"'][^\"'\s]{8}")
    found = F.when(may, F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    rows = rows.withColumn("found", found).withColumn(
        "made", F.when(F.size("found") > 0, F.transform("found", lambda m: pseudonym(m, key)))
    )
    # One more part than matches; both are walked once.
    parts = F.zip_with(F.split("text", ANY, -1), F.transform("made", lambda x: x["text"]), lambda part, new: F.concat(part, F.coalesce(new, F.lit(""))))
    joined = F.array_join(parts, "")
    count = lambda kind: F.aggregate(F.filter("made", lambda x: x["kind"] == kind), F.lit(0), lambda s, x: s + x["n"])
    counts = [F.when(F.col("made").isNull(), 0).otherwise(count(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    made = F.when(F.col("made").isNull(), F.col("text")).otherwise(joined)
    out = rows.select("doc_id", made.alias("text"), *counts)
    return out.withColumn("changed", sum((F.col(f"n_{k}") for k in KINDS), F.lit(0)) > 0)
