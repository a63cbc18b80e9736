"""Format-preserving pseudonyms of personal data, with DataFrame operations only.

Card, phone and social-security numbers, addresses (e-mail and IPv4) and dates are found by one pattern, validated by kind, and replaced
by a keyed Feistel permutation of the values of the same format: an equal value has the same pseudonym in every document, different
values of a format have different ones, and a pseudonym passes the validation of its kind.

A value is written as a pair (a, b) with a below m and b below n.  A round adds a keyed hash of the one half to the other, modulo its
bound, and swaps the halves; every round is invertible, so the rounds permute all m x n values.  The hash is SHA-256 over key, kind,
round and half.

Defined results: a null text stays null; text without personal data is unchanged; repeated rows are treated one by one; an empty table gives
an empty one; other columns stay as they are.  Dates outside 1800 to 2199, local parts over 64 characters and numbers that fail their
validation are left.  In dates with slashes the
month comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "card", "ssn", "phone", "ipv4", "date")

# The formats.  The order decides where two begin at one place.  Groups repeat at most three times: Java matches a
# repeated group that may give way by recursion, and a long text of many repeats would exhaust the stack.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}"
#: The longest local part that mail addresses may have; longer ones are none.
LOCAL_CHARS = 64
CARD = (
    r"(?<![0-9A-Za-z])(?:[2-6][0-9]{12,18}|[2-6][0-9]{3}(?: [0-9]{4}){3}|[2-6][0-9]{3}(?:-[0-9]{4}){3}"
    r"|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9A-Za-z])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-]|\.[0-9])"
PATTERNS = dict(zip(KINDS, (EMAIL, CARD, SSN, PHONE, IPV4, DATE), strict=True))
ANY = "|".join(PATTERNS[k] for k in KINDS)
#: Days from 1800-01-01 to 2199-12-31, one turn of the calendar, as a product.
FIRST_DAY, LAST_DAY, DAY_BOUNDS = "1800-01-01", "2199-12-31", (189, 773)
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")


def _long(value) -> Column:
    return F.lit(value).cast("long")


def _mix(key: str, kind: str, step: Column, half: Column) -> Column:
    """A keyed number of 60 bits."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, a: Column, b: Column, m, n) -> Column:
    """The pair that stands for (a, b), a below m and b below n; an even number of rounds brings the bounds back."""
    bounds = [x if isinstance(x, Column) else _long(x) for x in (m, n)]
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"), bounds[0].alias("m"), bounds[1].alias("n"))

    def turn(acc: Column, step: Column) -> Column:
        moved = F.pmod(acc["a"] + F.pmod(_mix(key, kind, step, acc["b"]), acc["m"]), acc["m"])
        return F.struct(acc["b"].alias("a"), moved.alias("b"), acc["n"].alias("m"), acc["m"].alias("n"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _number(digits: Column, start, length) -> Column:
    return F.substring(digits, start, length).cast("long")


def _padded(value: Column, width) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _refilled(found: Column, digits: Column) -> Column:
    """The digits in the places of those of ``found``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(acc: Column, k: Column) -> Column:
        here = F.substring(found, k, F.lit(1))
        is_digit = here.between("0", "9")
        return F.struct(
            F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["at"], F.lit(1))).otherwise(here)).alias("out"),
            (acc["at"] + F.when(is_digit, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(found)), start, put, lambda acc: acc["out"])


def card(found: Column, key: str) -> Column:
    """First digit kept, last one the check digit, all between permuted."""
    digits = _digits(found)
    u = F.floor((F.length(digits) - 2) / 2).cast("int")
    v = F.length(digits) - 2 - u
    power = lambda k: F.concat(F.lit("1"), F.repeat(F.lit("0"), k)).cast("long")
    new = feistel(key, "card", _number(digits, F.lit(2), u), _number(digits, u + 2, v), power(u), power(v))
    body = _let(new, lambda x: F.concat(F.substring(digits, 1, 1), _padded(x["a"], u), _padded(x["b"], v)))
    ends = F.array(*(F.lit(c) for c in "0123456789"))
    full = _let(body, lambda x: F.concat(x, F.get(F.filter(ends, lambda c: _luhn(F.concat(x, c))), 0)))
    return F.when(_luhn(digits), _let(full, lambda x: _refilled(found, x)))


def ssn(found: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group and serial not zero."""
    area, group, serial = _number(found, 1, 3), _number(found, 5, 2), _number(found, 8, 4)
    new = feistel(key, "ssn", area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9999 + serial - 1, 898, 99 * 9999)

    def written_out(x: Column) -> Column:
        to = x["a"] + 1 + F.when(x["a"] >= 665, 1).otherwise(0)
        return F.concat_ws("-", _padded(to, 3), _padded(F.floor(x["b"] / 9999) + 1, 2), _padded(F.pmod(x["b"], _long(9999)) + 1, 4))

    made = _let(new, written_out)
    return F.when(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), made)


def phone(found: Column, key: str) -> Column:
    """Country and area code kept; exchange (200 to 999) and line permuted."""
    digits = _digits(found)
    value = F.right(digits, F.lit(7)).cast("long") - 2_000_000
    new = feistel(key, "phone", F.floor(value / 4000), F.pmod(value, _long(4000)), 2000, 4000)
    line = _let(new, lambda x: (x["a"] * 4000 + x["b"] + 2_000_000).cast("string"))
    return _let(F.concat(F.substring(digits, F.lit(1), F.length(digits) - 7), line), lambda x: _refilled(found, x))


def ipv4(found: Column, key: str) -> Column:
    """All addresses of four numbers up to 255."""
    parts = F.transform(F.split(found, "\\."), lambda x: x.cast("long"))
    at = [F.get(parts, k) for k in range(4)]
    new = feistel(key, "ipv4", at[0] * 256 + at[1], at[2] * 256 + at[3], 65536, 65536)
    byte = lambda x: [F.floor(x / 256).cast("string"), F.pmod(x, _long(256)).cast("string")]
    return F.when(F.array_max(parts) <= 255, _let(new, lambda x: F.concat_ws(".", *byte(x["a"]), *byte(x["b"]))))


def date(found: Column, key: str) -> Column:
    """Days of 400 years in the format of the date."""
    formats = (("^[0-9]{4}-", "yyyy-MM-dd"), ("\\.", "dd.MM.yyyy"), ("/", "MM/dd/yyyy"))
    made = None
    for shape, pattern in formats:
        day = F.try_to_timestamp(found, F.lit(pattern)).cast("date")
        value = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
        new = feistel(key, "date", F.floor(value / DAY_BOUNDS[1]), F.pmod(value, _long(DAY_BOUNDS[1])), *DAY_BOUNDS)
        number = _let(new, lambda x: (x["a"] * DAY_BOUNDS[1] + x["b"]).cast("int"))
        to = F.date_add(F.lit(FIRST_DAY).cast("date"), number)
        text = F.when(day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), F.date_format(to, pattern))
        made = F.when(found.rlike(shape), text) if made is None else made.when(found.rlike(shape), text)
    return made


def _shifted(text: Column, digest: Column) -> Column:
    """Letters and digits moved on in their alphabets by the bytes of the digest; other characters stay."""

    def move(k: Column) -> Column:
        here = F.substring(text, k, F.lit(1))
        by = F.conv(F.substring(digest, F.pmod(2 * k - 2, F.lit(64)) + 1, F.lit(2)), 16, 10).cast("int")
        made = None
        for letters in ALPHABETS:
            new = F.substring(F.lit(letters), F.pmod(F.instr(F.lit(letters), here) - 1 + by, F.lit(len(letters))) + 1, F.lit(1))
            made = F.when(F.lit(letters).contains(here), new) if made is None else made.when(F.lit(letters).contains(here), new)
        return made.otherwise(here)

    return F.when(F.length(text) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), move), "")).otherwise("")


def email(found: Column, key: str) -> Column:
    """The local part as two halves of characters, each moved by the digest of the other; the domain stays."""
    name = F.substring_index(found, "@", 1)
    half = F.floor(F.length(name) / 2).cast("int")
    start = F.struct(F.substring(name, F.lit(1), half).alias("a"), F.substring(name, half + 1, F.length(name)).alias("b"))

    def turn(acc: Column, step: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), step.cast("string"), acc["b"]), 256)
        return F.struct(acc["b"].alias("a"), _shifted(acc["a"], digest).alias("b"))

    made = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda acc: F.concat(acc["a"], acc["b"]))
    return F.when(F.length(name) <= LOCAL_CHARS, F.concat(made, F.lit("@"), F.substring_index(found, "@", -1)))


def kind_of(found: Column) -> Column:
    """The kind of a match by its shape."""
    shape = lambda p: found.rlike(f"^(?:{p})$")
    return (
        F.when(found.contains("@"), "email")
        .when(shape("[0-9]{3}-[0-9]{2}-[0-9]{4}"), "ssn")
        .when(shape(r"[0-9]{1,3}(\.[0-9]{1,3}){3}"), "ipv4")
        .when(shape("[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4}"), "date")
        .when(F.length(_digits(found)) >= 13, "card")
        .otherwise("phone")
    )


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of one match, null where it fails the validation of its kind."""
    made, kind = None, kind_of(found)
    for name, function in (("email", email), ("ssn", ssn), ("ipv4", ipv4), ("date", date), ("card", card), ("phone", phone)):
        made = F.when(kind == name, function(found, key)) if made is None else made.when(kind == name, function(found, key))
    return made


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "pii") -> DataFrame:
    """``docs`` with pseudonyms in the text column, and ``found_col``: an array of (kind, value, pseudonym) in text order.

    The values are for audits; drop the column before the texts leave.  A column of that name in ``docs`` gives way.
    """
    text = F.col(f"__row.`{text_col}`")
    docs = docs.drop(found_col)
    whole = docs.select(F.struct("*").alias("__row"))
    matches = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1))).otherwise(F.array().cast("array<string>"))
    # one row of matches per text comes out of a generator, so no later filter is written into the search
    listed = whole.select("__row", F.explode(F.array(matches)).alias("__found"))
    replaced = F.transform(
        "__found", lambda x: F.struct(kind_of(x).alias("kind"), x.alias("value"), pseudonym(x, key).alias("pseudonym"))
    )
    made = listed.select("__row", F.explode(F.array(replaced)).alias("__found"))
    gaps = F.split(text, ANY)
    new = F.concat(F.transform("__found", lambda x: F.coalesce(x["pseudonym"], x["value"])), F.array(F.lit("")))
    joined = F.when(F.size("__found") > 0, F.array_join(F.zip_with(gaps, new, lambda g, x: F.concat(g, x)), "")).otherwise(text)
    columns = [joined.alias(c) if c == text_col else F.col(f"__row.`{c}`").alias(c) for c in docs.columns]
    valid = F.filter("__found", lambda x: x["pseudonym"].isNotNull())
    return made.select(*columns, valid.alias(found_col))
