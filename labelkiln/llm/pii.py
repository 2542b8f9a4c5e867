"""Personal data replaced by format-preserving Feistel pseudonyms.

Candidates are found by one pattern (``PATTERNS``, tried in order at each place),
checked (Luhn, IBAN remainder, octets, real calendar dates, number ranges) and
permuted by a keyed Feistel network within their own format: a card keeps its
length, layout, first digit and a right check digit, an address its dots, a date
its notation and stays a real date, letters and digits of an e-mail address or a
secret stay letters and digits. The permutation depends on the key and the value
only, so equal values get equal pseudonyms in every document, and it is a
bijection, so different values stay different. Numbers that fail their check are
left alone.

The network: text is halved, and each round shifts the characters of one half,
within their class, by digits of SHA-256 over key, round, place and the other
half. Dates, octets and social security numbers are split into two residues
(their domains are products) that shift each other in the same way.

Only DataFrame functions; row-local, no shuffle.

Edge cases: null text stays null, empty text empty; texts of any length are read
whole; all columns stay as they are (``n_chars``, if named, is set to the new
length); repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds of the network; even, so that both halves are treated alike.
ROUNDS = 8

#: What is looked for, in the order in which it is tried.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+",
    "secret": r"(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?[0-9A-Za-z+/_\-]{8,}",
    "aws": r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "iso_date": r"(?<![0-9\-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9\-])",
    "date": r"(?<![0-9./])[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{4}(?![0-9]|[./][0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5}|[0-9]{13,19})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{2,4}[ .\-])[0-9]{3,4}[ .\-][0-9]{3,4}"
             r"|\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,5}){2,4})(?![0-9A-Za-z])",
}
#: The patterns as one. Those that begin with a letter are tried at the beginning of a
#: word only, the others at a digit, a plus sign or a parenthesis only.
WORDS = ("email", "secret", "aws", "iban")
EVERY = (f"(?<![A-Za-z0-9])(?=[A-Za-z0-9._%+\\-])(?:{'|'.join(PATTERNS[k] for k in WORDS)})"
         f"|(?=[0-9+(])(?:{'|'.join(p for k, p in PATTERNS.items() if k not in WORDS)})")
#: What every find holds; a text without it is not searched further.
HINT = r"[0-9][0-9A-Z .()/\-]{5}|@|[=:][ \t]{0,3}[\"']?[0-9A-Za-z+/_\-]{8}|AKIA"
#: Put around finds; a text may hold it.
MARK = "\ue001"
#: Days in the 400 years from 1800-01-01, as a product; that day's distance from 1970-01-01.
DATE_PARTS, DATE_FIRST = (189, 773), -62091

LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: as the variable of a lambda.
    Inside lambdas anything else would be computed again for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _prf(key: str, *parts: Column) -> Column:
    """A keyed pseudo-random number below 2**48."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def permute_text(s: Column, key: str, tag: str, classes: tuple[str, ...] = (DIGITS, LOWER, UPPER)) -> Column:
    """Feistel permutation of a string: each character stays in its class and
    characters of no class stay as they are."""

    def shift(c: Column, by: Column) -> Column:
        out = c
        for alphabet in classes:
            at = F.instr(F.lit(alphabet), c)
            moved = F.substring(F.lit(alphabet), ((at - 1 + by) % len(alphabet) + 1).cast("int"), F.lit(1))
            out = F.when(at > 0, moved).otherwise(out)
        return out

    def half(x: Column, other: Column, turn: Column) -> Column:
        places = F.when(F.length(x) > 0, F.sequence(F.lit(1), F.length(x))).otherwise(F.array().cast("array<int>"))
        return F.array_join(F.transform(places, lambda i: shift(
            F.substring(x, i, F.lit(1)), _prf(key, F.lit(tag), turn, i, other))), "")

    def turn(text: Column, r: Column) -> Column:
        n = F.floor(F.length(text) / 2).cast("int")
        a, b = F.substring(text, F.lit(1), n), F.substring(text, n + 1, F.length(text) - n)
        return let(a, lambda a: let(b, lambda b: F.when(r % 2 == 0, F.concat(half(a, b, r), b)).otherwise(
            F.concat(a, half(b, a, r)))))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), s, turn)


def permute_pair(x: Column, parts: tuple[int, int], key: str, tag: str) -> Column:
    """Feistel permutation of a number in ``[0, a * b)`` for ``parts = (a, b)``."""
    a, b = parts
    start = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).cast("long").alias("r"))

    def turn(acc: Column, r: Column) -> Column:
        left = F.when(r % 2 == 0, (acc["l"] + _prf(key, F.lit(tag), r, acc["r"])) % a).otherwise(acc["l"])
        right = F.when(r % 2 == 1, (acc["r"] + _prf(key, F.lit(tag), r, acc["l"])) % b).otherwise(acc["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda acc: acc["l"] * b + acc["r"])


def _only(s: Column, keep: str) -> Column:
    return F.regexp_replace(s, f"[^{keep}]", "")


def _refill(layout: Column, chars: Column, kind: str) -> Column:
    """``layout`` with its characters of ``kind`` replaced by ``chars``, in order."""

    def fill(chars: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

        def step(acc: Column, i: Column) -> Column:
            c = F.substring(layout, i, F.lit(1))
            return F.when(c.rlike(f"^[{kind}]$"), F.struct(
                F.concat(acc["out"], F.substring(chars, acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at"))
            ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at")))

        return F.aggregate(F.sequence(F.lit(1), F.length(layout)), start, step, lambda acc: acc["out"])

    return let(chars, fill)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, the last digit counted once."""

    def total(digits: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            d = F.substring(digits, i, F.lit(1)).cast("int") * F.when((F.length(digits) - i) % 2 == 1, 2).otherwise(1)
            return acc + F.when(d > 9, d - 9).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)

    return let(digits, total)


def iban_remainder(s: Column) -> Column:
    """Remainder by 97 of an IBAN without spaces, letters read as 10 to 35."""

    def total(turned: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            v = F.instr(F.lit(DIGITS + UPPER), F.substring(turned, i, F.lit(1))) - 1
            return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)

    return let(s, lambda s: let(F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4)), total))


def _card(m: Column, key: str) -> Column:
    def moved(digits: Column) -> Column:
        n = F.length(digits)
        body = F.concat(F.substring(digits, 1, 1), permute_text(F.substring(digits, F.lit(2), n - 2), key, "card", (DIGITS,)))

        def checked(body: Column) -> Column:
            check = ((F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
            return _refill(m, F.concat(body, check), "0-9")

        return F.when(luhn_sum(digits) % 10 == 0, let(body, checked)).otherwise(m)

    return let(_only(m, "0-9"), moved)


def _iban(m: Column, key: str) -> Column:
    def moved(s: Column) -> Column:
        country, body = F.substring(s, 1, 2), permute_text(F.substring(s, F.lit(5), F.length(s)), key, "iban", (DIGITS, UPPER))

        def checked(body: Column) -> Column:
            check = F.lpad((F.lit(98) - iban_remainder(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0")
            return _refill(m, F.concat(country, check, body), "0-9A-Z")

        return F.when(iban_remainder(s) == 1, let(body, checked)).otherwise(m)

    return let(_only(m, "0-9A-Z"), moved)


def _ip(m: Column, key: str) -> Column:
    """Addresses from 1.0.0.0 on are permuted among themselves."""
    o = [F.split(m, r"\.")[i].cast("long") for i in range(4)]
    low = 1 << 24
    number = o[0] * (1 << 24) + o[1] * (1 << 16) + o[2] * (1 << 8) + o[3]

    def text(n: Column) -> Column:
        return F.concat_ws(".", *[(F.floor(n / (1 << s)) % 256).cast("string") for s in (24, 16, 8, 0)])

    valid = reduce(lambda a, b: a & b, [x <= 255 for x in o]) & (o[0] >= 1)
    return F.when(valid, let(permute_pair(number - low, (255 << 8, 1 << 16), key, "ip") + low, text)).otherwise(m)


def _moved_day(day: Column, key: str) -> Column:
    days = DATE_PARTS[0] * DATE_PARTS[1]
    at = F.unix_date(day).cast("long") - DATE_FIRST
    moved = F.date_from_unix_date((permute_pair(at, DATE_PARTS, key, "date") + DATE_FIRST).cast("int"))
    return F.when((at >= 0) & (at < days), moved)


def _iso_date(m: Column, key: str) -> Column:
    return F.coalesce(F.date_format(_moved_day(F.try_to_date(m, "yyyy-MM-dd"), key), "yyyy-MM-dd"), m)


def _date(m: Column, key: str) -> Column:
    """Day first, or month first where only that is a date; the notation stays."""
    sep = F.regexp_extract(m, r"[./]", 0)
    p = F.split(m, r"[./]")
    wide = [F.lpad(p[0], 2, "0"), F.lpad(p[1], 2, "0"), p[2]]

    def day_of(day: Column, month: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", wide[2], month, day), "yyyy-MM-dd")

    def shown(d: Column, first: str, second: str) -> Column:
        return F.concat(F.date_format(d, first), sep, F.date_format(d, second), sep, F.date_format(d, "yyyy"))

    dmy, mdy = day_of(wide[0], wide[1]), day_of(wide[1], wide[0])
    return F.coalesce(F.when(dmy.isNotNull(), shown(_moved_day(dmy, key), "dd", "MM")),
                      F.when(mdy.isNotNull(), shown(_moved_day(mdy, key), "MM", "dd")), m)


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    at = (area - 1 - (area > 666).cast("long")) * (99 * 9999) + (group - 1) * 9999 + serial - 1

    def text(moved: Column) -> Column:
        a, g, s = F.floor(moved / (99 * 9999)), F.floor(moved / 9999) % 99 + 1, moved % 9999 + 1
        a = a + 1 + (a >= 665).cast("long")
        return F.concat_ws("-", *[F.lpad(x.cast("long").cast("string"), n, "0") for x, n in ((a, 3), (g, 2), (s, 4))])

    return F.when(valid, let(permute_pair(at, (898, 99 * 9999), key, "ssn"), text)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    """Country code and layout stay; a first digit from 2 to 9 stays one."""
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .\-(])|^\+[0-9]", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))

    def filled(rest: Column) -> Column:
        digits = _only(rest, "0-9")
        first = F.substring(digits, 1, 1)

        def text(body: Column) -> Column:
            moved = F.when(first >= "2", F.substring(F.lit(DIGITS), (
                (first.cast("long") - 2 + _prf(key, F.lit("phone"), body)) % 8 + 3).cast("int"), F.lit(1))).otherwise(first)
            return _refill(rest, F.concat(moved, body), "0-9")

        return let(permute_text(F.substring(digits, F.lit(2), F.length(digits)), key, "phone", (DIGITS,)), text)

    return F.concat(code, let(rest, filled))


def _secret(m: Column, key: str) -> Column:
    value = F.regexp_extract(m, r"[0-9A-Za-z+/_\-]+$", 0)
    moved = F.when(value.rlike("^[0-9a-f]+$"), permute_text(value, key, "hex", (HEX,))).otherwise(
        permute_text(value, key, "secret"))
    return F.concat(F.substring(m, F.lit(1), F.length(m) - F.length(value)), moved)


def _email(m: Column, key: str) -> Column:
    """The local part is permuted, the domain stays."""
    local = F.substring_index(m, "@", 1)
    return F.concat(permute_text(local, key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def _aws(m: Column, key: str) -> Column:
    return F.concat(F.lit("AKIA"), permute_text(F.substring(m, 5, 16), key, "aws", (UPPER + "234567", "0189")))


KINDS = {"email": _email, "secret": _secret, "aws": _aws, "iban": _iban, "ip": _ip, "iso_date": _iso_date, "date": _date,
         "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of one found string (itself if it fails its check)."""
    out = found
    for kind in reversed(PATTERNS):
        out = F.when(found.rlike(f"^(?:{PATTERNS[kind]})$"), KINDS[kind](found, key)).otherwise(out)
    return out


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced.

    One pass puts a mark around each find; the parts between the marks are then
    texts and finds in turn. A text that holds the mark itself is split by the
    pattern instead."""
    text = F.col(f"`{text_col}`")
    marked = F.split(F.regexp_replace(text, f"({EVERY})", f"{MARK}$1{MARK}"), MARK, -1)
    quick = F.transform(marked, lambda part, i: F.when(i % 2 == 1, pseudonym(part, key)).otherwise(part))
    finds = F.regexp_extract_all(text, F.lit(f"({EVERY})"))
    slow = F.zip_with(F.split(text, EVERY, -1), finds, lambda a, b: F.concat(a, F.coalesce(pseudonym(b, key), F.lit(""))))
    new = F.array_join(F.when(F.contains(text, F.lit(MARK)), slow).otherwise(quick), "")
    changed = F.when(text.rlike(HINT), new).otherwise(text)
    out = docs.select(*[changed.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
    if chars_col and chars_col in docs.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return out
