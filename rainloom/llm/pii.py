"""Personal data replaced by format-preserving pseudonyms (DataFrame functions only).

Validated numbers and dates are permuted within the set of valid values of their format by a keyed
Feistel network over mixed radices, so equal values get equal pseudonyms in every document, different
values different ones, and whoever holds the key can restore them:

card       13 to 19 digits with a right Luhn check digit: digits permuted, check digit computed anew
phone      ``+`` with 8 to 15 digits, or a grouped 10-digit number: all digits but the country's, however
           the number is grouped
ip         four numbers up to 255
ssn        three, two and four digits with a valid area, group and serial number
date       yyyy-mm-dd, dd.mm.yyyy, dd/mm/yyyy from 1900 to 2099: a day of the same span
hex        32 to 64 hexadecimal digits with a letter and a digit (keys, tokens): the same length and
           case, as one value; in mixed case the letters of either case are symbols of their own
email      not a number: the address is replaced by a keyed digest, equal addresses by equal ones

Text outside the matches does not change. A number that fails its validation stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEY = "rainloom-demo-key"
ROUNDS = 8
#: fixed values: first day and number of days of the date format (73,049), as 17 * 4297
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)
#: fixed values: telephone country codes of one and two digits; all others have three
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: most steps along a cycle to an image that is valid again (all but one in ten million need one)
WALK = 8

_DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_CARD = r"\d{4}(?:[ -]?\d{4}){2}(?:[ -]?\d{1,7})|\d{13,19}"
_PHONE = r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{1,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_HEX = r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])"
_EDGE, _END = r"(?<![\w.])", r"(?!\w|\.\d)"
PATTERN = f"{_EMAIL}|{_HEX}|{_EDGE}(?:{_DATE}|{_IP}|{_SSN}|{_CARD}|{_PHONE}){_END}"
KINDS = ("card", "phone", "ip", "ssn", "date", "hex", "email")


def feistel(value: Column, a: Column | int, b: Column | int, tweak: Column | str, key: str = KEY, inverse: bool = False) -> Column:
    """Keyed permutation of 0 .. a*b-1: rounds of modular addition to halves of radix a and b."""
    a, b = (F.lit(x).cast("long") if isinstance(x, int) else x.cast("long") for x in (a, b))
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak

    def noise(half: Column, i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def forward(s, i):
        left = F.pmod(s["l"] + F.pmod(noise(s["r"], 2 * i), a), a)
        return F.struct(left.alias("l"), s["r"].alias("r"))

    def forward_right(s, i):
        return F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(noise(s["l"], 2 * i + 1), b), b).alias("r"))

    def back(s, i):
        return F.struct(F.pmod(s["l"] - F.pmod(noise(s["r"], 2 * i), a), a).alias("l"), s["r"].alias("r"))

    def back_right(s, i):
        return F.struct(s["l"].alias("l"), F.pmod(s["r"] - F.pmod(noise(s["l"], 2 * i + 1), b), b).alias("r"))

    # one step per half-round: even steps change the left half, odd steps the right one
    steps = F.sequence(F.lit(0), F.lit(2 * ROUNDS - 1))
    steps = F.reverse(steps) if inverse else steps
    left, right = (back, back_right) if inverse else (forward, forward_right)

    def step(s, i):
        n = F.floor(i / 2).cast("int")
        return F.when(i % 2 == 0, left(s, n)).otherwise(right(s, n))

    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, b).cast("long").alias("r"))
    return F.aggregate(steps, start, step, lambda s: s["l"] * b + s["r"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _power(n: Column) -> Column:
    """10 ** n as a bigint, exactly."""
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permute_digits(digits: Column, kind: str, key: str, inverse: bool) -> Column:
    """A digit string of 2 to 18 digits to one of the same length."""
    n = F.length(digits)
    low = F.floor(n / 2).cast("int")
    moved = feistel(digits.cast("long"), _power(n - low), _power(low), F.concat(F.lit(kind), n.cast("string")), key, inverse)
    return F.lpad(moved.cast("string"), n, "0")


def luhn_digit(payload: Column) -> Column:
    """The check digit that follows ``payload``."""
    odd = F.transform(F.split(F.reverse(payload), ""), lambda d, i: F.when(i % 2 == 0, 2 * d.cast("int")).otherwise(d.cast("int")))
    total = F.aggregate(odd, F.lit(0), lambda s, d: s + F.floor(d / 10).cast("int") + d % 10)
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _refill(match: Column, digits: Column) -> Column:
    """``match`` with its digits replaced one by one."""
    gaps, groups = F.split(match, "[0-9]+", -1), F.regexp_extract_all(match, F.lit("[0-9]+"), 0)
    start = F.struct(F.element_at(gaps, 1).alias("out"), F.lit(1).alias("at"))
    tail = F.slice(gaps, 2, F.size(groups))
    both = F.zip_with(groups, tail, lambda g, gap: F.struct(F.length(g).alias("n"), gap.alias("gap")))
    return F.aggregate(both, start, lambda s, g: F.struct(
        F.concat(s["out"], F.substring(digits, s["at"], g["n"]), g["gap"]).alias("out"), (s["at"] + g["n"]).alias("at")), lambda s: s["out"])


def _card(match, key, inverse):
    payload = F.substring(_digits(match), F.lit(1), F.length(_digits(match)) - 1)
    moved = permute_digits(payload, "card", key, inverse)
    return _refill(match, F.concat(moved, luhn_digit(moved)))


def is_card(match: Column) -> Column:
    digits = _digits(match)
    n = F.length(digits)
    return match.rlike(f"^(?:{_CARD})$") & n.between(13, 19) & (
        luhn_digit(F.substring(digits, F.lit(1), n - 1)) == F.substring(digits, n, F.lit(1)))


def _phone(match, key, inverse):
    digits = _digits(match)
    keep = F.when(match.startswith("+"), F.length(F.regexp_extract(digits, COUNTRY, 0))).otherwise(0)
    keep = F.least(keep, F.length(digits) - 4)
    rest = permute_digits(F.substring(digits, keep + 1, F.length(digits)), "phone", key, inverse)
    return _refill(match, F.concat(F.substring(digits, F.lit(1), keep), rest))


def _ip(match, key, inverse):
    number = F.aggregate(F.split(match, r"\."), F.expr("0L"), lambda s, p: s * 256 + p.cast("long"))
    moved = feistel(number, 65536, 65536, "ip", key, inverse)
    return F.concat_ws(".", *[F.pmod(F.shiftright(moved, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])


def _ssn_valid(match):
    area = F.substring(match, 1, 3).cast("int")
    return area.between(1, 899) & (area != 666) & (F.substring(match, 5, 2) != "00") & (F.substring(match, 8, 4) != "0000")


def _ssn(match, key, inverse):
    area = F.substring(match, 1, 3).cast("long")
    place = area - 1 - (area > 666).cast("long")
    number = (place * 99 + F.substring(match, 5, 2).cast("long") - 1) * 9999 + F.substring(match, 8, 4).cast("long") - 1
    moved = feistel(number, 898 * 99, 9999, "ssn", key, inverse)
    group = F.floor(moved / 9999)
    at = F.floor(group / 99) + 1
    return F.concat_ws("-", F.lpad((at + (at >= 666).cast("long")).cast("string"), 3, "0"),
                       F.lpad((group % 99 + 1).cast("string"), 2, "0"), F.lpad((moved % 9999 + 1).cast("string"), 4, "0"))


def _day(match: Column) -> Column:
    """Days since the first day; null if no such day."""
    iso = match.rlike(r"^\d{4}-")
    year = F.when(iso, F.substring(match, 1, 4)).otherwise(F.substring(match, 7, 4))
    month = F.when(iso, F.substring(match, 6, 2)).otherwise(F.substring(match, 4, 2))
    day = F.when(iso, F.substring(match, 9, 2)).otherwise(F.substring(match, 1, 2))
    return F.datediff(F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))


def _date(match, key, inverse):
    moved = feistel(_day(match).cast("long"), *DAYS, "date", key, inverse)
    date = F.date_add(F.lit(FIRST_DAY).cast("date"), moved.cast("int"))
    mark = F.substring(match, 3, 1)
    return F.when(match.rlike(r"^\d{4}-"), F.date_format(date, "yyyy-MM-dd")).otherwise(
        F.concat(F.date_format(date, "dd"), mark, F.date_format(date, "MM"), F.substring(match, 6, 1), F.date_format(date, "yyyy")))


def _hex_valid(text: Column, alphabet: Column) -> Column:
    """Are there a digit and a letter, and in mixed case letters of both cases?"""
    letters = F.when(F.length(alphabet) > 16, text.rlike("[a-f]") & text.rlike("[A-F]")).otherwise(text.rlike("[A-Fa-f]"))
    return letters & text.rlike("[0-9]")


def permute_symbols(text: Column, alphabet: Column, kind: str, key: str, inverse: bool) -> Column:
    """A string over an alphabet to one of the same length: a Feistel network whose halves are strings
    of up to 32 symbols, each half moved by a digest of all of the other."""
    radix, n = F.length(alphabet), F.length(text)
    cut = F.floor(n / 2).cast("int")

    def moved(half, other, i):
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), radix.cast("string"), i.cast("string"), other), 256)
        def symbol(c, at):
            step = F.conv(F.substring(digest, 2 * at + 1, F.lit(2)), 16, 10).cast("int")
            place = F.instr(alphabet, c) - 1
            return F.substring(alphabet, F.pmod(place - step if inverse else place + step, radix) + 1, F.lit(1))
        return F.array_join(F.transform(F.split(half, ""), symbol), "")

    def step(s, i):
        return F.when(i % 2 == 0, F.struct(moved(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), moved(s["r"], s["l"], i).alias("r")))

    steps = F.sequence(F.lit(0), F.lit(2 * ROUNDS - 1))
    start = F.struct(F.substring(text, F.lit(1), cut).alias("l"), F.substring(text, cut + 1, n).alias("r"))
    return F.aggregate(F.reverse(steps) if inverse else steps, start, step, lambda s: F.concat(s["l"], s["r"]))


def _hex(match, key, inverse):
    small, large, both = (F.lit("0123456789" + x) for x in ("abcdef", "ABCDEF", "abcdefABCDEF"))
    alphabet = F.when(~match.rlike("[A-F]"), small).when(~match.rlike("[a-f]"), large).otherwise(both)

    def walk(s, i):
        image = F.array(permute_symbols(s["text"], alphabet, "hex", key, inverse))
        return F.when(s["done"], s).otherwise(
            F.transform(image, lambda t: F.struct(t.alias("text"), _hex_valid(t, alphabet).alias("done")))[0])

    start = F.struct(match.alias("text"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, walk, lambda s: s["text"])


def _email(match, key, inverse):
    if inverse:
        return match
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(match)), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 16), F.lit("@pseudonym.invalid"))


def kind_of(match: Column) -> Column:
    """The kind of a validated match; null where the validation fails."""
    n = F.length(_digits(match))
    return (F.when(match.contains("@"), "email")
            .when(match.rlike("^[0-9A-Fa-f]{32,64}$"), F.when(match.rlike("[A-Fa-f]") & match.rlike("[0-9]"), "hex"))
            .when(match.rlike(f"^{_DATE}$"), F.when(_day(match).between(0, DAYS[0] * DAYS[1] - 1), "date"))
            .when(match.rlike(f"^{_IP}$"), F.when(F.forall(F.split(match, r"\."), lambda p: p.cast("int") <= 255), "ip"))
            .when(match.rlike(f"^{_SSN}$"), F.when(_ssn_valid(match), "ssn"))
            .when(is_card(match), "card")
            .when(match.rlike(f"^(?:{_PHONE})$") & n.between(8, 15), "phone"))


_MAKERS = {"card": _card, "phone": _phone, "ip": _ip, "ssn": _ssn, "date": _date, "hex": _hex, "email": _email}


def pseudonym(match: Column, kind: Column, key: str = KEY, inverse: bool = False) -> Column:
    """The pseudonym of a match of a kind (the value of a pseudonym if ``inverse``, but for addresses)."""
    value = F.when(F.lit(False), match)
    for name, make in _MAKERS.items():
        value = value.when(kind == name, make(match, key, inverse))
    return value.otherwise(match)


def replace_pii(docs: DataFrame, text: str = "text", key: str = KEY, inverse: bool = False) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``pii_kinds``, the kinds found, in text order.

    Null and empty texts stay as they are and have no kinds; repeated rows are rewritten alike. A
    column named ``pii_kinds`` is replaced.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    found = F.when(value.rlike("[0-9@]"), F.regexp_extract_all(value, F.lit(PATTERN), 0)).otherwise(F.array().cast("array<string>"))
    marked = docs.withColumn("__pii_found", found).withColumn("__pii_kinds", F.transform("__pii_found", kind_of))
    renamed = F.zip_with("__pii_found", "__pii_kinds", lambda m, k: pseudonym(m, k, key, inverse))
    marked = marked.withColumn("__pii_new", renamed)
    pieces = F.zip_with(F.split(value, PATTERN, -1), F.col("__pii_new"), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    rewritten = F.when(F.size("__pii_found") > 0, F.array_join(pieces, "")).otherwise(F.col(text))
    result = marked.withColumn(text, rewritten).withColumn("pii_kinds", F.filter("__pii_kinds", lambda k: k.isNotNull()))
    return result.drop("__pii_found", "__pii_kinds", "__pii_new")


def counts(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``doc_id, text`` and ``n_<kind>`` for every kind, of every row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    number = [
        F.size(F.expr(f"filter(pii_kinds, k -> k = '{name}')")).cast("long").alias(f"n_{name}") for name in KINDS]
    return replace_pii(slim, key=key).select("doc_id", "text", *number)

