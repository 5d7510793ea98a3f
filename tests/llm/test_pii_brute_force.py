"""Whole texts against pseudonyms written in plain Python; linkage, range and case of values."""

from __future__ import annotations

import hashlib
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rainloom.llm import common, pii
from tests.llm.conftest import HARD_TEXTS, SF
from tests.llm.test_pii import CASES, luhn, rewrite

KEY = pii.KEY


def sha(*parts):
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def network(value, a, b, tweak):
    left, right = divmod(value, b)
    for i in range(pii.ROUNDS):
        left = (left + int(sha(KEY, tweak, 2 * i, right)[:15], 16)) % a
        right = (right + int(sha(KEY, tweak, 2 * i + 1, left)[:15], 16)) % b
    return left * b + right


def digits_moved(digits, kind):
    low = len(digits) // 2
    return f"{network(int(digits), 10 ** (len(digits) - low), 10 ** low, f'{kind}{len(digits)}'):0{len(digits)}d}"


def refilled(match, digits):
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in match)


def check_digit(payload):
    return next(c for c in "0123456789" if luhn(payload + c))


TWO = {20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, *range(43, 50), *range(51, 59), *range(60, 67), 81, 82, 84, 86, *range(90, 96), 98}


def hex_moved(text):
    mixed = text != text.lower() and text != text.upper()
    alphabet = "0123456789" + ("abcdefABCDEF" if mixed else "abcdef" if text == text.lower() else "ABCDEF")
    def once(t):
        n = len(t)
        halves = [t[:n // 2], t[n // 2:]]
        for i in range(2 * pii.ROUNDS):
            mine, other = i % 2, 1 - i % 2
            key = bytes.fromhex(sha(KEY, "hex", n, len(alphabet), i, halves[other]))
            halves[mine] = "".join(alphabet[(alphabet.index(c) + k) % len(alphabet)] for c, k in zip(halves[mine], key))
        return "".join(halves)
    while True:
        text = once(text)
        fits = any(c.isalpha() for c in text) and any(c.isdigit() for c in text)
        if fits and (not mixed or (re.search("[a-f]", text) and re.search("[A-F]", text))):
            return text


def day_of(m):
    y, mo, d = (int(x) for x in (m.split("-") if m[4] == "-" else re.split("[./]", m)[::-1]))
    try:
        return (date(y, mo, d) - date(1900, 1, 1)).days
    except ValueError:
        return None


def brute_value(m):
    digits = re.sub("[^0-9]", "", m)
    if "@" in m:
        return f"u{sha(KEY, 'email', m.lower())[:16]}@pseudonym.invalid"
    if re.fullmatch("[0-9A-Fa-f]{32,64}", m):
        return hex_moved(m) if re.search("[A-Fa-f]", m) and re.search("[0-9]", m) else m
    if re.fullmatch(pii._DATE, m, re.A):
        at = day_of(m)
        if at is None or not 0 <= at < 73049:
            return m
        new = date(1900, 1, 1) + timedelta(days=network(at, 17, 4297, "date"))
        return new.isoformat() if m[4] == "-" else f"{new.day:02d}{m[2]}{new.month:02d}{m[5]}{new.year}"
    if re.fullmatch(pii._IP, m, re.A):
        parts = [int(x) for x in m.split(".")]
        if max(parts) > 255:
            return m
        new = network(int.from_bytes(bytes(parts), "big"), 65536, 65536, "ip")
        return ".".join(map(str, new.to_bytes(4, "big")))
    if re.fullmatch(pii._SSN, m, re.A):
        area, group, serial = map(int, m.split("-"))
        if not (1 <= area <= 899 and area != 666 and group and serial):
            return m
        new, serial = divmod(network(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, "ssn"), 9999)
        area, group = new // 99 + 1, new % 99 + 1
        return f"{area + (area >= 666):03d}-{group:02d}-{serial + 1:04d}"
    if re.fullmatch(pii._CARD, m, re.A) and 13 <= len(digits) <= 19 and luhn(digits):
        payload = digits_moved(digits[:-1], "card")
        return refilled(m, payload + check_digit(payload))
    if re.fullmatch(pii._PHONE, m, re.A) and 8 <= len(digits) <= 15:
        keep = 0
        if m[0] == "+":
            keep = 1 if digits[0] in "17" else 2 if int(digits[:2]) in TWO else 3
            keep = min(keep, len(digits) - 4)
        return refilled(m, digits[:keep] + digits_moved(digits[keep:], "phone"))
    return m


def brute(text):
    return None if text is None else re.sub(pii.PATTERN, lambda m: brute_value(m[0]), text, flags=re.A)


def test_whole_texts_equal_plain_python(spark, docs_of):
    docs = common.documents(spark, SF)
    old = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    assert {r["doc_id"]: r["text"] for r in pii.counts(docs).collect()} == {i: brute(t) for i, t in old.items()}
    rows = [(i, t) for i, t in HARD_TEXTS if i not in (8, None)] + [
        (100 + i, f"see {v}, or ({v}) {v}x") for i, v in enumerate(v for values in CASES.values() for v in values)]
    assert {r["doc_id"]: r["text"] for r in pii.counts(docs_of([r for r in rows])).collect()} == {i: brute(t) for i, t in rows}


@pytest.mark.parametrize("spellings", [
    ["+33612345678", "+33 612345678", "+33 6 12 34 56 78", "+33-612-345-678"], ["+1 (415) 555-2671", "+14155552671", "+1 415 555 2671"],
    ["+380 44 1234567", "+380441234567"], ["(415) 555-2671", "415-555-2671", "415.555.2671"], ["4111111111111111", "4111 1111-1111 1111"]])
def test_spellings_of_one_number_stay_linked(spark, spellings):
    new = rewrite(spark, [f"a {v} b" for v in spellings])
    assert len({re.sub(r"\D", "", new[i]["text"]) for i in range(len(spellings))}) == 1
    back = rewrite(spark, [new[i]["text"] for i in range(len(spellings))], inverse=True)
    assert [back[i]["text"][2:-2] for i in range(len(spellings))] == spellings


def test_every_day_stays_in_range_and_comes_back(spark):
    days = spark.range(73049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("old"))
    rows = days.withColumn("new", pii._date(F.col("old"), KEY, False)).withColumn("back", pii._date(F.col("new"), KEY, True)).collect()
    assert all(r["back"] == r["old"] for r in rows) and len({r["new"] for r in rows}) == 73049
    assert min(r["new"] for r in rows) == "1900-01-01" and max(r["new"] for r in rows) == "2099-12-31"


def test_hex_keeps_case_comes_back_and_hides_equal_beginnings(spark):
    values = ["deadbeef" * 4 + "01", "DEADBEEF" * 4 + "01", "DeadBeef" * 4 + "0a", "deadbeef" * 4 + "02", "a" * 31 + "1", "0" * 63 + "F"]
    new = rewrite(spark, values)
    back = rewrite(spark, [new[i]["text"] for i in range(len(values))], inverse=True)
    assert [back[i]["text"] for i in range(len(values))] == values
    assert new[0]["text"] == new[0]["text"].lower() and new[1]["text"] == new[1]["text"].upper()
    assert new[0]["text"][:12] != new[3]["text"][:12] and all(len(new[i]["text"]) == len(v) for i, v in enumerate(values))
