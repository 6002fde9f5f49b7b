"""Personal data against plain regular expressions."""

import random
import re

from cases import collected, rows, table
from pyspark.sql import functions as F

from legwork.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def check_digit(digits):
    return sum(sum(divmod(int(d) * (2 if i % 2 else 1), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def brute(text):
    text = text or ""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and check_digit(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def base_of(text, automaton):
    return [s for s in pii.spans_of(text, automaton) if s[0] in pii.BASE_KINDS]


def card(rng, n):
    digits = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(digits + d for d in "0123456789" if check_digit(digits + d))


def test_base_spans_like_patterns():
    rng, automaton = random.Random(11), pii.make_automaton()
    alphabets = ["ab@.-1", "12.", "1 -+", "+1 ().-", "0123456789 -+.@a(", "é1.@+ x2", "25.0"]
    n_found = 0
    for i in range(30_000):
        letters = alphabets[i % len(alphabets)]
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        if i % 5 == 0:
            number = card(rng, rng.randrange(15, 21))
            text += rng.choice(["", " ", "x", "-"]) + " ".join(re.findall("....|.+", number)) + rng.choice(["", " ", "1", "-2", "é"])
        assert base_of(text, automaton) == brute(text), text
        n_found += len(brute(text))
    assert n_found > 5_000


def test_known_cases():
    automaton = pii.make_automaton()
    for text in (
        "a@b.c@d.e x@@y.z a@b@c.de", "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 0001.0.0.255", "+1 (743) 555-3824 +1555 +1--2 ++12345678",
        "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111", "a" * 20_000 + "@b.cd", "1" * 4_000 + ".2.3.4",
        "1 " * 50_000, "@" * 1000, "+1" + " " * 100_000 + "2", "1." * 50_000, "é😀 x@y.zz 漢",
    ):
        assert base_of(text, automaton) == brute(text)


def test_added_spans():
    automaton = pii.make_automaton()

    def added(text):
        return [(k, text[a:b]) for k, a, b in pii.spans_of(text, automaton) if k in pii.ADDED_KINDS]

    assert added("see ftp://ann:pw@host.net:21/x and http://host.net/a@b") == [("url", "ftp://ann:pw@host.net:21")]
    assert added("IBAN: GB82 WEST 1234 5698 7654 32, IBAN GB83 WEST 1234 5698 7654 32") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert added("SSN 123-45-6789, ssn: 000-12-3456, social security number 219-09-9999") == [
        ("ssn", "123-45-6789"), ("ssn", "219-09-9999")]
    assert added("Account number: 1234 5678 90, accounting 123456789, acct #00112233") == [
        ("account", "1234 5678 90"), ("account", "00112233")]
    assert added('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" token of words, password: onlylettershere') == [
        ("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff")]
    assert added("account: 4111 1111 1111 1111") == []  # a card already
    assert added("a clean text with 3 numbers: 12, 2024 and http://host.net/") == []


def test_spans_of_a_table(spark):
    data = rows() + [(300, "mail a.b@c.de or +1 (743) 555-3824", "en", "s", 1), (301, 'token = "abc123abc123abc123"', "en", "s", 1)]
    df = table(spark, data, clashes=True).withColumn("personal_spans", F.lit("own"))
    found = pii.find_personal_data(df)
    assert set(found.columns) == set(df.columns)
    automaton = pii.make_automaton()
    want = sorted(((r[0], [tuple(s) for s in pii.spans_of(r[1] or "", automaton)]) for r in data), key=repr)
    got = [(i, [(s["kind"], s["start"], s["end"]) for s in spans]) for i, spans in collected(found, "doc_id", "personal_spans")]
    assert sorted(got, key=repr) == want
    masked = dict(collected(pii.mask_personal_data(df).filter("doc_id >= 300 OR doc_id IN (60, 61)"), "doc_id", "text"))
    assert masked == {300: "mail <email> or <phone>", 301: 'token = "<secret>"', 60: None, 61: ""}
    assert pii.find_personal_data(df.filter("false")).count() == 0
