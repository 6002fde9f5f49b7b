"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, digit pairs, plus signs before a digit,
scheme marks and identifier cues. A small parser for each kind of anchor grows the match from there
and checks it. Nothing else of the text is looked at, and every parser moves forward only, so the
time is linear in the text.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwork.llm.text import filled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Kinds with a fixed pattern, then those that the anchors add, in the order of the result.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "iban", "ssn", "account", "secret")
KINDS = BASE_KINDS + ADDED_KINDS
SPANS_TYPE = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

DIGITS = "0123456789"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
QUAD = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
CHAIN = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
DIAL = re.compile(r"[\x20().0-9-]*+")
LOGIN = re.compile(r"[^\x00-\x20/?#@\"'<>]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?::[0-9]++)?+")
#: Cue words and the kind they announce; each is looked for in lower case, capitalized and in capitals.
CUES = {
    "iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account",
    "token": "secret", "secret": "secret", "password": "secret", "passwd": "secret", "api_key": "secret", "apikey": "secret",
}
GAP = re.compile(r"(?:[\x20\t]{0,4}(?:number|no\.?|nr\.?|#|is))?[\x20\t]{0,4}[:=#.]?[\x20\t]{0,4}[\"']?", re.IGNORECASE | re.ASCII)
ASSIGNED = re.compile(r"[\"']?[\x20\t]{0,4}[:=][\x20\t]{0,4}[\"']?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
SSN = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,17}(?![0-9])")
SECRET = re.compile(r"[A-Za-z0-9_+/=.~-]{12,}+")


def make_automaton() -> ahocorasick.Automaton:
    """Anchors with (parser, length)."""
    anchors = {"@": "email", "://": "url"}
    for a in DIGITS:
        anchors[f"+{a}"] = "phone"
        for b in DIGITS:
            anchors[f"{a}.{b}"] = "ip"
            anchors |= {f"{a}{gap}{b}": "card" for gap in ("", " ", "-")}
    for cue, kind in CUES.items():
        anchors |= dict.fromkeys((cue, cue.capitalize(), cue.upper()), kind)
    automaton = ahocorasick.Automaton()
    for word, kind in anchors.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def byte_value(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def iban_end(text: str, start: int) -> int | None:
    """End of the longest prefix of the run at ``start`` with a right check number."""
    found = IBAN.match(text, start)
    if not found:
        return None
    end = found.end()
    while end - start >= 15:
        plain = text[start:end].replace(" ", "")
        if 15 <= len(plain) <= 34 and text[end - 1] != " ":
            if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                return end
        end -= 1
    return None


def added_span(kind: str, text: str, at: int, end: int) -> tuple[int, int] | None:
    """The value that the cue at [at, end) announces."""
    if kind == "url":
        login = LOGIN.match(text, end)
        start = at
        while start > 0 and text[start - 1] in SCHEME:
            start -= 1
        return (start, login.end()) if login and start < at else None
    if at and (text[at - 1].isalnum() or text[at - 1] == "_") and kind != "secret":
        return None  # inside a longer word
    gap = (ASSIGNED if kind == "secret" else GAP).match(text, end)
    if not gap:
        return None
    start = gap.end()
    if kind == "iban":
        stop = iban_end(text, start)
        return (start, stop) if stop else None
    if kind == "ssn":
        found = SSN.match(text, start)
        good = found and found[1] not in ("000", "666") and found[1] < "900" and found[2] != "00" and found[3] != "0000"
    elif kind == "account":
        found = good = ACCOUNT.match(text, start)
    else:
        found = SECRET.match(text, start)
        good = found and any(c in DIGITS for c in found[0]) and any(c.isalpha() for c in found[0])
    return found.span() if good else None


def spans_of(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, ordered by kind as listed, then start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    done = dict.fromkeys(KINDS, 0)  # what lies before is settled
    for last, (kind, length) in automaton.iter(text):
        end = last + 1
        at, free = end - length, done[kind]
        if kind == "card":
            if at < free:
                continue
            stop = done[kind] = CHAIN.match(text, at).end()
            digits = text[at:stop].replace(" ", "").replace("-", "") if stop - at >= 16 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                found[kind].append((at, stop))
        elif kind == "email":
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            domain = DOMAIN.match(text, end) if start < at else None
            if domain:
                done[kind] = domain.end()
                found[kind].append((start, domain.end()))
        elif kind == "ip":
            dot = start = at + 1
            while start > free and text[start - 1] in DIGITS:
                start -= 1
            quad = QUAD.match(text, start) if start < dot else None
            if quad:
                done[kind] = quad.end()
                if all(map(byte_value, quad[0].split("."))):
                    found[kind].append(quad.span())
        elif kind == "phone":
            if at < free:
                continue
            body = DIAL.match(text, end)[0].rstrip(" ().-")
            if len(body) >= 2:
                stop = done[kind] = end + len(body)
                if 8 <= 1 + sum(c in DIGITS for c in body) <= 15:
                    found[kind].append((at, stop))
        elif at >= free:
            span = added_span(kind, text, at, end)
            if span:
                done[kind] = span[1]
                found[kind].append(span)
    base = [span for kind in BASE_KINDS for span in found[kind]]
    for kind in ADDED_KINDS:  # what a base kind has found already is not said again
        if found[kind] and base:
            found[kind] = [s for s in found[kind] if not any(b[0] <= s[0] and s[1] <= b[1] for b in base)]
    return [(kind, *span) for kind in KINDS for span in found[kind]]


@F.arrow_udf(SPANS_TYPE)
def _spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    automaton = make_automaton()
    for texts in batches:
        rows = [
            [{"kind": k, "start": a, "end": b} for k, a, b in spans_of(text, automaton)] if text else []
            for text in texts.to_pylist()
        ]
        yield pa.array(rows, SPAN_ARROW)


@F.arrow_udf(T.StringType())
def _masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        parts, at = [], 0
        for span in sorted(found or [], key=lambda s: (s["start"], -s["end"])):
            if span["start"] >= at:
                parts += [text[at : span["start"]], f"<{span['kind']}>"]
            at = max(at, span["end"])
        out.append(None if text is None else "".join(parts) + text[at:])
    return pa.array(out, pa.string())


def personal_spans(text: Column | str) -> Column:
    """Array of (kind, start, end) of the whole text, in code points, end exclusive.

    Kinds in the order of ``KINDS``, each by start. Null and empty texts have none. Spans of a base
    kind are those of its pattern, leftmost first, without overlap. Added kinds are logins in
    addresses (``scheme://user:word@host``) and values behind a cue: IBAN with a right check number,
    social security numbers, account numbers, secrets. An added span inside a base span is left
    out. Time and memory are linear in the text, so a very long one costs its own size.
    """
    return _spans(filled(text))


def find_personal_data(docs: DataFrame, text_col: str = "text", name: str = "personal_spans") -> DataFrame:
    """``docs`` with the spans of each row's text in column ``name``.

    An input column of that name gives way; all others stay as they are. Rows are judged alone:
    repeated rows give repeated results, an empty table an empty one.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != name.lower()]
    return docs.select(*kept, personal_spans(F.col(f"`{text_col}`")).alias(name))


def mask_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets; null stays null."""
    text = F.col(f"`{text_col}`")
    masked = _masked(text, personal_spans(text)).alias(text_col)
    return docs.select(*[masked if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def written(spans: Column | str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def of_kinds(spans: Column | str, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
