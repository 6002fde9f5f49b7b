"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger stores the measurements and one bit per
failed rule; a policy is a named, versioned set of rules, and verdicts and ablations are bitwise
operations on the stored bits. All work stays inside the row, so nothing is shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.llm.text import filled, free, plus, shielded, unshielded, words

WINDOW = 8


class Rule(NamedTuple):
    """``fails`` is a condition over the measurements; rule number i has bit 2**i."""

    name: str
    fails: str


class Policy(NamedTuple):
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self) -> int:
        return sum(1 << i for i, rule in enumerate(RULES) if rule.name in self.rules)


# Append only: the place of a rule is its bit.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("short_mean_word", "word_chars < 3 * n_words"),
    Rule("long_mean_word", "word_chars > 10 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_text_lines"),
)
POLICIES = (
    Policy("base", 1, ("few_words", "repeated_words")),
    Policy("strict", 1, tuple(rule.name for rule in RULES)),
)
BASE, STRICT = POLICIES
MEASURES = ("n_words", "word_chars", "n_symbols", "n_text_lines", "n_dup_lines", "n_repeat_words")


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def repeated_window_words(of: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words found twice or more in the array.

    Windows are told apart by 64-bit hashes within one document. Only documents with a
    repeated hash sort their windows; the sorted pairs (hash, place) show the repeated places,
    and the covered words are summed over these in order.
    """

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(pairs: Column) -> Column:
            again = F.transform(
                pairs,
                lambda p, k: F.when(
                    (p["h"] == F.get(pairs, k + 1)["h"]) | (p["h"] == F.get(pairs, k - 1)["h"]), p["i"]
                ),
            )
            return F.sort_array(F.filter(again, lambda i: i.isNotNull()))

        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("sum"))
        return F.aggregate(
            bound(ordered, places),
            start,
            lambda seen, i: F.struct(
                i.alias("last"), (seen["sum"] + F.least(F.lit(width), i - seen["last"])).alias("sum")
            ),
            lambda seen: seen["sum"],
        )

    def counted(all_words: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(all_words) - (width - 1)),
            lambda i: F.xxhash64(F.slice(all_words, i, width)),
        )
        return bound(
            windows,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)),
        )

    return bound(of, lambda w: F.when(F.size(w) < width, 0).otherwise(counted(w)))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements (long); a null text measures like an empty one."""
    text = filled(text_col)
    tokens = words(text_col)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    line_counts = bound(
        lines, lambda x: F.struct(F.size(x).alias("all"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    )
    word_counts = bound(
        tokens,
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.length(F.array_join(w, "")).alias("chars"),
            repeated_window_words(w).alias("repeat"),
        ),
    )
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))
    # A generator keeps what is read several times later from being computed several times.
    m_words, m_lines, m_symbols = (free(docs, name) for name in ("m_words", "m_lines", "m_symbols"))
    row = F.struct(word_counts.alias(m_words), line_counts.alias(m_lines), symbols.alias(m_symbols))
    wide = plus(
        docs.select("*", F.inline_outer(F.array(row))),
        n_words=F.col(f"{m_words}.n").cast("long"),
        word_chars=F.col(f"{m_words}.chars").cast("long"),
        n_symbols=F.col(m_symbols).cast("long"),
        n_text_lines=F.col(f"{m_lines}.all").cast("long"),
        n_dup_lines=F.col(f"{m_lines}.dup").cast("long"),
        n_repeat_words=F.col(f"{m_words}.repeat").cast("long"),
    )
    return wide.drop(m_words, m_lines, m_symbols)


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failure_bits`` (long).

    Each row is judged alone: repeated rows and ties are judged alike, a null or empty text
    has no words and fails few_words only, an empty table gives an empty one. Input columns of
    the new names give way.
    """
    bits = None
    for i, rule in enumerate(RULES):
        bit = F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return plus(measured(docs, text_col), failure_bits=bits)


def fails(policy: Policy, bits: Column | str = "failure_bits") -> Column:
    """True if the document fails a rule of the policy."""
    column = F.col(bits) if isinstance(bits, str) else bits
    return column.bitwiseAND(F.lit(policy.mask()).cast("long")) != 0


def passing(docs: DataFrame, policy: Policy, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that fail no rule of the policy, with their own columns whatever their names.

    Null and empty texts fail for their few words, repeated rows pass or fail alike, a very long
    text is measured whole in its row, and an empty table gives an empty one.
    """
    inside, names = shielded(docs)
    return unshielded(ledger(inside, names[text_col]).filter(~fails(policy)), names)


def ablations(ledgered: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule: documents that fail it, fail only it, and the policy's rejects without it.

    The ledger is first counted by its bits; at most 2**rules rows remain for the rest.
    """
    by_bits = ledgered.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("docs"))
    cases = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(rule.name).alias("rule"),
                    F.lit(p.mask()).cast("long").alias("mask"), F.lit(1 << i).cast("long").alias("bit"),
                )
                for p in policies
                for i, rule in enumerate(RULES)
                if rule.name in p.rules
            ]
        )
    )
    held = by_bits.select("*", cases.alias("c")).select("failure_bits", "docs", "c.*")
    hit = F.col("failure_bits").bitwiseAND(F.col("mask"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("docs")).otherwise(0))

    return held.groupBy("policy", "version", "rule").agg(
        total(hit.bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(hit == F.col("bit")).alias("failed_only_this"),
        total(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) != 0).alias("rejected_without"),
    )
