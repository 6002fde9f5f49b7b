"""Token counts per section from one encoding of the whole document.

A document is encoded once. Byte-level tokens are consecutive pieces of its UTF-8 bytes, so the
lengths of the tokens give their byte spans, and from these their character spans. The spans
are then joined with the sections, two sorted lists of intervals, and a token that crosses a
section border is given away by the rule chosen.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published splitting pattern that belongs to this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
RULES = ("start", "majority", "fraction")
OUT_TYPE = "n_tokens long, outside double, crossing long, section_tokens array<double>"


def encoder_of(ranks_file: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder, and the byte length of every token."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, rank in ranks.items():
        lengths[rank] = len(piece)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def char_spans(text: str, byte_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans [start, end) of tokens; a token inside a character spans that character."""
    ends = np.cumsum(byte_lengths)
    starts = ends - byte_lengths
    if text.isascii():
        return starts, ends
    raw = np.frombuffer(text.encode(), np.uint8)
    char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char_of[starts], char_of[ends - 1] + 1


def attribute(
    starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, rule: str
) -> tuple[np.ndarray, float, int]:
    """Tokens per section, tokens outside all sections, and tokens crossing a border.

    ``borders`` are the sections' [start, end) rows, sorted and without overlap. ``start``
    gives a token to the section of its first character, ``majority`` to the section with most
    of its characters (the earliest of equals; outside counts as a section after all others),
    ``fraction`` to every section by its share of the characters.
    """
    counts = np.zeros(len(borders))
    if not len(starts):
        return counts, 0.0, 0
    if not len(borders):
        return counts, float(len(starts)), 0
    lows, highs = borders[:, 0], borders[:, 1]
    first = np.searchsorted(highs, starts, side="right")  # first section that ends after the start
    beyond = np.searchsorted(lows, ends, side="left")  # first section that begins at or after the end
    touched = beyond - first
    safe = np.minimum(first, len(lows) - 1)
    inside = (touched == 1) & (lows[safe] <= starts) & (highs[safe] >= ends)
    counts += np.bincount(first[inside], minlength=len(lows))
    outside = float((touched <= 0).sum())
    rest = np.flatnonzero(~inside & (touched > 0))
    for t in rest:
        span = np.arange(first[t], beyond[t])
        shared = np.minimum(highs[span], ends[t]) - np.maximum(lows[span], starts[t])
        free_chars = (ends[t] - starts[t]) - shared.sum()
        if rule == "fraction":
            counts[span] += shared / (ends[t] - starts[t])
            outside += free_chars / (ends[t] - starts[t])
        elif rule == "majority":
            if shared.max() >= free_chars:
                counts[span[np.argmax(shared)]] += 1
            else:
                outside += 1
        elif lows[span[0]] <= starts[t]:
            counts[span[0]] += 1
        else:
            outside += 1
    return counts, outside, len(rest)


def line_borders(text: str) -> np.ndarray:
    """Sections of a text without given ones: its lines, each with its line break."""
    ends = np.cumsum([len(line) + 1 for line in text.split("\n")])
    ends[-1] -= 1
    return np.stack([np.r_[0, ends[:-1]], ends], axis=1)


def attributed_batches(vocabulary, pattern: str, rule: str, given: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = encoder_of(vocabulary.value, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - (2 if given else 1)).to_pylist()
            spans = batch.column(batch.num_columns - 1).to_pylist() if given else [None] * len(texts)
            n_tokens, outside, crossing, per_section = [], [], [], []
            for text, sections in zip(texts, spans, strict=True):
                if not text:
                    n_tokens.append(0), outside.append(0.0), crossing.append(0)
                    per_section.append(np.zeros(len(sections or [])))
                    continue
                ids = np.asarray(encoding.encode_ordinary(text), np.int64)
                starts, ends = char_spans(text, lengths[ids])
                if given:
                    borders = np.array([(s["start"], s["end"]) for s in sections or []], np.int64).reshape(-1, 2)
                else:
                    borders = line_borders(text)
                counts, out, crossed = attribute(starts, ends, borders, rule)
                n_tokens.append(len(ids)), outside.append(out), crossing.append(crossed)
                per_section.append(counts)
            flat = np.concatenate(per_section) if per_section else np.zeros(0)
            offsets = np.r_[0, np.cumsum([len(x) for x in per_section])].astype(np.int32)
            kept = list(batch.columns[: batch.num_columns - (2 if given else 1)])
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_tokens, pa.int64()), pa.array(outside, pa.float64()),
                 pa.array(crossing, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat))],
                names=[*batch.schema.names[: len(kept)], "n_tokens", "outside", "crossing", "section_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sections_col: str | None = None,
    rule: str = "start",
    vocabulary: str = DEFAULT_VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """id, n_tokens, outside, crossing and section_tokens (one number per section, in order).

    ``sections_col`` is an array of structs with the character bounds ``start`` and ``end``,
    sorted and without overlap, gaps allowed; without it the lines of the text are the
    sections, each with its line break. Section counts and ``outside`` sum to ``n_tokens``.
    A null or empty text has no tokens, no lines, and zeros for given sections. Each row is
    encoded alone, so repeated rows give repeated results; other columns are not read; an empty
    table gives an empty one. The driver reads the vocabulary file (about 1 MB) and sends it to
    the executors, which need no copy.
    """
    if rule not in RULES:
        raise ValueError(f"The rule is one of {', '.join(RULES)}")
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())
    given = [F.col(sections_col).alias("_sections")] if sections_col else []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *given)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        attributed_batches(ranks, pattern, rule, bool(given)), f"doc_id {kind}, {OUT_TYPE}"
    )
