"""Benchmark passages in documents, found by a prefix-filtered join on rare words.

A window is ten consecutive words of an item (a shorter item is one window). Containment of a
window needs all of its words, so its rarest word is a sufficient prefix: words are ordered by
how often the documents use them, each distinct window is represented by its rarest word and
the place of that word, and only documents with that word at a place that leaves room for the
whole window (positional and length bound) become candidates. Candidates are verified word by
word against the document's own words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.llm.quality import bound
from legwork.llm.text import ascii_lower, filled, free, plus, same, sized_broadcast, text_key
from legwork.session import cut_to_table

# ASCII characters that are no letters and no digits part words.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10


def raw_words(text: Column | str) -> Column:
    """Words in their own case; lower-casing A-Z does not move word borders."""

    def inner(pieces: Column) -> Column:  # only the first and the last piece can be empty
        lead = (F.get(pieces, F.lit(0)) == "").cast("int")
        trail = (F.get(pieces, F.size(pieces) - 1) == "").cast("int")
        return F.slice(pieces, lead + 1, F.greatest(F.size(pieces) - lead - trail, F.lit(0)))

    return bound(F.split(filled(text), NO_WORD), inner)


def join_form(word: Column | str) -> Column:
    """Equal for words that are equal up to A-Z; other case pairs may also meet here."""
    return F.lower(word)


def item_windows(items: DataFrame, width: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: window (array of words) and items (sorted ids as text)."""
    own = F.transform(raw_words(text_col), ascii_lower)
    per_item = items.select(F.col(id_col).cast("string").alias("item"), own.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    rows = per_item.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("window"))
    return rows.groupBy("window").agg(F.collect_set("item").alias("items"))


def doc_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per word: doc, mark, n_words, pos, word in join form."""
    key = docs.select(
        F.col(id_col).alias("doc"), text_key(F.col(text_col)).alias("mark"), raw_words(text_col).alias("w")
    )
    rows = key.select("doc", "mark", F.size("w").alias("n_words"), F.posexplode("w").alias("pos", "word"))
    return rows.withColumn("word", join_form("word"))


def anchors(windows: DataFrame, usage: DataFrame) -> DataFrame:
    """Per window its rarest word (``word``) and that word's first place (``at``)."""
    each = windows.select(
        "window", F.posexplode(F.transform("window", join_form)).alias("at", "word")
    ).join(usage, "word", "left")
    # Ties of equal rarity go to the smaller word, then to the earlier place.
    least = F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "word", "at")).alias("least")
    rare = each.groupBy("window").agg(least)
    return windows.join(rare, "window").select("window", "items", "least.word", "least.at", "least.uses")


def judged(
    docs: DataFrame,
    items: DataFrame,
    width: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> tuple[DataFrame, str]:
    """``docs`` with a struct of n_words, n_hit and items, and its name; see ``hits``."""
    hit, hit_doc, hit_mark, hit_cands = (free(docs, name) for name in ("hit", "hit_doc", "hit_mark", "hit_cands"))
    windows = cut_to_table(item_windows(items, width, item_id_col, item_text_col), "windows")
    vocabulary = windows.select(F.explode(F.transform("window", join_form)).alias("word")).distinct()
    vocabulary = cut_to_table(vocabulary, "vocabulary")
    size = vocabulary.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("word")).alias("b")).first()
    words = doc_words(docs, id_col, text_col)
    known = words.join(sized_broadcast(vocabulary, size["n"], 32 + (size["b"] or 0)), "word", "left_semi")
    usage = known.groupBy("word").agg(F.count(F.lit(1)).alias("uses"))

    # Windows whose rarest word no document has cannot occur.
    rare = cut_to_table(anchors(windows, usage).filter("uses > 0"), "anchors")
    held = rare.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.octet_length(F.array_join("window", " ")) + F.octet_length(F.array_join("items", " "))).alias("b"),
    ).first()
    rare = sized_broadcast(rare.drop("uses"), held["n"], 64 + (held["b"] or 0))
    room = (F.col("pos") >= F.col("at")) & (F.col("pos") - F.col("at") + F.size("window") <= F.col("n_words"))
    found = words.join(rare, "word").filter(room)
    candidate = F.struct((F.col("pos") - F.col("at")).alias("start"), F.col("window"), F.col("items"))
    per_doc = found.groupBy(F.col("doc").alias(hit_doc), F.col("mark").alias(hit_mark)).agg(
        F.collect_set(candidate).alias(hit_cands)
    )

    joined = docs.join(
        per_doc, same([F.col(id_col), text_key(F.col(text_col))], [F.col(hit_doc), F.col(hit_mark)]), "left"
    )
    none = F.array().cast("array<struct<start:int,window:array<string>,items:array<string>>>")
    verdict = bound(raw_words(text_col), lambda w: verified(w, F.coalesce(hit_cands, none)))
    out = joined.select("*", F.inline_outer(F.array(F.struct(verdict.alias(hit)))))
    return out.drop(hit_doc, hit_mark, hit_cands), hit


def hits(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items (long) and item_ids (ids as text, sorted).

    A word is hit if it lies in an occurrence of a window of an item; ``item_ids`` are the
    items with an occurring window. Words are compared with A-Z lower-cased. Null and empty
    texts have no words, items without words have no windows, equal items all count, repeated
    documents all get the same result. Input columns of the new names give way. An empty
    table of documents gives an empty one; without items nothing is hit.
    """
    out, hit = judged(docs, items, **options)
    return plus(
        out,
        n_words=F.col(f"{hit}.n_words").cast("long"),
        n_hit=F.col(f"{hit}.n_hit").cast("long"),
        n_items=F.size(f"{hit}.items").cast("long"),
        item_ids=F.col(f"{hit}.items"),
    ).drop(hit)


def verified(own: Column, candidates: Column) -> Column:
    """Struct of n_words, n_hit and items from a document's words and its candidates."""
    true = F.filter(
        candidates,
        lambda c: F.transform(F.slice(own, c["start"] + 1, F.size(c["window"])), ascii_lower) == c["window"],
    )

    def summed(real: Column) -> Column:
        spans = F.sort_array(
            F.transform(real, lambda c: F.struct(c["start"].alias("s"), (c["start"] + F.size(c["window"])).alias("e")))
        )
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))
        covered = F.aggregate(
            spans,
            zero,
            lambda seen, x: F.struct(
                F.greatest(seen["end"], x["e"]).alias("end"),
                (seen["sum"] + F.greatest(F.lit(0), x["e"] - F.greatest(seen["end"], x["s"]))).alias("sum"),
            ),
            lambda seen: seen["sum"],
        )
        ids = F.sort_array(F.array_distinct(F.flatten(F.transform(real, lambda c: c["items"]))))
        return F.struct(F.size(own).alias("n_words"), covered.alias("n_hit"), ids.alias("items"))

    return bound(true, summed)


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with their own columns."""
    out, hit = judged(docs, items, **options)
    return out.filter(F.col(f"{hit}.n_hit") == 0).drop(hit)
