"""Small tables with the awkward cases, and brute-force helpers."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE = "a line long enough to be looked at by the shared line rule"
SHARED = "  A Line That Five Documents Share, Éach In Its Own Way Of White Space\t"

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Columns whose names the operators use for their own results.
CLASHES = (
    "shard", "slot", "size", "rate", "copies", "target", "source_size", "n_words", "n_hit", "failure_bits", "n_lines",
    "kept_text", "host", "path", "rule", "verdict", "_hit", "_at", "_mix", "until", "part", "first", "fingerprint",
)


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int) -> str:
    vocabulary = ["the", "of", "Rain", "été", "stone", "river", "wind", "grass", "NIGHT", "door", "salt", "ash"]
    vocabulary += [f"w{rng.randrange(300)}" for _ in range(40)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def rows(seed: int = 0) -> list[tuple]:
    rng = random.Random(seed)
    out = []

    def add(doc_id, text, source="s1", lang="en"):
        out.append((doc_id, text, lang, source, None if text is None else len(text)))

    for i in range(30):
        add(i, "\n".join(prose(rng, rng.randrange(5, 60)) for _ in range(rng.randrange(1, 5))), f"s{i % 4}")
    for i in range(30, 38):  # share a line, in several writings, some of them twice
        add(i, f"{prose(rng, 30)}\n{SHARED}\n{SHARED.upper() if i % 2 else SHARED}\n\n end")
    for i in range(40, 44):  # a line of four documents only
        add(i, f"{LINE}\n{prose(rng, 12)}")
    base = prose(rng, 400)
    for i in range(50, 56):
        add(i, base + (f" tail{i}" if i > 52 else ""), "s2")  # exact and near copies
    add(60, None)
    add(61, "")
    add(62, " \n\t ")
    add(63, "\x0b\x1c one\x0ctwo \x85 ")
    add(64, "word " * 30, None)
    add(65, "# * $ % & | < > " * 10, None)
    add(66, "x" * 500 + " y", "")
    add(67, ("to be or not to be that is the question " * 40).strip(), "s3")
    add(68, prose(rng, 30_000), "s9")  # very long
    add(None, "no id " + prose(rng, 25), None)
    add(None, None, None)
    add(-5, "<|im_start|> \\ \\\\ [INST]", "s0")
    for _ in range(3):  # repeated rows
        add(70, f"{prose(random.Random(9), 30)}\n{SHARED}", "s1")
    add(71, None, "s1", None)
    return out


def table(spark, data, schema=DOCS, clashes=False):
    df = spark.createDataFrame(data, schema)
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({name: F.lit(f"own {name}") for name in CLASHES})
    return df.repartition(5)


def collected(df, *names) -> list[tuple]:
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
