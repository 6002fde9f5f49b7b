"""The pipeline's stages against what their brute-force versions keep."""

import random
from collections import Counter

import corpus_pipeline
from cases import CLASHES, DOCS, prose, table
from pyspark.sql import functions as F
from test_rows import measure
from test_texts import alike_groups, brute_hits

from legwork.llm import quality
from legwork.llm.queries import QUERIES, SQL


def corpus():
    rng = random.Random(11)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    base = [fresh(80) for _ in range(40)]
    items = [(i, fresh(20)) for i in range(3)]
    data = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(base)]
    data += [(100 + i, base[i], "en", "s1", 1) for i in range(8)]  # exact copies
    data += [(200 + i, f"{base[20 + i]} {items[i % 3][1]} {fresh(5)}", "en", "s2", 1) for i in range(6)]  # leaks
    data += [(300, "too short", "en", "s0", 1), (301, None, "en", None, None), (302, "# " * 60, "en", "s0", 1)]
    data += [(303, prose(rng, 9) + " " + "again and again it says the same thing " * 30, "en", "s0", 1)]
    data += [(0, base[0], "en", "s0", len(base[0]))]  # a repeated row
    data += [(400 + i, f"{base[10 + i]} {fresh(6)}", "en", "s1", 1) for i in range(8)]  # near copies, 0.93 alike
    data += [(450 + i, f"{base[30 + i]} {fresh(60)}", "en", "s1", 1) for i in range(4)]  # 0.56 alike
    return data, items


def test_stages_like_brute_force(spark, tmp_path):
    data, items = corpus()
    sf = str(tmp_path)
    table(spark, data).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    def rows(df):
        return Counter((r["doc_id"], r["text"]) for r in df.collect())

    one = stages["quality_rules"](spark, docs, sf)
    names = ("few_words", "repeated_words", "many_symbols", "short_mean_word", "long_mean_word", "repeated_lines")
    assert tuple(r.name for r in quality.RULES) == names

    def good(text):
        m = measure(text)
        return not any(eval(rule.fails, {}, m) for rule in quality.RULES)  # noqa: S307

    kept = [r for r in data if good(r[1])]
    assert rows(one) == Counter((r[0], r[1]) for r in kept)
    assert {300, 301, 302, 303}.isdisjoint(r[0] for r in kept) and len(kept) == len(data) - 4

    two = stages["near_dedup"](spark, one, sf)
    group = alike_groups({r[1] for r in kept}, 5, 0.8)
    best = {}
    for doc, text, *_ in kept:
        g = group[text]
        best[g] = min(best.get(g, (doc, text)), (doc, text))
    assert rows(two) == Counter(best.values())
    ids = {doc for doc, _ in best.values()}
    assert not any(400 <= d < 450 for d in ids) and {450, 451, 452, 453} <= ids

    three = stages["decontamination"](spark, two, sf)
    clean = {h[0] for h in brute_hits(list(best.values()), items) if not h[2]}
    assert rows(three) == Counter(x for x in best.values() if x[0] in clean)
    assert not any(200 <= d < 300 for d in clean) and clean

    four = stages["source_mix"](spark, three, sf)
    assert four.columns == docs.columns and set(rows(four)) <= set(rows(three))
    assert max(rows(four).values()) <= 2

    whole = corpus_pipeline.run(spark, sf)
    assert rows(whole) == rows(four)
    sizes = Counter(r["shard"] for r in whole.collect())
    assert whole.columns == [*docs.columns, "shard", "slot"]
    assert max(sizes.values()) - min(sizes.values() if len(sizes) == corpus_pipeline.SHARDS else [0]) <= 1


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Internal and result names as columns of the documents, and a very long text."""
    data, items = corpus()
    data.append((500, " ".join(f"{i:05d}w" for i in range(60_000)), "en", "s1", 1))
    names = set(CLASHES) | {
        "n_words", "copies", "size", "rate", "target", "source_size", "failure_bits", "_copy", "_m_words", "_m_lines",
        "_m_symbols", "_mix_source", "_mix_size", "_mix_target", "_mix_rate", "_mix_number", "_hit_doc", "_hit_mark",
        "_hit_cands", "_own_0", "_own_1", "_keep_id", "n_symbols", "word_chars", "mark", "doc", "id", "again",
    }
    names -= {"shard", "slot"}
    sf = str(tmp_path)
    own = {n: F.concat(F.lit(f"own {n} "), F.col("doc_id").cast("string")) for n in sorted(names)}
    df = spark.createDataFrame(data, DOCS).withColumns(own).repartition(5)
    df.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        wrong = F.lit(False)
        for n in names:
            wrong = wrong | ~F.col(f"`{n}`").eqNullSafe(F.concat(F.lit(f"own {n} "), F.col("doc_id").cast("string")))
        assert out.filter(wrong).count() == 0 and out.filter("doc_id = 500").count() >= 1, name


def test_empty_documents(spark, tmp_path):
    sf = str(tmp_path)
    table(spark, []).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
    assert set(SQL) <= set(QUERIES)
