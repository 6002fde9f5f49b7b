"""Sharding, mixing, quality rules and line dedup against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from cases import CLASHES, DOCS, collected, lower, rows, table, words
from pyspark.sql import functions as F

from legwork.llm import line_dedup, mixing, quality, queries, sharding

OWN = [f.name for f in DOCS.fields]


@pytest.mark.parametrize("shards,cell_rows", [(7, 100_000), (3, 5), (200, 1)])
def test_shards_hold_every_row_once(spark, shards, cell_rows):
    data = rows()
    out = sharding.shard_rows(table(spark, data), shards, seed=3, cell_rows=cell_rows).collect()
    assert Counter(tuple(r[n] for n in OWN) for r in out) == Counter(data)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_of_an_empty_table_and_clashing_names(spark):
    empty = sharding.shard_rows(table(spark, []), 4)
    assert empty.columns == [*OWN, "shard", "slot"] and empty.count() == 0
    data = rows()
    out = sharding.shard_rows(table(spark, data, clashes=True), 4)
    assert out.count() == len(data)
    assert sorted(out.columns) == sorted([*OWN, *CLASHES])
    assert out.filter("size = 'own size'").count() == len(data)
    assert dict(out.dtypes)["slot"] == "bigint"


def test_shard_query_moves_whole_documents(spark, tmp_path, monkeypatch):
    table(spark, rows()).write.parquet(str(tmp_path / "documents.parquet"))
    deal = sharding.shard_rows

    def damaged(df, *args, **named):
        assert df.columns == OWN
        return deal(df, *args, **named).withColumn("text", F.lit("lost"))

    monkeypatch.setattr(sharding, "shard_rows", damaged)
    out = queries.op1_shards(spark, str(tmp_path)).collect()
    assert len(out) == len(rows()) and {(r["size"], r["text_crc32"]) for r in out} == {(20, zlib.crc32(b"lost"))}


def test_shard_of_a_row_is_uniform(spark):
    hits = np.zeros((4, 5))
    for seed in range(30):
        df = spark.range(0, 20, 1, 4)
        for r in sharding.shard_rows(df, 5, seed=seed).collect():
            hits[r["id"] // 5, r["shard"]] += 1
    assert abs(hits / 150 - 0.2).max() < 0.12


def test_communication_matrix_has_its_margins():
    rng = np.random.default_rng(0)
    sizes, room = [5, 0, 17, 8], [10, 10, 10]
    for _ in range(50):
        drawn = sharding.split_counts(rng, sizes, room)
        assert drawn.sum(axis=1).tolist() == sizes and drawn.sum(axis=0).tolist() == room
    draws = np.array([sharding.split_counts(rng, sizes, room)[2, 0] for _ in range(2000)])
    assert abs(draws.mean() - 17 / 3) < 0.15
    assert abs(draws.var() - 17 * (1 / 3) * (2 / 3) * (13 / 29)) < 0.3


def test_hypergeometric_beyond_the_library_limit():
    rng = np.random.default_rng(1)
    good, bad, draws = 3 * 10**9, 7 * 10**9, 10**6
    x = np.array([sharding.hypergeometric(rng, good, bad, draws) for _ in range(300)], float)
    deviation = (draws * 0.3 * 0.7) ** 0.5
    assert abs(x.mean() - 0.3 * draws) < 5 * deviation / 300**0.5
    assert 0.8 < x.std() / deviation < 1.2
    assert sharding.hypergeometric(rng, 10**9, 0, 5) == 5


def filled_targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """Excess shared again and again, as it is said."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def test_mix_targets_and_copies(spark):
    data = rows()
    sizes = Counter()
    for _, text, _, source, _ in data:
        sizes[source] += len(words(text))
    target = filled_targets(sizes)
    first = mixing.mix(table(spark, data)).collect()
    again = mixing.mix(table(spark, data)).collect()
    key = lambda r: (repr(r["doc_id"]), repr(r["text"]))
    assert sorted((key(r), r["copies"]) for r in first) == sorted((key(r), r["copies"]) for r in again)
    assert len(first) == len(data)
    for r in first:
        assert r["size"] == len(words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        rate = target[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert int(rate + 1e-9) <= r["copies"] <= int(rate - 1e-9) + 1 or r["copies"] == round(rate)
        assert r["copies"] <= 2


def test_mix_comes_near_its_targets(spark):
    data = [(i, f"a b c {i}", None, f"s{i % 3 if i % 2 else 0}", None) for i in range(3000)]
    out = mixing.mix(table(spark, data))
    taken = out.selectExpr("source", "target", "size * copies t").groupBy("source", "target").sum("t").collect()
    assert all(abs(r["sum(t)"] / r["target"] - 1) < 0.1 for r in taken)
    emitted = mixing.emit_copies(out, OWN)
    assert emitted.count() == out.groupBy().sum("copies").first()[0]


def test_mix_of_repeated_rows_comes_near_its_target(spark):
    """Equal rows draw each for itself: the target of their source is met within 2 %."""
    data = [(7, "a b c", None, "same", None)] * 6000 + [(i, "a b c d e", None, "other", None) for i in range(100, 1900)]
    df = table(spark, data)
    first = mixing.mix(df).groupBy("source", "doc_id", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("t")).collect()
    again = mixing.mix(df).groupBy("source", "doc_id", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("t")).collect()
    assert sorted(first) == sorted(again)
    (target, taken), = [(r["target"], r["t"]) for r in first if r["source"] == "same"]
    assert 18000 < target < 36000 and abs(taken / target - 1) < 0.02
    assert mixing.mixed_documents(df).count() * 3 > target


def test_line_dedup_keeps_columns_of_any_name(spark):
    df = table(spark, rows()).withColumns({n: F.lit("own") for n in ("_keep_id", "_keep_mark", "_keep_bits", "_u_x")})
    out = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df))
    assert out.filter("_keep_id = 'own' AND _keep_bits = 'own' AND _u_x = 'own'").count() == len(rows())


def test_mix_of_awkward_tables(spark):
    assert mixing.mix(table(spark, [])).count() == 0
    only_empty = mixing.mix(table(spark, [(1, None, None, "a", None), (2, "", None, None, None)])).collect()
    assert [(r["size"], r["target"], r["copies"]) for r in only_empty] == [(0, 0.0, 0)] * 2
    clash = mixing.mix(table(spark, rows(), clashes=True))
    assert clash.count() == len(rows()) and dict(clash.dtypes)["size"] == "bigint"
    assert clash.filter("shard = 'own shard'").count() == len(rows())


def measure(text: str | None) -> dict:
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if words(x)]
    return dict(
        n_words=len(w), word_chars=sum(map(len, w)), n_symbols=sum(text.count(c) for c in "#*$%&|<>"),
        n_text_lines=len(lines), n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered),
    )


def test_ledger_measures_like_brute_force(spark):
    data = rows()
    out = quality.ledger(table(spark, data)).collect()
    assert len(out) == len(data)
    for r in out:
        want = measure(r["text"])
        assert {k: r[k] for k in want} == want
        assert bool(r["failure_bits"] & quality.BASE.mask()) == (
            want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        )
    assert quality.ledger(table(spark, [])).count() == 0
    clash = quality.ledger(table(spark, data, clashes=True))
    assert dict(clash.dtypes)["n_words"] == "bigint" and clash.filter("rate = 'own rate'").count() == len(data)


def test_ablations_agree_with_the_bits(spark):
    out = quality.ledger(table(spark, rows()))
    bits = [r["failure_bits"] for r in out.collect()]
    for r in quality.ablations(out).collect():
        policy = next(p for p in quality.POLICIES if p.name == r["policy"])
        bit = next(1 << i for i, rule in enumerate(quality.RULES) if rule.name == r["rule"])
        mask = policy.mask()
        assert r["failed"] == sum(bool(b & bit) for b in bits)
        assert r["failed_only_this"] == sum((b & mask) == bit for b in bits)
        assert r["rejected_without"] == sum(bool(b & mask & ~bit) for b in bits)


def kept_lines(data, least=40, need=5) -> dict:
    strip = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for doc, text, *_ in data:
        for line in (text or "").split("\n"):
            holders[lower(line.strip(strip))].add(doc)
    rank = lambda d: (d is not None, d or 0)
    out = Counter()
    for doc, text, *_ in data:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            key = lower(line.strip(strip))
            held = holders[key]
            if len(key) < least or len(held) < need or doc == max(held, key=rank):
                keep.append(line)
        kept = hashlib.sha256("\n".join(keep).encode()).hexdigest()
        out[(doc, len(lines), len(lines) - len(keep), kept)] += 1
    return out


def test_line_dedup_like_brute_force(spark):
    data = rows()
    docs = table(spark, data, clashes=True)
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    got = Counter(
        (r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept_text"].encode()).hexdigest())
        for r in kept.collect()
    )
    want = kept_lines(data)
    assert got == want and any(n for _, _, n, _ in want)
    empty = table(spark, [])
    assert line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0


class Task:
    part = 0

    @classmethod
    def get(cls):
        return cls

    @classmethod
    def partitionId(cls):  # noqa: N802
        return cls.part


@pytest.mark.parametrize("seed", range(12))
def test_runs_across_partitions_and_batches(monkeypatch, seed):
    """Every way to cut the sorted rows gives the brute-force decisions."""
    monkeypatch.setattr(line_dedup, "TaskContext", Task)
    monkeypatch.setattr(line_dedup, "HOLD", 6 if seed % 2 else 1000)
    rng = random.Random(seed)
    lines = {(rng.randrange(4), rng.randrange(rng.choice([2, 9])), rng.randrange(2), rng.randrange(3)) for _ in range(60)}
    lines = sorted(lines, key=lambda x: (x[0], -x[1], x[2], x[3]))
    need = 4
    frame = pd.DataFrame([(h, 0, d, m, p, 3) for h, d, m, p in lines], columns=["h1", "h2", "doc", "mark", "pos", "n_lines"])
    cuts = sorted(rng.sample(range(len(lines)), 3))
    outs = []
    for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(lines)], strict=True)):
        Task.part = part
        inner = sorted(rng.sample(range(a, b + 1), min(4, b - a)))
        batches = [frame.iloc[x:y].reset_index(drop=True) for x, y in zip([a, *inner], [*inner, b], strict=True)]
        outs += list(line_dedup.stream_runs(need)(iter(batches)))
    out = pd.concat(outs, ignore_index=True)
    row = lambda r: (r.h1, r.doc, r.mark, r.pos)
    dropped = {row(r) for r in out[out.kind == line_dedup.DROP].itertuples()}
    docs, largest, last = Counter(), {}, {}
    for r in out[out.kind == line_dedup.RUN].sort_values(["h1", "part"]).itertuples():
        docs[r.h1] += r.docs - (last.get(r.h1) == r.doc)
        largest[r.h1] = max(r.doc, largest.get(r.h1, -1))
        last[r.h1] = r.last
    for r in out[out.kind == line_dedup.OPEN].itertuples():
        if docs[r.h1] >= need and r.doc != largest[r.h1]:
            dropped.add(row(r))
    held = defaultdict(set)
    for h, d, _, _ in lines:
        held[h].add(d)
    assert dropped == {x for x in lines if len(held[x[0]]) >= need and x[1] != max(held[x[0]])}
