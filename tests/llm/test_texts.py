"""URL filter, chat trees, SimHash, LM scores, decontamination and token counts."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import tiktoken
import xxhash
from cases import collected, lower, prose, rows, table, words
from pyspark.sql import functions as F

from legwork.llm import chat_tree, decontaminate, lm_score, simhash, token_counts, url_filter

SF = "/root/testdata/sf0.01"

URLS = [
    (1, "https://A.Example.ORG/es/x?y#z"), (2, "http://example.org/en/12"), (3, "http://b.example.org/en/2"),
    (4, "ftp://x.com/fr/a"), (5, "http://x.com/de/"), (6, "http://x.com/de"), (7, "http://notexample.org"),
    (8, "http://fooorg/"), (9, "http://ORG/"), (10, None), (11, ""), (12, "no scheme/x"), (13, "a://b://c/d"),
    (14, "http://h?q=/x"), (15, "http://h#f"), (16, "http://x.net/" + "p/" * 4000), (5, "http://x.com/de/"),
    (17, "http://Éx.com/fr/é"), (18, "http://u\nv.org/\n"),
]


def split_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def best_rule(host, path):
    fits = [
        r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.host + r.path)) if fits else None


def test_url_rules_like_brute_force(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("own")).repartition(3)
    out = url_filter.judge_urls(df).collect()
    assert len(out) == len(URLS)
    for r in out:
        host, path = split_url(r["url"])
        rule = best_rule(host, path)
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule.host + rule.path if rule else None)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")
    more = df.withColumns({"_u_host": F.lit("own"), "_u_score": F.lit("own")})
    assert url_filter.judge_urls(more).filter("_u_host = 'own' AND _u_score = 'own' AND host <> 'own'").count() == len(URLS)
    empty = url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"))
    assert empty.count() == 0
    lone = url_filter.judge_urls(spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")).first()
    assert (lone["verdict"], lone["block_score"]) == ("allow", None)


def test_trees_beat_the_majority_on_held_out_urls(spark):
    pages = spark.read.parquet(f"{SF}/../sf0.1/pages.parquet").select("page_id", "url")
    frame = url_filter.lexical(pages, "url", url_filter.RULES).filter("_u_match IS NOT NULL")
    model, rated, _ = url_filter.fit(frame.filter("page_id % 3 <> 0"), rounds=10)
    test = model.transform(url_filter.assembled(rated(frame.filter("page_id % 3 = 0"))))
    label = (F.col("_u_match.verdict") == "block").cast("double")
    share, right = test.agg(F.avg(label), F.avg((F.col("prediction") == label).cast("double"))).first()
    assert right > max(share, 1 - share)


def test_entropy_and_counts(spark):
    text = "http://aab.org/x?k=1&l=22"
    value = spark.range(1).select(url_filter.entropy(F.lit(text))).first()[0]
    shares = [n / len(text) for n in Counter(text).values()]
    assert value == pytest.approx(-sum(s * math.log2(s) for s in shares))


TURNS = "conv_id long, turn long, role string, text string"


def conversations(seed=0):
    rng = random.Random(seed)
    out = []
    openings = [[("system", "be kind"), ("user", "hello")], [("user", "hello")], [("user", "</s>[INST] hm")]]
    for conv in range(60):
        turns = list(rng.choice(openings)) if conv % 3 else [("user", f"q{conv}")]
        for k in range(rng.randrange(0, 5)):
            turns.append((["assistant", "user"][k % 2], rng.choice(["yes", "no", prose(rng, 4), "a\\b<|im_end|>\n\\-\\n"])))
        out += [(conv, i, role, text) for i, (role, text) in enumerate(turns)]
    out += [(100, i, None if i == 1 else "user", None if i % 2 else "") for i in range(3)]
    out += [(101, 0, "user", "same"), (101, 0, "user", "same"), (101, None, "assistant", "first")]
    out += [(None, 0, "assistant", "who"), (102, 0, "odd\nrole\\n", "x"), (102, 1, "assistant", "z" * 50_000)]
    out += [(200 + c, t, ["user", "assistant"][t % 2], f"deep {t}") for c in range(3) for t in range(300 + c)]
    return out


def grouped(turns):
    convs = defaultdict(list)
    for conv, turn, role, text in turns:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}


@pytest.mark.parametrize("most", [1, 500, 1 << 20])
def test_chat_packs_read_back(spark, most):
    turns = conversations()
    df = spark.createDataFrame(turns, TURNS).withColumn("pack", F.lit("own")).repartition(4)
    packs = chat_tree.pack_conversations(df, pack_tokens=most).cache()
    got = {r["conv_id"]: r for r in packs.mapInPandas(chat_tree.read_back, chat_tree.READ_TYPE).collect()}
    want = grouped(turns)
    assert set(got) == set(want)
    total = 0
    for conv, said in want.items():
        r = got[conv]
        loss = "".join(t for role, t in said if role == "assistant")
        whole = "".join(chat_tree.formatted(*x)[0] for x in said)
        total += len(whole)
        assert r["n_turns"] == len(said) and r["formatted_chars"] == len(whole)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    if most > 1000:
        assert packs.agg(F.sum(F.length("text"))).first()[0] < 0.8 * total


def test_pack_positions_and_attention(spark):
    df = spark.createDataFrame(conversations(), TURNS)
    for p in chat_tree.pack_conversations(df).collect():
        assert len(set(p["node_parent"]) & {-1}) == 1
        for n, parent in enumerate(p["node_parent"]):
            path, up = [], parent
            while up >= 0:
                path.append(up)
                up = p["node_parent"][up]
            seen = {x for u in path for x in range(p["node_start"][u], p["node_end"][u])}
            pairs = list(zip(p["node_attends"][n][::2], p["node_attends"][n][1::2], strict=True))
            assert {x for a, b in pairs for x in range(a, b)} == seen
            assert p["node_position"][n] == len(seen)
            assert p["node_start"][n] == (p["node_end"][n - 1] if n else 0)
        children = Counter((q, p["text"][p["node_start"][i] : p["node_end"][i]]) for i, q in enumerate(p["node_parent"]))
        assert max(children.values()) == 1  # shared turns stand once


def test_packs_in_tokens_of_an_encoder(spark):
    df = spark.createDataFrame(conversations(), TURNS)
    packs = chat_tree.pack_conversations(df, encode=lambda s: list(s.encode()))
    for p in packs.collect():
        assert bytes(p["token_ids"]) == p["text"].encode() and p["node_end"][-1] == len(p["token_ids"])
    assert chat_tree.pack_conversations(spark.createDataFrame([], TURNS)).count() == 0


def told(turns):
    """Per conversation what the digests of its turns must be."""
    out = {}
    for conv, said in grouped(turns).items():
        loss = "".join(t for role, t in said if role == "assistant")
        out[conv] = (
            len(said), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat_tree.formatted(*x)[0]) for x in said),
        )
    return out


DIGESTS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@pytest.mark.parametrize("part_turns, part_chars", [(8, 1 << 20), (1 << 20, 700), (1, 1)])
def test_chat_parts_of_long_conversations(spark, monkeypatch, part_turns, part_chars):
    monkeypatch.setattr(chat_tree, "PART_TURNS", part_turns)
    monkeypatch.setattr(chat_tree, "PART_CHARS", part_chars)
    rng = random.Random(5)
    turns = conversations()
    turns += [(None, t % 40, ["user", "assistant"][t % 2], "ok") for t in range(400)]  # rows without id, many equal
    turns += [(None, 1 + t % 7, "user", prose(rng, 5)) for t in range(300)]
    turns = list(dict.fromkeys(turns)) + [(None, 3, "assistant", "ok")] * 50
    df = spark.createDataFrame(turns, TURNS).withColumn("part", F.lit("own")).repartition(5)
    packs = chat_tree.pack_conversations(df, pack_tokens=3000).cache()
    got = {r["conv_id"]: tuple(r[c] for c in DIGESTS) for r in chat_tree.digests(packs).collect()}
    assert got == told(turns)
    if part_turns == 8:  # three conversations share 300 turns: their parts share nodes, too
        whole = sum(len(chat_tree.formatted(a, b)[0]) for c, s in grouped(turns).items() if c in (200, 201, 202) for a, b in s)
        deep = packs.filter("exists(conv_id, c -> c in (200, 201, 202))")
        seen = sum(p["text"].count("deep ") for p in deep.collect())
        assert seen < 500 and whole > 0
    bases = {}
    for p in packs.collect():
        for conv, part, parts, node in zip(p["conv_id"], p["conv_part"], p["conv_parts"], p["conv_node"], strict=True):
            root = node
            while p["node_parent"][root] >= 0:
                root = p["node_parent"][root]
            end = p["node_position"][node] + p["node_end"][node] - p["node_start"][node]
            bases[conv, part] = (p["node_position"][root], end, parts)
    for (conv, part), (begin, end, parts) in bases.items():  # positions run on from part to part
        assert begin == (bases[conv, part - 1][1] if (conv, part - 1) in bases else 0)
        assert end == got[conv][4] or any((conv, q) in bases for q in range(part + 1, part + 2000))


def test_equal_conversations_fill_packs(spark):
    turns = [(c, t, "user", "same") for c in range(300) for t in range(2)]
    packs = chat_tree.pack_conversations(spark.createDataFrame(turns, TURNS), pack_tokens=150).cache()
    assert max(len(p["conv_id"]) for p in packs.collect()) < 150
    got = {r["conv_id"]: tuple(r[c] for c in DIGESTS) for r in chat_tree.digests(packs).collect()}
    assert got == told(turns)


def test_packs_of_a_vocabulary(spark):
    with open(token_counts.DEFAULT_VOCABULARY, "rb") as ranks:
        encode = chat_tree.Vocabulary(ranks.read(), token_counts.PATTERN)
    turns = conversations()
    packs = chat_tree.pack_conversations(spark.createDataFrame(turns, TURNS), encode=encode).cache()
    got = {r["conv_id"]: tuple(r[c] for c in DIGESTS) for r in chat_tree.digests(packs).collect()}
    assert got == told(turns)
    for p in packs.collect():
        ends = [*p["node_char"][1:], len(p["text"])]
        for n, (a, b) in enumerate(zip(p["node_start"], p["node_end"], strict=True)):
            assert p["token_ids"][a:b] == encode(p["text"][p["node_char"][n] : ends[n]])


@pytest.mark.parametrize("text", ["", "\\", "\\-", "\\n", "[\\-INST]", "<s></s><<s>", "[INST][[/INST]", "<<SYS>>\n<</SYS>>"])
def test_escape_is_reversible(text):
    safe = chat_tree.escaped(text)
    assert chat_tree.unescaped(safe) == text
    assert not any(c in safe for c in chat_tree.CONTROLS)


def own_print(text, width=4):
    w = words(lower(text or ""))
    grams = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints: set, bits: int) -> dict:
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= bits:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in prints}


def test_simhash_like_brute_force(spark):
    data = [r for r in rows() if r[0] != 68]
    out = simhash.near_duplicates(table(spark, data, clashes=True)).select("*", simhash.hex_print("fingerprint").alias("x"))
    group = classes({own_print(t) for _, t, *_ in data}, 4)
    least = defaultdict(list)
    for doc, text, *_ in data:
        if doc is not None:
            least[group[own_print(text)]].append(doc)
    want = sorted(
        ((d, f"{own_print(t):016x}", min(least[group[own_print(t)]], default=None)) for d, t, *_ in data), key=repr
    )
    assert collected(out, "doc_id", "x", "component_id") == want
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def test_one_row_per_group(spark):
    data = [r for r in rows() if r[0] != 68]
    kept = simhash.one_per_group(table(spark, data))
    ids = [r["doc_id"] for r in kept.collect()]
    groups = simhash.near_duplicates(table(spark, data)).select("component_print").distinct().count()
    assert kept.columns == [f for f in ("doc_id", "text", "lang", "source", "n_chars")]
    assert len(ids) == groups and ids.count(70) == 1 and ids.count(50) == 1 and 51 not in ids
    only = simhash.one_per_group(table(spark, [(None, "a b c d e", None, None, 1)] * 3 + [(None, None, None, None, 0)]))
    assert only.count() == 2


@pytest.mark.parametrize("longest", [1 << 16, 20])
def test_links_keep_components(spark, longest):
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([2, 5, 60])):
            p = centre
            for b in rng.sample(range(64), rng.randrange(0, 7)):
                p ^= 1 << b
            prints.add(p)
    prints |= {0, 1, 0x0101010101000000, (1 << 64) - 1}
    as_long = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(as_long(p),) for p in prints], "fp long")
    links = simhash.fingerprint_links(df, 4, longest).collect()
    unsigned = lambda x: x & (1 << 64) - 1
    assert all((unsigned(r["a"]) ^ unsigned(r["b"])).bit_count() <= 4 and r["a"] < r["b"] for r in links)
    want = classes(prints, 4)
    parent = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for r in links:
            a, b = unsigned(r["a"]), unsigned(r["b"])
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
    assert parent == want


def shingles(text, width):
    w = words(lower(text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def alike_groups(texts: set, width: int, least: float) -> dict:
    """Each text's group: chains of texts whose shingle sets are alike (Jaccard)."""
    root = {t: t for t in texts}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t

    sets = {t: shingles(t, width) for t in texts}
    for a, b in combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both >= least * (len(sets[a]) + len(sets[b]) - both):
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {t: top(t) for t in texts}


@pytest.mark.parametrize("longest", [1 << 14, 8])
def test_similar_texts_like_brute_force(spark, longest, monkeypatch):
    rng = random.Random(3)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = {None, "", " \t", "one", "One", "two words", "a b c d e", "A b C d e"}
    for size, copies in ((100, 40), (300, 6), (60, 3), (9000, 3)):
        base = fresh(size)
        texts.add(" ".join(base))
        for _ in range(copies):  # at least 0.88 alike, and chains of them
            near = list(base)
            near[rng.randrange(size)] = "other"
            texts.add(" ".join(near))
        texts.add(" ".join(base + fresh(size)))  # half alike
    step = fresh(400)
    for _ in range(12):  # each 0.9 alike to the one before
        step = step[20:] + fresh(20)
        texts.add(" ".join(step))
    data = [(i, t, "en", "s", 1) for i, t in enumerate(sorted(texts, key=repr))]
    monkeypatch.setattr(simhash.sketch_links, "__defaults__", (longest,))
    out = simhash.near_duplicates(table(spark, data, clashes=True), width=5, similarity=0.8)
    group = alike_groups({t or "" for t in texts}, 5, 0.8)
    group = {t: group[t] if words(t) else "" for t in texts}
    least = {}
    for doc, text, *_ in data:
        least[group[text]] = min(doc, least.get(group[text], doc))
    assert collected(out, "doc_id", "component_id") == sorted(((d, least[group[t]]) for d, t, *_ in data), key=repr)


def test_links_near_the_limit_are_verified(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts = set()
    for _ in range(60):  # pairs from 0.75 to 0.85 alike, a fresh tail of each length
        base = fresh(404)
        cut = rng.randrange(33, 58)
        texts |= {" ".join(base), " ".join(base[:-cut] + fresh(cut))}
    frame = fresh(300)
    for _ in range(60):  # one family, mutually about 0.75 alike
        texts.add(" ".join(frame + fresh(50)))
    texts |= {"x y " * 30 + "z", "x y " * 31 + "z", " ".join(["q"] * 9), " ".join(["q"] * 12)}
    data = [(i, t, "en", "s", 1) for i, t in enumerate(sorted(texts))]
    out = simhash.near_duplicates(table(spark, data), width=5, similarity=0.8)
    group = alike_groups(texts, 5, 0.8)
    least = {}
    for doc, text, *_ in data:
        least[group[text]] = min(doc, least.get(group[text], doc))
    assert 0 < len(texts) - len(set(group.values())) < 62
    assert collected(out, "doc_id", "component_id") == sorted(((d, least[group[t]]) for d, t, *_ in data), key=repr)


def test_set_blocks_lose_no_link(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**9)}" for _ in range(200)]
    texts = [" ".join(base[:i] + [f"v{i}"] + base[i + 1 :]) for i in range(0, 200, 5)]
    monkeypatch.setattr(simhash, "SET_BLOCK", 4096)
    out = simhash.near_duplicates(table(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)]), width=5, similarity=0.8)
    assert {r["component_id"] for r in out.collect()} == {0}


def held_out():
    return F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))


def test_lm_base_and_both_ways_of_probing(spark):
    data = rows()
    df = table(spark, data, clashes=True)
    near = lm_score.lm_scores(df, held_out()).collect()
    far = lm_score.lm_scores(df, held_out(), broadcast_model=0).collect()
    key = lambda r: (repr(r["doc_id"]), r["n_tokens"], r["base_score"])
    assert len(near) == len(far) == len(data)
    for a, b in zip(sorted(near, key=key), sorted(far, key=key), strict=True):
        assert (a["doc_id"], a["n_tokens"], a["n_known"]) == (b["doc_id"], b["n_tokens"], b["n_known"])
        assert a["score"] == pytest.approx(b["score"]) and a["base_score"] == pytest.approx(b["base_score"])
    tokens = lambda t: [*words(lower(t or "")), None]
    counts = Counter(t for d, text, *_ in data if d is None or d % 3 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (repr(d), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)),
         round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens(t)), 6))
        for d, t, *_ in data
    )
    got = sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in near)
    assert got == want and {r["train_tokens"] for r in near} == {n}
    assert all(r["score"] < 0 for r in near)


def test_lm_ngrams_travel_packed(spark, monkeypatch):
    """A row per n-gram, and per chunk and block, grew with the square of the texts."""
    rng = random.Random(5)
    data = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(90))), None, None, 0) for i in range(120)]
    df = table(spark, data).coalesce(2)
    counted = df.select("text").mapInArrow(lm_score.count_batches(64), "part int, kind byte, hashes binary, counts binary")
    assert counted.count() <= df.rdd.getNumPartitions() * (2 * 64 // lm_score.GROUP_BLOCKS + 1)
    one = lm_score.lm_scores(df, held_out()).orderBy("doc_id").collect()
    for name, value in (("BLOCK_BYTES", 600), ("GROUP_BLOCKS", 3), ("ASK_CHUNK", 500), ("PROBE_CHUNK", 200)):
        monkeypatch.setattr(lm_score, name, value)
    near = lm_score.lm_scores(df, held_out()).orderBy("doc_id").collect()
    far = lm_score.lm_scores(df, held_out(), broadcast_model=0).orderBy("doc_id").collect()
    for a, b, c in zip(one, near, far, strict=True):
        assert (a["doc_id"], a["n_tokens"], a["n_known"]) == (b["doc_id"], b["n_tokens"], b["n_known"]) == (c["doc_id"], c["n_tokens"], c["n_known"])
        assert a["base_score"] == pytest.approx(b["base_score"]) and b["base_score"] == pytest.approx(c["base_score"])
        assert b["score"] == pytest.approx(c["score"])  # filters of blocks of another size err elsewhere


def test_lm_prefers_its_own_language(spark):
    rng = random.Random(2)
    data = [(3 * i + 1, " ".join(["red", "green", "blue", "black"][k % 4] for k in range(40)), None, None, 0) for i in range(50)]
    data += [(3, "red green blue black red green blue black", None, None, 0), (6, "black blue green red black blue green red", None, None, 0)]
    data += [(9, " ".join(f"q{rng.random()}" for _ in range(8)), None, None, 0)]
    out = {r["doc_id"]: r["score"] for r in lm_score.lm_scores(table(spark, data), held_out()).collect()}
    assert out[3] > out[6] > out[9]
    alone = lm_score.lm_scores(table(spark, [(3, "a b", None, None, 0)]), held_out()).first()
    assert (alone["train_tokens"], alone["n_known"], alone["base_score"]) == (0, 0, 0.0)
    assert lm_score.lm_scores(table(spark, []), held_out()).count() == 0


def test_filter_levels_are_close_to_the_counts():
    rng = np.random.default_rng(0)
    hashes = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    counts = rng.geometric(0.3, len(hashes)).astype(np.int64)
    import pandas as pd

    frame = pd.DataFrame({"kind": lm_score.BIGRAM, "h": hashes.view(np.int64), "n": counts})
    block = lm_score.build_block((0,), frame).iloc[0]
    model = lm_score.joined_blocks([(0, block["bits"], block["hashes"], block["counts"])], 1)
    got = lm_score.probed(model, hashes)
    assert (got >= lm_score.levels_of(counts)).all()  # a filter never forgets
    assert (got > lm_score.levels_of(counts)).mean() < 0.05
    others = np.setdiff1d(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64), hashes)
    assert (lm_score.probed(model, others) > 0).mean() < 0.05


ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM.findall(lower(text or ""))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(str(item))
    out = []
    for doc, text, *_ in docs:
        w = ITEM.findall(lower(text or ""))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    found |= windows[tuple(w[i : i + n])]
                    hit |= set(range(i, i + n))
        out.append((doc, len(w), len(hit), len(found), ",".join(sorted(found))))
    return sorted(out, key=repr)


def bench(seed=1):
    rng = random.Random(seed)
    texts = [prose(rng, n) for n in (30, 12, 10, 25)]
    return [(i, t) for i, t in enumerate(texts)] + [
        (10, "Rare Ünique-word"), (11, texts[1].upper()), (12, None), (13, ""), (14, "..."), (15, "K"),
        (16, texts[2]), (17, "the"),
    ]


def test_hits_like_brute_force(spark):
    items = bench()
    data = rows()
    for k in range(6):
        text = items[k % 4][1]
        data.append((500 + k, f"{data[k][1]} {text.replace(' ', '--') if k % 2 else text}, {data[k + 1][1]}", "en", "s", 1))
    data += [(600, "a rare\nüNIQUE word", "en", "s", 1), (601, "rare Ünique/word k K", "en", "s", 1), (601, "the", "en", "s", 1)]
    df = table(spark, data, clashes=True)
    bench_df = spark.createDataFrame(items, "item_id long, text string").withColumn("word", F.lit("own"))
    out = decontaminate.hits(df, bench_df).withColumn("ids", F.array_join("item_ids", ","))
    assert collected(out, "doc_id", "n_words", "n_hit", "n_items", "ids") == brute_hits(data, items)
    clean = decontaminate.clean(table(spark, data), bench_df)
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert clean.count() == sum(h[2] == 0 for h in brute_hits(data, items))
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.hits(df, none).filter("n_hit = 0 AND n_items = 0").count() == len(data)
    assert decontaminate.hits(table(spark, []), bench_df).count() == 0


def test_token_counts_like_brute_force(spark):
    data = rows()
    with open(token_counts.DEFAULT_VOCABULARY, "rb") as file:
        encoding, _ = token_counts.encoder_of(file.read(), token_counts.PATTERN)
    assert isinstance(encoding, tiktoken.Encoding)
    got = collected(
        token_counts.token_counts(table(spark, data, clashes=True)), "doc_id", "n_tokens", "outside", "crossing",
        "section_tokens",
    )
    want = []
    for doc, text, *_ in data:
        if not text:
            want.append((doc, 0, 0.0, 0, []))
            continue
        ids = encoding.encode_ordinary(text)
        spans, at = [], 0
        raw = text.encode()
        char_of = [i for i, c in enumerate(text) for _ in c.encode()]
        for t in ids:
            n = len(encoding.decode_single_token_bytes(t))
            spans.append((char_of[at], char_of[at + n - 1] + 1))
            at += n
        assert at == len(raw)
        ends, end = [], 0
        for line in text.split("\n"):
            end += len(line) + 1
            ends.append(end)
        ends[-1] -= 1
        per, crossing, j = [0.0] * len(ends), 0, 0
        for s, e in spans:
            while ends[j] <= s:
                j += 1
            per[j] += 1
            crossing += e > ends[j]
        want.append((doc, len(ids), 0.0, crossing, per))
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(table(spark, [])).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_given_sections(rule):
    rng = random.Random(3)
    for _ in range(200):
        cuts = sorted(rng.sample(range(40), 8))
        borders = np.array([(cuts[i], cuts[i + 1]) for i in range(0, 8, 2) if rng.random() < 0.8]).reshape(-1, 2)
        marks = sorted({0, 40, *rng.sample(range(40), 10)})
        starts, ends = np.array(marks[:-1]), np.array(marks[1:])
        counts, outside, crossing = token_counts.attribute(starts, ends, borders, rule)
        want, out, cross = [0.0] * len(borders), 0.0, 0
        for s, e in zip(starts, ends, strict=True):
            shares = [len(set(range(s, e)) & set(range(a, b))) for a, b in borders]
            free = (e - s) - sum(shares)
            cross += any(0 < x for x in shares) and max(shares) < e - s
            if rule == "fraction":
                want = [w + x / (e - s) for w, x in zip(want, shares, strict=True)]
                out += free / (e - s)
            elif rule == "majority":
                if shares and max(shares) >= max(free, 1):
                    want[shares.index(max(shares))] += 1
                else:
                    out += 1
            else:
                home = [i for i, (a, b) in enumerate(borders) if a <= s < b]
                if home:
                    want[home[0]] += 1
                else:
                    out += 1
        assert counts.tolist() == pytest.approx(want) and outside == pytest.approx(out) and crossing == cross


def test_sections_column(spark):
    df = spark.createDataFrame(
        [(1, "one two three", [(0, 4), (4, 8)]), (2, None, [(0, 1)]), (3, "x", []), (4, "y", None)],
        "doc_id long, text string, parts array<struct<start:int,end:int>>",
    )
    out = {r["doc_id"]: r for r in token_counts.token_counts(df, sections_col="parts", rule="fraction").collect()}
    assert sum(out[1]["section_tokens"]) + out[1]["outside"] == pytest.approx(out[1]["n_tokens"])
    assert out[2]["section_tokens"] == [0.0] and out[3]["outside"] == out[4]["outside"] == 1.0
