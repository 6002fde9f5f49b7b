"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from legwork.llm import prefix_trie

TYPE = "conv_id long, turn long, role string, text string, depth string, prior string, t0 string"


def key(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest() + str(len(text))


def ordered(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            by_conv[conv].append(((-1 if turn is None else 0, turn or 0, key(role, text)), (role or "", text or "")))
    return {c: tuple(t for _, t in sorted(v)) for c, v in by_conv.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        out[c] = convs.get(donor, ())[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        saved[path] = own + sum(saved[k] for k in children[path])
    out = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(path))
        out.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children[path]),
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def cases(seed=3):
    rng = random.Random(seed)
    rows = []

    def add(conv, turns, first=0):
        for i, (role, text) in enumerate(turns):
            rows.append((conv, first + i, role, text))

    said = [("user", f"line {i} " * (i + 1)) for i in range(4)] + [("assistant", ""), ("user", None), (None, "é€😀")]
    for c in range(0, 260):
        if c % 17 != 3:
            add(c, [rng.choice(said) for _ in range(rng.randrange(1, 7))])
    long = [rng.choice(said) for _ in range(45)]
    for c in (300, 306, 400, 1000):  # share 20, 33 and all of 45 turns
        add(c, long)
    add(500, long[:33] + [("user", "other")] * 5)
    add(600, long[:20] + [("user", f"own {i}") for i in range(60)])
    add(700, long[:16])  # ends at the edge of a block
    add(800, long[:24] + [("x", "y")])
    add(-7, [("a", "b")] * 3)
    add(-207, long[:2])
    add(900, [("user", "big " * 50_000), ("user", "big " * 50_000)])
    rows += [(901, None, "user", "no turn"), (901, 5, "user", "five"), (901, 5, "user", "five again"), (901, None, None, None)]
    rows += [(902, 1, "user", "twice")] * 3
    rows += [(None, 0, "user", "no conversation"), (None, None, None, None)]
    rows += [(5000 + i, 0, "user", "hot") for i in range(300)]  # copies of one turn
    rng.shuffle(rows)
    return [(*r, "own", "own", "own") for r in rows]


def found(df):
    return sorted((tuple(r[c] for c in prefix_trie.NODE_COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("width", [8, 3])
def test_trie_like_brute_force(spark, width):
    rows = cases()
    df = spark.createDataFrame(rows, TYPE).repartition(5)
    assert found(prefix_trie.prefix_trie(df, width)) == brute(ordered(rows))


def test_rebuilt_trie_like_brute_force(spark):
    rows = cases(4)
    df = spark.createDataFrame(rows, TYPE).repartition(5)
    assert found(prefix_trie.shared_starts(df)) == brute(rebuilt(ordered(rows)))


def test_trie_of_little(spark):
    assert found(prefix_trie.shared_starts(spark.createDataFrame([], TYPE))) == []
    one = [(105, 0, "user", "gone", "", "", "")]  # loses its only turn, the conversation it is built on is absent
    assert zlib.crc32(b"105") % 6 > 0
    empty = hashlib.sha256(b"105").hexdigest()
    assert found(prefix_trie.shared_starts(spark.createDataFrame(one, TYPE))) == [(105, 0, None, 1, 0, 1, 0, empty)]


def test_long_chains_of_copies(spark):
    """A chain longer than one stretch of running sums, said by two conversations."""
    turns = [(c, i, "u", f"t{i}" * (i % 5)) for c in (10, 20) for i in range(2500)]
    turns += [(30, i, "u", f"t{i}" * (i % 5)) for i in range(3)]
    df = spark.createDataFrame([(*t, "", "", "") for t in turns], TYPE)
    assert found(prefix_trie.prefix_trie(df)) == brute(ordered(turns))
