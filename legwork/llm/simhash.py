"""Near duplicates by SimHash: an index over byte positions, count filtering, verification.

A 64-bit fingerprint has eight bytes. If two fingerprints differ in at most k bits they differ
in at most k bytes, so they share at least 8 - k bytes in the same positions: the guaranteed
minimum of matches. A posting list per single byte would hold a 256th of everything, so the
lists are kept per combination of that many positions (for k = 4: 70 lists per fingerprint,
32 bits each), which every pair that reaches the minimum shares. A pair found in a list is
tallied (equal bytes in the same position), and verified by its differing bits.

Equal fingerprints are one entry. A long list does not emit its pairs: it is searched breadth
first, and the links found form a spanning forest of the list, which is all that components
need. Lists beyond ``LIST_MAX`` entries are divided once more by combinations of the four-bit
pieces of the bytes not yet fixed, which bounds them (for k = 4: 16 free bits).

Texts whose shingle sets are 0.8 alike differ in about ten bits, past any number that eight
bytes can guarantee a match for. Asked for a ``similarity``, the operator therefore also keeps
a sketch per distinct shingle set: ``SKETCH`` positional bytes, each of the smallest shingle
under one order, so that the share of equal bytes estimates the similarity. The index, the
tally and the search of a list are the same; a list longer than ``SKETCH_LIST`` is cut into
blocks, and every pair of blocks is searched. Sketches and fingerprints only propose: the sets
that their links bring together are compared shingle by shingle, and a link counts if their
Jaccard similarity reaches what was asked for.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.llm.text import free, same, sized_broadcast, text_key
from legwork.operators.graph import components
from legwork.session import cut_to_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HASH_SEED = 42
#: Longest list that one task searches at once.
LIST_MAX = 1 << 16
#: Lists up to this length are compared pair by pair, all lists of a batch at once.
SHORT = 12
#: Shingles whose bits are added up at a time.
BIT_CHUNK = 1 << 16
#: Positional bytes of a sketch; at 0.8 their estimate has a standard error of 0.025.
SKETCH = 256
#: Lists that a sketch is in, and bytes that such a list fixes: texts 0.8 alike share none of
#: them in one of 20 million cases.
SKETCH_LISTS, SKETCH_KEY = 32, 4
#: Standard errors that the tally of a pair may stay below its similarity and still be compared.
ERRORS = 5
#: Longest list of sketches that one task searches at once.
SKETCH_LIST = 1 << 14
#: Bytes of shingle sets in a block; one task compares the sets of two blocks.
SET_BLOCK = 1 << 24
#: Shingles sketched at a time.
SKETCH_CHUNK = 512
#: Odd factors, one per position, that put the shingles in as many orders.
FACTORS = np.random.default_rng(HASH_SEED).integers(0, 1 << 32, SKETCH, dtype=np.uint32) | np.uint32(1)
#: Odd factor that spreads a smallest value over its byte.
SPREAD = np.uint32(0x9E3779B1)


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; A-Z lower-cased."""
    parts = text.encode().lower().split()  # bytes methods know ASCII only
    if not parts:
        return np.zeros(0, np.uint64)
    whole = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= width:
        return np.array([digest(whole, HASH_SEED)], np.uint64)
    ends = (np.cumsum([len(p) + 1 for p in parts]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    hashes = [digest(whole[a:b], HASH_SEED) for a, b in zip(starts, ends[width - 1 :], strict=False)]
    return np.array(hashes, np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; zero for none. As a signed long."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BIT_CHUNK):
        raw = hashes[at : at + BIT_CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = total * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def sketch(hashes: np.ndarray) -> bytes:
    """A byte of the smallest shingle under each of the orders; zeros for no shingle."""
    least = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    if not len(hashes):
        return bytes(SKETCH)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), SKETCH_CHUNK):
        np.minimum(least, (short[at : at + SKETCH_CHUNK, None] * FACTORS).min(axis=0), out=least)
    return ((least * SPREAD) >> np.uint32(24)).astype(np.uint8).tobytes()


def set_key(shingles: np.ndarray) -> int:
    """Hash of a sorted set of shingles, as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), HASH_SEED)).astype(np.int64))


def fingerprint_batches(width: int, sketched: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sets, sketches = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                hashes = shingle_hashes(text or "", width)
                prints.append(fingerprint(hashes))
                if sketched:
                    hashes = np.unique(hashes)
                    sets.append(set_key(hashes))
                    sketches.append(sketch(hashes))
            made = {"fingerprint": pa.array(prints, pa.int64())}
            if sketched:
                made["set_id"] = pa.array(sets, pa.int64())
                made["sketch"] = pa.array(sketches, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *made.values()], names=[*batch.schema.names[:-1], *made]
            )

    return run


def set_batches(width: int):
    """Rows (component, set_id, text) to the sorted shingle sets, eight bytes a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(text or "", width)).tobytes() for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sets, pa.binary())], names=["component", "set_id", "shingles"]
            )

    return run


def masks_of(free: list[int], width: int, least: int) -> list[int]:
    """Bit masks of all choices of ``least`` pieces of ``width`` bits out of the pieces ``free``."""
    piece = (1 << width) - 1
    return [sum(piece << (width * p) for p in chosen) for chosen in combinations(free, least)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def reach(items: np.ndarray, linked: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices) of a spanning forest of the items; ``linked`` tells which of many are near one."""
    rest = np.arange(1, len(items))
    frontier = np.array([0])
    left, right = [], []
    while len(rest):
        if not len(frontier):
            frontier, rest = rest[:1], rest[1:]
            continue
        here, frontier = frontier[0], frontier[1:]
        hit = linked(items[rest], items[here])
        if hit.any():
            found = rest[hit]
            left.append(np.full(len(found), here)), right.append(found)
            frontier, rest = np.concatenate([frontier, found]), rest[~hit]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def near(a: np.ndarray, b, bits: int, least: int) -> np.ndarray:
    """Verification of tallied pairs: differing bits, after the count of shared bytes."""
    apart = np.bitwise_xor(a, b)
    tally = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    return (tally >= least) & (np.bitwise_count(apart) <= bits)


def list_links(bits: int, least: int, longest: int):
    """Rows (key columns, fp), sorted by key, to links (a, b); rows of overlong lists come back.

    A returned row has ``again`` set and keeps its list and fingerprint in a and b.
    """

    def is_near(many: np.ndarray, one) -> np.ndarray:
        return near(many, one, bits, least)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []  # fingerprints of the open list
        open_key, size, over = None, 0, False

        def links(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "again": 0})

        def again(key, prints: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"a": prints, "b": prints, "again": 1 + int(key[0])})

        def close():
            if not over and size > 1:
                prints = np.concatenate(held).view(np.uint64)
                a, b = reach(prints, is_near)
                if len(a):
                    yield links(prints[a].view(np.int64), prints[b].view(np.int64))

        for frame in frames:
            if not len(frame):
                continue
            c, k, fp = (frame[x].to_numpy() for x in ("c", "k", "fp"))
            new = np.r_[True, (c[1:] != c[:-1]) | (k[1:] != k[:-1])]
            starts = np.flatnonzero(new)
            stops = np.r_[starts[1:], len(fp)]
            body = 0  # lists of this frame before it are part of the open one
            if open_key == (c[0], k[0]):
                body = 1
                piece = fp[: stops[0]]
                if over:
                    yield again(open_key, piece)
                else:
                    held.append(piece)
                    size += len(piece)
                    if size > longest:
                        yield again(open_key, np.concatenate(held))
                        held, over = [], True
            if body < len(starts):  # the open list has ended
                yield from close()
                whole_starts, whole_stops = starts[body:-1], stops[body:-1]
                lengths = whole_stops - whole_starts
                short = lengths <= SHORT
                if short.any():
                    room = np.repeat(whole_stops[short], lengths[short])
                    at = np.concatenate([np.arange(a, b) for a, b in zip(whole_starts[short], whole_stops[short], strict=True)])
                    prints = fp.view(np.uint64)
                    for step in range(1, SHORT):
                        i = at[at + step < room]
                        if not len(i):
                            break
                        hit = near(prints[i], prints[i + step], bits, least)
                        if hit.any():
                            yield links(fp[i[hit]], fp[i[hit] + step])
                for s, e in zip(whole_starts[~short], whole_stops[~short], strict=True):
                    if e - s > longest:
                        yield again((c[s], k[s]), fp[s:e])
                        continue
                    prints = np.ascontiguousarray(fp[s:e]).view(np.uint64)
                    a, b = reach(prints, is_near)
                    if len(a):
                        yield links(prints[a].view(np.int64), prints[b].view(np.int64))
                last = starts[-1]
                open_key, held, size, over = (c[last], k[last]), [fp[last:].copy()], len(fp) - last, False
                if size > longest:
                    yield again(open_key, fp[last:])
                    held, over = [], True
        if open_key is not None:
            yield from close()

    return run


def fingerprint_links(prints: DataFrame, bits: int = 4, longest: int = LIST_MAX) -> DataFrame:
    """Links (a < b) that connect all distinct fingerprints (``fp``) within ``bits`` of each other.

    Not every near pair is listed, but near pairs always end in one component.
    """
    least = 8 - bits
    if least < 1:
        raise ValueError("Fingerprints of eight bytes guarantee a shared byte only up to 7 bits")
    spark = prints.sparkSession
    masks = masks_of(list(range(8)), 8, least)
    listed = prints.select("fp", F.posexplode(F.array(*[F.lit(signed(m)) for m in masks])).alias("c", "mask"))
    listed = listed.select("c", F.col("fp").bitwiseAND(F.col("mask")).alias("k"), "fp")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def searched(rows: DataFrame, limit: int) -> DataFrame:
        dealt = rows.repartition(parts, "c", "k").sortWithinPartitions("c", "k", "fp")
        return cut_to_table(dealt.mapInPandas(list_links(bits, least, limit), "a long, b long, again int"), "links")

    first = searched(listed, longest)
    links = first.filter("again = 0").select("a", "b")
    overlong = first.filter("again > 0").select((F.col("again") - 1).alias("c0"), F.col("b").alias("fp"))
    if not overlong.isEmpty():
        # Nibbles of the bytes that the list leaves free: 2 * bits pieces, of which bits may differ.
        finer = [
            [signed(m | n) for n in masks_of([p for p in range(16) if not m >> (4 * p) & 15], 4, bits)] for m in masks
        ]
        table = spark.createDataFrame(
            [(c, i, m) for c, each in enumerate(finer) for i, m in enumerate(each)], "c0 int, i int, mask long"
        )
        per_list = F.broadcast(table)  # at most 70 * 70 rows
        fine = overlong.join(per_list, "c0").select(
            (F.col("c0") * 4096 + F.col("i")).alias("c"), F.col("fp").bitwiseAND(F.col("mask")).alias("k"), "fp"
        )
        links = links.union(searched(fine, 1 << 62).select("a", "b"))
    return links.distinct()


def group_links(keys: list[str], id_col: str, value_col: str, search: Callable):
    """Rows sorted by ``keys`` to links (a, b) within each group that has the same keys.

    ``search`` takes the values of a group and gives the links as indices.
    """

    def links(group: pd.DataFrame) -> pd.DataFrame:
        ids = group[id_col].to_numpy()
        a, b = search(group[value_col].to_numpy())
        a, b = ids[a], ids[b]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})[a != b].drop_duplicates()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the group that is still open
        for frame in frames:
            if not len(frame):
                continue
            at = frame[keys].to_numpy()
            starts = np.r_[0, 1 + np.flatnonzero((at[1:] != at[:-1]).any(axis=1)), len(frame)]
            if held and (held[0][keys].to_numpy()[0] != at[0]).any():
                yield links(pd.concat(held, ignore_index=True))
                held = []
            found = []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e == len(frame):
                    held.append(frame.iloc[s:e])
                elif held:
                    found.append(links(pd.concat([*held, frame.iloc[s:e]], ignore_index=True)))
                    held = []
                elif e - s > 1:
                    found.append(links(frame.iloc[s:e]))
            if found:
                yield pd.concat(found)
        if held:
            yield links(pd.concat(held, ignore_index=True))

    return run


def sketches_alike(least: int):
    """Links that connect all sketches of a group with ``least`` equal bytes."""

    def alike(many: np.ndarray, one: np.ndarray) -> np.ndarray:
        return (many == one).sum(axis=1) >= least

    def search(sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return reach(np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, SKETCH), alike)

    return search


def sets_alike(similarity: float):
    """Links that connect all shingle sets of a group with that Jaccard similarity, each compared exactly."""

    def search(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(x) // 8 for x in sets])
        distinct, flat = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
        flat = flat.astype(np.int32)
        stops = np.cumsum(sizes)
        starts = stops - sizes
        here = np.zeros(len(distinct), bool)

        def alike(many: np.ndarray, one: int) -> np.ndarray:
            small, large = np.minimum(sizes[many], sizes[one]), np.maximum(sizes[many], sizes[one])
            hit = (small > 0) & (small >= similarity * large)  # the most that the sizes allow
            if hit.any():
                those = many[hit]
                here[flat[starts[one] : stops[one]]] = True
                both = np.array([np.count_nonzero(here[flat[starts[i] : stops[i]]]) for i in those])
                here[flat[starts[one] : stops[one]]] = False
                hit[hit] = both >= similarity * (sizes[those] + sizes[one] - both)
            return hit

        return reach(np.arange(len(sets)), alike)

    return search


def in_blocks(rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """``rows`` once for every pair of blocks (``pair``) that their block is in, dealt and sorted."""
    block = F.pmod(F.xxhash64(id_col), F.col("blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.least(block, other) * F.col("blocks") + F.greatest(block, other),
    )
    kept = [c for c in rows.columns if c != "blocks"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*kept, F.explode(pairs).alias("pair")).repartition(parts, *keys, "pair")
    return dealt.sortWithinPartitions(*keys, "pair")


def least_tally(similarity: float) -> int:
    """Equal bytes of a sketch, ``ERRORS`` standard errors below what the similarity lets expect."""
    equal = similarity + (1 - similarity) / 256
    return max(0, math.floor(SKETCH * equal - ERRORS * math.sqrt(SKETCH * equal * (1 - equal))))


def sketch_links(entries: DataFrame, similarity: float, longest: int = SKETCH_LIST) -> DataFrame:
    """Links (a < b) between the ids of distinct (set_id, sketch) that connect all sets that share
    a list and whose tally leaves room for the similarity."""
    keys = [F.xxhash64(F.lit(c), F.substring("sketch", 1 + SKETCH_KEY * c, SKETCH_KEY)) for c in range(SKETCH_LISTS)]
    narrow = entries.select("set_id", F.explode(F.array(*keys)).alias("k"))
    sizes = narrow.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.when(F.col("n") > longest, F.ceil(2 * F.col("n") / longest)).otherwise(1).cast("long")
    shared = cut_to_table(sizes.select("k", blocks.alias("blocks")), "shared_lists")
    # Only sketches that share a list at all are carried to their lists.
    in_lists = narrow.join(sized_broadcast(shared, shared.count(), 32), "k")
    in_lists = in_lists.groupBy("set_id").agg(F.collect_list(F.struct("k", "blocks")).alias("lists"))
    listed = entries.join(in_lists, "set_id").select("set_id", "sketch", F.inline("lists"))
    run = group_links(["k", "pair"], "set_id", "sketch", sketches_alike(least_tally(similarity)))
    return in_blocks(listed, ["k"], "set_id").mapInPandas(run, "a long, b long").distinct()


def candidate_links(prints: DataFrame, entries: DataFrame, bits: int, similarity: float) -> DataFrame:
    """Links (a < b) between shingle sets that are near by fingerprint or by sketch."""
    pairs = cut_to_table(prints.select(F.col("fingerprint").alias("fp"), "set_id").distinct(), "print_sets")
    heads = cut_to_table(pairs.groupBy("fp").agg(F.min("set_id").alias("head")), "print_heads")
    equal = pairs.join(heads, "fp").select(F.col("head").alias("a"), F.col("set_id").alias("b"))
    near = fingerprint_links(heads, bits)
    near = near.join(heads.toDF("a", "x"), "a").join(heads.toDF("b", "y"), "b")
    near = near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    links = near.union(equal).filter("a < b").union(sketch_links(entries, similarity))
    return cut_to_table(links.distinct(), "candidates")


def verified_links(docs: DataFrame, entries: DataFrame, links: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links (a < b) that connect all shingle sets of that similarity which ``links`` bring together.

    ``docs`` has doc_id, text_mark and text, ``entries`` the (doc_id, text_mark) of one row per
    set. All pairs of a component of ``links`` count as proposed; components of more than
    ``SET_BLOCK`` bytes are cut into blocks, and every pair of blocks is searched.
    """
    ids = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    of_set = components(links, ids).select(F.col("id").alias("set_id"), "component")
    proposed = cut_to_table(
        entries.join(of_set, "set_id").select("component", "set_id", F.col("least.*")).toDF("component", "set_id", "_id", "_mark"),
        "proposed",
    )
    both = same([F.col("doc_id"), F.col("text_mark")], [F.col("_id"), F.col("_mark")])
    texts = docs.join(sized_broadcast(proposed, proposed.count(), 64), both).select("component", "set_id", "text")
    sets = texts.mapInArrow(set_batches(width), "component long, set_id long, shingles binary")
    sets = cut_to_table(sets.distinct(), "shingle_sets")
    bytes_of = sets.groupBy("component").agg(F.sum(F.octet_length("shingles").cast("long")).alias("n"))
    blocks = bytes_of.select("component", F.greatest(F.lit(1), F.ceil(F.col("n") / SET_BLOCK)).cast("long").alias("blocks"))
    run = group_links(["component", "pair"], "set_id", "shingles", sets_alike(similarity))
    dealt = in_blocks(sets.join(blocks, "component"), ["component"], "set_id")
    return cut_to_table(dealt.mapInPandas(run, "a long, b long").distinct(), "verified")


def fingerprinted(
    docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text", sketched: bool = False
) -> DataFrame:
    """doc_id, text_mark (hash of the text), fingerprint (signed long) and, if asked, set_id (hash
    of the shingle set) and sketch of every row."""
    columns = "doc_id long, text_mark long, fingerprint long" + (", set_id long, sketch binary" if sketched else "")
    return text_rows(docs, id_col, text_col).mapInArrow(fingerprint_batches(width, sketched), columns)


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("text_mark"),
        F.col(text_col).alias("text"),
    )


def near_duplicates(
    docs: DataFrame,
    width: int = 4,
    bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float | None = None,
) -> DataFrame:
    """doc_id, text_mark, fingerprint, component_id and component_print of every row of ``docs``.

    Shingles are ``width`` words joined by a space, A-Z lower-cased, repeats included; fewer
    words are one shingle, and a text without words (null, empty) has fingerprint zero, which
    links like any other. With a ``similarity``, fingerprints and sketches propose links, and
    those count whose sets of shingles have at least that Jaccard similarity (texts without
    words are alike, and like no other). component_id is the smallest doc_id that a chain of links reaches.
    Rows without an id take part, but no component is named after them unless it has no
    other row (then it is null). component_print is the component's smallest fingerprint, or
    with a ``similarity`` the smallest hash of its shingle sets. Ids are integers; repeated rows give repeated results; other columns are not read; an empty
    table gives an empty one.
    """
    prints = cut_to_table(fingerprinted(docs, width, id_col, text_col, similarity is not None), "fingerprints")
    if similarity is None:
        prints = prints.withColumn("key", F.col("fingerprint"))
        distinct = cut_to_table(prints.groupBy("key").agg(F.min("doc_id").alias("least")), "distinct_prints")
        links = fingerprint_links(distinct.withColumnRenamed("key", "fp"), bits)
    else:
        prints = prints.withColumn("key", F.col("set_id"))
        one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_mark")).alias("one")
        entries = prints.groupBy("set_id", "sketch").agg(one)
        entries = cut_to_table(
            entries.select("set_id", "sketch", F.struct("one.doc_id", "one.text_mark").alias("least")), "sketches"
        )
        distinct = entries.select(F.col("set_id").alias("key"), F.col("least.doc_id").alias("least"))
        proposed = candidate_links(prints, entries.select("set_id", "sketch"), bits, similarity)
        links = verified_links(text_rows(docs, id_col, text_col), entries, proposed, width, similarity)
    labels = components(links, distinct.select(F.col("key").alias("id"))).select(F.col("id").alias("key"), "component")
    named = distinct.join(labels, "key")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_key = cut_to_table(named.join(smallest, "component").select("key", "component_id", "component"), "print_components")
    return prints.join(of_key, "key").select(
        "doc_id", "text_mark", "fingerprint", "component_id", F.col("component").alias("component_print")
    )


def hex_print(value: Column) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def one_per_group(
    docs: DataFrame,
    width: int = 4,
    bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float | None = None,
) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, of several texts the smallest hash.

    Rows without an id are chosen last. Of rows with the same id and text one stays.
    """
    marked = near_duplicates(docs, width, bits, id_col, text_col, similarity)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_mark")
    sim_id, sim_mark = free(docs, "sim_id"), free(docs, "sim_mark")
    chosen = cut_to_table(
        marked.groupBy("component_print")
        .agg(F.min(rank).alias("r"))
        .select(F.col("r.doc_id").alias(sim_id), F.col("r.text_mark").alias(sim_mark)),
        "chosen",
    )
    both = same([F.col(id_col).cast("long"), text_key(F.col(text_col))], [F.col(sim_id), F.col(sim_mark)])
    kept = docs.join(chosen, both, "left_semi")
    chosen_rows = marked.join(
        chosen, same([F.col("doc_id"), F.col("text_mark")], [F.col(sim_id), F.col(sim_mark)]), "left_semi"
    )
    counts = chosen_rows.groupBy("doc_id", "text_mark").agg(F.count(F.lit(1)).alias("n"))
    if counts.filter("n > 1").isEmpty():
        return kept
    mark = free(docs, "sim_text")
    return kept.withColumn(mark, text_key(F.col(text_col))).dropDuplicates([id_col, mark]).drop(mark)
