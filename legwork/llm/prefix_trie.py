"""A trie of conversation prefixes by ROLLUP over positional turn columns.

Every conversation becomes rows of ``WIDTH`` positional turn columns, one row per block of turns.
One ROLLUP over these columns counts all prefixes that end in the block; a second one, over the
nodes that the first has found, sums what lies below each node. A longer conversation goes on in
the next block, keyed by the node at which the block before it ended. Blocks are only rolled up
while a node is shared by different conversations: equal conversations are counted as one with a
weight, and a conversation that is alone is a plain chain.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.text import filled
from legwork.session import cut_to_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Turn columns of one block.
WIDTH = 8
#: Conversation ids packed into one row on the way to their digest.
PIECE = 4096
#: Turns summed together where running sums go along a chain.
STRETCH = 1024
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE_COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def turn_key(role: Column, text: Column) -> Column:
    """What makes two turns equal, as a digest followed by the code points of the text."""
    role, text = filled(role), filled(text)
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(said.cast("binary")), F.length(text).cast("string"))


def code_points(key: Column) -> Column:
    return F.substring(key, 33, 20).cast("long")


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv, pos, key): the turns of each conversation counted from 0 by turn, nulls first.

    Turns of equal number are ordered by their digest, so the result does not depend on the order
    of the rows. The rows are dealt by range, so a conversation of any length is spread: each
    range counts its own rows and starts where the ranges before it have ended.
    """
    narrow = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", turn_key(F.col("role"), F.col("text")).alias("key"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["turn", "key", "_row"]
    dealt = narrow.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id())
    dealt = cut_to_table(dealt, "trie-dealt")
    parts = dealt.groupBy("conv", "part").count()
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("conv", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*[F.asc_nulls_first(c) for c in order]))
    numbered = dealt.withColumn("place", place).join(starts, ["conv", "part"])
    return cut_to_table(numbered.select("conv", (F.col("start") + F.col("place") - 1).alias("pos"), "key"), "trie-turns")


def sequences(numbered: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different sequences of turns: (conv, rep, n, length) and (rep, n, length, pos, key).

    ``conversations`` (conv) may name conversations without turns. ``rep`` is the smallest
    conversation of those that say the same, ``n`` their number.
    """
    marks = numbered.groupBy("conv").agg(
        F.bit_xor(F.xxhash64("pos", "key")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit("b"), "pos", "key")).alias("b"),
        F.count(F.lit(1)).alias("length"),
    )
    marks = conversations.join(marks, "conv", "left").fillna(0, ["a", "b", "length"])
    groups = marks.groupBy("a", "b", "length").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n"))
    members = cut_to_table(marks.join(groups, ["a", "b", "length"]).select("conv", "rep", "n", "length"), "trie-members")
    reps = members.filter("conv = rep").select("rep", "n", "length")
    return members, numbered.withColumnRenamed("conv", "rep").join(reps, "rep")


def id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (rep, conv) rows to rows of up to ``PIECE`` joined ids."""
    names = ["rep", "first", "ids"]
    for batch in batches:
        rows = {name: [] for name in names}
        reps, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begin = 0
        for i in range(1, len(reps) + 1):
            if i == len(reps) or reps[i] != reps[begin] or i - begin == PIECE:
                rows["rep"].append(reps[begin])
                rows["first"].append(convs[begin])
                rows["ids"].append(",".join(map(str, convs[begin:i])))
                begin = i
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["rep"], pa.int64()), pa.array(rows["first"], pa.int64()), pa.array(rows["ids"], pa.string())], names
        )


def digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (rep, first) to one SHA-256 per rep; only its state is held."""
    current, state = None, None

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["rep", "ends_sha256"]
        )

    for batch in batches:
        done = {"rep": [], "ends_sha256": []}
        for rep, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if rep != current:
                if state is not None:
                    done["rep"].append(current)
                    done["ends_sha256"].append(state.hexdigest())
                current, state = rep, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(done["rep"], pa.int64()), pa.array(done["ends_sha256"], pa.string())], ["rep", "ends_sha256"]
        )
    if state is not None:
        yield row()


def member_digests(members: DataFrame) -> DataFrame:
    """(rep, ends_sha256): digest of the ids of each group of equal conversations.

    A digest is made in order, so one task feeds it; it gets packed ids, a row per ``PIECE``.
    """
    pairs = members.select("rep", "conv").repartitionByRange("rep", "conv").sortWithinPartitions("rep", "conv")
    pieces = pairs.mapInArrow(id_pieces, "rep long, first long, ids string")
    in_order = pieces.repartition("rep").sortWithinPartitions("rep", "first")
    return in_order.mapInArrow(digest_pieces, "rep long, ends_sha256 string")


def _turns(width: int) -> list[str]:
    return [f"t{i}" for i in range(width)]


def _rollup(rows: DataFrame, width: int, measures: str) -> DataFrame:
    """``measures`` for every prefix of the turn columns inside ``prior``, with its ``level``."""
    names = ", ".join(_turns(width))
    return rows.sparkSession.sql(
        f"SELECT prior, {names}, {width} - bit_count(grouping_id()) AS level, {measures} "
        f"FROM {{rows}} GROUP BY prior, ROLLUP({names})",
        rows=rows,
    )


def _is_node(width: int) -> Column:
    """The last turn of the prefix is a turn; conversations that end earlier leave nulls."""
    last = F.lit(None).cast("string")
    for i, name in enumerate(_turns(width)):
        last = F.when(F.col("level") == i + 1, F.col(name)).otherwise(last)
    return last.isNotNull()


def _path(upto: Column, width: int) -> Column:
    """Key of the node at level ``upto`` on the way of a row."""
    parts = [F.when(F.lit(i) < upto, F.col(name)) for i, name in enumerate(_turns(width))]
    return F.md5(F.concat_ws("/", "block", "prior", *parts).cast("binary"))


def _blocks(turns: DataFrame, width: int) -> DataFrame:
    """(rep, n, length, block, t0..): the turns of a block side by side."""
    columns = [F.max(F.when(F.col("pos") % width == i, F.col("key"))).alias(name) for i, name in enumerate(_turns(width))]
    block = F.floor(F.col("pos") / width).cast("long").alias("block")
    return turns.groupBy("rep", "n", "length", block).agg(*columns)


def _chains(turns: DataFrame, alone: DataFrame) -> DataFrame:
    """Nodes below the place from which a conversation is alone."""
    rows = turns.join(alone.select("rep", "start"), "rep").filter("pos >= start")
    rows = rows.withColumns({
        "own": (F.col("n") - 1) * code_points(F.col("key")), "stretch": F.floor(F.col("pos") / STRETCH),
    })
    sums = rows.groupBy("rep", "stretch").agg(F.sum("own").alias("below"))
    later = Window.partitionBy("rep").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rep", "stretch", F.coalesce(F.sum("below").over(later), F.lit(0)).alias("below"))
    inside = Window.partitionBy("rep", "stretch").orderBy(F.desc("pos"))
    rows = rows.withColumn("here", F.sum("own").over(inside)).join(sums, ["rep", "stretch"])
    last = F.col("pos") + 1 == F.col("length")
    return rows.select(
        F.col("rep").alias("conv_id"), (F.col("pos") + 1).alias("depth"), F.col("rep").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), (F.col("below") + F.col("here")).alias("saved_tokens"),
        F.when(last, F.col("rep")).alias("end_rep"), "start",
    )


def trie_nodes(numbered: DataFrame, conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the trie of all conversations, columns ``NODE_COLUMNS``.

    ``numbered`` has (conv, pos, key) with positions from 0 without gaps, ``conversations`` all
    ids. A node is a sequence of first turns; its ``conv_id`` is the smallest conversation that
    begins with it, and (conv_id, depth) tells nodes apart. Without conversations there is no node;
    conversations without turns end at the root. Key of equality are the digests of the turns, so
    very long texts take no more room than short ones; repeated conversations are members of the
    same nodes. The rounds grow with the longest sequence of turns that different conversations
    share, not with the longest conversation.
    """
    members, turns = sequences(numbered, conversations)
    blocks = cut_to_table(_blocks(turns, width), "trie-blocks")
    silent = F.min(F.when(F.col("length") == 0, F.col("conv"))).alias("end_rep")
    root = members.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), silent).first()
    if root["conv"] is None:
        return _finished(_no_nodes(members), members)
    top, names = root["conv"], _turns(width)

    # down: the nodes of each block, as long as different conversations share one
    found, alones = [], []
    going = members.filter("conv = rep AND length > 0").select("rep", F.lit(top).alias("prior"))
    while going is not None:
        b = len(found)
        rows = blocks.filter(F.col("block") == b).join(going, "rep")
        nodes = _rollup(
            rows, width,
            "min(rep) AS conv, sum(n) AS n_convs, count(*) AS n_seqs, max(length) AS longest, "
            "min(length) AS shortest, min_by(rep, length) AS short_rep",
        )
        nodes = nodes.filter(_is_node(width)).withColumn("block", F.lit(b).cast("long"))
        nodes = cut_to_table(nodes, "trie-nodes")
        ends = nodes.filter(F.col("level") == width).select("prior", *names, "conv", "n_seqs")
        onward = rows.filter(F.col("length") > (b + 1) * width).join(ends, ["prior", *names])
        onward = cut_to_table(onward.select("rep", "n", F.col("conv").alias("prior"), "n_seqs"), "trie-onward")
        found.append(nodes)
        alones.append(onward.filter("n_seqs = 1").select("rep", F.lit((b + 1) * width).cast("long").alias("start")))
        going = onward.filter("n_seqs > 1").select("rep", "prior")
        if going.isEmpty():
            going = None

    alone = alones[0]
    for more in alones[1:]:
        alone = alone.unionByName(more)
    chains = cut_to_table(_chains(turns, alone), "trie-chains")

    # up: sums over the subtrees, block by block
    carried, done = None, []
    for b in reversed(range(len(found))):
        tops = chains.filter((F.col("start") == (b + 1) * width) & (F.col("depth") == F.col("start") + 1))
        below = tops.select(
            F.col("conv_id").alias("conv"), F.lit(1).cast("long").alias("c_children"),
            F.col("n_leaves").alias("c_leaves"), F.col("saved_tokens").alias("c_saved"),
        )
        below = below if carried is None else below.unionByName(carried)
        below = below.withColumn("level", F.lit(width))
        nodes = found[b].join(below, ["conv", "level"], "left").fillna(0, ["c_children", "c_leaves", "c_saved"])
        chars = F.lit(None).cast("string")
        for i, name in enumerate(names):
            chars = F.when(F.col("level") == i + 1, F.col(name)).otherwise(chars)
        depth = F.lit(b * width) + F.col("level")
        nodes = nodes.withColumns({
            "saved": (F.col("n_convs") - 1) * code_points(chars) + F.col("c_saved"),
            "leaves": F.when(F.col("longest") == depth, 1).otherwise(F.col("c_leaves")).cast("long"),
            "end_rep": F.when(F.col("shortest") == depth, F.col("short_rep")),
        }).withColumnRenamed("level", "at")
        sums = _rollup(
            nodes, width,
            "min_by(struct(conv, n_convs, end_rep, c_children), at) AS node, sum(saved) AS saved_tokens, "
            "sum(leaves) AS n_leaves, " + ", ".join(f"count_if(at = {i + 1}) AS at_{i + 1}" for i in range(width)),
        )
        sums = cut_to_table(sums.filter((F.col("level") == 0) | _is_node(width)).withColumn("block", F.lit(b)), "trie-sums")
        carried = sums.filter("level = 0").select(
            F.col("prior").alias("conv"), F.col("at_1").alias("c_children"),
            F.col("n_leaves").alias("c_leaves"), F.col("saved_tokens").alias("c_saved"),
        )
        children = F.col("node.c_children")
        for i in range(1, width):
            children = F.when(F.col("level") == i, F.col(f"at_{i + 1}")).otherwise(children)
        done.append(sums.filter("level > 0").select(
            F.col("node.conv").alias("conv_id"), (F.lit(b * width) + F.col("level")).cast("long").alias("depth"),
            F.when(F.col("level") == 1, F.col("prior")).alias("above"),
            F.col("node.n_convs").alias("n_convs"), children.alias("n_children"), "n_leaves", "saved_tokens",
            F.col("node.end_rep").alias("end_rep"),
            _path(F.col("level"), width).alias("path"), _path(F.col("level") - 1, width).alias("path_above"),
        ))

    nodes = done[0]
    for more in done[1:]:
        nodes = nodes.unionByName(more)
    parents = nodes.select(F.col("path").alias("path_above"), F.col("conv_id").alias("parent"))
    nodes = nodes.join(parents, "path_above", "left").withColumn("parent_conv_id", F.coalesce("above", "parent"))
    spark = members.sparkSession
    base = spark.createDataFrame([tuple(root)], "conv long, n_convs long, end_rep long")
    base = base.join(carried, "conv", "left").select(
        F.col("conv").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.coalesce("c_children", F.lit(0)).alias("n_children"), F.coalesce("c_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("c_saved", F.lit(0)).alias("saved_tokens"), "end_rep",
    )
    wanted = [*NODE_COLUMNS[:-1], "end_rep"]
    return _finished(nodes.select(wanted).unionByName(chains.select(wanted)).unionByName(base.select(wanted)), members)


def _no_nodes(members: DataFrame) -> DataFrame:
    blank = [F.lit(None).cast("long").alias(c) for c in [*NODE_COLUMNS[:-1], "end_rep"]]
    return members.filter("false").select(*blank)


def _finished(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes with the digest of the conversations that end at them."""
    ends = member_digests(members).withColumnRenamed("rep", "end_rep")
    digest = F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")
    longs = [F.col(c).cast("long").alias(c) for c in NODE_COLUMNS[:-1]]
    return nodes.join(ends, "end_rep", "left").select(*longs, digest)


def prefix_trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """The trie of the conversations in ``turns`` (conv_id, turn, role, text).

    Null roles and texts are empty ones, a null turn comes first, turns of equal number are
    ordered by their digest. Rows without a conversation id belong to no conversation and are left
    out; other columns are not read.
    """
    numbered = number_turns(turns.select("conv_id", "turn", "role", "text"))
    return trie_nodes(numbered, numbered.select("conv").distinct(), width)


def shared_starts(turns: DataFrame, width: int = WIDTH, family: int = 100, most: int = 6) -> DataFrame:
    """The trie after every conversation c was rebuilt on conversation c - c % ``family``.

    The first crc32(c) % ``most`` turns of that conversation (as many as it has) take the place of
    as many of its own.
    """
    numbered = number_turns(turns.select("conv_id", "turn", "role", "text"))
    lengths = numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h")
    wanted = lengths.select("conv", taken, (F.col("conv") - F.col("conv") % family).alias("donor"))
    given = lengths.select(F.col("conv").alias("donor"), F.col("own").alias("offered"))
    plan = wanted.join(given, "donor", "left").select(
        "conv", "donor", "h", F.least("h", F.coalesce("offered", F.lit(0))).alias("got")
    )
    plan = cut_to_table(plan, "trie-plan")
    starts = numbered.filter(F.col("pos") < most).withColumnRenamed("conv", "donor")
    lent = starts.join(plan.filter("got > 0"), "donor").filter("pos < got").select("conv", "pos", "key")
    kept = numbered.join(plan, "conv").filter("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "key")
    rebuilt = cut_to_table(lent.unionByName(kept), "trie-rebuilt")
    return trie_nodes(rebuilt, plan.select("conv"), width)
