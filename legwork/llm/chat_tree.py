"""Chat formatting as packed prefix trees.

Conversations that share their initial turns share the nodes of a tree. Sorted by the hashes of
their turns, conversations of a tree stand in depth-first order, so a range-partitioned, sorted
stream meets every shared turn in one stretch and emits it once. The stream fills packs with
trees; a pack that begins inside a tree repeats the turns above its first conversation, which
also divides a tree that crosses partitions. Position ids count along a conversation's own path,
and attention intervals name the parts of the pack that a node may see.

No task holds a whole conversation. Turns are sorted by conversation over all partitions and
numbered there, the turns before a partition being added from one summary per partition. A
conversation is cut into parts by the number and the characters of the turns before, so
conversations with the same start have the same parts there. Parts that follow the same turns
are trees of their own, found by a hash of these turns, and count positions on from them.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.text import filled
from legwork.llm.token_counts import encoder_of
from legwork.session import cut_to_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Strings that chat templates give a meaning; none of them survives in a text.
CONTROLS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>", "<pad>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
#: A pack ends with the first part that brings its tokens and parts together to this many.
PACK_TOKENS = 1 << 18
#: A part of a conversation ends after this many turns, or with the turn that fills its characters.
PART_TURNS, PART_CHARS = 512, 1 << 20
#: Turns and characters by which turns and parts are dealt to ranges; the order within goes on.
DEALT_TURNS, DEALT_CHARS = 32, 256

CONTROL_AT = re.compile("(?=" + "|".join(re.escape(c) for c in CONTROLS) + ")(.)", re.S)
ESCAPE = re.compile(r"\\(.)", re.S)
TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE), re.S)
NUMBERED = pa.schema(
    [
        ("src", pa.int32()), ("lead", pa.bool_()), ("none", pa.bool_()), ("conv", pa.int64()), ("i", pa.int64()),
        ("c", pa.int64()), ("chars", pa.int64()), ("size", pa.int64()), ("role", pa.string()), ("text", pa.string()),
        ("ids", pa.binary()),
    ]
)
NUMBERED_TYPE = (
    "src int, lead boolean, none boolean, conv long, i long, c long, chars long, size long, role string, "
    "text string, ids binary"
)
INTS = pa.list_(pa.int32())
PACK = pa.schema(
    [
        ("pack", pa.int64()), ("text", pa.string()), ("token_ids", INTS), ("node_parent", INTS), ("node_start", INTS),
        ("node_end", INTS), ("node_position", pa.list_(pa.int64())), ("node_attends", pa.list_(INTS)),
        ("node_char", INTS), ("node_loss", pa.list_(INTS)), ("conv_id", pa.list_(pa.int64())),
        ("conv_part", INTS), ("conv_parts", INTS), ("conv_node", INTS),
    ]
)
PACK_TYPE = (
    "pack long, text string, token_ids array<int>, node_parent array<int>, node_start array<int>, "
    "node_end array<int>, node_position array<long>, node_attends array<array<int>>, node_char array<int>, "
    "node_loss array<array<int>>, conv_id array<long>, conv_part array<int>, conv_parts array<int>, "
    "conv_node array<int>"
)
DIGEST_TYPE = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
READ_TYPE = DIGEST_TYPE + ", part int, parts int, text string, loss string"


class Vocabulary:
    """Encoder of a vocabulary file; it is built where it is first called."""

    def __init__(self, ranks: bytes, pattern: str):
        self.source, self.made = (ranks, pattern), None

    def __getstate__(self):
        return {"source": self.source, "made": None}

    def __call__(self, text: str) -> list[int]:
        if self.made is None:
            self.made = encoder_of(*self.source)[0]
        return self.made.encode_ordinary(text)


def escaped(text: str) -> str:
    """Backslashes doubled, and every control string broken by a mark after its first character."""
    return CONTROL_AT.sub(r"\1\\-", text.replace("\\", "\\\\"))


def escaped_role(role: str) -> str:
    return escaped(role).replace("\n", "\\n")


def unescaped(text: str) -> str:
    return ESCAPE.sub(lambda m: {"-": "", "n": "\n"}.get(m[1], m[1]), text)


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text begins and ends."""
    head, body = f"{OPEN}{escaped_role(role)}\n", escaped(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parsed(text: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a formatted conversation."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in TURN.finditer(text)]


def joined(intervals: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted intervals with touching ones put together."""
    out: list[tuple[int, int]] = []
    for a, b in intervals:
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


class Pack:
    """Nodes and conversations of the pack being built."""

    def __init__(self):
        self.text: list[str] = []
        self.chars = self.tokens = 0
        self.ids: list[bytes] = []
        self.rows: list[tuple] = []  # parent, start, end, position, attends, char, loss
        self.convs: list[tuple] = []  # id, part, parts, last node
        self.path: list[tuple[tuple, int]] = []  # turn and node

    def add(self, conv: tuple, above: str, base: int, turns: list[tuple]) -> None:
        """Adds a part whose turns come after ``base`` tokens, of turns with the hash ``above``."""
        # turns are the same node if all turns before are, also those of earlier parts
        keys = [(above, *turns[0][:2]), *(t[:2] for t in turns[1:])]
        shared = 0
        while shared < min(len(keys), len(self.path)) and self.path[shared][0] == keys[shared]:
            shared += 1
        del self.path[shared:]
        for key, (role, text, size, ids) in zip(keys[shared:], turns[shared:], strict=True):
            segment, a, b = formatted(role, text)
            parent = self.path[-1][1] if self.path else -1
            up = self.rows[parent] if self.path else None
            position = up[3] + up[2] - up[1] if up else base
            attends = joined([*up[4], (up[1], up[2])]) if up else []
            loss = [self.chars + a, self.chars + b] if role == LOSS_ROLE else []
            self.rows.append((parent, self.tokens, self.tokens + size, position, attends, self.chars, loss))
            self.path.append((key, len(self.rows) - 1))
            self.text.append(segment)
            self.ids.append(ids)
            self.chars += len(segment)
            self.tokens += size
        self.convs.append((*conv, self.path[-1][1]))

    def batch(self, number: int) -> pa.RecordBatch:
        parent, start, end, position, attends, char, loss = (list(x) for x in zip(*self.rows, strict=True))
        conv, part, parts, leaf = (list(x) for x in zip(*self.convs, strict=True))
        ids = np.frombuffer(b"".join(self.ids), np.int32)
        seen = [[x for pair in a for x in pair] for a in attends]
        row = [number, "".join(self.text), ids, parent, start, end, position, seen, char, loss, conv, part, parts, leaf]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, PACK, strict=True)], schema=PACK)


def pack_stream(most: int):
    """Parts of conversations in depth-first order to packs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, pack = TaskContext.get().partitionId(), 0, Pack()
        for batch in batches:
            for row in batch.to_pylist():
                if pack.convs and pack.tokens + len(pack.convs) >= most:
                    yield pack.batch((task << 33) + number)
                    number, pack = number + 1, Pack()
                turns = [(t["role"], t["text"], t["size"], t["ids"]) for t in row["turns"]]
                conv = None if row["none"] else row["conv"]
                pack.add((conv, row["part"], row["parts"]), row["above"], row["base"], turns)
        if pack.convs:
            yield pack.batch((task << 33) + number)

    return run


def number_stream(encode):
    """Numbers the sorted turns of a partition, and counts the characters before each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src, now, lead, i, c = TaskContext.get().partitionId(), None, True, 0, 0
        for batch in batches:
            rows = []
            columns = (batch.column(n).to_pylist() for n in ("none", "conv", "role", "text"))
            for none, conv, role, text in zip(*columns, strict=True):
                if now != (none, conv):
                    now, lead, i, c = (none, conv), now is None, 0, 0
                segment = formatted(role, text)[0]
                ids = np.array(encode(segment), np.int32).tobytes() if encode else b""
                size = len(ids) // 4 if encode else len(segment)
                rows.append((src, lead, none, conv, i, c, len(segment), size, role, text, ids))
                i, c = i + 1, c + len(segment)
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(columns, NUMBERED, strict=True)], schema=NUMBERED
                )

    return run


def numbered_turns(turns: DataFrame, parts: int, encode) -> DataFrame:
    """Turns (none, conv, turn, role, text) with their place ``at`` in their conversation and its ``part``."""
    order = ["none", "conv", "turn", "role", "start", "hash", "salt"]
    keyed = turns.withColumns(
        {"start": F.left("text", F.lit(DEALT_CHARS)), "hash": F.xxhash64("text"), "salt": F.spark_partition_id()}
    )
    dealt = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = cut_to_table(
        dealt.select("none", "conv", "role", "text").mapInArrow(number_stream(encode), NUMBERED_TYPE), "chat-turns"
    )
    # a conversation that came from an earlier partition leads its own: at most one for each
    key = ["none", "conv"]
    crossing = rows.filter("lead").select(*key).distinct()
    before = Window.partitionBy(*key).orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        rows.select("src", *key, "chars")
        .join(F.broadcast(crossing), key)
        .groupBy("src", *key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
        .select("src", *key, F.sum("n").over(before).alias("n_before"), F.sum("chars").over(before).alias("c_before"))
        .filter(F.col("n_before") > 0)
    )
    zero = F.lit(0).cast("long")
    placed = rows.join(F.broadcast(counted), ["src", *key], "left")  # two rows a partition at most
    at = F.col("i") + F.coalesce("n_before", zero)
    chars = F.col("c") + F.coalesce("c_before", zero)
    part = F.expr("at div %d" % PART_TURNS) + F.expr("chars_before div %d" % PART_CHARS)
    placed = placed.withColumns({"at": at, "chars_before": chars})
    return placed.select(*key, part.cast("int").alias("part"), "at", "role", "text", "size", "ids")


def pack_conversations(
    turns: DataFrame,
    pack_tokens: int = PACK_TOKENS,
    encode: Callable[[str], list[int]] | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Packs of prefix trees from rows of turns.

    A pack has the text with every shared turn once, depth first, and per node (one turn)
    the parent's number (-1 for a root), its tokens [start, end) in the pack, the position id
    of its first token, the token intervals of its ancestors (pairs, touching ones joined),
    its first character, and the characters under the loss mask (the text of an assistant turn,
    else empty). ``conv_node`` is the last node of each conversation's part ``conv_part`` of
    ``conv_parts`` (counted from 0); nodes of a later part also see the whole path of the
    conversation's part before, and position ids count on. Tokens are code points,
    or what ``encode`` makes of a turn; ``token_ids`` holds the latter.

    Turns go by number, then role, the first 256 characters of the text and a hash of it;
    repeated rows are turns of their own. A null role or text is empty, a null turn comes first,
    rows without a conversation id are one conversation without id. Conversations that are equal
    share all nodes. A task holds parts (512 turns, or about a million characters and one text
    more) and the pack being filled; a single text must fit in a row. An empty table gives an
    empty one.
    """
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    conv = F.col(conv_col).cast("long")
    named = turns.select(
        conv.isNull().alias("none"), F.coalesce(conv, F.lit(0).cast("long")).alias("conv"),
        F.col(turn_col).alias("turn"), filled(role_col).alias("role"), filled(text_col).alias("text"),
    )
    placed = numbered_turns(named, parts, encode)
    key = ["none", "conv"]
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    hashes = placed.groupBy(*key, "part").agg(
        F.bit_xor(F.xxhash64("at", "role", "text")).alias("a"),
        F.bit_xor(F.xxhash64("text", "role", "at")).alias("b"),
        F.sum("size").alias("tokens"),
    )
    above = F.concat_ws(":", F.hex(F.bit_xor("a").over(before)), F.hex(F.bit_xor("b").over(before)))
    # a long text may leave numbers out, so parts are counted anew
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("part")) - 1
    several = hashes.select(
        *key, "part", nth.alias("nth"), above.alias("above"), F.sum("tokens").over(before).alias("base"),
        F.count(F.lit(1)).over(Window.partitionBy(*key)).cast("int").alias("parts"),
    ).filter(F.col("parts") > 1)
    held = placed.groupBy(*key, "part").agg(
        F.sort_array(F.collect_list(F.struct("at", "role", "text", "size", "ids"))).alias("turns")
    )
    order = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"]))
    sized = held.join(several, [*key, "part"], "left").select(
        *key, F.coalesce("nth", F.lit(0)).alias("part"), F.coalesce("parts", F.lit(1)).alias("parts"), filled("above").alias("above"),
        F.coalesce("base", F.lit(0).cast("long")).alias("base"), "turns", order.alias("order"),
    )
    dealt = sized.withColumn("start", F.slice("order", 1, DEALT_TURNS))
    dealt = dealt.repartitionByRange(parts, "above", "start", *key).sortWithinPartitions("above", "order", *key)
    return dealt.drop("start", "order").mapInArrow(pack_stream(pack_tokens), PACK_TYPE)


def read_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Packs to what each conversation's path says; of a conversation in parts, the parts' texts."""
    names = [c.split()[0] for c in READ_TYPE.split(", ")]
    for frame in frames:
        for pack in frame.itertuples(index=False):
            rows = []
            ends = [*pack.node_char[1:], len(pack.text)]
            for conv, part, parts, node in zip(
                pack.conv_id, pack.conv_part, pack.conv_parts, pack.conv_node, strict=True
            ):
                path = []
                while node >= 0:
                    path.append(node)
                    node = pack.node_parent[node]
                path.reverse()
                text = "".join(pack.text[pack.node_char[n] : ends[n]] for n in path)
                masks = (pack.node_loss[n] for n in path)
                loss = "".join(unescaped(pack.text[m[0] : m[1]]) for m in masks if len(m))
                conv = None if pd.isna(conv) else int(conv)
                if parts > 1:
                    rows.append((conv, None, None, None, None, None, part, parts, text, loss))
                else:
                    digest = Digest(conv)
                    digest.add(text, loss)
                    rows.append((*digest.row(), part, parts, None, None))
            yield pd.DataFrame(rows, columns=names, dtype=object)


class Digest:
    """What the parts of a conversation say, in the order in which they are added."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, loss: str) -> None:
        said = parsed(text)
        for role, body in said:
            self.turns.update(f"{role}\n{body}\n".encode())
        self.loss.update(loss.encode())
        self.n_turns += len(said)
        self.loss_chars += len(loss)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def whole_digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of conversations; parts, sorted, are added up one by one."""
    names = [c.split()[0] for c in DIGEST_TYPE.split(", ")]
    digest = None
    for frame in frames:
        rows = []
        for r in frame.astype(object).itertuples(index=False):
            if r.parts == 1:
                rows.append(tuple(r)[: len(names)])
                continue
            if r.part == 0:
                digest = Digest(None if pd.isna(r.conv_id) else int(r.conv_id))
            digest.add(r.text, r.loss)
            if r.part == r.parts - 1:
                rows.append(digest.row())
        yield pd.DataFrame(rows, columns=names, dtype=object)


def digests(packs: DataFrame) -> DataFrame:
    """Turns, loss texts and lengths of every conversation, read back from the packs.

    SHA-256 goes through a conversation in order, so its parts are streamed through one task.
    """
    read = packs.mapInPandas(read_back, READ_TYPE)
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInPandas(whole_digests, DIGEST_TYPE)
