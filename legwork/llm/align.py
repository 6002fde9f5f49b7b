"""Cross-tokenizer alignment: which tokens of two vocabularies end together, counted over a corpus.

A document is encoded by both tokenizers. Where a token of either side ends at the same byte, the
two are linked, and the tokens between two such places form a group. How often a pair of ids is
linked in the whole corpus is counted by an external merge:

* a task collects the links of a chunk of documents as packed (pair, document) records, sorts
  them, deals them by the low bits of their B id and stores one zstd run per part;
* a k-way heap merge adds up the runs of a part, at most ``FAN`` at a time, level by level;
* the last merge passes the pairs ordered by B id, so the highest count of a B id is known when its
  last pair has passed;
* the runs are merged once more, beside the totals of their part, and every record's share streams
  back to its chunk.

Runs are rows of tables, so Spark moves them, and a lost executor costs its tasks only.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwork.llm.token_counts import PATTERN
from legwork.session import cut_to_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIDE_A = "/opt/tokenizers/byte_bpe_50k.json"
SIDE_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Parts that the records are dealt to; a power of two.
PART_BITS = 6
PARTS = 1 << PART_BITS
#: A chunk ends after so many links or documents. A single document may have more links.
CHUNK_LINKS, DOC_BITS = 2_000_000, 13
#: Runs that one merge reads side by side.
FAN = 64
#: Records of one compressed block, and blocks of one row.
BLOCK, ROW_BLOCKS = 1 << 15, 32
RUN_TYPE = "part long, slice long, blocks array<binary>"
RUN_SCHEMA = pa.schema([("part", pa.int64()), ("slice", pa.int64()), ("blocks", pa.list_(pa.binary()))])


# --- blocks -----------------------------------------------------------------------------
def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compresses well."""
    return np.ascontiguousarray(values.astype(np.int64)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(raw: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(np.int64).reshape(n)


def pack_blocks(columns: list[np.ndarray]) -> list[bytes]:
    """Aligned columns, the first one sorted, as compressed blocks."""
    squeeze = zstandard.ZstdCompressor(level=1)
    out = []
    for at in range(0, len(columns[0]), BLOCK):
        first, *rest = [c[at : at + BLOCK] for c in columns]
        steps = np.diff(first, prepend=0)
        out.append(squeeze.compress(b"".join(_planes(c) for c in (steps, *rest))))
    return out


def unpack_block(block: bytes, width: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = len(raw) // (8 * width)
    first, *rest = [_unplanes(raw[8 * n * i : 8 * n * (i + 1)], n) for i in range(width)]
    return [np.cumsum(first), *rest]


def merge(runs: list[Iterator[list[np.ndarray]]]) -> Iterator[list[tuple[int, list[np.ndarray]]]]:
    """k-way merge of runs of sorted blocks.

    Yields rounds in rising order: the (run, columns) of all records up to the least end of the
    current blocks. All records of a key lie in one round, or in rounds that follow each other
    if the key is the last of its round.
    """
    heads, ends = {}, []

    def advance(i: int) -> None:
        block = next(runs[i], None)
        if block is not None:
            heads[i] = block
            heapq.heappush(ends, (int(block[0][-1]), i))

    for i in range(len(runs)):
        advance(i)
    while ends:
        bound = ends[0][0]
        taken = []
        for i, columns in heads.items():
            cut = int(np.searchsorted(columns[0], bound, "right"))
            if cut:
                taken.append((i, [c[:cut] for c in columns]))
                heads[i] = [c[cut:] for c in columns]
        while ends and ends[0][0] == bound:
            i = heapq.heappop(ends)[1]
            del heads[i]
            advance(i)
        yield taken


def summed(runs: list[Iterator[list[np.ndarray]]]) -> Iterator[list[np.ndarray]]:
    """(keys, counts) of the merged runs, every key once, in order."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for taken in merge(runs):
        keys = np.concatenate([keys, *[c[0] for _, c in taken]])
        counts = np.concatenate([counts, *[c[1] for _, c in taken]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        if len(keys) > BLOCK:  # the last key can go on in the next round
            yield [keys[:-1], counts[:-1]]
            keys, counts = keys[-1:], counts[-1:]
    if len(keys):
        yield [keys, counts]


def with_maxima(blocks: Iterator[list[np.ndarray]], a_bits: int) -> Iterator[list[np.ndarray]]:
    """Adds whether a pair has the highest count of its B id. A B id's pairs are held together."""
    held: list[list[np.ndarray]] = []

    def flush(columns):
        keys, counts = columns
        sides = keys >> a_bits
        starts = np.flatnonzero(np.diff(sides, prepend=sides[0] - 1))
        tops = np.maximum.reduceat(counts, starts)
        return [keys, counts, (counts == np.repeat(tops, np.diff(np.r_[starts, len(keys)]))).astype(np.int64)]

    for keys, counts in blocks:
        sides = keys >> a_bits
        cut = int(np.searchsorted(sides, sides[-1], "left"))
        if cut == 0 and held and held[-1][0][-1] >> a_bits == sides[0]:
            held.append([keys, counts])
            continue
        whole = [np.concatenate(c) for c in zip(*held, [keys[:cut], counts[:cut]])]
        if len(whole[0]):
            yield flush(whole)
        held = [[keys[cut:], counts[cut:]]]
    if held:
        yield flush([np.concatenate(c) for c in zip(*held)])


# --- encoding ---------------------------------------------------------------------------
class Sides(NamedTuple):
    """The files of both vocabularies, as bytes."""

    a: bytes
    b: bytes
    pattern: str

    def widths(self) -> tuple[int, int]:
        """Bits of an A id and of a B id."""
        top = max(json.loads(self.a)["model"]["vocab"].values())
        model = sentencepiece.SentencePieceProcessor(model_proto=self.b)
        return top.bit_length(), max(1, (model.vocab_size() - 1).bit_length())


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes_a(file: bytes) -> dict[bytes, int]:
    """Bytes to id of the byte-level vocabulary; special tokens are left out."""
    letters, data = byte_letters(), json.loads(file)
    special = {t["content"] for t in data["added_tokens"] if t["special"]}
    return {
        bytes(letters[c] for c in token): i for token, i in data["model"]["vocab"].items() if token not in special
    }


def token_bytes_b(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    return [
        bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i)
        else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.vocab_size())
    ]


class Encoder:
    """Both tokenizers with the bytes and the written ids of their tokens."""

    def __init__(self, sides: Sides):
        ranks = token_bytes_a(sides.a)
        self.a = tiktoken.Encoding("a", pat_str=sides.pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=sides.b)
        of_a = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            of_a[i] = piece
        self.bytes_a, self.sizes_a, self.written_a = self._tables(of_a, "|")
        self.bytes_b, self.sizes_b, self.written_b = self._tables(token_bytes_b(self.b), ";")

    @staticmethod
    def _tables(pieces: list[bytes], end: str):
        known = np.empty(len(pieces), object)
        known[:] = pieces
        written = np.empty(2 * len(pieces), object)
        written[:] = [f"{i}{mark}" for mark in (",", end) for i in range(len(pieces))]
        return known, np.array([len(p) for p in pieces], np.int64), written

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None if there are none or they do not spell the text."""
        if not text:
            return None
        raw = b" " + text.encode()
        a = np.asarray(self.a.encode_ordinary(" " + text), np.int64)
        b = np.asarray(self.b.encode(text), np.int64)
        for found, known in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join(known[found].tolist()) != raw:
                return None
        return a, b

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``a`` and ``b`` of the tokens that end together."""
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        near = np.searchsorted(ends_b, ends_a)
        both = np.flatnonzero(ends_b[near] == ends_a)
        return both, near[both]

    def groups(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of every group."""
        written = np.empty(len(a) + len(b), object)
        kind_a, kind_b = a.copy(), b.copy()
        kind_a[in_a] += len(self.sizes_a)
        kind_b[in_b] += len(self.sizes_b)
        # tokens of the other side that stand before: for A those of earlier groups, for B also of its own
        before_a = np.repeat(np.r_[0, in_b[:-1] + 1], np.diff(in_a, prepend=-1))
        before_b = np.repeat(in_a + 1, np.diff(in_b, prepend=-1))
        written[np.arange(len(a)) + before_a] = self.written_a[kind_a]
        written[np.arange(len(b)) + before_b] = self.written_b[kind_b]
        return "".join(written.tolist())[:-1]


DOC_FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def encoded_runs(sides, a_bits: int, b_bits: int, id_type: pa.DataType):
    """Documents to their own rows (part -1) and to the runs of their chunks."""
    schema = pa.schema([
        ("part", pa.int64()), ("chunk", pa.int64()), ("doc", pa.int64()), ("doc_id", id_type),
        *[(name, pa.int64()) for name in DOC_FIELDS], ("groups_sha256", pa.string()), ("blocks", pa.list_(pa.binary())),
    ])

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Sides(*sides.value))
        chunk = TaskContext.get().partitionId() << 32
        docs, records, links = 0, [], 0

        def runs_of_chunk() -> list[dict]:
            packed = np.concatenate([*records, np.zeros(0, np.int64)])
            packed.sort()
            starts = np.flatnonzero(np.diff(packed, prepend=-1))
            packed, times = packed[starts], np.diff(np.r_[starts, len(packed)])
            borders = np.searchsorted(packed >> (a_bits + b_bits + DOC_BITS), np.arange(PARTS + 1))
            rows = []
            for part in range(PARTS):
                low, high = borders[part], borders[part + 1]
                if low < high:
                    found = packed[low:high]
                    columns = [found >> DOC_BITS, found & ((1 << DOC_BITS) - 1), times[low:high]]
                    rows.append({"part": part, "chunk": chunk, "blocks": pack_blocks(columns)})
            return rows

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = {"part": -1, "chunk": chunk, "doc": docs, "doc_id": doc_id, "groups_sha256": ""}
                row |= dict.fromkeys(DOC_FIELDS, 0)
                ids = encoder.ids(text)
                if ids is not None:
                    a, b = ids
                    in_a, in_b = encoder.align(a, b)
                    pairs = (((b[in_b] & (PARTS - 1)) << b_bits | b[in_b]) << a_bits) | a[in_a]
                    records.append(pairs << DOC_BITS | docs)
                    links += len(in_a)
                    row |= {"n_a": len(a), "n_b": len(b), "n_groups": len(in_a), "n_links": len(in_a)}
                    row["groups_sha256"] = hashlib.sha256(encoder.groups(a, b, in_a, in_b).encode()).hexdigest()
                rows.append(row)
                docs += 1
                if docs == 1 << DOC_BITS or links >= CHUNK_LINKS:
                    rows += runs_of_chunk()
                    chunk, docs, records, links = chunk + 1, 0, [], 0
            yield batch_of(rows)
        if docs:
            yield batch_of(runs_of_chunk())

    return run


# --- merging ----------------------------------------------------------------------------
def _blocks_of(column, width: int) -> list[Iterator[list[np.ndarray]]]:
    """One iterator over blocks per row of packed blocks."""

    def reader(row: int):
        for block in column[row].values:
            yield unpack_block(block.as_buffer(), width)

    return [reader(row) for row in range(len(column))]


def _pair_counts(run: Iterator[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """(pair, document, times) to (pair, times)."""
    for keys, _, times in run:
        yield [keys, times]


def _rows(part: int, piece: int, blocks: Iterator[list[np.ndarray]]) -> pa.Table:
    packed = [b for columns in blocks for b in pack_blocks(columns)]
    rows = [packed[i : i + ROW_BLOCKS] for i in range(0, len(packed), ROW_BLOCKS)]
    return pa.table([[part] * len(rows), [piece] * len(rows), pa.array(rows, pa.list_(pa.binary()))], schema=RUN_SCHEMA)


def _chained(column, places: np.ndarray, width: int) -> list[Iterator[list[np.ndarray]]]:
    """Rows that begin where others of the run end, read one after the other."""
    runs: dict[int, list[int]] = {}
    for row, place in enumerate(places):
        runs.setdefault(int(place), []).append(row)
    readers = _blocks_of(column, width)

    def chain(rows: list[int]):
        loaded = sorted((unpack_block(column[r].values[0].as_buffer(), width)[0][0], r) for r in rows)
        for _, r in loaded:
            yield from readers[r]

    return [chain(rows) for rows in runs.values()]


def count_runs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Runs of one part and slice to one counted run."""
    part, piece = (k.as_py() for k in key)
    runs = [_pair_counts(r) for r in _blocks_of(table.column("blocks").combine_chunks(), 3)]
    return _rows(part, piece, summed(runs))


def merge_counts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Counted runs of one part, of up to ``FAN`` slices, to one counted run."""
    part, piece = (k.as_py() for k in key)
    runs = _chained(table.column("blocks").combine_chunks(), table.column("slice").to_numpy(), 2)
    return _rows(part, piece, summed(runs))


def rank_counts(a_bits: int):
    """The one counted run of a part, with its maxima."""

    def rank(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        runs = _chained(table.column("blocks").combine_chunks(), np.zeros(len(table)), 2)
        return _rows(key[0].as_py(), 0, with_maxima(summed(runs), a_bits))

    return rank


SHARE_SCHEMA = pa.schema([("chunk", pa.int64()), ("block", pa.binary())])


def shares(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """Per chunk: document, links whose pair is its B id's best, sum of the pairs' counts."""
    if not len(runs):
        return SHARE_SCHEMA.empty_table()
    sides = _chained(totals.column("blocks").combine_chunks(), np.zeros(len(totals)), 3)
    sides += _blocks_of(runs.column("blocks").combine_chunks(), 3)
    chunks = runs.column("chunk").to_pylist()
    best = np.zeros((len(chunks), 1 << DOC_BITS), np.int64)
    sums = np.zeros_like(best)
    keys = counts = tops = np.zeros(0, np.int64)
    for taken in merge(sides):
        for more in (columns for i, columns in taken if i == 0):
            keys, counts, tops = (np.concatenate([old[-1:], new]) for old, new in zip((keys, counts, tops), more))
        for i, columns in taken:
            if i:
                found, docs, times = columns
                at = np.searchsorted(keys, found)
                np.add.at(sums[i - 1], docs, counts[at] * times)
                np.add.at(best[i - 1], docs, tops[at] * times)
    rows = []
    for i in range(len(chunks)):
        docs = np.flatnonzero(sums[i])
        rows.append(b"".join(pack_blocks([docs, best[i][docs], sums[i][docs]])))
    return pa.table([pa.array(chunks, pa.int64()), pa.array(rows, pa.binary())], schema=SHARE_SCHEMA)


DOC_SCHEMA = pa.schema([("chunk", pa.int64()), ("doc", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def add_shares(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The shares of a chunk from all parts, added up per document."""
    best, sums = np.zeros(1 << DOC_BITS, np.int64), np.zeros(1 << DOC_BITS, np.int64)
    for block in table.column("block"):
        docs, tops, parts = unpack_block(block.as_buffer(), 3)
        best[docs] += tops
        sums[docs] += parts
    docs = np.flatnonzero(sums)
    chunk = np.full(len(docs), key[0].as_py())
    return pa.table([chunk, docs, best[docs], sums[docs]], schema=DOC_SCHEMA)


def align_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    side_a: str = SIDE_A,
    side_b: str = SIDE_B,
    pattern: str = PATTERN,
) -> tuple[DataFrame, DataFrame, int]:
    """Aligns all texts: (documents, pair totals, bits of an A id).

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, one row per
    row of ``docs``. A text that is null or empty, or that one side cannot spell, has zeros and an
    empty digest. Rows are encoded alone, so repeated rows give repeated results and count as often
    as they stand there; a very long text is one document of its chunk, held by one task. Other columns
    are not read, and an empty table gives empty results. Pair totals are packed runs, see
    ``pair_table``. The driver reads the two vocabulary files (about 2 MB) and sends them along.
    """
    spark = docs.sparkSession
    with open(side_a, "rb") as file_a, open(side_b, "rb") as file_b:
        files = Sides(file_a.read(), file_b.read(), pattern)
    a_bits, b_bits = files.widths()
    if PART_BITS + a_bits + b_bits + DOC_BITS > 63:
        raise ValueError("The ids of these vocabularies do not fit into a record")
    sides = spark.sparkContext.broadcast(tuple(files))  # executors need no copy of the class
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    id_type = spark.createDataFrame([], f"x {kind}").toArrow().schema.field(0).type
    out_type = (
        f"part long, chunk long, doc long, doc_id {kind}, {', '.join(f'{n} long' for n in DOC_FIELDS)}, "
        "groups_sha256 string, blocks array<binary>"
    )
    stored = cut_to_table(rows.mapInArrow(encoded_runs(sides, a_bits, b_bits, id_type), out_type), "align-runs")

    runs = stored.filter("part >= 0").select("part", "chunk", "blocks")
    n_chunks = stored.filter("part < 0").agg(F.countDistinct("chunk")).first()[0]
    slices = max(1, -(-n_chunks // FAN))
    runs = runs.withColumn("slice", F.pmod(F.xxhash64("chunk"), F.lit(slices)))
    counted = runs.groupBy("part", "slice").applyInArrow(count_runs, RUN_TYPE)
    left = slices
    while left > 1:
        counted = cut_to_table(counted, "align-counts")
        left = -(-left // FAN)
        counted = counted.groupBy("part", F.floor(F.col("slice") / FAN).alias("next")).applyInArrow(merge_counts, RUN_TYPE)
    totals = counted.groupBy("part").applyInArrow(rank_counts(a_bits), RUN_TYPE)
    totals = cut_to_table(totals.select("part", "blocks"), "align-totals")

    spread = totals.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    back = runs.groupBy("part", "slice").cogroup(spread.groupBy("part", "slice")).applyInArrow(shares, "chunk long, block binary")
    added = back.groupBy("chunk").applyInArrow(add_shares, "chunk long, doc long, n_best long, count_sum long")
    found = stored.filter("part < 0").drop("part", "blocks").join(added, ["chunk", "doc"], "left")
    found = found.fillna(0, ["n_best", "count_sum"])
    return found.select("doc_id", *DOC_FIELDS, "n_best", "count_sum", "groups_sha256"), totals, a_bits


def pair_table(totals: DataFrame, a_bits: int, b_bits: int) -> DataFrame:
    """(b, a, links, best) of the packed totals."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0):
                for block in row.values:
                    keys, counts, tops = unpack_block(block.as_buffer(), 3)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in ((keys >> a_bits) & ((1 << b_bits) - 1), keys & ((1 << a_bits) - 1), counts, tops > 0)],
                        names=["b", "a", "links", "best"],
                    )

    return totals.select("blocks").mapInArrow(unpacked, "b long, a long, links long, best boolean")
