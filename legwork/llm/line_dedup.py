"""Lines that many documents share, found by a range-partitioned stream over line hashes.

Every eligible line becomes a narrow row (128-bit hash of its key, document, position). The
rows are range-partitioned and sorted by hash, then by document from the largest id down, then
by position, so that a stream over a partition meets the first occurrence of a key first. A
run of one hash may cross partitions: rows of the first run of a partition, and of a last run
that is still short, leave the stream undecided, together with a summary of that run; the
summaries (two per partition at most) are put together and settle them. No text moves until
the keep bitmaps are applied.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.text import filled, free, plus, same, sized_broadcast, text_key
from legwork.session import cut_to_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Stands for a null id inside the stream; it sorts below all ids.
NO_ID = -(1 << 63)
#: Rows sent to the JVM at a time.
CHUNK = 200_000
#: Rows of an undecided run that a task holds; a longer run leaves the stream undecided.
HOLD = 500_000
ORDER = ["h1", "h2", "doc", "mark", "pos"]
LINE_ROW = "h1 long, h2 long, doc long, mark long, pos int, n_lines int"
STREAM_ROW = LINE_ROW + ", kind int, part int, last long, docs long"
DROP, OPEN, RUN = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """White space off both ends, A-Z lower-cased; bytes methods know ASCII only."""
    return line.strip().lower()


def eligible(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode()) >= least)


def hashed_lines(least: int):
    """Batches of (doc, mark, text) to one row per eligible line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], [], []]
        digests: list[bytes] = []

        def flush() -> pa.RecordBatch:
            halves = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)
            docs, marks, places, counts = columns
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(docs, pa.int64()),
                    pa.array(marks, pa.int64()), pa.array(places, pa.int32()), pa.array(counts, pa.int32()),
                ],
                names=["h1", "h2", "doc", "mark", "pos", "n_lines"],
            )
            digests.clear()
            for column in columns:
                column.clear()
            return out

        for batch in batches:
            for doc, mark, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                lines = text.encode().split(b"\n")
                for place, line in enumerate(lines):
                    key = line_key(line)
                    if eligible(key, least):
                        digests.append(xxhash.xxh3_128_digest(key))
                        for column, value in zip(columns, (doc, mark, place, len(lines)), strict=True):
                            column.append(value)
                        if len(digests) >= CHUNK:
                            yield flush()
        if digests:
            yield flush()

    return run


def stream_runs(need: int):
    """Sorted line rows to dropped rows, undecided rows and run summaries."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        held: pd.DataFrame | None = None  # rows of the last run while it has too few documents
        state = {"key": None, "first": None, "last": None, "docs": 0, "open": True, "begun": False}

        def out(rows: pd.DataFrame, kind: int) -> pd.DataFrame:
            return rows.assign(kind=kind, part=part, last=0, docs=0)

        def summary() -> pd.DataFrame:
            h1, h2 = state["key"]
            row = dict(h1=h1, h2=h2, doc=state["first"], mark=0, pos=0, n_lines=0, kind=RUN, part=part,
                       last=state["last"], docs=state["docs"])
            return pd.DataFrame([row])

        for frame in frames:
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
                held, state["key"] = None, None  # the held rows are counted again
            if not len(frame):
                continue
            h1, h2, doc = (frame[c].to_numpy() for c in ("h1", "h2", "doc"))
            new_run = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            new_doc = new_run | np.r_[True, doc[1:] != doc[:-1]]
            starts = np.flatnonzero(new_run)
            index = np.cumsum(new_run) - 1
            first = doc[starts].copy()
            carried = state["key"] == (h1[0], h2[0])
            if carried:
                new_doc[0] = doc[0] != state["last"]
                first[0] = state["first"]
            elif state["open"] and state["key"] is not None:
                yield summary()  # an undecided run ended with the batch before
            docs = np.add.reduceat(new_doc.astype(np.int64), starts)
            if carried:
                docs[0] += state["docs"]
            # The first run of a partition may have begun before; a carried open run stays open.
            undecided = np.zeros(len(starts), bool)
            undecided[0] = state["open"] and (carried or not state["begun"])
            state["begun"] = True
            gone = (docs >= need)[index] & (doc != first[index]) & ~undecided[index]
            if gone.any():
                yield out(frame[gone], DROP)
            if undecided[0]:
                yield out(frame[undecided[index]], OPEN)
                if len(starts) > 1:
                    state.update(key=(int(h1[0]), int(h2[0])), first=int(first[0]), docs=int(docs[0]),
                                 last=int(doc[starts[1] - 1]))
                    yield summary()
            state.update(key=(int(h1[-1]), int(h2[-1])), first=int(first[-1]), last=int(doc[-1]),
                         docs=int(docs[-1]), open=bool(undecided[-1]))
            if docs[-1] < need and not state["open"]:
                held = frame[starts[-1]:].drop_duplicates()
                if len(held) > HOLD:
                    yield out(held, OPEN)
                    held, state["open"] = None, True
        if held is not None:
            yield out(held, OPEN)
        if state["key"] is not None:
            yield summary()

    return run


def packed(counts: pd.Series, places: pd.Series) -> pd.Series:
    def one(lines: int, dropped) -> bytes:
        keep = np.ones(lines, bool)
        keep[np.asarray(dropped, dtype=np.int64)] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return pd.Series([one(n, p) for n, p in zip(counts, places, strict=True)])


def unpacked(keep: bytes, lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=lines).astype(bool)


def keep_bitmaps(
    docs: DataFrame, least_chars: int = 40, least_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document that loses lines: doc_id, text_mark, n_lines, n_dropped, keep.

    A line's key is the line stripped of white space and with A-Z lower-cased. A key of at
    least ``least_chars`` code points in at least ``least_docs`` documents loses its lines in
    all but the largest of these documents, which keeps all of its own. ``keep`` is a
    zlib-compressed bitmap, the first line in the highest bit. Documents without a row keep
    everything. Ids are integers and name documents: rows that repeat an id count as one
    document, and (id, text hash) tells their texts apart. All rows without an id count as one
    document below all others. Null and empty texts have no eligible line. Other columns are
    not read.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        text_key(F.col(text_col)).alias("mark"),
        F.col(text_col).alias("text"),
    ).filter("text IS NOT NULL")
    lines = rows.mapInArrow(hashed_lines(least_chars), LINE_ROW)
    order = [F.col("h1"), F.col("h2"), F.desc("doc"), F.col("mark"), F.col("pos")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stream = cut_to_table(ordered.mapInPandas(stream_runs(least_docs), STREAM_ROW), "line_runs")

    # Runs over partition borders: a document cut by a border is counted on both sides.
    line = Window.partitionBy("h1", "h2").orderBy("part")
    seen = F.lag("last").over(line)
    runs = stream.filter(F.col("kind") == RUN).withColumn(
        "docs", F.col("docs") - F.when(seen == F.col("doc"), 1).otherwise(0)
    )
    settled = runs.groupBy("h1", "h2").agg(F.sum("docs").alias("all_docs"), F.max("doc").alias("largest"))
    settled = sized_broadcast(settled.filter(F.col("all_docs") >= least_docs), 2 * parts, 64)
    late = stream.filter(F.col("kind") == OPEN).drop("docs").join(settled, ["h1", "h2"]).filter("doc <> largest")
    columns = ["doc", "mark", "n_lines", "pos"]
    dropped = stream.filter(F.col("kind") == DROP).select(*columns).union(late.select(*columns))
    per_doc = dropped.groupBy("doc", "mark").agg(
        F.first("n_lines").alias("n_lines"), F.collect_set("pos").alias("dropped")
    )
    pack = F.pandas_udf(packed, "binary")
    return per_doc.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        F.col("mark").alias("text_mark"),
        "n_lines",
        F.size("dropped").alias("n_dropped"),
        pack("n_lines", "dropped").alias("keep"),
    )


def kept_text(texts: pd.Series, keeps: pd.Series) -> pd.Series:
    def one(text, keep):
        if text is None or keep is None:
            return None
        lines = text.split("\n")
        return "\n".join(line for line, stays in zip(lines, unpacked(keep, len(lines)), strict=True) if stays)

    return pd.Series([one(t, k) for t, k in zip(texts, keeps, strict=True)], dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_lines (before), n_dropped and kept_text; a null text has one empty line.

    Only texts that lose lines pass through Python. Input columns of the new names give way.
    """
    keep_id, keep_mark, keep_dropped, keep_bits = (free(docs, f"keep_{n}") for n in ("id", "mark", "dropped", "bits"))
    keeps = bitmaps.select(
        F.col("doc_id").alias(keep_id), F.col("text_mark").alias(keep_mark),
        F.col("n_dropped").alias(keep_dropped), F.col("keep").alias(keep_bits),
    )
    both = same([F.col(id_col).cast("long"), text_key(F.col(text_col))], [F.col(keep_id), F.col(keep_mark)])
    joined = docs.join(keeps, both, "left")
    text = filled(text_col)
    cut = F.pandas_udf(kept_text, "string")(F.when(F.col(keep_bits).isNotNull(), text), F.col(keep_bits))
    out = plus(
        joined,
        n_lines=(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long"),
        n_dropped=F.coalesce(keep_dropped, F.lit(0)).cast("long"),
        kept_text=F.coalesce(cut, text),
    )
    return out.drop(keep_id, keep_mark, keep_dropped, keep_bits)
