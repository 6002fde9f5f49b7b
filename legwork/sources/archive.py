"""Zipped monthly archives -> rows and back, months already loaded left out.

Reading is a Spark data source that plans one partition for each CSV member: planning lists the
archives and their tables of contents, a task seeks to its member and reads it in chunks, so
neither an archive nor a member is ever held as a whole.
"""

from __future__ import annotations

import sys
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from legwork.schemas import RAW_LEG_TYPES

# tasks get the functions of this module by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_ROWS = 50_000
FORMAT = "zipped_legs"
ARCHIVE_SCHEMA = "archive string, " + ", ".join(f"`{n}` string" for n in RAW_LEG_TYPES)
WRITTEN_SCHEMA = "archive string, members int, rows long"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if colon and scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Member(InputPartition):
    """One CSV file of one archive."""

    path: str
    member: str

    def __init__(self, path: str, member: str):
        self.path, self.member = path, member


class _MemberReader(DataSourceReader):
    def __init__(self, root: str, skip: frozenset[str]):
        self.root, self.skip = root, skip

    def partitions(self) -> list[Member]:
        files, inside = _opened(self.root)
        found = []
        for info in sorted(files.get_file_info(fs.FileSelector(inside)), key=lambda i: i.path):
            if info.is_file and info.base_name.lower().endswith(".zip") and info.base_name not in self.skip:
                with files.open_input_file(info.path) as raw, zipfile.ZipFile(raw) as packed:
                    names = [n for n in packed.namelist() if n.lower().endswith(".csv")]
                found += [Member(info.path, n) for n in names]
        return found

    def read(self, partition: Member | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no members at all
            return
        columns = list(RAW_LEG_TYPES)
        schema = pa.schema([("archive", pa.string()), *[(n, pa.string()) for n in columns]])
        files, _ = _opened(self.root)
        with files.open_input_file(partition.path) as raw, zipfile.ZipFile(raw) as packed:
            with packed.open(partition.member) as lines:
                for chunk in pd.read_csv(lines, usecols=columns, dtype=str, chunksize=CHUNK_ROWS):
                    chunk.insert(0, "archive", partition.path.rsplit("/", 1)[-1])
                    yield pa.RecordBatch.from_pandas(chunk[schema.names], schema, preserve_index=False)


class ZippedLegs(DataSource):
    """CSV members of the zip files in the folder ``path``; archives named in ``skip`` are left out."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ARCHIVE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _MemberReader(self.options["path"], frozenset(self.options.get("skip", "").split("/")))


def read_archives(spark: SparkSession, path: str, loaded: DataFrame | None = None) -> DataFrame:
    """Typed leg rows of all zip files in the folder ``path``; one member is one unit of work.

    ``loaded`` lists archive names (column ``archive``) that are not read again. Their names go
    to the planner, which lists the archives anyway.
    """
    spark.dataSource.register(ZippedLegs)
    names = [] if loaded is None else [r["archive"] for r in loaded.select("archive").distinct().collect()]
    # names of files hold no slash
    rows = spark.read.format(FORMAT).option("skip", "/".join(n for n in names if n)).load(path)
    return rows.select("archive", *[F.col(n).cast(kind).alias(n) for n, kind in RAW_LEG_TYPES.items()])


def _archive_writer(root: str, member_rows: int):
    """Rows sorted by month to one archive per month and partition, in members of bounded size."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = _opened(root)
        files.create_dir(folder, recursive=True)
        task = TaskContext.get()
        month = packed = sink = None
        members = rows = 0

        def finish() -> pd.DataFrame:
            packed.close()
            sink.close()
            name = f"legs-{month[0]}-{month[1]}-{task.partitionId()}.zip"
            files.move(part, f"{folder}/{name}")  # a repeated task replaces its archive
            return pd.DataFrame([(name, members, rows)], columns=["archive", "members", "rows"])

        part = f"{folder}/part-{task.taskAttemptId()}"
        for frame in frames:
            for key, chunk in frame.groupby(["Year", "Month"], sort=False, dropna=False):
                if key != month:
                    if packed is not None:
                        yield finish()
                    sink = files.open_output_stream(part)
                    packed = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                    month, members, rows = key, 0, 0
                for begin in range(0, len(chunk), member_rows):
                    piece = chunk.iloc[begin : begin + member_rows]
                    packed.writestr(f"legs-{members}.csv", piece.to_csv(index=False))
                    members, rows = members + 1, rows + len(piece)
        if packed is not None:
            yield finish()

    return run


def write_archives(df: DataFrame, path: str, member_rows: int = CHUNK_ROWS) -> DataFrame:
    """Raw legs as zip files by month in the folder ``path``; returns (archive, members, rows).

    Months are dealt by ranges of (month, hash of the row), so a large month becomes several
    archives. Null and empty texts are both empty fields. The files are written at once.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select([F.col(n).cast("string").alias(n) for n in RAW_LEG_TYPES])
    keyed = texts.withColumn("_hash", F.xxhash64(*RAW_LEG_TYPES))
    dealt = keyed.repartitionByRange(parts, "Year", "Month", "_hash").sortWithinPartitions("Year", "Month").drop("_hash")
    written = dealt.mapInPandas(_archive_writer(path, member_rows), WRITTEN_SCHEMA).collect()  # a row per file
    return spark.createDataFrame(written, WRITTEN_SCHEMA)
