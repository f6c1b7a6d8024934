"""Randomly accessible compressed corpora.

Each document line is compressed as its own gzip member; members are
concatenated, so any document is ``bytes[start:end)`` of the file followed
by one gunzip, while the whole file still reads as ordinary gzip text.

Files are written by a Spark data source: a task writes its files, cut by
size, and a table of their members under a temporary name of the job, and
reports them; only when all tasks have ended does the driver move them to
their places, so a lost or repeated task leaves nothing behind. Paths may be
of any file system that ``pyarrow.fs`` opens. Readers take byte ranges of the
files, so a file is read by as many tasks as its size asks for.

Compression is the only Python step (``mtime=0`` makes members byte-identical
across runs and task retries). Offsets in one concatenated file are the
two-level running sum of member sizes.
"""

from __future__ import annotations

import gzip
import sys
import uuid as _uuid
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import BinaryType

from corpusforge.operators.offsets import json_path, ordered_running_sum
from corpusforge.session import cut

#: A part file ends when it has grown to this size; bytes that one reading task takes.
MAX_FILE_BYTES, READ_BYTES = 1 << 30, 64 << 20
MEMBERS = "part_file string, doc_id string, start long, end long"
_MEMBERS_ARROW = pa.schema([("part_file", pa.string()), ("doc_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_MEMBER_ROWS = 1 << 16


@F.pandas_udf(BinaryType())
def gzip_member(lines: pd.Series) -> pd.Series:
    """``gzip(line + '\\n')`` as one member with a zero timestamp."""
    return lines.map(lambda s: None if s is None else gzip.compress((s + "\n").encode("utf-8"), mtime=0))


# Python workers may not have this package on their path: ship this module's
# functions (the UDF bodies) by value with each task instead of by import name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def member_offsets(lines: DataFrame, order_key: str, id_field: str = "docno",
                   line_col: str = "line") -> DataFrame:
    """``(doc_id, start, end)`` of each member in one concatenated file (ordered by ``order_key``)."""
    x = lines.select(order_key, F.get_json_object(F.col(line_col), json_path(id_field)).alias("doc_id"),
                     F.octet_length(gzip_member(F.col(line_col))).alias("__bytes"))
    # Written once, so each line is compressed a single time.
    return ordered_running_sum(cut(x), "__bytes", order_key).select(order_key, "doc_id", "start", "end")


def _files(path: str):
    """File system and path of a URI or of an absolute path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path.rstrip("/"))


@dataclass
class _Written(WriterCommitMessage):
    parts: list  # (temporary name, final name) below the two folders


class _MemberWriter(DataSourceArrowWriter):
    """Rows (doc_id, line), in order, to part files of members and tables of their offsets."""

    def __init__(self, out_dir: str, manifest_dir: str, max_file_bytes: int):
        self.out_dir, self.manifest_dir, self.max_file_bytes = out_dir, manifest_dir, max_file_bytes
        self.job = f"_temporary-{_uuid.uuid4().hex}"  # readers skip names that begin so

    def write(self, iterator):
        import pyarrow.parquet as pq
        (out_fs, out), (man_fs, man) = _files(self.out_dir), _files(self.manifest_dir)
        task = TaskContext.get()
        temporary = f"{self.job}/{task.partitionId():05d}-{task.taskAttemptId()}"
        for f, base in ((out_fs, out), (man_fs, man)):
            f.create_dir(f"{base}/{temporary}", recursive=True)
        parts, data, table, rows, size = [], None, None, [], 0

        def flush():
            nonlocal rows
            if rows:
                table.write_table(pa.Table.from_pydict(dict(zip(_MEMBERS_ARROW.names, zip(*rows))), schema=_MEMBERS_ARROW))
                rows = []

        def close():
            nonlocal data, table
            if data is not None:
                flush()
                data.close()
                table.close()
            data = table = None
        try:
            for batch in iterator:
                for doc_id, line in zip(batch.column("doc_id").to_pylist(), batch.column("line").to_pylist()):
                    if data is None or size >= self.max_file_bytes:
                        close()
                        name = f"part-{task.partitionId():05d}-{len(parts):03d}"
                        parts.append((temporary, name))
                        data = out_fs.open_output_stream(f"{out}/{temporary}/{name}.jsonl.gz", compression=None)
                        table = pq.ParquetWriter(man_fs.open_output_stream(f"{man}/{temporary}/{name}.parquet"), _MEMBERS_ARROW)
                        size = 0
                    member = gzip.compress((line + "\n").encode("utf-8"), mtime=0)
                    data.write(member)
                    rows.append((f"{name}.jsonl.gz", doc_id, size, size + len(member)))
                    size += len(member)
                    if len(rows) >= _MEMBER_ROWS:
                        flush()
        finally:
            close()
        return _Written(parts)

    def _ends(self):
        return ((*_files(self.out_dir), ".jsonl.gz"), (*_files(self.manifest_dir), ".parquet"))

    def commit(self, messages):
        from pyarrow import fs
        for f, base, ending in self._ends():
            # What an earlier job left in its place goes first.
            for old in f.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                if old.base_name.startswith("part-") and old.base_name.endswith(ending):
                    f.delete_file(old.path)
            for m in messages:
                for temporary, name in m.parts if m is not None else ():
                    f.move(f"{base}/{temporary}/{name}{ending}", f"{base}/{name}{ending}")
        self._clean()

    def abort(self, messages):
        self._clean()

    def _clean(self):
        from pyarrow import fs
        for f, base, _ in self._ends():
            if f.get_file_info(f"{base}/{self.job}").type == fs.FileType.Directory:
                f.delete_dir(f"{base}/{self.job}")


class MemberFiles(DataSource):
    """The data source ``gzip_members``: options ``path``, ``manifest`` and ``max_file_bytes``."""

    @classmethod
    def name(cls):
        return "gzip_members"

    def schema(self):
        return "doc_id string, line string"

    def writer(self, schema, overwrite):
        return _MemberWriter(self.options["path"], self.options["manifest"], int(self.options.get("max_file_bytes", MAX_FILE_BYTES)))


def write_member_files(lines: DataFrame, order_key: str, out_dir: str, manifest_path: str, num_tasks: int | None = None,
                       id_field: str = "docno", line_col: str = "line", max_file_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Write ``part-*.jsonl.gz`` files of gzip members and the table of their members, which is returned.

    Files follow ``order_key`` ranges, one task each, and a task's files are
    cut at ``max_file_bytes``; offsets are local to each file, so no global
    sum is needed. Rows of ``out_dir`` and ``manifest_path`` (folders, by URI
    or absolute path) replace those of an earlier job when this one ends.
    """
    spark = lines.sparkSession
    spark.dataSource.register(MemberFiles)
    rows = lines.select(order_key, F.get_json_object(F.col(line_col), json_path(id_field)).alias("doc_id"), F.col(line_col).alias("line"))
    ranged = rows.repartitionByRange(num_tasks, order_key) if num_tasks else rows.repartitionByRange(order_key)
    (ranged.sortWithinPartitions(order_key).select("doc_id", "line").write.format("gzip_members").mode("append")
     .option("manifest", manifest_path).option("max_file_bytes", str(max_file_bytes)).save(out_dir))
    return read_manifest(spark, manifest_path)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """(part_file, doc_id, start, end) of every member."""
    return spark.read.schema(MEMBERS).parquet(manifest_path)


def read_members(manifest: DataFrame, base_dir: str, read_bytes: int = READ_BYTES) -> DataFrame:
    """Fetch documents by byte range: ``(doc_id, line)`` for every manifest row.

    Random access as a distributed read: members gather by stretches of
    ``read_bytes`` of a file and are read in one forward pass, so a large file
    is read by many tasks.
    """
    ordered = manifest.select("part_file", "doc_id", "start", "end", F.floor(F.col("start") / read_bytes).alias("stretch"))
    ordered = ordered.repartition("part_file", "stretch").sortWithinPartitions("part_file", "start")

    def fetch(batches):
        files, base = _files(base_dir)
        handle, current = None, None
        try:
            for batch in batches:
                lines = []
                for name, start, end in zip(*(batch.column(c).to_pylist() for c in ("part_file", "start", "end"))):
                    if name != current:
                        if handle is not None:
                            handle.close()
                        handle, current = files.open_input_file(f"{base}/{name}"), name
                    handle.seek(start)
                    lines.append(gzip.decompress(handle.read(end - start)).decode("utf-8").removesuffix("\n"))
                yield pa.record_batch([batch.column("doc_id"), pa.array(lines, pa.string())], names=["doc_id", "line"])
        finally:
            if handle is not None:
                handle.close()

    return ordered.mapInArrow(fetch, "doc_id string, line string")


def read_member(path: str, start: int, end: int) -> str:
    """Fetch one document by byte range (for checks and random access)."""
    files, at = _files(path)
    with files.open_input_file(at) as fh:
        fh.seek(start)
        return gzip.decompress(fh.read(end - start)).decode("utf-8")
