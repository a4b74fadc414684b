"""Bytes of files, read and written in tasks through the file system that a path names.

Files are streamed in chunks, so a file may have any size; nothing here is held whole.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20

# Names that Hadoop file systems go by and the reading library does not.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}

#: What can happen to a file on its way. ``cut``: its end is missing. ``overwritten``: bytes of its first
#: data page are replaced, its size stays. ``emptied``: it has no bytes. ``whole``: nothing.
KINDS = ("whole", "cut", "overwritten", "emptied")

# A cut file lacks so many bytes, or a tenth of them if that is less.
CUT_BYTES = 4096

_OVERWRITTEN = range(4, 604)


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it. A path without a scheme is a local one."""
    scheme, colon, rest = uri.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), re.sub("^/+", "/", rest or uri)
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system that the session itself would use for it."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    return plain.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(plain).toString()


@contextmanager
def replaced_folder(spark: SparkSession, path: str) -> Iterator[str]:
    """A new folder to write to, hidden from scans, that takes the place of ``path`` when the block ends well."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = store.makeQualified(folder)
    part = spark._jvm.org.apache.hadoop.fs.Path(folder.getParent(), f".{folder.getName()}.{uuid.uuid4().hex}")
    store.mkdirs(part)
    try:
        yield part.toString()
        store.delete(folder, True)
        if not store.rename(part, folder):
            raise OSError(f"{part.toString()} could not be renamed to {folder.toString()}.")
    finally:
        store.delete(part, True)


def digest(uri: str, chunk: int = CHUNK_BYTES) -> str:
    """SHA-256 of a file's bytes."""
    store, path = located(uri)
    state = hashlib.sha256()
    with store.open_input_stream(path) as stream:
        while data := stream.read(chunk):
            state.update(data)
    return state.hexdigest()


def parquet_footer(uri: str) -> tuple[list[str], int | None, str | None]:
    """(column names, rows, error) of a Parquet file; only its end is read."""
    store, path = located(uri)
    try:
        with store.open_input_file(path) as file:
            metadata = pq.read_metadata(file)
            return metadata.schema.to_arrow_schema().names, metadata.num_rows, None
    except Exception as error:  # any unreadable file is a finding, not a failure
        # Fixed value: error texts of reports hold at most 500 characters.
        return [], None, f"{type(error).__name__}: {str(error)[:500]}"


def with_footers(listing: DataFrame, *, digests: bool) -> DataFrame:
    """A listing with a ``path`` column, and ``columns``, ``footer_rows``, ``footer_error`` and ``sha256``.

    Without ``digests`` only the ends of the files are read. The listing's partitions are the scan's, cut
    by the files' sizes, so the bytes are spread over tasks.
    """
    new = {
        "columns": ("array<string>", pa.list_(pa.string())),
        "footer_rows": ("bigint", pa.int64()),
        "footer_error": ("string", pa.string()),
        "sha256": ("string", pa.string()),
    }
    at = listing.columns.index("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(at).to_pylist()
            found = [(*parquet_footer(p), digest(p) if digests else None) for p in paths]
            columns = list(zip(*found)) or [()] * len(new)
            added = [pa.array(c, kind) for c, (_, kind) in zip(columns, new.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *new])

    held = [f"`{f.name}` {f.dataType.simpleString()}" for f in listing.schema]
    return listing.mapInArrow(read, ", ".join([*held, *(f"{name} {sql}" for name, (sql, _) in new.items())]))


def with_key_ranges(listing: DataFrame, column: str) -> DataFrame:
    """A listing with a ``path`` column, and the rows, least and greatest text of ``column`` per file.

    All from the statistics in the footers. Files whose statistics lack the column have no range.
    """
    at = listing.columns.index("path")

    def ranges(uri: str) -> tuple[int, str | None, str | None]:
        store, path = located(uri)
        with store.open_input_file(path) as file:
            metadata = pq.read_metadata(file)
        lows, highs = [], []
        for group in map(metadata.row_group, range(metadata.num_row_groups)):
            for found in map(group.column, range(group.num_columns)):
                if found.path_in_schema == column and found.statistics is not None and found.statistics.has_min_max:
                    lows.append(str(found.statistics.min))
                    highs.append(str(found.statistics.max))
        return metadata.num_rows, min(lows, default=None), max(highs, default=None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ranges(p) for p in batch.column(at).to_pylist()]
            columns = list(zip(*found)) or [()] * 3
            added = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "rows", "low", "high"])

    held = [f"`{f.name}` {f.dataType.simpleString()}" for f in listing.schema]
    return listing.mapInArrow(read, ", ".join([*held, "rows bigint", "low string", "high string"]))


def _copy(source: str, target: str, kind: str) -> None:
    """Copy in chunks; the file appears under its final name only when it is complete."""
    (from_store, from_path), (to_store, to_path) = located(source), located(target)
    size = from_store.get_file_info(from_path).size
    left = {"cut": size - min(CUT_BYTES, size // 10), "emptied": 0}.get(kind, size)
    to_store.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
    part = f"{to_path}.{uuid.uuid4().hex}.part"
    at = 0
    with from_store.open_input_stream(from_path) as reader, to_store.open_output_stream(part) as writer:
        while left and (data := reader.read(min(CHUNK_BYTES, left))):
            if kind == "overwritten" and at == 0:
                start, stop = (min(x, len(data)) for x in (_OVERWRITTEN.start, _OVERWRITTEN.stop))
                data = data[:start] + b"\xff" * (stop - start) + data[stop:]
            writer.write(data)
            at += len(data)
            left -= len(data)
    to_store.move(part, to_path)


#: Rows of a group that are held before they are written.
HELD_ROWS = 100_000


def _directory(name: str, value: str | None) -> str:
    """``name=value`` as Spark spells a partition directory."""
    if not value:
        return f"{name}=__HIVE_DEFAULT_PARTITION__"
    return f"{name}=" + re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda c: f"%{ord(c[0]):02X}", value)


def written_groups(rows: DataFrame, key: str, name: str, root: str) -> DataFrame:
    """Write each run of equal ``key`` to ``root/name=key/events.parquet``; returns the paths in their store.

    Rows must lie side by side by ``key``. A file appears under its name only when it is complete, and a
    task that runs twice writes it again. Tasks write through the file system's library, since Spark's writer
    starts several processes per file on a local disk and renames all directories on the driver.
    """
    at = rows.columns.index(key)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = located(root)
        written: list[str] = []
        current: str | None = None
        writer = part = None
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            if held:
                table = pa.Table.from_batches(held)
                writer.write_table(table, row_group_size=HELD_ROWS)
                held.clear()

        def close() -> None:
            flush()
            writer.close()
            store.move(part, part.rsplit(".", 2)[0])
            written.append(part.rsplit(".", 2)[0])

        for batch in batches:
            values = batch.column(at)
            starts = [0]
            if batch.num_rows > 1:
                runs = pa.compute.run_end_encode(values)
                starts += runs.run_ends.to_pylist()[:-1]
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                if start == end:
                    continue
                value = values[start].as_py()
                if writer is None or value != current:
                    if writer is not None:
                        close()
                    current = value
                    folder = f"{base.rstrip('/')}/{_directory(name, value)}"
                    store.create_dir(folder, recursive=True)
                    part = f"{folder}/events.parquet.{uuid.uuid4().hex}.part"
                    writer = pq.ParquetWriter(
                        part, batch.schema, filesystem=store, compression="snappy", store_schema=False
                    )
                held.append(batch.slice(start, end - start))
                if sum(b.num_rows for b in held) >= HELD_ROWS:
                    flush()
        if writer is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(written, pa.string())], ["path"])

    return rows.mapInArrow(write, "path string")


def copied(plan: DataFrame, tasks: int) -> DataFrame:
    """Carry out (source, target, kind) in ``tasks`` tasks; returns the targets.

    A copy that runs twice writes the same bytes under the same name. The number of tasks is stated,
    since adaptive execution would merge a short list of paths into one task.
    """

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, target, kind in zip(*(c.to_pylist() for c in batch.columns)):
                _copy(source, target, kind)
            yield batch.select(["target"])

    rows = plan.select("source", "target", "kind").repartition(max(1, tasks), F.col("target"))
    return rows.mapInArrow(copy, "target string")
