"""Files of any size: listings, byte ranges that tasks share, and digests that are read in chunks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a task holds of a file at a time.
CHUNK = 4 << 20
#: Bytes of a range, where no other size is asked for.
RANGE = 64 << 20


def file_list(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """(path, name, length) of the files that Spark's binary reader finds; no content is read.

    ``name`` is the path below ``base`` where it lies there, else the whole path.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # Spark plans no task for an empty file, so these are known from its index alone, which the driver holds anyway
    indexed = [(re.sub("^file:/+", "file:/", unquote(name)),) for name in found.inputFiles()]
    names = spark.createDataFrame(indexed, "path string")
    listed = names.join(found.select("path", "length"), "path", "left").select("path", F.coalesce("length", F.lit(0)).cast("long").alias("length"))
    below = F.lit(None).cast("string") if base is None else F.when(F.contains("path", F.lit(f"{base.rstrip('/')}/")), F.substring_index("path", f"{base.rstrip('/')}/", -1))
    return listed.select("path", F.coalesce(below, F.col("path")).alias("name"), "length")


def open_file(path: str) -> BinaryIO:
    """A file as Spark names it, for reading from a task: local ones by the system, others by Arrow's file systems."""
    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    from pyarrow.fs import FileSystem

    system, inner = FileSystem.from_uri(path)
    return system.open_input_file(inner)


def chunks(path: str, offset: int, length: int, size: int = CHUNK) -> Iterator[bytes]:
    """``length`` bytes from ``offset`` on, ``size`` at a time; a file that ends before is an error."""
    with open_file(path) as file:
        file.seek(offset)
        while length > 0:
            found = file.read(min(size, length))
            if not found:
                raise EOFError(f"{path} ends {length} bytes early")
            length -= len(found)
            yield bytes(found)


def _dealt(rows: DataFrame, at_most: int) -> DataFrame:
    """As many tasks as rows, ``at_most`` at most: rows are small but what they stand for is not."""
    return rows.repartition(max(1, min(at_most, rows.count())))


def streamed_digests(spark: SparkSession, path: str, base: str | None = None, digest: Callable = hashlib.sha256, tasks: int = 10_000) -> DataFrame:
    """(path, name, bytes, digest) of each file, digest in lowercase hex.

    A digest depends on all bytes in order, so a file is one task's work, but only a chunk of it is held at a time:
    files have no size limit. An empty file has the digest of no bytes.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = []
            for file, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                state = digest()
                for part in chunks(file, 0, length):
                    state.update(part)
                found.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("name"), batch.column("length"), pa.array(found, pa.string())], names=["path", "name", "bytes", "digest"])

    return _dealt(file_list(spark, path, base), tasks).mapInArrow(run, "path string, name string, bytes long, digest string")


def byte_ranges(spark: SparkSession, path: str, size: int = RANGE, base: str | None = None) -> DataFrame:
    """(path, name, part, offset, length): files cut into ranges of ``size`` bytes, numbered from 0; empty files have none."""
    files = file_list(spark, path, base).where("length > 0")
    cut = files.select("path", "name", F.col("length").alias("all"), F.explode(F.expr(f"sequence(0L, (length - 1) div {int(size)})")).alias("part"))
    offset = F.col("part") * F.lit(int(size)).cast("long")
    return cut.select("path", "name", "part", offset.alias("offset"), F.least(F.lit(int(size)).cast("long"), F.col("all") - offset).alias("length"))


def read_ranges(ranges: DataFrame, tasks: int = 100_000) -> DataFrame:
    """The bytes of ``byte_ranges`` as ``content``. Each range is read by itself, so a large file is many tasks' work."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["path", "name", "part", "offset", "length"]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                path, offset, length = (row.column(n)[0].as_py() for n in ("path", "offset", "length"))
                content = b"".join(chunks(path, offset, length))
                yield pa.RecordBatch.from_arrays([*(row.column(n) for n in names), pa.array([content], pa.binary())], names=[*names, "content"])

    return _dealt(ranges, tasks).mapInArrow(run, "path string, name string, part long, offset long, length long, content binary")
