"""Helpers that the corpus operators share: table access and cutting lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Upper-case ASCII only; other letters keep their case in every contract here.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())

#: Largest number of rows of a lookup table that is sent to all executors.
BROADCAST_ROWS = 500_000
#: Largest size of one, as JSON text.
BROADCAST_BYTES = 64 << 20
#: Texts that a Python worker takes from an Arrow batch at a time.
TEXTS_AT_ONCE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where none is named, a temporary folder is set for the session if all runs on one machine, as in tests; else it fails.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="factmill-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Writes ``df`` as a Parquet table in the shared folder and reads it back.

    This cuts lineage: a lost executor costs the running stage only, and what is used twice is computed once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows that take at most ``size`` bytes as JSON. ``df`` should be a written table."""
    found = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size")).first()
    return found["n"] <= rows and (found["size"] or 0) <= size


def bounded_broadcast(df: DataFrame, bound: int | None = None) -> DataFrame:
    """Marks ``df`` for broadcast only if its rows and bytes are counted and small.

    Beyond that the frame is returned as it is, and Spark joins by shuffle (with its own skew handling).
    """
    return F.broadcast(df) if is_small(df, BROADCAST_ROWS if bound is None else bound) else df


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(column):
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, UPPER, UPPER.lower())


def id_remainder(column, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def map_texts(rows: DataFrame, compute: Callable[[list[str]], tuple], fields: list[tuple[str, str]], keep_text: bool = False) -> DataFrame:
    """Computes columns from ``text`` in Arrow batches; all other columns pass untouched (nulls and wide integers too).

    ``compute`` gets the texts of a batch (no nulls) and returns (rows, columns): for each result row the number of
    its text, or None for one row for each text, and a list of values for each of ``fields``.
    """
    kept = [f for f in rows.schema.fields if f.name != "text" or keep_text]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept] + [T.StructField(n, TYPES[t]) for n, t in fields])
    names = [f.name for f in kept]
    filled = rows.withColumn("text", F.coalesce("text", F.lit("")))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                index, columns = compute(part.column(part.schema.get_field_index("text")).to_pylist())
                rest = [part.column(part.schema.get_field_index(n)) for n in names]
                if index is not None:
                    chosen = pa.array(index, pa.int64())
                    rest = [c.take(chosen) for c in rest]
                new = [pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)]
                yield pa.RecordBatch.from_arrays([*rest, *new], names=[*names, *(n for n, _ in fields)])

    return filled.mapInArrow(run, schema)
