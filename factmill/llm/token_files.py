"""Token counts of documents in flat, unindexed token files: separators are searched block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factmill.llm.common import TEXTS_AT_ONCE, materialize, table
from factmill.llm.tokens import encoder, vocabulary_path
from factmill.sources.blobs import byte_ranges, read_ranges

#: <|endoftext|> of the vocabulary; its ids fit into unsigned 16-bit integers.
SEPARATOR = 49407
BLOCK_TOKENS = 65_536
WIDEST = 65_535
#: Blocks of a file that are read together.
RANGE_BLOCKS = 64
#: Blocks that are scanned together before their totals are scanned.
SPAN_BLOCKS = 1024


def _writer(path: str, separator: int, block_tokens: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec, name = encoder(path, special_as_text=True), f"tokens-{TaskContext.get().partitionId():06d}"
        held, block, ordinal = bytearray(), 0, 0
        size, end = 2 * block_tokens, np.asarray([separator], "<u2").tobytes()
        ids = None

        def rows(blocks: list, order: list, doc_ids) -> pa.RecordBatch:
            n = max(len(blocks), len(order))
            columns = [pa.array([name] * n), pa.array([b for b, _ in blocks] or [None] * n, pa.int64()), pa.array([d for _, d in blocks] or [None] * n, pa.binary()), pa.array(order or [None] * n, pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, doc_ids if order else pa.nulls(n, doc_ids.type)], names=["file", "block", "data", "ordinal", "doc_id"])

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part, blocks = batch.slice(at, TEXTS_AT_ONCE), []
                ids = part.column(0)
                for text in part.column(1).to_pylist():
                    found = np.frombuffer(codec.encode(text), "<u4")
                    if found.size and found.max() > WIDEST:
                        raise ValueError(f"id {found.max()} of the vocabulary does not fit into 16 bits")
                    held += found.astype("<u2").tobytes() + end
                    while len(held) >= size:
                        blocks.append((block, bytes(held[:size])))
                        del held[:size]
                        block += 1
                yield rows([], list(range(ordinal, ordinal + part.num_rows)), ids)
                ordinal += part.num_rows
                if blocks:
                    yield rows(blocks, [], ids)
        if held:
            yield rows([(block, bytes(held))], [], ids)

    return run


def token_files(documents: DataFrame, path: str, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Writes the documents' ids, each followed by the separator, as flat files, one for each partition.

    Returns the files' blocks (file, block, data: little-endian unsigned 16-bit ids, cut without regard to documents)
    and the order in which documents were written (file, ordinal, doc_id). The blocks carry no index of documents.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    written = rows.mapInArrow(_writer(path, separator, block_tokens), f"file string, block long, data binary, ordinal long, doc_id {kind}")
    written = materialize(written, "tokens")
    return written.where(F.col("block").isNotNull()).select("file", "block", "data"), written.where(F.col("ordinal").isNotNull()).select("file", "ordinal", "doc_id")


def blocks_of_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """Blocks (file, block, data) of flat binary files of unsigned 16-bit ids, of any size.

    Files are read by ranges of ``range_blocks`` blocks, each by itself, so a large file is many tasks' work.
    """
    size = 2 * block_tokens
    found = read_ranges(byte_ranges(spark, path, size * range_blocks))
    cut = F.expr(f"transform(sequence(0, cast((length - 1) div {size} as int)), i -> substring(content, i * {size} + 1, {size}))")
    cut = found.select(F.col("path").alias("file"), (F.col("part") * range_blocks).alias("first"), F.posexplode(cut).alias("at", "data"))
    return cut.select("file", (F.col("first") + F.col("at")).alias("block"), "data")


def _separators(separator: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [np.frombuffer(d, "<u2") for d in batch["data"]]
            ends = [np.flatnonzero(x == separator) for x in ids]
            yield pd.DataFrame({"file": batch["file"], "block": batch["block"], "n_ids": [len(x) for x in ids], "ends": ends})

    return run


def separator_counts(blocks: DataFrame, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """file, ordinal, n_tokens (without the separator), closed of every document in the blocks of flat token files.

    All blocks but a file's last hold ``block_tokens`` ids. Each block is searched on its own; a prefix scan (within
    spans of blocks, then over the spans' totals) gives each block the documents that end before it and the position
    of the last separator before it, so documents over any number of blocks are stitched and no file is one task's
    work. Ids after a file's last separator are one more document with closed = false. Empty documents count 0.
    """
    found = blocks.mapInPandas(_separators(separator), "file string, block long, n_ids long, ends array<long>")
    found = materialize(found.withColumn("span", F.expr(f"block div {SPAN_BLOCKS}")), "ends")
    base = F.col("block") * block_tokens
    found = found.select(
        "file", "span", "block", (base + F.col("n_ids")).alias("stop"), F.transform("ends", lambda e: base + e).alias("ends"), F.size("ends").cast("long").alias("n"),
        F.when(F.size("ends") > 0, base + F.element_at("ends", -1)).alias("last"),
    )
    spans = found.groupBy("file", "span").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.max("stop").alias("stop"))
    earlier = W.partitionBy("file").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.select(
        F.col("file").alias("f"), F.col("span").alias("s"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.max("last").over(earlier).alias("last0"),
        F.max("stop").over(W.partitionBy("file")).alias("file_stop"),
    )
    inside = W.partitionBy("file", "span").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    scanned = found.withColumns({"n1": F.coalesce(F.sum("n").over(inside), F.lit(0)), "last1": F.max("last").over(inside)})
    scanned = scanned.join(spans, (F.col("file") == F.col("f")) & (F.col("span") == F.col("s")))
    before = F.coalesce(F.greatest("last0", "last1"), F.lit(-1))
    at_end = F.when(F.col("stop") == F.col("file_stop"), F.col("stop") - 1 - F.greatest(F.coalesce("last", F.lit(-1)), before)).otherwise(0)
    marks = scanned.select("file", (F.col("n0") + F.col("n1")).alias("first"), F.concat(F.array(before), "ends").alias("marks"), at_end.alias("rest"))
    closed = F.transform(F.sequence(F.lit(1), F.size("marks") - 1), lambda i: F.struct((F.col("first") + i - 1).alias("ordinal"), (F.get("marks", i) - F.get("marks", i - 1) - 1).alias("n_tokens"), F.lit(True).alias("closed")))
    closed = F.when(F.size("marks") > 1, closed).otherwise(F.array().cast("array<struct<ordinal:bigint,n_tokens:bigint,closed:boolean>>"))
    rest = F.when(F.col("rest") > 0, F.array(F.struct((F.col("first") + F.size("marks") - 1).alias("ordinal"), F.col("rest").alias("n_tokens"), F.lit(False).alias("closed"))))
    rows = F.concat(closed, F.coalesce(rest, F.array().cast("array<struct<ordinal:bigint,n_tokens:bigint,closed:boolean>>")))
    return marks.select("file", F.inline(rows))


def count_tokens(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, file, ordinal, n_tokens of every document, read back from flat token files.

    Null and empty texts count 0 ids; null ids, ties and repeated rows keep a row each (they are told apart by file
    and ordinal); other columns are ignored; an empty table gives an empty result. A separator's text inside a
    document is encoded as ordinary text and ends nothing.
    """
    blocks, order = token_files(documents, path)
    counted = separator_counts(blocks)
    return order.join(counted, ["file", "ordinal"], "left").select("doc_id", "file", "ordinal", "n_tokens")


def op9_separator_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())
