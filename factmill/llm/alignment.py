"""Alignment of two public tokenizers over the same texts: overlaps by as-of joins, groups by equal ends, counts of pairs."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.llm.common import bounded_broadcast, materialize, table
from factmill.llm.tokens import vocabulary_path

RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
#: UTF-8 bytes of text that are aligned at a time; one text is the least.
TEXT_BYTES = 1 << 20
#: Chunks that a worker remembers; the cache starts anew beyond that.
CACHE = 300_000
_LONGEST = 40
#: Pairs of ids that all tasks hold at most: the most frequent. Rarer ones are joined by shuffle.
HEAD = 500_000
#: A space between two characters that are no white space: no token of either side crosses its left edge.
_EDGE = re.compile(r"(?<=\S) (?=\S)")


class TwoTokenizers:
    """Ids of " " + text by byte-level BPE (A), and of text by sentence pieces, which put that space first (B).

    Neither vocabulary joins a character to a space after it (B's is looked through for that), so texts are cut before
    single spaces and recurring chunks are encoded once. Chunks that B doesn't give back byte for byte are never cut out:
    such a text is encoded and compared as a whole.
    """

    def __init__(self, ranks_path: str, pieces_path: str) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def _both(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by A and by B, or None unless both give back " " + text."""
        whole = (" " + text).encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return None
        return np.array(a, np.int32), np.array(b, np.int32)

    def _learn(self, chunks: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """Chunks with no white space at their ends are encoded in one go and cut apart at their ends."""
        learned: dict[str, tuple[bytes, bytes] | None] = {}
        plain = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace()]
        if len(plain) > 1 and (found := self._both(" ".join(plain))):
            ends = np.cumsum([len(c.encode()) + 1 for c in plain])
            cut = []
            for ids, sizes in zip(found, (self.a_sizes, self.b_sizes), strict=True):
                reach = np.cumsum(sizes[ids])
                at = np.searchsorted(reach, ends)
                if not np.array_equal(reach[at], ends):
                    break
                data, at = ids.tobytes(), (4 * (at + 1)).tolist()
                cut.append(map(data.__getitem__, map(slice, [0, *at], at)))
            if len(cut) == 2:
                learned = dict(zip(plain, zip(*cut, strict=False), strict=False))
        for c in chunks:
            if c not in learned:
                found = self._both(c)
                learned[c] = found and (found[0].tobytes(), found[1].tobytes())
        return learned

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids by A and B as little-endian 32-bit integers; none unless both give back its bytes."""
        if len(self.known) > CACHE:
            self.known.clear()
        known = self.known
        cut = [text.split(" ") if self.cuts else [text] for text in texts]
        missing: dict[str, None] = {}
        for i, parts in enumerate(cut):
            new = [p for p in parts if p not in known]
            if any(not p or p[0].isspace() or p[-1].isspace() for p in new):
                cut[i] = parts = _EDGE.split(texts[i]) if self.cuts else parts
                new = [p for p in parts if p not in known]
            missing.update(dict.fromkeys(new))
        learned = self._learn(list(missing))
        # what has white space at its ends stays out of the cache, so that such texts are always cut by the expression
        known.update((c, e) for c, e in learned.items() if len(c) <= _LONGEST and c and not c[0].isspace() and not c[-1].isspace())
        out = []
        for text, parts in zip(texts, cut, strict=True):
            entries = [known[p] if p in known else learned[p] for p in parts]
            if not text:
                out.append((b"", b""))
            elif None in entries:
                found = self._both(text)
                out.append((found[0].tobytes(), found[1].tobytes()) if found else (b"", b""))
            else:
                a, b = zip(*entries, strict=True)
                out.append((b"".join(a), b"".join(b)))
        return out


_held: dict[tuple[str, str], TwoTokenizers] = {}


def tokenizers(ranks_path: str, pieces_path: str) -> TwoTokenizers:
    """One pair for each worker and vocabularies."""
    key = (ranks_path, pieces_path)
    if key not in _held:
        _held[key] = TwoTokenizers(*key)
    return _held[key]


def overlaps(a_starts: np.ndarray, a_docs: np.ndarray, b_starts: np.ndarray, b_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of all tokens of one document that share a byte, each pair once.

    Two tokens overlap just if the later of their starts lies in the other, so each start looks up the other side's
    covering token, keyed by document, and both directions are united; equal starts are found twice and kept once.
    """
    a = pd.DataFrame({"start": a_starts, "doc": a_docs, "a": np.arange(len(a_starts))})
    b = pd.DataFrame({"start": b_starts, "doc": b_docs, "b": np.arange(len(b_starts))})
    covered = pd.merge_asof(a, b.assign(other=b_starts), on="start", by="doc")
    covering = pd.merge_asof(b, a.assign(other=a_starts), on="start", by="doc")
    late = (covering["other"] < covering["start"]).to_numpy()
    return (
        np.concatenate([covered["a"].to_numpy(), covering["a"].to_numpy()[late]]).astype(np.int64),
        np.concatenate([covered["b"].to_numpy(), covering["b"].to_numpy()[late]]).astype(np.int64),
    )


def _align(ranks_path: str, pieces_path: str, doc_type):
    def counts(per_doc: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """How many flags are set in each document's run."""
        running = np.concatenate([[0], np.cumsum(flags)])
        ends = np.cumsum(per_doc)
        return running[ends] - running[ends - per_doc]

    def aligned(texts: list[str], both: TwoTokenizers, shown: tuple[np.ndarray, np.ndarray]):
        import pyarrow as pa

        found = both.encode(texts)
        n_a, n_b = (np.array([len(x[side]) // 4 for x in found], np.int64) for side in (0, 1))
        a, b = (np.frombuffer(b"".join([x[side] for x in found]), "<i4") for side in (0, 1))
        # texts lie end to end: both sides give back the same bytes of each, so their places agree
        a_ends, b_ends = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b])
        docs = np.arange(len(texts), dtype=np.int32)
        a_docs, b_docs = np.repeat(docs, n_a), np.repeat(docs, n_b)
        at_a, at_b = overlaps(a_ends - both.a_sizes[a], a_docs, b_ends - both.b_sizes[b], b_docs)
        base_a, base_b = len(both.a_bytes), len(both.b_bytes)
        pairs, times = np.unique((a_docs[at_a].astype(np.int64) * base_a + a[at_a]) * base_b + b[at_b], return_counts=True)
        owners = pairs // (base_a * base_b)
        # a group ends where both sides end
        ends = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, bool)
        ends[b_ends] = True
        a_closes = ends[a_ends]
        ends[:] = False
        ends[a_ends] = True
        b_closes = ends[b_ends]
        a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
        groups = int(a_closes.sum())
        in_a, in_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        parts = np.empty(len(a) + len(b), object)
        parts[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[a_group]] = shown[0][a + base_a * a_closes]
        parts[np.arange(len(b)) + np.cumsum(in_a)[b_group]] = shown[1][b + base_b * b_closes]
        stops = np.cumsum(n_a + n_b).tolist()
        digests = [hashlib.sha256(b"".join(parts[lo:hi].tolist())[:-1]).hexdigest() if hi > lo else "" for lo, hi in zip([0, *stops], stops, strict=False)]
        struct = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (pairs // base_b % base_a, pairs % base_b, times)], names=["a", "b", "n"])
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owners, np.arange(len(texts) + 1)).astype(np.int32)), struct)
        links = np.bincount(a_docs[at_a], minlength=len(texts)) if len(at_a) else np.zeros(len(texts), np.int64)
        numbers = [pa.array(np.asarray(x, np.int64)) for x in (n_a, n_b, counts(n_a, a_closes), links)]
        return [*numbers, pa.array(digests, pa.string()), lists]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        both = tokenizers(ranks_path, pieces_path)
        shown = tuple(np.array([b"%d%s" % (i, end) for end in ends for i in range(len(side))], object) for side, ends in ((both.a_bytes, (b",", b"|")), (both.b_bytes, (b",", b";"))))
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).cumsum()
            at = 0
            while at < batch.num_rows:
                done = int(sizes[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, done + TEXT_BYTES, side="right")))
                part = batch.slice(at, stop - at)
                columns = aligned([t or "" for t in part.column("text").to_pylist()], both, shown)
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *columns], names=_FIELDS)
                at = stop

    return run


_FIELDS = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]


def align_texts(documents: DataFrame, ranks_path: str, pieces_path: str) -> DataFrame:
    """For each row: numbers of tokens, groups and links, the digest of the groups, and ``pairs``, an array of the id
    pairs that are linked in it with how often. ``row`` numbers the rows; the result is a written table, so it stays."""
    kind = documents.schema["doc_id"].dataType
    pair = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("a", "b", "n")]))
    kinds = [T.LongType(), kind, *[T.LongType()] * 4, T.StringType(), pair]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(_FIELDS, kinds, strict=True)])
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return materialize(rows.mapInArrow(_align(ranks_path, pieces_path, kind), schema), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, count, best) of each linked id pair over all rows; best: no pair of its b counts more. A written table.

    Pairs are added up in each task before the shuffle. There is one maximum for each id of B, so those of a vocabulary
    are few; they are broadcast behind a check of their size.
    """
    counted = materialize(aligned.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("n").alias("count")), "pairs")
    most = bounded_broadcast(counted.groupBy("b").agg(F.max("count").alias("most")))
    return materialize(counted.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "pair-counts")


def _head(counts: DataFrame, bound: int) -> tuple[int, bool]:
    """The least power of two such that at most ``bound`` pairs count as much or more, and whether rarer pairs are left."""
    level = F.floor(F.log2(F.col("count").cast("double")) + 1e-9).cast("int")
    sizes = {r.level: r.n for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row for each power of two
    held, least = 0, 62
    for k in sorted(sizes, reverse=True):
        if held + sizes[k] > bound:
            break
        held, least = held + sizes[k], k
    return 1 << least, held < sum(sizes.values())


def align_tokenizers(documents: DataFrame, ranks_path: str, pieces_path: str, head: int = HEAD) -> DataFrame:
    """How two tokenizers cut the texts of ``documents`` (doc_id, text), and how their ids go together in all of them.

    Columns: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Null and empty texts, and those whose
    bytes a tokenizer doesn't give back, have no tokens: zeros and an empty digest. Texts are aligned whole, however
    long, some at a time; repeated rows and null ids keep a row each and all count; other columns are ignored; an empty
    table gives an empty result.

    Every text is encoded once; what goes on is each row's distinct id pairs. The most frequent pairs (at most ``head``)
    are broadcast, which leaves only rare pairs to a shuffle, so a pair that a third of the rows hold loads no task.
    """
    aligned = align_texts(documents, ranks_path, pieces_path)
    counts = pair_counts(aligned)
    least, more = _head(counts, head)
    held = F.broadcast(counts.where(F.col("count") >= least))  # at most `head` rows of 17 bytes
    used = aligned.select("row", F.inline("pairs"))

    def summed(rows: DataFrame) -> DataFrame:
        best = F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("long")
        return rows.groupBy("row").agg(best.alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))

    sums = summed(used.join(held, ["a", "b"]))
    if more:
        rare = used.join(held.select("a", "b"), ["a", "b"], "left_anti").join(counts.where(F.col("count") < least), ["a", "b"])
        sums = sums.unionByName(summed(rare)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = aligned.drop("pairs").join(sums, "row", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), vocabulary_path(RANKS), vocabulary_path(PIECES))
