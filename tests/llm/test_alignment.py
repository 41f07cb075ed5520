"""Alignment of two tokenizers against a byte-by-byte one."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from factmill.llm import alignment
from factmill.llm.tokens import vocabulary_path

TEXTS = [
    "The and attion to thanedble the, anea.\nEriner  thanea.", "", None, " ", "   leading and trailing  ", "tab\tand\nline\r\nend\n", "a" * 300 + " " + "z" * 50, "Éréier enqueeau de, les la vioi - it's we'll 's 123 4567 !!! ...",
    "<|endoftext|> and </s> <s> <unk> <0x41> stay text", "under▁score is lost", "日本語のテキスト and 한국어 \U0001f600\U0001f468‍\U0001f469 mixed", "nul\x00 bell\x07 sep\x1c next\x85line para nbsp　wide", "x", "  x", "x  ", "same words same words same words",
    "same words same words same words", "é combining ﻿bom", "\n", "▁", "ends in space ", "co-op  don't   stop    me", "͸ unassigned \U000e0001 tag",
]


@pytest.fixture(scope="module")
def both():
    return alignment.TwoTokenizers(vocabulary_path(alignment.RANKS), vocabulary_path(alignment.PIECES))


@pytest.fixture(scope="module")
def plain():
    """The contract's own tokenizers, without chunks: ids and bytes of both sides, or none."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printable)}

    def run(text):
        if not text:
            return [], []
        left = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
        whole = (" " + text).encode()
        return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])

    return run


def spans(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(texts, plain):
    """Rows of the contract, byte by byte."""
    rows, all_links = [], Counter()
    for text in texts:
        left, right = map(spans, plain(text))
        links = [(a, b) for a, s, e in left for b, s2, e2 in right if s < e2 and s2 < e]
        all_links.update(links)
        stops = sorted({e for *_, e in left} & {e for *_, e in right})
        shown = [",".join(str(i) for i, s, e in left if lo <= s < hi) + "|" + ",".join(str(i) for i, s, e in right if lo <= s < hi) for lo, hi in zip([0, *stops], stops, strict=False)]
        rows.append((left, right, stops, links, hashlib.sha256(";".join(shown).encode()).hexdigest() if left else ""))
    most = {}
    for (_, b), n in all_links.items():
        most[b] = max(most.get(b, 0), n)
    return [(len(a), len(b), len(stops), len(links), sum(all_links[x] == most[x[1]] for x in links), sum(all_links[x] for x in links), digest) for a, b, stops, links, digest in rows]


def test_ids_are_those_of_the_whole_text(both, plain):
    r = random.Random(4)
    alphabet = ["the", "é", "x", " ", "  ", "\n", "'s", "▁", "1", "!", "日", "\x1c", " ", "end", "-", "\t"]
    texts = [t or "" for t in TEXTS] + ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 40))) for _ in range(1500)]
    for at in range(0, len(texts), 50):
        some = texts[at : at + 50]
        for text, (a, b) in zip(some, both.encode(some), strict=True):
            left, right = plain(text)
            assert ([int.from_bytes(a[k : k + 4], "little") for k in range(0, len(a), 4)], [int.from_bytes(b[k : k + 4], "little") for k in range(0, len(b), 4)]) == ([i for i, _ in left], [i for i, _ in right]), repr(text)


@pytest.mark.parametrize("head", [alignment.HEAD, 40, 0])
def test_alignment_against_brute_force(spark, plain, head, monkeypatch):
    texts = [*TEXTS, "The and attion to thanedble the, anea. " * 40]
    monkeypatch.setattr(alignment, "TEXT_BYTES", 300)
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("row", "a", "b", "n", "count", "best", "pairs", "n_a", "most")})
    got = alignment.align_tokenizers(df, vocabulary_path(alignment.RANKS), vocabulary_path(alignment.PIECES), head)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    wanted = [(i, *w) for (i, _), w in zip(rows, brute(texts, plain), strict=True)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)


def test_long_text_and_empty_table(spark, plain):
    schema, paths = "doc_id long, text string", (vocabulary_path(alignment.RANKS), vocabulary_path(alignment.PIECES))
    text = "lorem ipsum dolor sit amet\n" * 20_000
    (row,) = alignment.align_tokenizers(spark.createDataFrame([(1, text)], schema), *paths).collect()
    left, right = plain(text)
    assert (row.n_a, row.n_b) == (len(left), len(right)) and row.n_links >= max(row.n_a, row.n_b) >= row.n_groups > 0
    assert alignment.align_tokenizers(spark.createDataFrame([], schema), *paths).collect() == []
