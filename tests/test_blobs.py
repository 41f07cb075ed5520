"""Files of any size: ranges and digests."""

import hashlib
import os
import resource

import pytest

from factmill.operators import quality as ql
from factmill.sources import blobs


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "odd name+1 é").mkdir(parents=True)
    for name, data in (("a.bin", os.urandom(1000)), ("empty", b""), ("odd name+1 é/b %41.bin", os.urandom(257))):
        (tmp_path / "in" / name).write_bytes(data)
    return tmp_path / "in"


def test_digests(spark, folder, monkeypatch):
    monkeypatch.setattr(blobs, "CHUNK", 100)
    got = {r.path: (r.artifact, r.bytes, r.sha256) for r in ql.file_digests(spark, str(folder), str(folder)).collect()}
    assert got == {str(p.relative_to(folder)): (p.name, p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in folder.rglob("*") if p.is_file()}


def test_row_counts_meet_odd_names(spark, folder):
    for name in ("a.bin", "odd name+1 é/b %41.bin"):
        (folder / name).write_text("x\ny\n")
    rows = ql.file_row_counts(spark.read.option("recursiveFileLookup", True).text(str(folder)), str(folder))
    listed = ql.manifest_artifacts(ql.file_digests(spark, str(folder), str(folder)), rows)
    assert {r.path: r.row_count for r in listed.collect()} == {"a.bin": 2, "empty": None, "odd name+1 é/b %41.bin": 2}


@pytest.mark.parametrize("size", [1, 64, 257, 1000, 5000])
def test_ranges_make_up_the_files(spark, folder, size):
    ranges = blobs.byte_ranges(spark, str(folder), size, str(folder))
    if size == 1:
        ranges = ranges.where("name <> 'a.bin'")
    got = {}
    for r in blobs.read_ranges(ranges, tasks=3).collect():
        got.setdefault(r.name, {})[r.part] = bytes(r.content)
    for name, parts in got.items():
        assert b"".join(parts[i] for i in range(len(parts))) == (folder / name).read_bytes() and all(len(p) == size for i, p in parts.items() if i < len(parts) - 1)
    assert "empty" not in got and len(got) == (1 if size == 1 else 2)


def test_a_file_beyond_two_gigabytes(spark, tmp_path):
    """A sparse file of 3 GB: digested in chunks, read by range past what one Spark cell can hold."""
    big = tmp_path / "big"
    with open(big, "wb") as f:
        f.truncate(3 << 30)
        f.seek((3 << 30) - 3)
        f.write(b"end")
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    state = hashlib.sha256()
    for part in blobs.chunks(f"file:{big}", 0, 3 << 30):
        state.update(part)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000
    (row,) = ql.file_digests(spark, str(big)).collect()
    assert (row.bytes, row.sha256) == (3 << 30, state.hexdigest())
    last = blobs.byte_ranges(spark, str(big), 1 << 20).where("part = 3071")
    assert bytes(blobs.read_ranges(last).first().content)[-3:] == b"end"


def test_a_file_that_shrank_is_an_error(tmp_path):
    (tmp_path / "x").write_bytes(b"123")
    with pytest.raises(EOFError):
        list(blobs.chunks(f"file:{tmp_path}/x", 1, 3))
