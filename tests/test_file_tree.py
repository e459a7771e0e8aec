"""Hash trees of files against reading them whole."""

import hashlib
import random

import pyarrow as pa
import pytest

from tastemill.sources.file_tree import FAN, _pieces, chunk_hashes, compare_trees, tree_roots


def leaves(folder, chunk):
    out = {}
    for f in sorted(folder.rglob("*.*")):
        data, at, held = f.read_bytes(), 0, {}
        lines = data.split(b"\n")
        for line in lines[:-1] if not lines[-1] else lines:
            held.setdefault(at // chunk, []).append(hashlib.sha256(line).hexdigest())
            at += len(line) + 1
        for c, hs in (held if data else {}).items():
            out[str(f.relative_to(folder)), c] = (hashlib.sha256("".join(hs).encode()).hexdigest(), len(data))
    return out


@pytest.fixture()
def folder(tmp_path):
    rng = random.Random(2)
    (tmp_path / "in" / "a b").mkdir(parents=True)
    (tmp_path / "in" / "noise.bin").write_bytes(rng.randbytes(300_000))
    (tmp_path / "in" / "a b" / "text.csv").write_bytes(b"".join(b"%d,x\n" % k for k in range(20_000)))
    (tmp_path / "in" / "no_newline.txt").write_bytes(b"one\r\ntwo\n\n\nthree")
    (tmp_path / "in" / "one_line.txt").write_bytes(b"z" * 50_000)
    (tmp_path / "in" / "empty.txt").write_bytes(b"")
    return tmp_path / "in"


def got(df):
    return {(r["name"], r["chunk"]): (r["sha256"], r["size_bytes"]) for r in df.collect()}


@pytest.mark.parametrize("split", ["128m", "4k"])
def test_leaves_do_not_depend_on_how_files_are_split(spark, folder, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        want = {(k[0].replace(" ", "%20"), k[1]): v for k, v in leaves(folder, 1000).items()}
        found = {(k[0].replace(" ", "%20"), k[1]): v for k, v in got(chunk_hashes(spark, str(folder), 1000)).items()}
        assert found == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_changed_missing_and_new_files(spark, folder):
    old = chunk_hashes(spark, str(folder), 1000).localCheckpoint()
    data = bytearray((folder / "noise.bin").read_bytes())
    data[150_000] ^= 1
    (folder / "noise.bin").write_bytes(bytes(data))
    (folder / "one_line.txt").unlink()
    (folder / "new.txt").write_bytes(b"n\n")
    (folder / "no_newline.txt").write_bytes(b"one\r\ntwo\n\n\nthree\n")
    rows = {r["name"]: r for r in compare_trees(old, chunk_hashes(spark, str(folder), 1000)).collect()}
    assert {n for n, r in rows.items() if r["ok"]} == {n for n in rows if n.endswith("text.csv")}
    assert rows["noise.bin"]["n_changed"] <= 3 and rows["noise.bin"]["n_changed"] >= 1
    assert rows["one_line.txt"]["actual"] is None and rows["new.txt"]["expected"] is None
    # A last newline changes no line, but the size, which the root holds.
    assert rows["no_newline.txt"]["n_changed"] == 0 and not rows["no_newline.txt"]["ok"]


def test_roots_by_hand(spark, make):
    n = 2 * FAN + 5
    hashes = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(n)]
    level = hashes
    for _ in range(3):
        level = [hashlib.sha256("".join(level[k : k + FAN]).encode()).hexdigest() for k in range(0, len(level), FAN)]
    chunks = make([("f", k, h, 77) for k, h in enumerate(hashes)], "name string, chunk long, sha256 string, size_bytes long")
    row = tree_roots(chunks).first()
    assert row["sha256"] == hashlib.sha256(f"77-{level[0]}".encode()).hexdigest() and row["n_chunks"] == n


def test_only_the_edges_of_a_block_leave_the_task_as_line_hashes():
    lines = [b"%d,x" % k for k in range(5000)]
    h = [hashlib.sha256(line).digest() for line in lines]
    names = ["file", "size_bytes", "block", "first", "step", "h"]
    whole = pa.RecordBatch.from_arrays(
        [pa.array(["f"] * 5000), pa.array([99] * 5000), pa.array([7] * 5000), pa.array([2500] * 5000), pa.array([len(x) + 1 for x in lines]), pa.array(h)], names
    )
    rows = [r for part in _pieces(1000)(whole.slice(k, 700) for k in range(0, 5000, 700)) for r in part.to_pylist()]
    assert sum(r["hashes"] is not None for r in rows) == 2 and len(rows) > 25
    assert rows[0]["chunk"] == 2 and rows[0]["start"] == 2500 and rows[0]["hashes"] and rows[-1]["hashes"]
    starts, at = {}, 2500
    for line, digest in zip(lines, h):
        starts.setdefault(at // 1000, []).append(digest.hex())
        at += len(line) + 1
    assert [r["chunk"] for r in rows] == sorted(starts)
    assert all(r["sha256"] == hashlib.sha256("".join(starts[r["chunk"]]).encode()).hexdigest() for r in rows[1:-1])
