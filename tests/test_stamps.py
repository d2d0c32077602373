import hashlib
import os

from recsense.operators import lineage


def test_files_are_stamped_in_pieces_and_missing_ones_are_named(spark, tmp_path, monkeypatch):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    contents = {"in/a.bin": os.urandom(1000), "in/deep/b.csv": b"1,2", "in/deep/c d.csv": "é".encode() * 5}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    inputs = [("clean", "logs", str(tmp_path / "in")), ("train", "one", str(tmp_path / "in" / "a.bin")), ("train", "model", str(tmp_path / "none"))]
    first = lineage.stamp_files(spark, inputs, chunk=7).persist()
    got = {(r.stage, r.label, os.path.basename(r.path)): (r.sha256, r.bytes, r.missing) for r in first.collect()}
    want = {("clean", "logs", os.path.basename(n).replace(" ", "%20")): (hashlib.sha256(d).hexdigest(), len(d), False) for n, d in contents.items()}
    want |= {("train", "one", "a.bin"): want["clean", "logs", "a.bin"], ("train", "model", "none"): (None, None, True)}
    assert {(*k[:2], k[2].replace(" ", "%20")): v for k, v in got.items()} == want
    # an unchanged file isn't read again: its old stamp stays although the content is another of the same size and time
    kept = (tmp_path / "in/a.bin").stat()
    (tmp_path / "in/a.bin").write_bytes(os.urandom(1000))
    os.utime(tmp_path / "in/a.bin", ns=(kept.st_atime_ns, kept.st_mtime_ns))
    (tmp_path / "in/deep/b.csv").write_bytes(b"later")
    again = {os.path.basename(r.path): r.sha256 for r in lineage.stamp_files(spark, inputs[:1], first).collect()}
    assert again["a.bin"] == got["clean", "logs", "a.bin"][0] and again["b.csv"] == hashlib.sha256(b"later").hexdigest()
    assert [tuple(r)[:3] for r in lineage.stamp_files(spark, inputs[2:]).collect()] == [inputs[2]]


def test_a_large_file_is_not_held(tmp_path):
    """A sparse file of over 2 GB, past what one column value can hold."""
    size = (2 << 30) + 5
    with open(tmp_path / "big", "wb") as f:
        f.truncate(size)
    state = hashlib.sha256()
    for _ in range(size >> 20):
        state.update(bytes(1 << 20))
    state.update(bytes(5))
    assert lineage.digest_of(f"file://{tmp_path}/big") == (state.hexdigest(), size)
