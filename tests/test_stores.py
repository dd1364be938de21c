import io
import os

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from conftest import brute_force, rows
from wordloom import IndexSession
from wordloom.operators import classify, postings, statistics
from wordloom.sources import stores, trees
from test_trees import tree, write  # noqa: F401

LIMIT = 5 * 1024 * 1024


def told(df):
    """Rows by path, the pieces of a file put together; paths in hexadecimal form."""
    out = {}
    columns = [F.hex(F.col("path").cast("binary")).alias("path"), "size_bytes", "status", F.col("error").isNull().alias("fine"), "text", "piece"]
    for row in df.select(*columns).orderBy("path", "piece").collect():
        before = out.get(row["path"], (None, None, None, ""))
        out[row["path"]] = (row["size_bytes"], row["status"], row["fine"], before[3] + (row["text"] or ""))
    return out


def test_same_rows_as_the_mounted_tree(spark, tree):  # noqa: F811
    by_store = stores.corpus_from_uri(spark, f"file://{tree}", LIMIT)
    found, wanted = told(by_store), told(trees.corpus_from_tree(spark, str(tree), LIMIT))
    prefix = "file://".encode().hex().upper()
    assert {path.removeprefix(prefix): row for path, row in found.items()} == wanted
    assert rows(statistics.index_stats(by_store)) == rows(statistics.index_stats(trees.corpus_from_tree(spark, str(tree), LIMIT)))


def plain_tree(root):
    texts = {
        "a.TXT": "Hello hello WORLD", "empty.md": "", ".hidden.txt": "dot", "_under.log": "under", ".h/_u/n.txt": "deep",
        "k=1/p.csv": "key", "sub/a b%20c.csv": "sp", "sub/x.bin": "x", "notes": "x", "large.txt": "one two three four five " * 3000 + "z" * 40_000 + " end",
        "é/ünï.md": "name",
    }
    for name, text in texts.items():
        write(root / name, text.encode())
    (root / "nothing").mkdir()
    return texts


def test_remote_storage_lists_every_name(spark, tmp_path):
    """The interface of remote storage, over a local file system that is used as one."""
    texts = plain_tree(tmp_path)
    remote = stores.Remote(fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem()), "")
    found, level = {}, [b""]
    while level:
        entries = [one for directory in level for one in remote.children(directory)]
        found |= {path.decode(): size for path, kind, size, _ in entries if kind == "file"}
        level = [path for path, kind, _, _ in entries if kind == "directory"]
    assert found == {name: len(text.encode()) for name, text in texts.items()}
    for name, text in texts.items():
        with remote.open(name.encode()) as file:
            assert file.read() == text.encode()
    planned = [
        {"path": name.encode(), "size_bytes": len(text), "status": "eligible", "error": None, "start": start, "stop": stop}
        for name, text in texts.items()
        for start, stop in stores._ranges(len(text.encode()), 1000)
    ]
    read = {}
    for path, _, _, error, content, number in stores.read_planned(remote, planned, 300):
        assert error is None
        read.setdefault(path.decode(), []).append((number, content))
    assert {name: b"".join(content for _, content in parts).decode() for name, parts in read.items()} == texts
    assert all([number for number, _ in parts].count(0) == 1 for parts in read.values())
    (gone,) = remote.children(b"absent")
    assert gone[:3] == (b"absent", "unlisted", None) and gone[3]


def test_large_files_are_read_in_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "LEAST_TASK_BYTES", 20_000)
    texts = plain_tree(tmp_path)
    corpus = stores.corpus_from_uri(spark, str(tmp_path), piece_bytes=5000, range_bytes=20_000)
    found = rows(postings.postings(corpus))
    supported = {f"{tmp_path}/{name}": text for name, text in texts.items() if name.lower().endswith((".txt", ".md", ".log", ".csv"))}
    assert {(w, p): n for w, p, n in found} == brute_force(supported)
    stats = statistics.index_stats(corpus).first()
    assert (stats["discovered"], stats["indexed"], stats["skipped"]) == (len(texts), len(supported), len(texts) - len(supported))
    large = corpus.where(F.col("path").endswith("large.txt")).withColumn("task", F.spark_partition_id())
    assert large.select("task").distinct().count() > 1


def test_plans_hold_bounded_partitions(spark, tmp_path):
    for number in range(40):
        write(tmp_path / f"in/d{number % 3}/f{number}.txt", b"x" * 1000)
    planned = stores.plan(spark, str(tmp_path / "in"), location=str(tmp_path / "plan"), task_bytes=4000, range_bytes=4000)
    reader = stores.CorpusReader({"path": str(tmp_path / "in"), "plan": planned})
    parts = reader.partitions()
    sizes = [sum(row["size_bytes"] for row in batch.to_pylist()) for part in parts for batch in reader.read(part)]
    assert len(parts) >= 10 and max(sizes) <= 5000 and sum(sizes) == 40_000


@pytest.mark.parametrize("root", ["missing", "file.txt"])
def test_bad_roots(spark, tmp_path, root):
    write(tmp_path / "file.txt", b"x")
    with pytest.raises(ValueError):
        stores.corpus_from_uri(spark, str(tmp_path / root))


def test_empty_root_and_paths_as_typed(spark, tmp_path, monkeypatch):
    (tmp_path / "none").mkdir()
    assert rows(statistics.index_stats(stores.corpus_from_uri(spark, str(tmp_path / "none")))) == [(0, 0, 0, 0, 0, 0)]
    write(tmp_path / "in/a.txt", b"x")
    monkeypatch.chdir(tmp_path)
    for typed, expected in {"in": "in/a.txt", "./in": "./in/a.txt", "in/": "in/a.txt"}.items():
        assert [r["path"] for r in stores.corpus_from_uri(spark, typed).collect()] == [expected]


def test_file_lost_after_planning_fails_alone(spark, tmp_path):
    for number in range(5):
        write(tmp_path / f"d{number % 2}/f{number}.txt", b"some words")
    corpus = stores.corpus_from_uri(spark, str(tmp_path))
    (tmp_path / "d0/f2.txt").unlink()
    lost = classify.failures(corpus).collect()
    assert [(r["path"], r["error"]) for r in lost] == [(f"{tmp_path}/d0/f2.txt", "FileNotFoundError: No such file or directory")]
    assert rows(statistics.index_stats(corpus)) == [(5, 4, 1, 0, 2, 8)]


def test_session_over_a_store(spark, tmp_path):
    texts = plain_tree(tmp_path / "in")
    session = IndexSession(spark, workspace=str(tmp_path / "work"), log=str(tmp_path / "log"))
    stats = session.index_store(f"file://{tmp_path}/in").first()
    assert (stats["discovered"], stats["failed"]) == (len(texts), 0)
    mounted = IndexSession(spark, workspace=str(tmp_path / "work"))
    assert rows(mounted.index_tree(str(tmp_path / "in"))) == [tuple(stats)]
    assert {r["path"] for r in session.search("deep dot").collect()} == {f"file://{tmp_path}/in/{n}" for n in (".h/_u/n.txt", ".hidden.txt")}
    assert session.log().count() == stats["indexed"]


# Files that fail while they are read -------------------------------------------


class Failing(io.BytesIO):
    """A file with a bad sector."""

    def __init__(self, content, bad):
        super().__init__(content)
        self.bad = bad

    def read(self, size=-1):
        if self.tell() + (size if size >= 0 else len(self.getvalue())) > self.bad:
            raise OSError(5, "bad sector")
        return super().read(size)


class Damaged:
    """Storage in which some files fail after a number of bytes."""

    def __init__(self, contents, bad):
        self.contents, self.bad = contents, bad

    def open(self, path):
        name = path.decode()
        return Failing(self.contents[name], self.bad[name]) if name in self.bad else io.BytesIO(self.contents[name])


def damaged_corpus(spark, contents, bad, range_bytes=10_000, piece_bytes=1000):
    planned = [
        {"path": name.encode(), "size_bytes": len(data), "status": "eligible", "error": None, "start": start, "stop": stop}
        for name, data in contents.items()
        for start, stop in stores._ranges(len(data), range_bytes)
    ]
    read = list(stores.read_planned(Damaged(contents, bad), planned, piece_bytes))
    schema = "path binary, size_bytes bigint, status string, error string, content binary, piece int"
    made = spark.createDataFrame([(bytearray(r[0]), *r[1:4], None if r[4] is None else bytearray(r[4]), r[5]) for r in read], schema)
    return made.select(F.col("path").cast("string").alias("path"), "size_bytes", "status", "error", F.decode("content", "ISO-8859-1").alias("text"), "piece")


@pytest.mark.parametrize("bad_at", [0, 3_500, 12_000, 25_000])
@pytest.mark.parametrize("range_bytes", [10_000, 1 << 30])
def test_a_late_error_takes_the_file_back(spark, tmp_path, bad_at, range_bytes):
    words = b"alpha beta gamma " * 100
    contents = {"good.txt": words, "bad.txt": b"only here " * 4000, "empty.txt": b"", "more.txt": words * 30}
    corpus = damaged_corpus(spark, contents, {"bad.txt": bad_at}, range_bytes)
    assert classify.failures(corpus).where(F.col("path") == "bad.txt").count() >= 1
    session = IndexSession(spark, workspace=str(tmp_path / "work"), log=str(tmp_path / "log"))
    stats = rows(session.index_corpus(corpus))
    assert stats == [(4, 3, 1, 0, 3, 300 + 9000)]
    texts = {name: data.decode() for name, data in contents.items() if name != "bad.txt"}
    assert {(w, p): n for w, p, n in rows(session.snapshot())} == brute_force(texts)
    assert rows(session.search("only here")) == []
    failed = session.files().where(F.col("outcome") == "failed").collect()
    assert [(r["path"], r["size_bytes"], r["token_count"], r["error"]) for r in failed] == [("bad.txt", 40_000, 0, "OSError: bad sector")]
    assert {r["path"] for r in session.log().collect()} == set(texts)


def test_a_damaged_tree_still_builds(spark, tmp_path, monkeypatch):
    """The mounted source: a failure after the third piece is a failed file of a finished build."""
    rows_read = []

    def opened(path, mode):
        content = b"word " * 4000
        return Failing(content, 16_000) if b"bad" in path else io.BytesIO(content)

    class Batch:
        def __init__(self, paths):
            self.rows = [{"path": p, "size_bytes": 20_000, "status": "eligible", "error": None} for p in paths]

        def to_pylist(self):
            return self.rows

    monkeypatch.setattr(trees, "open", opened, raising=False)
    monkeypatch.setattr(trees, "pieces", lambda file, size: stores.pieces(file, size, step=500))
    for batch in trees._read_files(b"/", 4000)(iter([Batch([b"bad.txt", b"good.txt"])])):
        rows_read += batch.to_pylist()
    bad = [r for r in rows_read if r["path"] == b"bad.txt"]
    assert [r["piece"] for r in bad] == [0, 1, 2, 3] and bad[-1]["error"] == "OSError: bad sector" and bad[2]["content"]
    schema = "path string, size_bytes bigint, status string, error string, text string, piece int"
    corpus = spark.createDataFrame(
        [(r["path"].decode(), r["size_bytes"], r["status"], r["error"], r["content"] and r["content"].decode(), r["piece"]) for r in rows_read], schema
    )
    session = IndexSession(spark, workspace=str(tmp_path / "work"))
    assert rows(session.index_corpus(corpus)) == [(2, 1, 1, 0, 1, 4000)]


def test_repeated_paths_are_refused_even_if_one_fails(spark, tmp_path):
    corpus = damaged_corpus(spark, {"a.txt": b"x " * 4000, "b.txt": b"y"}, {"a.txt": 3000})
    session = IndexSession(spark, workspace=str(tmp_path / "work"))
    with pytest.raises(ValueError, match="a.txt"):
        session.index_corpus(corpus.unionByName(corpus.where(F.col("path") == "a.txt")))
