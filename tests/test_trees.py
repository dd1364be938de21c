import io
import os

import pytest
from pyspark.sql import functions as F

from conftest import brute_force, rows
from wordloom.operators import classify, postings, statistics
from wordloom.sources import pieces, trees

LIMIT = 5 * 1024 * 1024


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    """The tree of FIXTURES.md section 3."""
    root = tmp_path_factory.mktemp("tree") / "root"
    write(root / "a.TXT", b"Hello hello WORLD\nfoo_bar 42x")
    write(root / "empty.md", b"")
    write(root / ".txt", b"x")
    write(root / "..txt", b"x")
    write(root / "_f.txt", b"under")
    write(root / ".hid/n.txt", b"hidden")
    write(root / "_und/n.txt", b"under")
    write(root / "k=1/p.log", b"key")
    write(root / "sub/a b%20c.csv", b"sp")
    write(root / "sub/bad.txt", b"bad\xc3Ab \xfftail caf\xc3\xa9x \xe2\x84\xaaelvin")
    write(root / "sub/exact.txt", b"a" * LIMIT)
    write(root / "sub/over.txt", b"a" * (LIMIT + 1))
    write(root / "sub/x.bin", b"x")
    write(root / "a.txt.bin", b"x")
    write(root / "notes.", b"x")
    write(root / "a.txt\n", b"x")
    write(root / "deep/er/and/deeper/end.txt", b"deep")
    (root / "d.txt").mkdir()
    os.mkfifo(root / "p.txt")
    (root / "linked").symlink_to(root / "sub")
    (root / "l.txt").symlink_to(root / "a.TXT")
    (root / "z.txt").symlink_to(root / "gone")
    (root / "loop.txt").symlink_to(root / "loop.txt")
    with open(os.path.join(os.fsencode(root), b"odd\xff.txt"), "wb") as file:
        file.write(b"odd")
    return root


ELIGIBLE = {
    "a.TXT", "empty.md", "..txt", "_f.txt", ".hid/n.txt", "_und/n.txt", "k=1/p.log",
    "sub/a b%20c.csv", "sub/bad.txt", "sub/exact.txt", "deep/er/and/deeper/end.txt", "l.txt",
}
SKIPPED = {".txt", "sub/over.txt", "sub/x.bin", "a.txt.bin", "notes.", "a.txt\n"}
INACCESSIBLE = {"z.txt", "loop.txt"}


def named(df, root):
    """Rows by path below the root; the undecodable name is told by its hex form."""
    raw = df.withColumn("path", F.hex(F.col("path").cast("binary"))).collect()
    prefix = os.fsencode(root) + b"/"
    return {bytes.fromhex(r["path"]).removeprefix(prefix): r for r in raw}


def test_inventory(spark, tree):
    found = named(trees.inventory(spark, str(tree), LIMIT), tree)
    by_status = {}
    for path, row in found.items():
        by_status.setdefault(row["status"], set()).add(path)
    assert by_status == {
        "eligible": {os.fsencode(p) for p in ELIGIBLE} | {b"odd\xff.txt"},
        "skipped": {os.fsencode(p) for p in SKIPPED},
        "inaccessible": {os.fsencode(p) for p in INACCESSIBLE},
    }
    assert found[b"sub/exact.txt"]["size_bytes"] == LIMIT
    assert all(found[os.fsencode(p)]["error"] for p in INACCESSIBLE)


def test_executors_list_what_the_driver_would(spark, tree, monkeypatch):
    """A tree of any size is listed alike, by the driver or level by level by executors."""
    by_driver = named(trees.inventory(spark, str(tree), LIMIT), tree)
    monkeypatch.setattr(trees, "WALKED_ENTRIES", 3)
    assert named(trees.inventory(spark, str(tree), LIMIT), tree) == by_driver


def test_text_and_counts(spark, tree):
    corpus = trees.corpus_from_tree(spark, str(tree), LIMIT)
    words = {}
    for row in postings.postings(corpus).where(~F.col("path").contains("odd")).collect():
        name = row["path"].removeprefix(f"{tree}/")
        words.setdefault(name, {})[row["word"]] = row["frequency"]
    assert words["a.TXT"] == {"hello": 2, "world": 1, "foo": 1, "bar": 1, "42x": 1}
    assert words["l.txt"] == words["a.TXT"]
    assert words["sub/bad.txt"] == dict.fromkeys(["bad", "ab", "tail", "caf", "x", "elvin"], 1)
    assert words["sub/exact.txt"] == {"a" * LIMIT: 1}
    assert "empty.md" not in words
    stats = statistics.index_stats(corpus).first()
    assert stats["discovered"] == len(ELIGIBLE) + 1 + len(SKIPPED) + len(INACCESSIBLE)
    assert stats["indexed"] == len(ELIGIBLE) + 1
    assert stats["skipped"] == len(SKIPPED) + len(INACCESSIBLE)
    assert stats["failed"] == 0


def test_large_files_are_read_in_pieces(spark, tmp_path):
    words = [f"w{n % 300}x" for n in range(60_000)]
    write(tmp_path / "large.txt", (" ".join(words) + "\n" + "z" * 200_000 + " end").encode())
    write(tmp_path / "none.txt", b"")
    files = trees.inventory(spark, str(tmp_path))
    pieces = trees.with_text(spark, files, piece_bytes=50_000)
    assert pieces.count() > 5
    texts = {f"{tmp_path}/large.txt": (tmp_path / "large.txt").read_text(), f"{tmp_path}/none.txt": ""}
    found = rows(postings.postings(pieces))
    assert {(w, p): n for w, p, n in found} == brute_force(texts)
    assert rows(statistics.index_stats(pieces)) == [(2, 2, 0, 0, 302, 60_002)]
    assert statistics.ledger_stats(postings.ledger(pieces)).first()["discovered"] == 2


@pytest.mark.parametrize("content", [b"", b"a", b"ab cd", b"x" * 300, b"one, two;three " * 50])
@pytest.mark.parametrize("size", [1, 7, 64])
def test_pieces_end_between_tokens(content, size):
    found = list(pieces.pieces(io.BytesIO(content), size, step=5))
    assert b"".join(found) == content and found
    for one, other in zip(found, found[1:]):
        assert not (one[-1:].isalnum() and other[:1].isalnum())


@pytest.mark.parametrize("content", [b"", b"a", b"ab cd", b"x" * 300, b", " * 40, b"one, two;three " * 50, b"x" * 90 + b" " + b"y" * 90])
@pytest.mark.parametrize("width", [1, 2, 13, 50, 1000])
@pytest.mark.parametrize("size", [1, 9, 64])
def test_ranges_share_no_token_and_leave_none_out(content, width, size):
    """Ranges of any width put together are the file, and are cut between tokens."""
    starts = list(range(0, max(1, len(content)), width))
    found = []
    for start in starts:
        stop = None if start == starts[-1] else start + width
        found += pieces.pieces(io.BytesIO(content), size, start, stop, step=7)
    assert b"".join(found) == content and found
    for one, other in zip(found, found[1:]):
        assert not (one[-1:].isalnum() and other[:1].isalnum())


def test_file_lost_after_listing_fails_alone(spark, tmp_path):
    for number in range(5):
        write(tmp_path / f"d{number % 2}/f{number}.txt", b"some words")
    files = trees.inventory(spark, str(tmp_path))
    (tmp_path / "d0/f2.txt").unlink()
    corpus = trees.with_text(spark, files)
    lost = classify.failures(corpus).collect()
    assert [(r["path"], r["error"]) for r in lost] == [
        (f"{tmp_path}/d0/f2.txt", "FileNotFoundError: No such file or directory")
    ]
    assert rows(statistics.index_stats(corpus)) == [(5, 4, 1, 0, 2, 8)]


def test_bad_roots(spark, tmp_path):
    with pytest.raises(ValueError):
        trees.inventory(spark, str(tmp_path / "missing"))
    write(tmp_path / "file.txt", b"x")
    with pytest.raises(ValueError):
        trees.inventory(spark, str(tmp_path / "file.txt"))


def test_empty_root(spark, tmp_path):
    corpus = trees.corpus_from_tree(spark, str(tmp_path))
    assert rows(statistics.index_stats(corpus)) == [(0, 0, 0, 0, 0, 0)]


def test_paths_keep_the_root_as_typed(spark, tmp_path, monkeypatch):
    write(tmp_path / "in/a.txt", b"x")
    monkeypatch.chdir(tmp_path)
    for root, expected in {"in": "in/a.txt", "./in": "./in/a.txt", "in/": "in/a.txt"}.items():
        assert [r["path"] for r in trees.inventory(spark, root).collect()] == [expected]


def test_directories_that_cannot_be_listed(tmp_path):
    """Without permission: passed over. For another reason: one inaccessible entry."""

    class Column:
        def __init__(self, values):
            self.values = values

        def to_pylist(self):
            return self.values

    class Batch:
        def column(self, name):
            return Column([b"closed", b"vanished"])

    def scandir(path):
        raise PermissionError(13, "closed") if path.endswith(b"closed") else FileNotFoundError(2, "gone")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(os, "scandir", scandir)
        found = [b for b in trees._list_directories(b"/")(iter([Batch()]))]
    assert [b.to_pylist() for b in found] == [
        [{"path": b"vanished", "kind": "unlisted", "error": "FileNotFoundError: gone"}]
    ]


def test_batches_are_bounded(monkeypatch):
    monkeypatch.setattr(trees, "BATCH_BYTES", 100)
    monkeypatch.setattr(trees, "BATCH_ROWS", 4)
    made = [(bytes(60), None, None) for _ in range(5)] + [(b"x", 1, None) for _ in range(9)]
    batches = list(trees._batches(made, trees._SIZED))
    assert sum(b.num_rows for b in batches) == 14
    assert all(b.num_rows <= 4 for b in batches)
    assert max(sum(len(p) for p in b.column("path").to_pylist()) for b in batches) <= 160


def test_scan_order(spark, tmp_path):
    for name in ["src1/a.txt", "src1-b/a.txt", "src1.txt"]:
        write(tmp_path / name, b"x")
    files = classify.in_scan_order(trees.inventory(spark, str(tmp_path)))
    names = {r["position"]: r["path"].removeprefix(f"{tmp_path}/") for r in files.collect()}
    assert names == {0: "src1/a.txt", 1: "src1-b/a.txt", 2: "src1.txt"}


def test_many_files_match_brute_force(spark, tmp_path):
    texts = {}
    for number in range(120):
        name = f"g{number % 7}/h{number % 3}/f{number}.md"
        texts[f"{tmp_path}/{name}"] = f"Word{number % 11} common, common x{number}\n"
        write(tmp_path / name, texts[f"{tmp_path}/{name}"].encode())
    found = rows(postings.postings(trees.corpus_from_tree(spark, str(tmp_path))))
    assert {(w, p): n for w, p, n in found} == brute_force(texts)


def test_listing_by_spark(spark, tree):
    corpus = trees.corpus_from_store(spark, str(tree / "sub"), LIMIT)
    found = {r["path"].removeprefix(f"{tree}/sub/"): r["size_bytes"] for r in
             corpus.select("path", "size_bytes").collect()}
    assert found == {"a b%20c.csv": 2, "bad.txt": 28, "exact.txt": LIMIT}
