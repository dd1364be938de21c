import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sample_tree(tmp_path):
    """Two small files with shared words, a hyphen, a heading and repeated terms."""
    root = tmp_path / "samples"
    root.mkdir()
    (root / "notes.txt").write_text(
        "Concurrency is kept apart: every task counts its own lines and sends totals.\n"
        "The merged table of totals is written when the last file ends.\n"
    )
    (root / "readme.md").write_text(
        "# Reading Guide\n\n"
        "Rows are sorted by score, and a path tie-rule settles the others, so two files\n"
        "with one score never swap places.\n"
    )
    return root


def table(spark, texts):
    """A corpus table from a dict of path to text."""
    return spark.createDataFrame(list(texts.items()), "path string, text string")


def brute_force(texts):
    """Postings computed in plain Python, as {(word, path): frequency}."""
    counts = {}
    for path, text in texts.items():
        word = ""
        for character in text + " ":
            if character.isascii() and character.isalnum():
                word += character.lower()
            elif word:
                counts[word, path] = counts.get((word, path), 0) + 1
                word = ""
    return counts


def rows(df):
    return [tuple(row) for row in df.collect()]
