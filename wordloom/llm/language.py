"""Language identification, words first.

A word the model knows is scored by its log frequency in each language. For
other words the model falls back to character n-grams, longest first, until one
of them is known. A text is scored by the sum over its words.
"""

from __future__ import annotations

import io
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.scratch import resident, shared_folder
from wordloom.llm.token_files import store, write_whole

#: Labelled documents of each language that the model is fitted on, about. This
#: and the sizes below are its bounds; all of a language are used if it has fewer.
FIT_DOCUMENTS = 2_000
#: Most frequent words of a language that the model knows.
KNOWN_WORDS = 20_000
#: Most frequent n-grams of a language, by length.
KNOWN_GRAMS = {4: 12_000, 3: 6_000, 2: 2_000, 1: 500}
#: Words whose scores a worker keeps.
_KEPT_WORDS = 150_000
#: N-grams of a word that are listed in one go, and different ones that are counted in one go.
_GRAM_BLOCK, _COUNTED_GRAMS = 65_536, 200_000

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
#: Longest word whose scores are kept; longer ones are scored each time they occur.
_KEPT_LENGTH = 64
_COUNTS = "lang string, size int, gram string, n bigint"
_PREDICTED = "doc_id bigint, lang_pred string, score double"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from fitting: crc32 of its id modulo 3 is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def words_of(text: str | None) -> list[str]:
    """Runs of letters of a whole text, in lower case. Numerals such as superscripts are no letters."""
    found = _WORD.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    letters = ("".join(c if c.isalpha() else " " for c in word) for word in found)
    return [word for part in letters for word in part.split()]


def _grams(word: str, size: int) -> Iterator[list[str]]:
    """N-grams of a whole word with its ends marked, in blocks; single letters are not marked."""
    marked = word if size == 1 else f"_{word}_"
    count = len(marked) - size + 1
    for first in range(0, count, _GRAM_BLOCK):
        yield [marked[at : at + size] for at in range(first, min(first + _GRAM_BLOCK, count))]


def _count_rows(rows: list[tuple[str, int, str, int]]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)],
        ["lang", "size", "gram", "n"],
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (size 0) and n-grams of labelled texts, added up per batch of rows and bounded in number."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            words: dict[str, Counter] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(words_of(text))
            rows = []
            for lang, counts in words.items():
                rows += [(lang, 0, word, n) for word, n in counts.items()]
                for size in KNOWN_GRAMS:
                    grams: Counter = Counter()
                    for word, n in counts.items():
                        for block in _grams(word, size):
                            for gram in block:
                                grams[gram] += n
                            if len(grams) > _COUNTED_GRAMS:
                                yield _count_rows([(lang, size, gram, n) for gram, n in grams.items()])
                                grams.clear()
                    rows += [(lang, size, gram, n) for gram, n in grams.items()]
                    if len(rows) > _COUNTED_GRAMS:
                        yield _count_rows(rows)
                        rows = []
            if rows:
                yield _count_rows(rows)


class Model:
    """Log frequencies of words and n-grams by language."""

    def __init__(self, langs: list[str], tables: dict[int, tuple[list[str], np.ndarray]]):
        self.langs = langs
        self._tables = {
            size: (dict(zip(grams, range(len(grams)))), logs) for size, (grams, logs) in tables.items()
        }
        # All tables one below the other, words first, then n-grams from long to short.
        self._order = [size for size in (0, *sorted((s for s in tables if s), reverse=True)) if size in tables]
        self._logs = np.concatenate([self._tables[size][1] for size in self._order] or [np.zeros((0, len(langs)))])
        sizes = [len(self._tables[size][0]) for size in self._order]
        self._levels = [(size, self._tables[size][0], sum(sizes[:at])) for at, size in enumerate(self._order)]
        self._rows: dict[str, int] = {}
        self._scores = np.zeros((1024, len(langs)))

    @classmethod
    def from_counts(cls, rows: list[tuple[str, int, str, int]]) -> Model:
        langs = sorted({row[0] for row in rows})
        tables = {}
        for size in sorted({row[1] for row in rows}):
            grams = sorted({row[2] for row in rows if row[1] == size})
            place = dict(zip(grams, range(len(grams))))
            counts = np.zeros((len(grams), len(langs)))
            for lang, kind, gram, n in rows:
                if kind == size:
                    counts[place[gram], langs.index(lang)] = n
            # Half a count for what a language has not shown.
            counts += 0.5
            tables[size] = (grams, np.log(counts / counts.sum(axis=0)))
        return cls(langs, tables)

    def dump(self) -> bytes:
        arrays = {"langs": np.array(self.langs, dtype=object)}
        for size, (grams, logs) in self._tables.items():
            arrays[f"grams{size}"] = np.array(list(grams), dtype=object)
            arrays[f"logs{size}"] = logs.astype(np.float32)
        out = io.BytesIO()
        np.savez_compressed(out, **arrays)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        arrays = np.load(io.BytesIO(data), allow_pickle=True)
        sizes = [int(name[5:]) for name in arrays.files if name.startswith("grams")]
        return cls(
            arrays["langs"].tolist(),
            {size: (arrays[f"grams{size}"].tolist(), arrays[f"logs{size}"].astype(np.float64)) for size in sizes},
        )

    def word_scores(self, word: str) -> np.ndarray:
        """Scores of one word: its own, or those of the longest n-grams that are known."""
        for size in (0, *sorted((s for s in self._tables if s), reverse=True)):
            known, logs = self._tables.get(size, ({}, None))
            total, count = np.zeros(len(self.langs)), 0
            for block in [[word]] if size == 0 else _grams(word, size):
                found = [known[gram] for gram in block if gram in known]
                if found:
                    total, count = total + logs[found].sum(axis=0), count + len(found)
            if count:
                return total / count
        return np.zeros(len(self.langs))

    def _known(self, word: str) -> list[int]:
        """Rows of what the model knows of a word: itself, or its longest n-grams that are known."""
        for size, known, first in self._levels:
            if size == 0:
                row = known.get(word)
                if row is not None:
                    return [row]
                continue
            marked = word if size == 1 else f"_{word}_"
            grams = [marked[at : at + size] for at in range(len(marked) - size + 1)]
            rows = [known[gram] + first for gram in grams if gram in known]
            if rows:
                return rows
        return []

    def scores_of(self, words: list[str]) -> np.ndarray:
        """The scores of many words, a row each; very long words are scored by themselves."""
        out = np.zeros((len(words), len(self.langs)))
        rows = [[] if len(word) > _GRAM_BLOCK else self._known(word) for word in words]
        counts = np.array([len(one) for one in rows], np.int64)
        some = np.flatnonzero(counts)
        if len(some):
            starts = (np.cumsum(counts) - counts)[some]
            sums = np.add.reduceat(self._logs[[row for one in rows for row in one]], starts, axis=0)
            out[some] = sums / counts[some, None]
        for at, word in enumerate(words):
            if len(word) > _GRAM_BLOCK:
                out[at] = self.word_scores(word)
        return out

    def _keep(self, word: str, scores: np.ndarray) -> None:
        """Remember a word while there is room; the frequent ones come early."""
        row = len(self._rows)
        if row >= _KEPT_WORDS or len(word) > _KEPT_LENGTH:
            return
        if row >= len(self._scores):
            self._scores = np.concatenate([self._scores, np.zeros_like(self._scores)])
        self._scores[row] = scores
        self._rows[word] = row

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score of a text; the score is the posterior of its mean word."""
        words = words_of(text)
        if not words or not self.langs:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.langs))
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            rows = list(map(self._rows.get, part))
            gaps = [place for place, row in enumerate(rows) if row is None]
            unknown = list({part[place] for place in gaps})
            new = dict(zip(unknown, self.scores_of(unknown)))
            scores = self._scores[[0 if row is None else row for row in rows]]
            if gaps:
                scores[gaps] = [new[part[place]] for place in gaps]
            for word, found in new.items():
                self._keep(word, found)
            total += scores.sum(axis=0)
        mean = total / len(words)
        odds = np.exp(mean - mean.max())
        best = int(mean.argmax())
        return self.langs[best], float(odds[best] / odds.sum())


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Fit a model on labelled rows; rows without a label or a text teach nothing.

    About ``FIT_DOCUMENTS`` rows of each language are used, picked by a digest of
    ``key``. What reaches the driver is bounded by the known words and n-grams.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit("fit"), F.col(key)).alias("pick")
    )
    sizes = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], {})
    share = F.lit(None).cast("double")
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, FIT_DOCUMENTS / n)).otherwise(share)
    picked = rows.where(F.pmod(F.col("pick"), F.lit(1 << 30)) < share * (1 << 30))
    counts = (
        picked.select("lang", "text")
        .mapInArrow(_count, _COUNTS)
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("n"))
    )
    most = F.lit(KNOWN_WORDS)
    for size, number in KNOWN_GRAMS.items():
        most = F.when(F.col("size") == size, number).otherwise(most)
    place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram"))
    # A first cut in parts, so that no task ranks all words of a language.
    part = F.pmod(F.xxhash64("gram"), F.lit(64))
    first = F.row_number().over(
        Window.partitionBy("lang", "size", "part").orderBy(F.desc("n"), "gram")
    )
    best = (
        counts.withColumn("part", part)
        .withColumn("first", first)
        .where(F.col("first") <= most)
        .withColumn("place", place)
        .where(F.col("place") <= most)
    )
    return Model.from_counts([tuple(row) for row in best.select("lang", "size", "gram", "n").collect()])


def _loaded(location: str) -> Model:
    def load() -> Model:
        files, path = store(location)
        with files.open_input_file(path) as file:
            return Model.load(file.read())

    return resident(("language", location), load)


def save(model: Model, folder: str) -> str:
    """Write a model where executors can read it and return its place."""
    files, path = store(folder)
    files.create_dir(path, recursive=True)
    write_whole(files, f"{path}/model.npz", model.dump())
    return f"{folder}/model.npz"


def _predictor(location: str):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _loaded(location)
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return predict


def identify(docs: DataFrame, location: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Predict languages with a saved model: (doc_id, lang_pred, score).

    One row per input row; other columns are left out and never looked at. A
    null text and one without letters are ``und`` with score 0; equal scores go
    to the first language by name. A model that was fitted on nothing says
    ``und`` to everything.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_predictor(location), _PREDICTED)


def _keeper(location: str, least_score: float, text_at: int, lang_at: int | None):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _loaded(location)
        for batch in batches:
            texts = (text.as_py() for text in batch.column(text_at))
            if model.langs:
                found = [model.predict(text) for text in texts]
                good = [lang != UNKNOWN and score >= least_score for lang, score in found]
                if lang_at is not None:
                    label = batch.schema.field(lang_at)
                    told = pa.array([lang for lang, _ in found], pa.string()).cast(label.type)
                    batch = batch.set_column(lang_at, label, pc.coalesce(batch.column(lang_at), told))
            else:
                good = [bool(words_of(text)) for text in texts]
            yield batch.filter(pa.array(good, pa.bool_()))

    return keep


def identified_documents(
    docs: DataFrame, location: str, text: str = "text", least_score: float = 0.0, lang: str | None = None
) -> DataFrame:
    """The rows of ``docs`` whose language can be told.

    They are unchanged, except that with ``lang`` rows that have no language in
    that column get the one that was told; a given one stays as it is.
    A model that was fitted on nothing tells no language and gives no score, so
    with it all rows with a letter stay, whatever ``least_score`` is.
    """
    lang_at = None if lang is None else docs.columns.index(lang)
    return docs.mapInArrow(_keeper(location, least_score, docs.columns.index(text), lang_at), docs.schema)


def fitted(docs: DataFrame) -> str:
    """Fit on the documents that are not held out; returns where the model is."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return save(model, shared_folder(docs.sparkSession, "language"))
