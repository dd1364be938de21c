"""Spelling variants: words one edit apart, found through a reduced alphabet.

The letters of a word are hashed to a few symbols. One edit of a word is one
edit of its reduced form, or none, so the full one-edit neighbourhood of the
reduced form holds the reduced forms of all near words. With few symbols that
neighbourhood is small; it is listed as 64-bit hashes, looked up in a bitmap of
the reduced vocabulary, joined with the vocabulary itself and verified on the
words as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.scratch import kept, resident, shared_folder
from wordloom.llm.token_files import store, write_whole

#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: Words that may share a reduced form. Those of a larger group are searched for
#: over the whole alphabet, where each has a form of its own.
GROUP_WORDS = 512
#: Fixed value: code points 0 to 255 hold every letter of a word.
WHOLE_ALPHABET = 256
#: Runs whose checksum this divides lose a code point.
TYPO_EVERY = 97
LEAST_LENGTH, LEAST_COUNT, STRONGER = 5, 3, 2

#: Size of the bitmap of a reduced vocabulary, as a power of two in bits: 16 MiB,
#: whatever the vocabulary. A fuller one rules out less and changes no result.
BITMAP_BITS = 27
#: Fixed value: bits in one of Spark's bitmap buckets.
_BUCKET_BITS = 32_768

#: Words whose neighbourhoods one task lists.
TASK_WORDS = 50_000
#: Letters of words, and positions of a long one, that are worked on at once.
_CELLS = 1 << 18
#: Pieces that the targets of frequent keys are cut into when chains are followed.
_SALTS = 8

_RUN = "[A-Za-z\\u00C0-\\u00FF]+"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def runs(text: Column) -> Column:
    """Maximal runs of letters of a whole text, with A to Z in lower case; none for null."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, lower), F.lit(_RUN), F.lit(0))


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The vocabulary: (word, n). A null id is written as an empty text before the colon.

    Words are counted on the map side before they are shuffled. A run only gets
    shorter, so the short ones are dropped before their checksum is taken.
    """
    run, mark = F.col("run"), F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")))
    at = (F.col("mark") % F.length(run)).cast("int")
    typed = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return (
        docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs(F.col(text))).alias("run"))
        .where(F.length("run") >= LEAST_LENGTH)
        .select("run", mark.alias("mark"))
        .select(F.when(F.col("mark") % TYPO_EVERY == 0, typed).otherwise(run).alias("word"))
        .where(F.length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


def _mixed(value: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


class Alphabet:
    """Code points hashed to ``symbols`` symbols, each with a 64-bit value."""

    def __init__(self, symbols: int):
        points = np.arange(256, dtype=np.uint64)
        whole = symbols >= WHOLE_ALPHABET
        self.size = WHOLE_ALPHABET if whole else symbols
        self.of = (points if whole else _mixed(points * _BASE) % np.uint64(symbols)).astype(np.int16)
        self.used = np.unique(self.of)
        self.values = _mixed(np.arange(1, self.size + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _powers(count: int) -> np.ndarray:
    powers = np.full(count, _BASE, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _key(sums: np.ndarray, length: int) -> np.ndarray:
    """The hash of a form from the sum over its symbols and its length."""
    return _mixed(sums + np.uint64(length * 0xA24BAED4963EE407 % (1 << 64))).view(np.int64)


def _groups(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of equal length as (places in the column, matrix of code points)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    texts = column.to_pylist()
    lengths = np.array([len(one) for one in texts])
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        for first in range(0, len(places), max(1, _CELLS // max(length, 1))):
            some = places[first : first + max(1, _CELLS // max(length, 1))]
            joined = "".join(texts[place] for place in some.tolist()).encode("latin-1")
            yield some, np.frombuffer(joined, np.uint8).reshape(len(some), length)


def form_keys(column: pa.Array, alphabet: Alphabet) -> np.ndarray:
    """The hash of each word's own reduced form."""
    out = np.zeros(len(column), np.int64)
    for places, points in _groups(column):
        terms = alphabet.values[alphabet.of[points]] * _powers(points.shape[1])
        out[places] = _key(terms.sum(axis=1, dtype=np.uint64), points.shape[1])
    return out


def neighbour_keys(points: np.ndarray, alphabet: Alphabet) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the full one-edit neighbourhood of reduced words of one length.

    Yields (row, hash) in bounded parts: the form itself, each deletion, each
    insertion and each replacement. Edits that give one form are listed once.
    """
    count, length = points.shape
    form = alphabet.of[points]
    powers = _powers(length + 2)
    terms = alphabet.values[form] * powers[:length]
    before = np.zeros((count, length + 1), np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    total = before[:, -1:]
    rows = np.arange(count)
    yield rows, _key(total[:, 0], length)
    step = max(1, _CELLS // count)
    for first in range(0, length + 1, step):
        stop = min(first + step, length + 1)
        inside = slice(first, min(stop, length))
        head, tail = before[:, first:stop], total - before[:, first:stop]
        symbol = form[:, inside]
        width = symbol.shape[1]
        if width:
            rest = total - before[:, first + 1 : first + 1 + width]
            keys = _key(head[:, :width] + rest * _BASE_BACK, length - 1)
            # In a run of one symbol every deletion gives the same form.
            fresh = np.ones(symbol.shape, bool)
            fresh[:, 1:] = symbol[:, 1:] != symbol[:, :-1]
            if first:
                fresh[:, 0] = symbol[:, 0] != form[:, first - 1]
            row, place = np.nonzero(fresh)
            yield row, keys[row, place]
        for other in alphabet.used.tolist():
            value = alphabet.values[other]
            # Before an equal symbol is the same as after it, so it is left to the place after.
            keys = _key(head + value * powers[first:stop] + tail * _BASE, length + 1)
            fresh = np.ones(keys.shape, bool)
            fresh[:, :width] = symbol != other
            row, place = np.nonzero(fresh)
            yield row, keys[row, place]
            if width:
                keys = _key(total - terms[:, inside] + value * powers[inside], length)
                row, place = np.nonzero(symbol != other)
                yield row, keys[row, place]


def _form_adder(symbols: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet(symbols)
        for batch in batches:
            keys = pa.array(form_keys(batch.column(0), alphabet))
            yield pa.RecordBatch.from_arrays([keys, batch.column(0), batch.column(1)], ["form", "word", "n"])

    return add


def forms(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """(form, word, n): every word with the hash of its reduced form."""
    return vocabulary.select("word", "n").mapInArrow(_form_adder(symbols), "form bigint, word string, n bigint")


def _bit(form: Column) -> Column:
    return F.shiftrightunsigned(form, 64 - BITMAP_BITS)


def bitmap(reduced: DataFrame) -> str:
    """Write the bitmap of all forms to the shared folder; returns its place.

    Bits are gathered by Spark in buckets of 4 KiB, of which there are at most
    4,096, so what the driver handles does not grow with the vocabulary.
    """
    bit = _bit(F.col("form"))
    parts = reduced.groupBy(F.floor(bit / _BUCKET_BITS).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(bit % _BUCKET_BITS).alias("bits")
    )
    whole = bytearray(1 << (BITMAP_BITS - 3))
    size = _BUCKET_BITS // 8
    for row in parts.collect():
        whole[row["bucket"] * size : (row["bucket"] + 1) * size] = row["bits"]
    folder = shared_folder(reduced.sparkSession, "forms")
    files, path = store(folder)
    files.create_dir(path, recursive=True)
    write_whole(files, f"{path}/bitmap", bytes(whole))
    return f"{folder}/bitmap"


def _bits(location: str) -> np.ndarray:
    def load() -> np.ndarray:
        files, path = store(location)
        with files.open_input_file(path) as file:
            return np.frombuffer(file.read(), np.uint8)

    return resident(("bitmap", location), load)


def _prober(location: str, symbols: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, bits = Alphabet(symbols), _bits(location)
        shift = np.uint64(64 - BITMAP_BITS)
        for batch in batches:
            for places, points in _groups(batch.column(0)):
                for rows, keys in neighbour_keys(points, alphabet):
                    bit = keys.view(np.uint64) >> shift
                    there = np.flatnonzero((bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)
                    for first in range(0, len(there), 65_536):
                        some = there[first : first + 65_536]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[some]), batch.column(0).take(pa.array(places[rows[some]]))], ["form", "word"]
                        )

    return probe


def neighbours(vocabulary: DataFrame, reduced: DataFrame, symbols: int) -> DataFrame:
    """(form, word): forms one edit from a word's own that the vocabulary may hold.

    Listing costs far more than the bytes of a word suggest, so words are dealt
    to tasks by number.
    """
    probe = _prober(bitmap(reduced), symbols)
    tasks = max(vocabulary.sparkSession.sparkContext.defaultParallelism, vocabulary.count() // TASK_WORDS)
    return vocabulary.select("word").repartition(tasks, "word").mapInArrow(probe, "form bigint, word string")


def _verified(probes: DataFrame, reduced: DataFrame) -> DataFrame:
    """Join neighbourhoods with the reduced vocabulary; one edit exactly stays."""
    found = reduced.select("form", F.col("word").alias("near"), F.col("n").alias("near_n"))
    near = F.levenshtein("word", "near", 1) == 1
    return probes.join(found, "form").where((F.col("word") != F.col("near")) & near).select("word", "near", "near_n")


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS, group_words: int = GROUP_WORDS) -> DataFrame:
    """All pairs (word, near, near_n) that differ by one edit, in both directions.

    Two forms have one hash or one edit between them for one reason only, so a
    pair comes once. Words of a form that more than ``group_words`` share are
    found through the whole alphabet instead, by the words whose neighbourhood
    touches that form; no group is ever paired with itself in full.
    """
    reduced = kept(forms(vocabulary, symbols))
    probes = kept(neighbours(vocabulary, reduced, symbols))
    crowded = kept(reduced.groupBy("form").agg(F.count("*").alias("words")).where(F.col("words") > group_words))
    if crowded.isEmpty():
        return _verified(probes, reduced).distinct()
    crowd = crowded.select("form")
    light = _verified(probes.join(crowd, "form", "left_anti"), reduced.join(crowd, "form", "left_anti"))
    targets = kept(forms(reduced.join(crowd, "form", "left_semi"), WHOLE_ALPHABET))
    sources = kept(probes.join(crowd, "form", "left_semi").select("word").distinct())
    heavy = _verified(neighbours(sources, targets, WHOLE_ALPHABET), targets)
    return light.unionByName(heavy).distinct()


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form) without cycles: the last word of each chain.

    Chains are followed by doubling, so one of a length of 2^k takes k rounds;
    counts at least double along a chain, which bounds it by 63. The targets
    are copied to ``_SALTS`` pieces, since a form may be that of very many words.
    """
    reached = kept(links.select("word", F.col("form").alias("root")))
    salt = F.pmod(F.xxhash64("word"), F.lit(_SALTS)).cast("int")
    while True:
        further = reached.select(
            F.col("word").alias("root"),
            F.col("root").alias("beyond"),
            F.explode(F.array(*[F.lit(one) for one in range(_SALTS)])).alias("salt"),
        )
        stepped = kept(reached.withColumn("salt", salt).join(further, ["root", "salt"], "left"))
        reached = stepped.select("word", F.coalesce("beyond", "root").alias("root"))
        if stepped.where(F.col("beyond").isNotNull()).isEmpty():
            return reached


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every word with its stronger spelling: (word, form, root, n, n_near, form_n).

    ``form`` is the near word of largest count, ties to the smaller one in
    code-point order, if it occurs at least twice as often as the word; ``root``
    is the last word of the chain of forms. Null and empty texts hold no words;
    repeated rows count as often as they occur; a null id counts as an empty
    one; words of any length are compared whole. An empty table gives no rows.
    Other columns are never looked at.
    """
    vocabulary = kept(words(docs, doc_id, text))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    summed = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= STRONGER * F.col("n")
    told = kept(
        vocabulary.join(summed, "word", "left").select(
            "word",
            F.when(strong, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(strong, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(told.where(F.col("form").isNotNull()).select("word", "form"))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
