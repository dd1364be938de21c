import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import SCHEMA, awkward, awkward_rows, empty, fold, sorted_rows
from wordloom.llm import queries, spelling


def vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = fold(run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if mark % 97 == 0:
                at = mark % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 5:
                counts[word] += 1
    return {word: n for word, n in counts.items() if n >= 3}


def one_edit(one, other):
    if len(one) > len(other):
        one, other = other, one
    if len(other) - len(one) > 1 or one == other:
        return False
    at = 0
    while at < len(one) and one[at] == other[at]:
        at += 1
    return one[at:] == other[at + 1 :] if len(one) < len(other) else one[at + 1 :] == other[at + 1 :]


def variants(counts):
    """Every pair compared, then every chain followed word by word."""
    out, forms = {}, {}
    by_length = {}
    for word in counts:
        by_length.setdefault(len(word), []).append(word)
    for word, n in counts.items():
        near = [o for size in (-1, 0, 1) for o in by_length.get(len(word) + size, ()) if one_edit(word, o)]
        best = min(near, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= 2 * n:
            forms[word] = best
        out[word] = len(near)
    rows = []
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        rows.append((word, form, root, n, out[word], counts.get(form)))
    return sorted(rows, key=repr)


def texts(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)


def drawn(seed=3, words=150):
    """Words over few letters, with many neighbours and chains of counts."""
    rng = random.Random(seed)
    made = ["".join(rng.choice("abé÷xyZ") for _ in range(rng.randint(4, 8))) for _ in range(words)]
    made += [w[:i] + rng.choice("abcdeÀ") + w[i:] for w in made for i in (0, 2, len(w))]
    rows = []
    for number in range(40):
        rows.append((number, " ".join(rng.choice(made[: 1 + rng.randrange(len(made))]) for _ in range(200))))
    chain = [("kettle", 4), ("kettles", 9), ("kettlers", 19), ("nettlers", 40), ("nettler", 41)]
    rows += [(50 + at, " ".join([word] * n)) for at, (word, n) in enumerate(chain)]
    return rows


def test_equals_comparing_all_pairs(spark):
    rows = drawn()
    wanted = variants(vocabulary(rows))
    assert any(r[1] and r[1] != r[2] for r in wanted)
    assert sorted_rows(spelling.spelling_variants(texts(spark, rows))) == wanted


def test_crowded_forms_are_searched_over_the_whole_alphabet(spark):
    counts = vocabulary(drawn(7, 300))
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    pairs = {(w, o) for w in counts for o in counts if one_edit(w, o)}
    for symbols, group_words in [(8, 512), (2, 3), (1, 2), (2, 0)]:
        found = spelling.near_words(table, symbols, group_words).collect()
        assert len(found) == len(pairs)
        assert {(r["word"], r["near"]) for r in found} == pairs
        assert all(r["near_n"] == counts[r["near"]] for r in found)


@pytest.mark.parametrize("symbols", [1, 3, 8, spelling.WHOLE_ALPHABET])
@pytest.mark.parametrize("cells", [4, 1 << 18])
def test_neighbourhoods_are_full_and_list_each_form_once(symbols, cells, monkeypatch):
    monkeypatch.setattr(spelling, "_CELLS", cells)
    alphabet = spelling.Alphabet(symbols)
    letters = "abcdeéÿ"
    for word in ["abcde", "aaaaa", "éaéaÿb"]:
        column = pa.array([word, word[::-1]])
        listed = {0: [], 1: []}
        for places, points in spelling._groups(column):
            for rows, keys in spelling.neighbour_keys(points, alphabet):
                for row, key in zip(rows.tolist(), keys.tolist()):
                    listed[places[row]].append(key)
        assert all(len(keys) == len(set(keys)) for keys in listed.values())
        edits = [word, *(word[:i] + word[i + 1 :] for i in range(len(word)))]
        edits += [word[:i] + c + word[i:] for c in letters for i in range(len(word) + 1)]
        edits += [word[:i] + c + word[i + 1 :] for c in letters for i in range(len(word))]
        assert set(spelling.form_keys(pa.array(edits), alphabet).tolist()) <= set(listed[0])


def test_bitmap_has_a_bit_for_each_form(spark):
    reduced = spark.range(5000).select(F.xxhash64("id").alias("form"))
    bits = spelling._bits(spelling.bitmap(reduced))
    for row in reduced.collect():
        bit = (row["form"] % (1 << 64)) >> (64 - spelling.BITMAP_BITS)
        assert bits[bit >> 3] >> (bit & 7) & 1
    assert int(np.unpackbits(bits).sum()) <= 5000


def test_chains_are_followed_to_their_end(spark):
    chain = [(f"w{at:02d}", f"w{at + 1:02d}") for at in range(21)] + [(f"x{at}", "w05") for at in range(30)]
    found = spelling.roots(spark.createDataFrame(chain, "word string, form string"))
    assert {tuple(r) for r in found.collect()} == {(word, "w21") for word, _ in chain}


def test_awkward_rows(spark):
    long_word = "".join(chr(97 + (at * at + at // 7) % 26) for at in range(20_000))
    extra = [(20 + at, long_word, None, None, None) for at in range(3)]
    extra += [(30 + at, long_word[:9000] + "q" + long_word[9000:], None, None, None) for at in range(4)]
    rows = [row[:2] for row in awkward_rows()] + [row[:2] for row in extra]
    docs = awkward(spark).unionByName(spark.createDataFrame(extra, SCHEMA))
    for name in ("word", "form", "root", "n", "run", "mark", "id"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs = docs.withColumn("notes", F.create_map(F.lit("a"), F.lit(1)))
    wanted = variants(vocabulary(rows))
    assert any(len(row[0]) > 10_000 and row[4] for row in wanted)
    assert sorted_rows(spelling.spelling_variants(docs)) == wanted


def test_empty_table(spark):
    found = spelling.spelling_variants(empty(spark))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found.count() == 0


def test_query_on_the_given_table(spark):
    directory = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{directory}/documents.parquet").collect()]
    found = sorted_rows(queries.op12_spelling_variants(spark, directory))
    wanted = vocabulary(rows)
    assert {r[0]: r[3] for r in found} == wanted
    # Neighbours by deletion: two words are near if they share a word less one letter, then compared.
    by_deletion = {}
    for word in wanted:
        for form in {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}:
            by_deletion.setdefault(form, set()).add(word)
    near = {word: set() for word in wanted}
    for group in by_deletion.values():
        for word in group:
            near[word].update(o for o in group if one_edit(word, o))
    assert {r[0]: r[4] for r in found} == {word: len(others) for word, others in near.items()}
    for word, form, root, n, _, form_n in found:
        best = min(near[word], key=lambda o: (-wanted[o], o), default=None)
        strong = best is not None and wanted[best] >= 2 * n
        assert (form, form_n) == ((best, wanted[best]) if strong else (None, None))
        assert root == word if form is None else root != word
