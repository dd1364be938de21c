import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, awkward_rows, empty

from wordloom.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def sequences(histogram, capacity, groups=packing.GROUPS):
    """Number of sequences of a plan, after checking that it is one."""
    runs = packing.plan(histogram, capacity, groups)
    ranks, taken = defaultdict(list), []
    for run in runs:
        offset = 0
        for length, rank, at in run.items:
            assert at == offset
            offset += length
            ranks[length].append((rank, rank + run.count))
        assert offset == run.used <= capacity
        taken.append((run.first, run.first + run.count))
    for spans in (sorted(taken), *map(sorted, ranks.values())):
        assert all(one[1] <= other[0] for one, other in zip(spans, spans[1:]))
    for length, count in histogram.items():
        spans = sorted(ranks[length])
        assert spans[0][0] == 0 and spans[-1][1] == count == sum(b - a for a, b in spans)
    return sum(run.count for run in runs)


def best_fit_decreasing(histogram, capacity):
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fitting = [at for at, room in enumerate(rooms) if room >= length]
            if fitting:
                rooms[min(fitting, key=lambda at: rooms[at])] -= length
            else:
                rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("capacity", [30, 200, 1024])
def test_plans_are_near_the_lower_bound(seed, capacity):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, capacity + 1, 800) if seed % 2 else np.minimum(capacity, rng.lognormal(3, 1, 800).astype(int) + 1)
    histogram = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}
    used = sequences(histogram, capacity)
    assert used <= best_fit_decreasing(histogram, capacity) * 1.01 + 1
    sequences(histogram, capacity, groups=7)


def test_perfect_and_awkward_histograms():
    assert sequences({1024: 5}, 1024) == 5
    assert sequences({600: 100, 424: 100}, 1024) == 100
    assert sequences({1: 5000}, 1024) == 5
    assert sequences({513: 7}, 1024) == 7
    assert sequences({341: 4, 342: 2}, 1024) == 2
    assert packing.plan({}, 1024) == [] and packing.plan({5: 0}, 1024) == []
    with pytest.raises(ValueError):
        packing.plan({2000: 1}, 1024)


def test_nothing_is_rounded_while_there_are_groups_for_all_lengths():
    skewed = {1024: 3_000_000, **{length: 6_000 for length in range(129, 1024)}}
    cut = packing.grouped(skewed, packing.GROUPS)
    assert cut == [[(length, skewed[length])] for length in sorted(skewed, reverse=True)]
    assert len(packing.grouped(skewed, 800)) <= 800 and any(len(group) > 1 for group in packing.grouped(skewed, 800))
    sequences(skewed, 1024)


def test_the_plan_does_not_grow_with_the_corpus():
    small = packing.plan_rows(packing.plan({n: 50 for n in range(1, 1025)}))
    large = packing.plan_rows(packing.plan({n: 50_000_000 + n for n in range(1, 1025)}))
    assert len(large) < 4 * len(small) < 20_000


def check(rows, found, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    wanted = defaultdict(int)
    for doc_id, text, *_ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(min(first, len(ids)), len(ids), capacity), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    got = defaultdict(int)
    places = defaultdict(list)
    for row in found:
        got[tuple(row)[:5]] += 1
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    assert got == wanted
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_awkward_rows(spark, capacity, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 3)
    docs = awkward(spark, ["length", "rank", "piece", "rows", "of"])
    found = packing.packed_documents(docs, VOCABULARY, capacity=capacity).collect()
    used = check(awkward_rows(), found, capacity)
    assert used <= -(-sum(row["length"] for row in found) // capacity) + 2


def test_a_hot_length_is_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 10)
    rows = [(n, "one two", None, None, None) for n in range(300)] + [(n, "a " * (n % 50), None, None, None) for n in range(300, 500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n bigint").repartition(5)
    check(rows, packing.packed_documents(docs, VOCABULARY, capacity=64).collect(), 64)


def test_empty_table(spark):
    assert packing.packed_documents(empty(spark), VOCABULARY).collect() == []
