"""Packing documents into sequences of bounded length.

Lengths are whole numbers up to the capacity, so the whole problem is a
histogram of at most that many rows, whatever the corpus. The packing is decided
on the histogram, for runs of equal sequences:

1. Linear grouping: the large lengths, longest first, are cut into groups of
   equal cardinality, and every length counts as the longest of its group. Where
   there are no more lengths than groups, each is a group and nothing is rounded.
2. Configurations of these few sizes are chosen, each filled as far as its sizes
   allow, and used as often as the counts permit.
3. The actual documents take the places of the rounded ones.
4. The small documents go where they fit best, into new sequences at the end.

Documents then find their place by their rank among those of the same length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.scratch import kept, lookup
from wordloom.llm.tokens import KEPT_BYTES, encoder

CAPACITY = 1024
#: Lengths above this part of the capacity are large.
SMALL_PART = 8
#: Groups of the linear grouping.
GROUPS = 1024
#: Pieces of one length that are numbered in one go.
RANK_ROWS = 50_000

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PLAN = "length bigint, first_rank bigint, last_rank bigint, first_sequence bigint, offset bigint"


@dataclass
class Run:
    """``count`` sequences with equal contents: (length, rank in the first, offset)."""

    first: int
    count: int
    used: int = 0
    items: list[tuple[int, int, int]] = field(default_factory=list)

    def split(self, count: int) -> tuple[Run, Run]:
        """The first ``count`` sequences, and the others."""
        rest = [(length, rank + count, offset) for length, rank, offset in self.items]
        return (
            Run(self.first, count, self.used, list(self.items)),
            Run(self.first + count, self.count - count, self.used, rest),
        )


class _Supply:
    """Documents by length, handed out as ranks."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.next = defaultdict(int)

    def take(self, length: int, count: int) -> int:
        rank = self.next[length]
        self.next[length] += count
        self.left[length] -= count
        return rank


def grouped(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths, longest first, in groups of equal cardinality as (length, count).

    No more lengths than groups are groups of their own.
    """
    if len(counts) <= groups:
        return [[(length, counts[length])] for length in sorted(counts, reverse=True)]
    total = sum(counts.values())
    each = max(1, -(-total // groups))
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        count = counts[length]
        while count:
            if not room:
                out.append([])
                room = each
            here = min(room, count)
            out[-1].append((length, here))
            room -= here
            count -= here
    return out


def _fullest(room: int, sizes: list[int], left: list[int], last: int) -> list[tuple[int, int]]:
    """Sizes from ``last`` on that fill ``room`` as far as they can: (place, how many).

    Longer sizes come first, so short ones remain for later.
    """
    reach = [0] * (len(sizes) + 1)
    reach[len(sizes)] = 1
    mask = (1 << (room + 1)) - 1
    for place in range(len(sizes) - 1, last - 1, -1):
        size, can = sizes[place], reach[place + 1]
        times = min(left[place], room // size)
        step = 1
        while times > 0 and size <= room:
            now = min(step, times)
            can |= (can << (size * now)) & mask
            times -= now
            step *= 2
        reach[place] = can
    fill = reach[last].bit_length() - 1
    chosen = []
    for place in range(last, len(sizes)):
        if fill == 0:
            break
        size = sizes[place]
        most = min(left[place], fill // size)
        for times in range(most, -1, -1):
            if reach[place + 1] >> (fill - times * size) & 1:
                if times:
                    chosen.append((place, times))
                    fill -= times * size
                break
    return chosen


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Contents by place in ``sizes``, longest first, and how many sequences have them."""
    left = list(counts)
    out = []
    for place, size in enumerate(sizes):
        while left[place]:
            left[place] -= 1
            rest = _fullest(capacity - size, sizes, left, place)
            left[place] += 1
            need = defaultdict(int, {place: 1})
            for other, times in rest:
                need[other] += times
            uses = min(left[other] // times for other, times in need.items())
            for other, times in need.items():
                left[other] -= times * uses
            out.append((sorted(need.items()), uses))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs of sequences that hold every document of a histogram of lengths once."""
    counts = {length: count for length, count in histogram.items() if count > 0}
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    supply = _Supply(counts)
    small = capacity // SMALL_PART
    cut = grouped({length: n for length, n in counts.items() if length > small}, groups)
    # Groups that round to the same length are one size.
    sizes = sorted({group[0][0] for group in cut}, reverse=True)
    members: dict[int, list[list[int]]] = {size: [] for size in sizes}
    for group in cut:
        members[group[0][0]] += [list(pair) for pair in group]
    totals = [sum(n for _, n in members[size]) for size in sizes]
    runs: list[Run] = []
    sequence = 0
    for contents, uses in configurations(sizes, totals, capacity):
        slots = [sizes[place] for place, times in contents for _ in range(times)]
        waiting = [Run(sequence, uses)]
        sequence += uses
        # Actual documents take the slots, split wherever a length runs out.
        for size in slots:
            done = []
            while waiting:
                run = waiting.pop()
                length, available = members[size][-1]
                if available < run.count:
                    run, later = run.split(available)
                    waiting.append(later)
                members[size][-1][1] -= run.count
                if not members[size][-1][1]:
                    members[size].pop()
                run.items.append((length, supply.take(length, run.count), run.used))
                run.used += length
                done.append(run)
            waiting = done
        runs += waiting
    return _best_fit(runs, supply, capacity, sequence)


def _best_fit(runs: list[Run], supply: _Supply, capacity: int, sequence: int) -> list[Run]:
    """Put what is left into the sequences with the least room that still fits."""
    open_runs: dict[int, list[Run]] = defaultdict(list)
    rooms: list[int] = []

    def offer(run: Run) -> None:
        room = capacity - run.used
        if not open_runs[room]:
            insort(rooms, room)
        open_runs[room].append(run)

    for run in runs:
        offer(run)
    for length in sorted((n for n, count in supply.left.items() if count), reverse=True):
        while supply.left[length]:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fresh = -(-supply.left[length] // (capacity // length))
                offer(Run(sequence, fresh))
                sequence += fresh
                continue
            room = rooms[at]
            run = open_runs[room].pop()
            if not open_runs[room]:
                rooms.pop(at)
            each = min(room // length, supply.left[length])
            count = min(run.count, supply.left[length] // each)
            if count < run.count:
                run, later = run.split(count)
                offer(later)
            for _ in range(each):
                run.items.append((length, supply.take(length, run.count), run.used))
                run.used += length
            offer(run)
    return [run for same in open_runs.values() for run in same if run.items]


def plan_rows(runs: list[Run]) -> list[tuple[int, int, int, int, int]]:
    """The plan as rows: which ranks of a length stand in which sequences, and where."""
    return [
        (length, rank, rank + run.count - 1, run.first, offset)
        for run in runs
        for length, rank, offset in run.items
    ]


def _cutter(vocabulary: str, end_id: int, capacity: int, kept_bytes: int = KEPT_BYTES):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, kept_bytes)
        ending = np.array([end_id], encode.dtype).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = []
                found = encode.encode(part.column(1).to_pylist())
                for doc_id, packed in zip(part.column(0).to_pylist(), found):
                    ids = np.frombuffer(packed + ending, encode.dtype).astype("<u4")
                    start, piece = 0, 0
                    stop = len(ids) % capacity or min(capacity, len(ids))
                    while start < len(ids):
                        rows.append((doc_id, piece, start, stop - start, zlib.crc32(ids[start:stop])))
                        start, stop, piece = stop, stop + capacity, piece + 1
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(column), kind) for column, kind in zip(columns, kinds)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return cut


def pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    kept_bytes: int = KEPT_BYTES,
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids, the first being the shorter one.

    Texts of any length are encoded whole. Rows without an id and rows that repeat
    one are documents like any other; other columns are never looked at. A worker
    keeps ``kept_bytes`` of words it has met, which changes its speed only.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_cutter(vocabulary, end_id, capacity, kept_bytes), _PIECES)


def _ranked(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0, in parts of about ``RANK_ROWS``."""
    parts = F.ceil(F.col("rows") / RANK_ROWS).cast("bigint")
    salted = rows.join(F.broadcast(counts), "length").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece"), parts)
    )
    so_far = Window.partitionBy("length").orderBy("part")
    starts = (
        salted.groupBy("length", "part")
        .agg(F.count("*").alias("here"))
        .select("length", "part", (F.sum("here").over(so_far) - F.col("here")).alias("before"))
    )
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (
        salted.withColumn("inside", F.row_number().over(order) - 1)
        .join(lookup(kept(starts)), ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .drop("part", "before", "inside", "rows")
    )


def pack(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Give each piece its sequence: adds ``sequence_id`` and ``offset``.

    Needs doc_id, piece, start, length, ids_crc32 as ``pieces`` gives them and
    keeps these. The driver sees the histogram, at most ``capacity`` rows, and
    nothing else. An empty table gives no rows; repeated rows each get a place.
    """
    spark = cut.sparkSession
    cut = kept(cut)
    counts = kept(cut.groupBy("length").agg(F.count("*").alias("rows")))
    histogram = {row["length"]: row["rows"] for row in counts.collect()}
    table = lookup(spark.createDataFrame(plan_rows(plan(histogram, capacity, groups)), _PLAN))
    placed = _ranked(cut, counts).join(
        table.withColumnRenamed("length", "of"),
        (F.col("length") == F.col("of")) & F.col("rank").between(F.col("first_rank"), F.col("last_rank")),
    )
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
        "offset",
    )


def packed_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    groups: int = GROUPS,
    kept_bytes: int = KEPT_BYTES,
) -> DataFrame:
    """Encode, cut and pack a corpus. A null or empty text is the one piece (``end_id``)."""
    return pack(pieces(docs, vocabulary, end_id, capacity, kept_bytes=kept_bytes), capacity, groups)
