"""Near duplicates: SuperMinHash, banding, verification, union-find.

Texts with equal shingle sets are one node from the start, so a group of copies
is one row. Nodes that share a band are candidates:

1. In every bucket all nodes are compared with one of them, the pivot, which is the
   one that shares most with others, and the links found are grouped.
2. Whatever two nodes of a bucket are still in different groups is settled group
   by group: a node of the smaller group is compared with all members of the
   larger one, which come in chunks of bounded size.

So every pair of candidates is either compared on full sets or already in one
group, and no step lists the pairs of a large group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.scratch import kept, lookup, release
from wordloom.llm.superminhash import band_keys, most_mismatches, shingle_set, signatures, sketches

#: Words of a shingle, and the least similarity of a link in percent.
SHINGLE_WORDS = 5
PERCENT = 80
#: Bands and values per band. Two sets of similarity 0.8 share none of the bands
#: with a probability of (1 - 0.8 ** 5) ** 36, less than one in a million, if places
#: were independent. Measured on sets of 4 and 5 shingles: none in 960,000 pairs.
BANDS, DEPTH = 36, 5
#: Length of a signature: the next prime.
SIGNATURE = 181
#: Bits of each value that travel with a candidate. They rule out pairs that are
#: far from the similarity asked for; what is left is compared on full sets.
PLANES = 4
_WORDS = -(-BANDS * DEPTH // 64)
#: Shingles of the group members that are compared in one go, and texts compared with them.
CHUNK_SHINGLES, CHUNK_PROBES = 200_000, 512
#: Most rows of two numbers, and most places of texts in cells (some 60 bytes each),
#: that are sent to every executor; beyond that texts are shuffled.
SENT_KEYS, SENT_PLACES = 500_000, 300_000

_SKETCH = "doc_id bigint, row_key bigint, n_shingles bigint, node binary, bands array<bigint>, sketch array<bigint>"
_SETS = "cell binary, role int, node binary, hashes binary"
_LINKS = "a binary, b binary"


def row_key(doc_id: str = "doc_id", text: str = "text"):
    """Names a row by id and text; equal rows share it."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def _node(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def _sketcher(words: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids: list, keys: list, sets: list) -> pa.RecordBatch:
            rows = signatures(sets, SIGNATURE)
            bands = band_keys(rows, BANDS, DEPTH).view(np.int64)
            sketch = sketches(rows, BANDS * DEPTH, PLANES)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array([len(one) for one in sets], pa.int64()),
                    pa.array([_node(one) for one in sets], pa.binary()),
                    pa.array([row if len(one) else None for row, one in zip(bands, sets)], pa.list_(pa.int64())),
                    pa.array(list(sketch), pa.list_(pa.int64())),
                ],
                ["doc_id", "row_key", "n_shingles", "node", "bands", "sketch"],
            )

        release()
        for batch in batches:
            ids, keys, sets, held = [], [], [], 0
            for doc_id, key, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                ids.append(doc_id.as_py())
                keys.append(key.as_py())
                sets.append(shingle_set(text.as_py(), words))
                held += len(sets[-1])
                if held > 100_000 or len(sets) >= 512:
                    yield done(ids, keys, sets)
                    ids, keys, sets, held = [], [], [], 0
            if ids:
                yield done(ids, keys, sets)

    return sketch


def _set_maker(words: int):
    """Shingle sets of the texts that take part in a comparison."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                cells, roles, nodes, hashes = [], [], [], []
                for cell_list, node, text in zip(*(part.column(k).to_pylist() for k in range(3))):
                    one = shingle_set(text, words)
                    if _node(one) != node:
                        continue
                    for cell in cell_list:
                        cells.append(cell["cell"])
                        roles.append(cell["role"])
                        nodes.append(node)
                        hashes.append(one.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cells, pa.binary()),
                        pa.array(roles, pa.int32()),
                        pa.array(nodes, pa.binary()),
                        pa.array(hashes, pa.binary()),
                    ],
                    ["cell", "role", "node", "hashes"],
                )

    return make


class _Members:
    """The sets a cell is compared with, as one sorted list of (hash, owner)."""

    def __init__(self):
        self.nodes: list[bytes] = []
        self._sets: list[np.ndarray] = []
        self._ready = False

    def add(self, node: bytes, hashes: np.ndarray) -> None:
        if node not in self.nodes[-1:]:
            self.nodes.append(node)
            self._sets.append(hashes)

    def linked(self, hashes: np.ndarray, percent: int) -> np.ndarray:
        """Places of the members that are similar enough to a set."""
        if not self._ready:
            self._sizes = np.array([len(one) for one in self._sets])
            self._owners = np.repeat(np.arange(len(self._sets)), self._sizes)
            self._all = np.concatenate(self._sets)
            self._ready = True
        at = np.searchsorted(hashes, self._all)
        at[at == len(hashes)] = 0
        shared = np.bincount(self._owners[hashes[at] == self._all], minlength=len(self._sizes))
        return np.flatnonzero(100 * shared >= percent * (self._sizes + len(hashes) - shared))


def _verifier(percent: int):
    """Links within cells. Rows come sorted by (cell, role): members first, then the others."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, members = None, _Members()
        for batch in batches:
            ones, others = [], []
            for this, role, node, packed in zip(*(batch.column(k) for k in range(4))):
                this, node = this.as_py(), node.as_py()
                hashes = np.frombuffer(packed.as_buffer(), np.uint64)
                if this != cell:
                    cell, members = this, _Members()
                if role.as_py() == 0:
                    members.add(node, hashes)
                elif members.nodes:
                    for place in members.linked(hashes, percent)[:1]:
                        ones.append(members.nodes[place])
                        others.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(ones, pa.binary()), pa.array(others, pa.binary())], ["a", "b"])

    return verify


def _links(docs: DataFrame, cells: DataFrame, words: int, percent: int) -> DataFrame:
    """Compare the texts of cells (cell, role, node, rep_key) on their full sets."""
    wanted = kept(
        cells.groupBy("rep_key", "node").agg(F.collect_list(F.struct("cell", "role")).alias("cells"))
    )
    places = wanted.agg(F.sum(F.size("cells")).alias("n")).first()["n"] or 0
    sent = F.broadcast(wanted) if places <= SENT_PLACES else wanted
    texts = docs.select(row_key().alias("key"), "text")
    sets = (
        texts.join(sent, F.col("key") == F.col("rep_key"))
        .select("cells", "node", "text")
        .mapInArrow(_set_maker(words), _SETS)
    )
    dealt = sets.repartition("cell").sortWithinPartitions("cell", "role", "node")
    return kept(dealt.mapInArrow(_verifier(percent), _LINKS))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: each node with the least of its set."""
    parent: dict[bytes, bytes] = {}

    def root(node: bytes) -> bytes:
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for batch in batches:
        for one, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one, other = root(one), root(other)
            if one != other:
                parent[max(one, other)] = min(one, other)
    nodes = list(parent)
    for at in range(0, len(nodes), 10_000):
        part = nodes[at : at + 10_000]
        pairs = [(node, root(node)) for node in part if root(node) != node]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in pairs], pa.binary()), pa.array([b for _, b in pairs], pa.binary())], ["a", "b"]
        )


def components(links: DataFrame) -> DataFrame:
    """Group linked nodes: (node, comp), comp being the least node of the group.

    Each task first reduces its links to a forest. Then every node is hooked to
    the least of its neighbours, alternating between the larger and the smaller
    ones, until each hangs on the root of its group. Nodes without links are
    left out.
    """
    edges = kept(links.where("a <> b").mapInArrow(_forest, _LINKS).distinct())
    while True:
        if edges.isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        # edges run from a to the smaller b.
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        small = (
            large.join(below, "a").select(F.explode(hooked).alias("e")).select("e.*").where("a <> b").distinct()
        )
        edges = kept(small)
        # Done when every node hangs on one other and none of these hangs itself.
        roots = edges.select(F.col("b").alias("a")).distinct().withColumn("hooks", F.lit(1))
        seen = edges.withColumn("hooks", F.lit(1)).select("a", "hooks").unionByName(roots)
        if seen.groupBy("a").agg(F.sum("hooks").alias("hooks")).where("hooks > 1").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def _named(node, *numbers):
    """A cell name: a node and numbers, as bytes."""
    return F.concat(node, *[F.encode(F.concat(F.lit("/"), number.cast("string")), "utf-8") for number in numbers])


def near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Groups of near duplicates: (doc_id, row_key, n_shingles, component_id, stays).

    Documents are linked when their shingle sets share at least ``percent`` of
    their union; a group is what links connect, named by its smallest id. One
    row per input row; other columns are left out. Null and empty texts and
    texts without words are linked with nothing. Rows without an id take part;
    a group with no id at all has a null name.

    ``stays`` is true for one row of each group, the one with the smallest
    (doc_id, row_key), null ids last; of rows equal in both it is any one. A row
    that is linked with nothing stays.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # Stored with the rows, the place tells equal rows apart from here on.
    sketched = kept(
        docs.select("doc_id", row_key().alias("row_key"), "text")
        .mapInArrow(_sketcher(words), _SKETCH)
        .withColumn("place", F.monotonically_increasing_id())
    )
    nodes = kept(
        sketched.where("node is not null")
        .groupBy("node", "n_shingles", "bands", "sketch")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key", "place")).alias("first_row"),
            F.min("row_key").alias("rep_key"),
        )
    )
    banded = nodes.select("node", "n_shingles", "rep_key", F.explode("bands").alias("bucket"))
    shared = kept(banded.groupBy("bucket").agg(F.count("*").alias("rows")).where("rows > 1"))
    members = kept(banded.join(lookup(shared, SENT_KEYS).hint("shuffle_hash"), "bucket"))
    reach = members.groupBy("node").agg(F.sum("rows").alias("reach"))
    members = kept(members.join(reach.join(nodes.select("node", "sketch"), "node"), "node"))
    grouped = _grouped(docs, members, words, percent)
    named = (
        nodes.select("node", "first_row")
        .join(grouped, "node", "left")
        .select("node", "first_row", F.coalesce("comp", "node").alias("comp"))
    )
    first = named.groupBy("comp").agg(F.min("first_row").alias("first_row"))
    names = named.select("node", "comp").join(first, "comp").select(
        "node", F.col("first_row.doc_id").alias("component_id"), F.col("first_row.place").alias("first_place")
    )
    columns = ["doc_id", "row_key", "n_shingles"]
    alone = sketched.where("node is null")
    return (
        sketched.where("node is not null")
        .join(names, "node")
        .select(*columns, "component_id", (F.col("place") == F.col("first_place")).alias("stays"))
        .unionByName(alone.select(*columns, F.col("doc_id").alias("component_id"), F.lit(True).alias("stays")))
    )


def _fits(one, other, percent: int):
    """Whether two set sizes allow the similarity at all."""
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def _near(one, other, percent: int):
    """Whether two sketches allow the similarity, but for a chance of one in ten million."""
    differing = F.lit(0)
    for word in range(_WORDS):
        bits = F.lit(0).cast("bigint")
        for plane in range(PLANES):
            at = plane * _WORDS + word
            bits = bits.bitwiseOR(F.get(one, F.lit(at)).bitwiseXOR(F.get(other, F.lit(at))))
        differing = differing + F.bit_count(bits)
    return differing <= most_mismatches(percent, BANDS * DEPTH, PLANES)


def _grouped(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Groups (node, comp) of the nodes that share buckets."""
    # The node that shares most is nearest to the middle of its group, so that most of
    # the others link to it, and the same node serves many buckets.
    best = F.max(F.struct("reach", "node")).alias("best")
    pivots = kept(members.groupBy("bucket").agg(best).select("bucket", F.col("best.node").alias("pivot")))
    against = members.select(
        "bucket",
        F.col("node").alias("pivot"),
        F.col("n_shingles").alias("pivot_n"),
        F.col("rep_key").alias("pivot_key"),
        F.col("sketch").alias("pivot_sketch"),
    ).join(pivots, ["bucket", "pivot"])
    pairs = (
        members.join(against, "bucket")
        .where(
            (F.col("node") != F.col("pivot"))
            & _fits(F.col("n_shingles"), F.col("pivot_n"), percent)
            & _near(F.col("sketch"), F.col("pivot_sketch"), percent)
        )
        .select("pivot", "pivot_key", "node", "rep_key")
        .distinct()
    )
    pairs = kept(pairs)
    salts = kept(pairs.groupBy("pivot").agg(F.ceil(F.count("*") / CHUNK_PROBES).alias("salts")))
    dealt = pairs.join(salts, "pivot").withColumn(
        "cell", _named(F.col("pivot"), F.pmod(F.xxhash64("node"), F.col("salts")))
    )
    in_pivots = dealt.select(
        "cell", F.lit(0).alias("role"), F.col("pivot").alias("node"), F.col("pivot_key").alias("rep_key")
    )
    cells = in_pivots.distinct().unionByName(dealt.select("cell", F.lit(1).alias("role"), "node", "rep_key"))
    first_links = _links(docs, cells, words, percent)
    comps = components(first_links)
    second_links = _across(docs, members, pivots, comps, words, percent)
    joined = components(
        second_links.join(comps.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left")
        .join(comps.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )
    joined = joined.select(F.col("node").alias("of"), F.col("comp").alias("whole"))
    # A node that was alone in the first round may hang on a group by itself now.
    return kept(
        comps.join(joined, F.col("comp") == F.col("of"), "left")
        .select("node", F.coalesce("whole", "comp").alias("comp"))
        .unionByName(
            joined.join(comps, F.col("of") == F.col("node"), "left_anti").select(
                F.col("of").alias("node"), F.col("whole").alias("comp")
            )
        )
    )


def _across(
    docs: DataFrame, members: DataFrame, pivots: DataFrame, comps: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links between nodes that share a bucket and are still in different groups."""
    placed = (
        members.where("rows > 2")
        .join(comps, "node", "left")
        .withColumn("comp", F.coalesce("comp", "node"))
        .join(pivots, "bucket")
        .where("node <> pivot")
        .select("bucket", "node", "n_shingles", "rep_key", "sketch", "comp")
    )
    placed = kept(placed)
    everyone = (
        members.select("node", "n_shingles", "rep_key")
        .distinct()
        .join(comps, "node", "left")
        .withColumn("comp", F.coalesce("comp", "node"))
    )
    everyone = kept(everyone)
    groups = kept(
        everyone.groupBy("comp").agg(
            F.count("*").alias("size"),
            F.min("n_shingles").alias("least_n"),
            F.max("n_shingles").alias("most_n"),
            F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES).alias("chunks"),
        )
    )
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("one"), F.max("comp").alias("other")).where("one <> other")
    mixed = kept(mixed.select("bucket"))
    there = placed.join(mixed, "bucket")
    # A group of one is ruled out by its sketch where possible, a larger one by sizes only.
    present = (
        there.groupBy("bucket", "comp").agg(F.max("sketch").alias("target_sketch")).join(groups, "comp")
    )
    sized = there.join(groups.select("comp", F.col("size").alias("own_size")), "comp")
    targets = present.select(
        "bucket", F.col("comp").alias("target"), "size", "least_n", "most_n", "chunks", "target_sketch"
    )
    smaller = F.struct("own_size", "comp") < F.struct(F.col("size").alias("own_size"), F.col("target").alias("comp"))
    possible = (F.col("n_shingles") * percent <= F.col("most_n") * 100) & (
        F.col("least_n") * percent <= F.col("n_shingles") * 100
    ) & ((F.col("size") > 1) | _near(F.col("sketch"), F.col("target_sketch"), percent))
    probes = kept(
        sized.join(targets, "bucket")
        .where(smaller & possible)
        .select("node", "rep_key", "target", "chunks")
        .distinct()
    )
    salts = kept(probes.groupBy("target", "chunks").agg(F.ceil(F.count("*") / CHUNK_PROBES).alias("salts")))
    zero = F.lit(0).cast("bigint")
    asked = (
        probes.join(salts, ["target", "chunks"])
        .withColumn("chunk", F.explode(F.sequence(zero, F.col("chunks") - 1)))
        .withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")))
        .select(_named(F.col("target"), F.col("chunk"), F.col("salt")).alias("cell"), F.lit(1).alias("role"), "node", "rep_key")
    )
    answering = (
        everyone.join(salts, F.col("comp") == F.col("target"))
        .withColumn("salt", F.explode(F.sequence(zero, F.col("salts") - 1)))
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
        .select(_named(F.col("target"), F.col("chunk"), F.col("salt")).alias("cell"), F.lit(0).alias("role"), "node", "rep_key")
    )
    return _links(docs, answering.unionByName(asked), words, percent)


def deduplicated(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest (doc_id, row_key).

    Null ids come last. Of rows with that id and text one stays, the smallest by
    its other columns, in their order and nulls first. Columns stay as they are.
    Documents without words are never duplicates of each other.
    """
    found = near_duplicates(docs, words, percent)
    rows = kept(
        found.groupBy("row_key").agg(
            F.count("*").alias("times"), F.max("stays").alias("stays"), F.max("n_shingles").alias("n")
        )
    )
    # The columns of ``docs`` travel as one, so that no name of theirs can clash.
    columns = [F.col(f"`{name}`") for name in docs.columns]
    whole = docs.select(row_key().alias("key"), F.struct(*columns).alias("row"))
    gone = rows.where("not stays").select(F.col("row_key").alias("key"))
    again = kept(rows.where("stays and times > 1 and n > 0").select(F.col("row_key").alias("key")))
    left = whole.join(lookup(kept(gone), SENT_KEYS), "key", "left_anti")
    if again.isEmpty():
        return left.select("row.*")
    order = F.struct(*[_ordered(F.col("row").getField(name), docs.schema[name].dataType) for name in docs.columns])
    once = left.join(again, "key", "left_semi").groupBy("key").agg(F.min_by("row", order).alias("row"))
    return left.join(again, "key", "left_anti").unionByName(once).select("row.*")


def _ordered(column: Column, kind: T.DataType) -> Column:
    """The column, or where it holds maps, which have no order, its text form."""
    return F.to_json(F.struct(column.alias("of"))) if "map<" in kind.simpleString() else column
