"""Mixing sources to target weights.

Every document gets a hash-random key, which puts the documents of a source in
a reproducible random order. Keys are cut into ranges of about ``RANGE_ROWS``
documents; the word totals of the ranges give distributed prefix sums, and only
the one range per source in which the budget ends is ordered document by
document. What is left of the mix is one short row per source: how many whole
passes it takes, and the place in the order up to which it takes one more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.scratch import kept, lookup

#: Weights by source in code point order, repeating; null comes last.
WEIGHTS = (5, 2, 1)
#: Times its own size that a source may be taken at most.
MOST_EPOCHS = 3
#: Documents of a source that one range of keys holds on average.
RANGE_ROWS = 50_000
#: Decides the order of the documents.
SEED = "mix-1"

_KEYS = 16**15


def word_count(text: Column | str) -> Column:
    """Runs of anything but white space (space, tab to carriage return); null has 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def order_key(doc_id: Column | str, seed: str = SEED) -> Column:
    """The first 60 bits of a digest of seed and id, as a number."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(column.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Words to take of each source, for a table (source, source_size, ...).

    The total is shared by weight. Sources whose share is above ``most`` times
    their size stop there; in order of cap per unit of weight these come first,
    so one pass of running sums finds the level that the others share.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]),
        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"),
    ).cast("bigint")
    weighed = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source")
    )
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    shared = (
        weighed.withColumn("place", F.row_number().over(order))
        .withColumn(
            "left_over",
            F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        )
        .withColumn("weights_left", F.sum("weight").over(after))
        .withColumn("open", F.col("left_over") * F.col("weight") <= F.col("cap") * F.col("weights_left"))
    )
    level = F.min(F.when(F.col("open"), F.struct("place", "left_over", "weights_left"))).over(everything)
    return (
        shared.withColumn("level", level)
        .withColumn(
            "target",
            F.when(
                F.col("place") < F.col("level.place"), F.col("cap").cast("double")
            ).otherwise((F.col("level.left_over") * F.col("weight")) / F.col("level.weights_left")),
        )
        .select("source", "source_size", "documents", "target")
    )


def _cuts(sized: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """One row per source: target, whole passes, and where the last pass ends."""
    sizes = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents")
    )
    goal = F.floor("target")
    passes = F.when(F.col("source_size") > 0, goal.cast("bigint") - goal % F.col("source_size"))
    goals = (
        targets(sizes, weights, most)
        .withColumn("whole", F.coalesce(passes, F.lit(0)).cast("bigint"))
        .withColumn("rest", (goal - F.col("whole")).cast("bigint"))
        .withColumn("epochs", F.coalesce(F.try_divide("whole", "source_size"), F.lit(0)).cast("bigint"))
        .withColumn("ranges", F.ceil(F.col("documents") / RANGE_ROWS).cast("bigint"))
    )
    goals = kept(goals)
    by_source = lookup(goals.select(F.col("source").alias("of"), "rest", "ranges"))
    ranged = (
        sized.join(by_source, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("key_range", F.floor(F.col("key") / _KEYS * F.col("ranges")))
        .drop("of")
    )
    totals = ranged.groupBy("source", "key_range", "rest").agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy("key_range")
    # The budget ends in the first range whose running total reaches it.
    last = (
        totals.withColumn("through", F.sum("words").over(so_far))
        .where(F.col("through") >= F.col("rest"))
        .groupBy("source")
        .agg(F.min(F.struct("key_range", (F.col("through") - F.col("words")).alias("before"))).alias("end"))
        .select(F.col("source").alias("of"), F.col("end.key_range").alias("end_range"), F.col("end.before").alias("before"))
    )
    last = lookup(kept(last))
    inside = ranged.join(
        last, F.col("source").eqNullSafe(F.col("of")) & (F.col("key_range") == F.col("end_range"))
    )
    # Repeated ids are one step of the order. The first step that does not fit is the cut.
    steps = inside.groupBy("source", "rest", "before", "key", "doc_id").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    through = F.col("before") + F.sum("words").over(running)
    room = F.col("rest") - (F.col("through") - F.col("words"))
    place = (
        steps.withColumn("through", through)
        .where(F.col("through") > F.col("rest"))
        .groupBy("source")
        .agg(
            F.min(F.struct("key", "doc_id")).alias("cut"),
            F.min_by(F.struct(room.alias("room"), "words"), F.struct("key", "doc_id")).alias("part"),
        )
        .select(F.col("source").alias("of"), "cut", "part")
    )
    ends = last.withColumnRenamed("of", "in_source")
    return (
        goals.join(ends, F.col("source").eqNullSafe(F.col("in_source")), "left")
        .join(place, F.col("source").eqNullSafe(F.col("of")), "left")
        .select(
            F.col("source").alias("of"),
            "source_size",
            "target",
            "epochs",
            "end_range",
            "ranges",
            "cut",
            "part",
        )
    )


def _last_pass(key: Column, doc_id: Column, all_of_it: Column, part: Column) -> Column:
    """What the last, partial pass takes: all of a document, a part at the cut, or nothing."""
    key_range = F.floor(key / _KEYS * F.col("ranges"))
    place = F.struct(key.alias("key"), doc_id.alias("doc_id"))
    return (
        F.when(key_range < F.col("end_range"), all_of_it)
        .when(key_range > F.col("end_range"), F.lit(0))
        .when(F.col("cut").isNull() | (place < F.col("cut")), all_of_it)
        .when(place.eqNullSafe(F.col("cut")), part)
        .otherwise(F.lit(0))
    )


def _part(size: Column) -> Column:
    return F.floor(size * F.col("part.room") / F.col("part.words"))


def _first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word."""
    pattern = F.concat(
        F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), words.cast("string"), F.lit("}+")
    )
    return F.coalesce(F.regexp_substr(text, pattern), F.lit(""))


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        order_key(F.col(doc_id), seed).alias("key"),
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Words taken of each document: (doc_id, size, source_size, target, taken).

    One row per input row, other columns left out. A null text has size 0, null
    is a source of its own, rows that share an id are taken alike, and an empty
    table gives no rows. A source gives the whole words of its target: the
    document at the cut is taken in part.
    """
    sized = kept(_sized(docs, doc_id, text, source, seed))
    cuts = lookup(kept(_cuts(sized, weights, most)))
    size = F.col("size")
    last = _last_pass(F.col("key"), F.col("doc_id"), size, _part(size))
    taken = size * F.col("epochs") + last
    return sized.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken")
    )


def mixed_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: rows of ``docs``, as often as they are taken.

    Texts stay where they are; only the row per source travels. At the cut of a
    source a text ends after the last word that fits. Documents without words
    weigh nothing and follow the same order.
    """
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"))
    fields = {name: F.col("row").getField(name) for name in (doc_id, source, text)}
    sized = kept(_sized(docs, doc_id, text, source, seed))
    cuts = lookup(kept(_cuts(sized, weights, most)))
    key = order_key(fields[doc_id], seed)
    part = F.when(F.col("part.room") > 0, F.lit(-1)).otherwise(0)
    last = _last_pass(key, fields[doc_id], F.lit(1), part)
    copies = F.concat(
        F.array_repeat(F.lit(False), F.col("epochs").cast("int") + F.when(last == 1, 1).otherwise(0)),
        F.array_repeat(F.lit(True), F.when(last == -1, 1).otherwise(0)),
    )
    shortened = F.when(
        F.col("in_part"), _first_words(fields[text], _part(word_count(fields[text])))
    ).otherwise(fields[text])
    return (
        whole.join(cuts, fields[source].eqNullSafe(F.col("of")), "left")
        .withColumn("in_part", F.explode(copies))
        .select(F.col("row").withField(text, shortened).alias("row"))
        .select("row.*")
    )
