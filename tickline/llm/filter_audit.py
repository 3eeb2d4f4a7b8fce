"""Filter interaction audit by min-plus removal ranks, in DataFrame functions only.

A set of filters is applied left to right in every order of its letters. Which
filters a document fails is its *mask*; all that the audit needs of a document
is its part, its mask and its weights, so documents are counted by (part, mask)
first: five filters have 32 masks, however many documents there are.

The cost row of a mask holds 0 at each filter it fails and ``NEVER`` elsewhere.
The position matrix holds, for each order, the step at which each filter runs
(the inverse of the permutation). Their min-plus product, entry by entry the
minimum over filters of cost + position, is the step at which a mask is removed
in an order; ``NEVER`` or more means that it is kept to the end. Weights are
then scattered to (part, order, step) by comparing each step with that rank.

Identical texts are told by SHA-256. Copies are counted by (digest, part,
weights) with map-side partial sums before the smallest id of a digest is
looked up, so a text that a third of all rows share is a handful of rows there.

Defined cases: a null text is empty; a null part is the empty string; a row with
a null id is never a copy and makes no other row one; equal rows count as often
as they occur, and a row isn't a copy of one with its own id; labels of an id
that occurs twice count if any of them does; a table without rows gives none;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality_rules import words_of

#: Cost of a filter that a mask passes; larger than any step.
NEVER = 99


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a whole text."""
    words = words_of(text)
    n_words = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n_words < 50,
        "B": F.lit(100).cast("long") * F.size(F.array_distinct(words)) < F.lit(65).cast("long") * n_words,
        "C": F.lit(100).cast("long") * capitals > F.lit(5).cast("long") * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _bits(conditions: Sequence[Column]) -> Column:
    total = F.lit(0)
    for k, condition in enumerate(conditions):
        total = total + F.when(condition, F.lit(1 << k)).otherwise(F.lit(0))
    return total


def document_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Documents counted by ``part`` and ``mask``: ``n``, ``good`` (quality = 1), ``toxic`` (toxic = 1).

    Bit k of ``mask`` is the k-th letter of ``ABCDE``; bit 4 is the copy filter.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        _bits(list(text_filters(text).values())).alias("bits"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    rows = own.groupBy("id", "part", "bits", "digest").agg(F.count(F.lit(1)).alias("c"))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    rows = rows.join(marks.hint("merge"), "id", "left").na.fill(0, ["good", "toxic"])
    # of each kind of row: all, those without an id, and those that hold the kind's smallest id
    smallest = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "c")))
    kinds = rows.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("c").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("c")).otherwise(0)).alias("without_id"),
        smallest["id"].alias("least"),
        smallest["c"].alias("at_least"),
    )
    firsts = kinds.groupBy("digest").agg(F.min("least").alias("first"))
    kinds = kinds.join(firsts.hint("merge"), "digest")
    originals = F.col("without_id") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    split = F.explode(F.array(F.struct(F.lit(0).alias("copy"), originals.alias("n")), F.struct(F.lit(1).alias("copy"), (F.col("n") - originals).alias("n"))))
    kinds = kinds.select("part", "bits", "good", "toxic", split.alias("s")).where("s.n > 0")
    return kinds.groupBy("part", (F.col("bits") + 16 * F.col("s.copy")).alias("mask")).agg(
        F.sum("s.n").alias("n"), F.sum(F.col("s.n") * F.col("good")).alias("good"), F.sum(F.col("s.n") * F.col("toxic")).alias("toxic")
    )


def removal_ranks(mask: Column, letters: str) -> Column:
    """Min-plus product of one mask's cost row with the position matrix: a rank for each order."""
    cost = F.transform(F.sequence(F.lit(0), F.lit(len(letters) - 1)), lambda k: F.when(F.getbit(mask, k) == 1, F.lit(0)).otherwise(F.lit(NEVER)))
    positions = F.array(*[F.array(*[F.lit(order.index(letter) + 1) for letter in letters]) for order in permutations(letters)])
    return F.transform(positions, lambda row: F.array_min(F.zip_with(cost, row, lambda c, p: c + p)))


def audit(masks: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of ``letters`` and step, from ``part, mask, n, good, toxic``."""
    orders = F.array(*[F.lit("".join(order)) for order in permutations(letters)])
    ranked = masks.withColumn("ranks", removal_ranks(F.col("mask"), letters)).select("part", "mask", "n", "good", "toxic", F.posexplode("ranks").alias("k", "rank"))
    ranked = ranked.select("*", F.get(orders, F.col("k")).alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    ranked = ranked.withColumn("bit", F.instr(F.lit(letters), letter) - 1)
    fails = F.getbit("mask", F.col("bit")) == 1

    def total(weight: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(weight)).otherwise(F.lit(0).cast("long")))

    here = F.col("rank") == F.col("step")
    counts = ranked.groupBy("part", "filter_order", "step", "bit").agg(
        total("n", F.col("rank") > F.col("step")).alias("kept"),
        total("n", here).alias("removed"),
        total("n", fails & (F.col("rank") < F.col("step"))).alias("redundant"),
        total("n", F.col("mask") == F.expr("shiftleft(1, bit)")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
    )
    # a filter's removals over all orders: 120 rows a part and filter
    every = F.sum("removed").over(Window.partitionBy("part", "bit"))
    return counts.withColumn("shapley", every).drop("bit")
