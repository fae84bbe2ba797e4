"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis and Spirakis)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.parts import hash52, repeat_rows, with_small
from tallyfold.runtime import stage

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
# Characters that prose hardly uses; their share lowers a document's sampling weight.
MARKS = "!#$%&*+/<=>@[]^_{|}~"
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 50_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str = "text") -> Column:
    """Sampling weight from 0.05 to 1: the squared share of characters that are not marks."""
    n = F.length(text)
    plain = F.length(F.translate(F.col(text), MARKS, ""))
    share = F.when(n > 0, plain / n).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.05), F.coalesce(share * share, F.lit(0.0)))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MAX_EPOCHS) -> DataFrame:
    """Word targets of (source, source_size): shares by weight of all words, at most ``most`` times a source's size.

    What is cut off is shared again by weight among the others until none is above its limit. Sources in the order of
    limit / weight are limited up to one point, so the fixed point needs running sums instead of rounds.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    each = sizes.withColumn("w", w).withColumn("top", F.col("source_size") * most)
    by = Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last())
    rest = by.rowsBetween(0, Window.unboundedFollowing)
    each = each.withColumn("top_before", F.coalesce(F.sum("top").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    each = each.withColumn("level", (F.sum("source_size").over(Window.partitionBy()) - F.col("top_before")) / F.sum("w").over(rest))
    each = each.withColumn("limited", F.col("top") / F.col("w") <= F.col("level"))
    level = F.min(F.when(~F.col("limited"), F.struct(F.col("top") / F.col("w"), "level"))).over(Window.partitionBy())
    target = F.when(F.col("limited"), F.col("top")).otherwise(F.col("w") * level["level"])
    return each.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words of each document a mix takes: one row per document.

    A source whose target exceeds its size gives every document once per full epoch; the rest of the target is a
    weighted sample: documents come in the order of -ln(u) / weight, u a hash of the document, until the words are
    reached. ``copies`` counts whole repeats, ``part`` the words of one more repeat: all of them, none, or for the
    document that crosses the target what is still missing, so each source meets its target to the word.

    Rows of one source are never ranked together: words are summed per slice of the key, and only the slice that crosses
    the target is sorted. Equal rows are counted first. A null text has no words and gives none; a null source is a
    source of its own, the last; an empty table gives no rows; only the three named columns are read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        quality_weight(text_col).alias("weight"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
    )
    counted = rows.groupBy("doc_id", "source", "size", "weight", "crc").agg(F.count("*").alias("n"))
    u = (hash52(F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("crc").cast("string")) + 0.5) / float(1 << 52)
    counted = stage(counted.withColumn("key", -F.log(u) / F.col("weight")), "mix")

    sizes = stage(counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "mix")
    total = counted.agg(F.count("*")).first()[0]
    buckets = 1 << max(10, math.ceil(math.log2(max(1, total / BUCKET_ROWS))))
    bucket = F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * buckets)
    goal = targets(sizes, weights)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("epochs", epochs)
    goal = stage(goal.withColumn("rest", F.floor(F.col("target") + 0.5).cast("long") - F.col("epochs") * F.col("source_size")), "mix")

    slices = counted.withColumn("bucket", bucket).groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    named = lambda df: df.withColumn("none", F.col("source").isNull()).withColumn("name", F.coalesce("source", F.lit(""))).drop("source")
    plan = named(goal)
    slices = named(slices.withColumn("upto", upto)).join(plan.select("none", "name", "rest"), ["none", "name"])
    crossing = slices.where("upto >= rest AND upto - words < rest").groupBy("none", "name").agg(
        F.min("bucket").alias("cross"), F.min(F.col("upto") - F.col("words")).alias("before")
    )
    plan = stage(plan.join(crossing, ["none", "name"], "left"), "mix")

    known = with_small(named(counted.withColumn("bucket", bucket)), plan, ["none", "name"])
    # Without a crossing slice nothing is left to sample, or (rest at the size of the source) all of it.
    clear = known.where("cross IS NULL OR bucket <> cross").withColumn(
        "room", F.when(F.col("bucket") < F.col("cross"), F.col("size") * F.col("n")).otherwise(F.lit(0).cast("long"))
    )
    order = Window.partitionBy("none", "name").orderBy("key", "doc_id", "crc", "size")
    ahead = F.coalesce(F.sum(F.col("size") * F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tight = known.where("bucket = cross").withColumn("room", F.col("rest") - F.col("before") - ahead)
    each = repeat_rows(clear.unionByName(tight), "n", "copy")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - F.col("copy") * F.col("size"))).cast("long")
    return each.select(
        "doc_id", F.when(~F.col("none"), F.col("name")).alias("source"), "size", "source_size", "target", "epochs",
        part.alias("part"), F.col("crc").alias("text_crc32"), "copy",
    ).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
