"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a word budget. It is met by complete epochs (all documents of the source)
and one fractional epoch: documents in the order of exponential keys, divided by their quality
weights, until the words they bring reach the rest of the budget.

The prefix sum over a source never meets in one task: keys are cut into about sqrt(documents)
ranges per source, the ranges' sums are prefix-summed, and only the range in which the budget
ends is sorted. What comes out is one border per source, so taking a document is a comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histkit.llm.common import fresh, store, words_in

LEAST_LONG = -(1 << 63)


def text_quality(text: Column) -> Column:
    """Share of words that are letters with at most one mark at the end; 0.1 at least."""
    clean = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"(?<![^\x20\x09-\x0D])\p{L}+[.,;:!?]?(?![^\x20\x09-\x0D])"))
    return F.greatest(F.lit(0.1), F.coalesce(clean / F.nullif(words_in(text), F.lit(0)), F.lit(0.0)))


def exponential_key(doc_id: Column, quality: Column, seed: int) -> Column:
    """-ln(u) / quality with u in (0, 1) from a hash of the document's id, so reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / quality


def source_targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: documents, size, target.

    Sources by code point, null last, get the weights in turn. They share ``share`` of all
    sizes; no target is above ``most`` times its source's size, and what is cut off there is
    shared by weight among the others. In order of (limit / weight) the limited sources come
    first, so the common level is found by prefix sums instead of rounds.
    """
    per_source = sized.groupBy("source").agg(F.count("*").alias("documents"), F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    limited = per_source.withColumn("weight", F.get(cycle, turn % len(weights))).withColumn("limit", F.col("source_size") * most)
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, all_rows = rising.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(all_rows) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = limited.withColumn("level", level).withColumn("nth", F.row_number().over(rising))
    fits = F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.struct("nth", "level"))
    common = F.min(fits).over(all_rows)["level"]
    return levels.withColumn("target", F.coalesce(F.least("limit", common * F.col("weight")), "limit")).select("source", "documents", "source_size", "target")


def borders(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Add to each source: complete epochs, and the key and id at which its fractional epoch
    ends, with the words taken there and the words that all rows of that key and id have."""
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("epochs", epochs.cast("long")).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    plan = plan.withColumn("ranges", F.ceil(F.sqrt("documents")))
    of = plan.select(F.col("source").alias("s"), "rest", "ranges")
    range_of_key = F.floor((1 - F.exp(-F.col("key"))) * F.col("ranges"))
    keyed = sized.join(of, F.col("source").eqNullSafe(F.col("s"))).select("source", "doc_id", "size", "key", "rest", range_of_key.alias("range"))
    sums = keyed.groupBy("source", "rest", "range").agg(F.sum("size").alias("words"))
    rising = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    last = sums.withColumn("before", F.coalesce(F.sum("words").over(rising), F.lit(0))).where("before <= rest and rest < before + words")
    last = last.select(F.col("source").alias("s"), F.col("range").alias("r"), "before")
    inside = keyed.join(last, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    ordered, group = Window.partitionBy("source").orderBy("key", "doc_id"), Window.partitionBy("source", "key", "doc_id")
    ends = inside.withColumn("upto", F.col("before") + F.sum("size").over(ordered)).withColumn("group_size", F.sum("size").over(group))
    ends = ends.where("rest < upto and upto - group_size <= rest").groupBy(F.col("source").alias("s"))
    ends = ends.agg(F.min("key").alias("border_key"), F.min("doc_id").alias("border_id"), F.min(F.col("rest") - F.col("upto") + F.col("group_size")).alias("border_words"), F.min("group_size").alias("border_size"))
    return plan.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "ranges", "documents")


def mix(docs: DataFrame, quality: Column | None = None, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7, whole: bool = False) -> DataFrame:
    """``docs`` with the columns of its source's budget and what the mix takes of each row.

    Needs doc_id, text and source. Added: size (words), source_size, target, copies (times the
    whole document is taken), extra (words taken of it once more) and taken (all words taken).
    ``whole`` takes the document at the border whole or not at all, whichever is nearer.
    ``quality`` is a positive weight, by default from the text. Columns of ``docs`` that have one
    of these names are replaced. A null or empty text has size 0 and is taken in
    complete epochs only; a null source is a source of its own; repeated rows are taken alike
    and share the border evenly; an empty table gives no rows.
    """
    added = ["size", "source_size", "target", "copies", "extra", "taken"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    key, order = fresh(docs, "key", "order_id")
    weight = text_quality(F.col("text")) if quality is None else quality
    sized = docs.withColumns({"size": words_in(F.col("text")), key: exponential_key(F.col("doc_id"), weight, seed), order: F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_LONG))})
    small = store(sized.select(F.col(order).alias("doc_id"), F.col("source").cast("string").alias("source"), "size", F.col(key).alias("key")), "sizes")
    plan = store(borders(small, source_targets(small, weights, share, most)), "mix-plan")
    plan = plan.select([F.col(c).alias(f"{c}_of_plan") for c in plan.columns])
    p = lambda c: F.col(f"{c}_of_plan")
    joined = sized.join(plan, F.col("source").eqNullSafe(p("source")), "left")
    place, border = F.struct(F.col(key), F.col(order)), F.struct(p("border_key"), p("border_id"))
    if whole:
        at_border = F.when(2 * p("border_words") >= p("border_size"), F.col("size")).otherwise(0)
    else:
        at_border = F.floor(p("border_words") * F.col("size") / p("border_size")).cast("long")
    extra = F.when(p("border_key").isNull() | (place > border), 0).when(place < border, F.col("size")).otherwise(at_border)
    out = joined.withColumns({"source_size": p("source_size"), "target": p("target"), "copies": p("epochs"), "extra": extra.cast("long")})
    return out.withColumn("taken", F.col("copies") * F.col("size") + F.col("extra")).select(*docs.columns, *added)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as whole documents are taken."""
    taken = mix(docs, whole=True, **options)
    times = F.col("copies") + F.when((F.col("size") > 0) & (F.col("extra") == F.col("size")), 1).otherwise(0)
    return taken.withColumn("copies", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*docs.columns)
