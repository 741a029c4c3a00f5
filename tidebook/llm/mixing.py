"""Mixing sources to target weights with hash-threshold histograms.

Each source gets a share of the budget by its weight, capped at max_epochs times its size; what a
cap cuts off is shared again by weight. A source whose target is r times its size is taken floor(r)
times in full, and the remaining fraction selects the documents whose hash lies below a threshold.
The threshold comes from a histogram of words by (source, hash bucket): only the bucket in which the
running sum crosses the budget is split further, level by level, and the documents are then filtered
by comparing their hash. Nothing is sorted, and a smaller budget selects a subset of a larger one.

Defined results: a null text counts zero words; a null source is a source of its own, last in order;
rows with equal doc_id share a hash and are taken together; sources of no words have target 0; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm.common import WORD, global_index, materialize

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
BITS = 12  # hash bits that one histogram level resolves
LEVELS = 4  # 48 bits in all: documents that still share a bucket are taken together


SMALL = 100_000  # source tables up to this many rows are broadcast; larger ones are joined by a shuffle


def small(df: DataFrame) -> DataFrame:
    """df marked for broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= SMALL else df


def words(text: str = "text") -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def doc_hash(doc_id: str = "doc_id") -> Column:
    """48 uniform bits from the id: the first twelve hex digits of its MD5; 0 for a null id."""
    digits = F.substring(F.md5(F.col(doc_id).cast("string").cast("binary")), 1, 12)
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: float = 1.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights by code-point order of source.

    Raising the common level until no source is above its cap takes a few passes over the sources,
    each of them one aggregate; no source list is gathered anywhere.
    """
    ranked = global_index(sizes, [F.col("source").isNull().asc(), F.col("source").asc()], "mix-sources", "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(max_epochs)).alias("cap")), "mix-weights")
    total = float((ranked.agg(F.sum("source_size")).first()[0] or 0) * budget)
    level = 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * level
        used, rest = ranked.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not rest:
            break
        raised = (total - used) / rest
        if raised <= level:
            break
        level = raised
    return ranked.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * level).alias("target"))


def thresholds(sized: DataFrame, need: DataFrame, bits: int = BITS, levels: int = LEVELS) -> DataFrame:
    """(source, threshold): taking hash < threshold sums to the amount nearest to need's.

    sized has (source, hash, size) and need (source, need), null sources included. Each level sums
    words by bucket of the next bits inside the bucket still open, at most 2**bits rows a source.
    """
    open_ = materialize(need, "mix-need").select(F.col("source").alias("s"), F.col("need"), F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("below"))
    for level in range(levels):
        shift = bits * (levels - 1 - level)
        inside = F.shiftright("hash", shift + bits) == F.col("prefix")
        table = small(open_)
        hist = (
            sized.join(table, F.col("source").eqNullSafe(F.col("s")) & inside)
            .groupBy("s", "need", "below", F.shiftright("hash", shift).alias("bucket"))
            .agg(F.sum("size").cast("double").alias("part"))
        )
        w = Window.partitionBy("s").orderBy("bucket")
        run = hist.withColumn("upto", F.col("below") + F.sum("part").over(w))
        # The boundary bucket is the first whose running sum reaches the need, or else the last one.
        crossed = F.min(F.when(F.col("upto") >= F.col("need"), F.struct("bucket", "upto", "part")))
        ended = F.max(F.struct("bucket", "upto", "part"))
        picked = run.groupBy("s", "need").agg(F.coalesce(crossed, ended).alias("at"))
        open_ = materialize(
            picked.select("s", "need", F.col("at.bucket").alias("prefix"), (F.col("at.upto") - F.col("at.part")).alias("below"), F.col("at.upto").alias("upto")),
            f"mix-level{level}",
        )
    closer = F.col("upto") - F.col("need") < F.col("need") - F.col("below")
    return open_.select(F.col("s").alias("source"), (F.col("prefix") + F.when(closer, 1).otherwise(0)).alias("threshold"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(sized, plan): (doc_id, source, size, hash) by row, and (p, source_size, target, whole, threshold) by source p."""
    sized = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(text_col).alias("size"), doc_hash(id_col).alias("hash")), "mix-sizes"
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, max_epochs, budget), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("int"))
    need = targets.filter("source_size > 0").select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("need"))
    cut = small(materialize(thresholds(sized, need.filter("need > 0")), "mix-thresholds"))
    joined = small(targets).join(cut.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "p")
    return sized, materialize(joined, "mix-plan")


def copies(max_epochs: int = MAX_EPOCHS) -> Column:
    """How often a row with a hash is taken under its source's plan."""
    extra = (F.col("hash") < F.coalesce("threshold", F.lit(0).cast("long"))).cast("int")
    return F.least(F.col("whole") + extra, F.lit(max_epochs))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: float = 1.0) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies) for every row; copies is how often it is taken."""
    sized, by_source = plan(docs, id_col, text_col, source_col, weights, max_epochs, budget)
    return sized.join(small(by_source), F.col("source").eqNullSafe(F.col("p"))).select(
        "doc_id", "size", "source", "source_size", "target", copies(max_epochs).alias("copies"), "hash"
    )


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: float = 1.0) -> DataFrame:
    """The mixed rows: docs with each row as often as the mix takes it, possibly never."""
    _, by_source = plan(docs, id_col, text_col, source_col, weights, max_epochs, budget)
    told = by_source.select("p", "whole", "threshold")
    # The row travels as one value, so that its other columns may have any names.
    rows = docs.select(F.struct("*").alias("row"), F.col(source_col).alias("source"), doc_hash(id_col).alias("hash"))
    picked = rows.join(small(told), F.col("source").eqNullSafe(F.col("p"))).select("row", copies(max_epochs).alias("copies")).filter("copies > 0")
    return picked.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
