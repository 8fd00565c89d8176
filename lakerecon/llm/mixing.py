"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Targets: sources in code point order, null last, have the given weights in turn and share ``share`` times
the size of everything. A target stops at ``cap`` times the size of its source and what is over goes to
the others by weight: target = min(cap * size, L * weight), where L is found from running sums over the sources.

Sampling: a document of a source is expected ``target / source size`` times. Documents lie on a line, each as long
as its expectation; a random offset is added once per source, and a document is emitted once for each
integer that its stretch crosses. No document is emitted more than ``cap`` times (rounded up).

The line of a source is laid in blocks of about BLOCK documents: sums of blocks first, then running
sums inside blocks, so a source with a third of all rows is shared by many tasks. A document's block and place come
from md5 of its id; inside a block the order is by size, which keeps the words that are taken near the target.
Expectations are whole multiples of 2^-32, so sums are exact in any order and reruns agree.

Null and empty texts have size 0 and take part like others. Documents with equal id and size are
interchangeable; a null id is placed by the md5 of an empty text. A null source is a source. Other columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerecon.llm.frames import small

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK = 8_192
UNIT = 2**32

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size (long) and target (double) of every source of ``sized`` (source, size)."""
    whole = Window.partitionBy(F.lit(0))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ordered = sources.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ordered = ordered.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("at") % len(weights) + 1).cast("int")))
    limited = ordered.withColumn("most", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("most") / F.col("weight"))
    rising = Window.orderBy("ratio", "at").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("most").over(rising), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0))
    )
    found = limited.withColumn("level", level).withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "at", "level"))).over(whole)["level"])
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("level") * F.col("weight")))
    return found.select("source", "source_size", target.alias("target"), "docs")


def mix(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 1, carry: list[str] | None = None,
) -> DataFrame:
    """Every document as a struct ``row``, with size, source_size, target and ``copies``, the times the mix takes it.

    ``carry`` names the columns of ``row``, by default all; what is left out is not shuffled.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"))
    sized = documents.select(
        F.struct(*(carry or documents.columns)).alias("row"), F.col(source_column).cast("string").alias("source"), words(text_column).alias("size"), key.alias("key")
    )
    goals = targets(sized, weights, share, cap)
    goals = goals.withColumn(
        "each", F.when(F.col("source_size") > 0, F.floor(F.least(F.col("target") / F.col("source_size"), F.lit(cap)) * F.lit(float(UNIT)))).otherwise(F.lit(0)).cast("decimal(20,0)")
    ).withColumn("blocks", F.ceil(F.col("docs") / BLOCK))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))).cast("binary")), 1, 5), 16, 10)
    goals = small(goals.withColumn("offset", (offset.cast("long") * (UNIT >> 20)).cast("decimal(20,0)")).withColumnRenamed("source", "its"))
    block = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("blocks")
    dealt = sized.join(goals, F.col("source").eqNullSafe(F.col("its"))).withColumn("block", block)
    sums = dealt.groupBy("its", "block").agg(F.count("*").alias("n"))
    before = sums.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("its").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = small(before.select(F.col("its").alias("b_its"), F.col("block").alias("b_block"), "before"))
    placed = dealt.join(before, F.col("its").eqNullSafe(F.col("b_its")) & (F.col("block") == F.col("b_block")))
    inside = F.row_number().over(Window.partitionBy("its", "block").orderBy("size", "key"))
    end = placed.withColumn("end", (F.col("before") + inside).cast("decimal(18,0)") * F.col("each") + F.col("offset"))
    copies = F.expr(f"end DIV {UNIT} - (end - each) DIV {UNIT}").cast("long")
    return end.select("row", "size", "source_size", "target", copies.alias("copies"))


def mixture(documents: DataFrame, **settings) -> DataFrame:
    """The mix itself: each document as often as it is taken, with ``copy`` counting from 1."""
    taken = mix(documents, **settings).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).select("row.*", "copy")
