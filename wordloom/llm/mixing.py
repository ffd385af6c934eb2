"""Mixing sources to target weights by capped water-filling, with seeded
whole and fractional repetitions.

Every source gets the share of a total that its weight asks for, but no more
than ``max_epochs`` times its own size; what a clamped source can't take is
shared among the others by weight, until none is above its cap.  A source
repeats all its documents ``floor(target / size)`` times, and a seeded
fraction of them once more.

Plan: built-in expressions only.  The water level is a scalar found by a few
aggregates over the one-row-per-source table.  The fraction is a prefix of
the source in seeded hash order; where it ends comes from a histogram of
sizes per (source, first 12 bits of the hash), which is at most 4,096 rows
per source however large a source is, and then from the documents of the
single histogram cell in which it ends.  No window ever holds a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import WORD, broadcast_if_small, written

#: Hexadecimal digits of the hash that name a cell of the histogram.
CELL = 3


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_level(sources: DataFrame, total: float) -> float:
    """The level L at which sum(min(cap, L * weight)) is ``total`` over rows
    (cap, weight); infinity if the caps add up to no more than ``total``.

    A source is clamped when its cap is at most L * weight.  Each round
    clamps at least one more source, so the level only rises; only scalars
    leave Spark."""
    level = -1.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        row = sources.agg(F.sum(F.when(full, F.col("cap"))).alias("c"),
                          F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        if not row["w"]:
            return float("inf")
        new = (total - float(row["c"] or 0)) / float(row["w"])
        if new <= level:
            return level
        level = new


def mix(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", budget: float = 1.5, max_epochs: float = 2.0,
        seed: str = "mix") -> DataFrame:
    """``docs`` with the columns ``size``, ``source_size``, ``target`` and
    ``copies`` (how often the mix repeats the document) added.

    ``weights`` holds one row (source, weight) per source, matched null-safe;
    a source without a row or with a weight that is not positive gets target
    0.  The targets add up to ``budget`` times all sizes (in words), or to
    all caps if that is less.  The extra repetition goes to the documents of
    the source with the smallest md5 of ``seed:id``, as many as bring the
    source's words closest to its target.  Null texts have size 0; rows
    sharing an id are treated alike (all or none of them get the extra
    copy); rows with a null id hash like the id "null".  An empty table
    gives an empty mix.  Input columns named like a new one are replaced.
    Reruns agree.
    """
    new = ("size", "source_size", "target", "copies")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    slim = written(docs.select(F.col(source_col).alias("s"), word_count(F.col(text_col)).alias("size"),
                               key.alias("key")))
    cells = written(slim.groupBy("s", F.substring("key", 1, CELL).alias("cell")).agg(F.sum("size").alias("size")))
    sizes = cells.groupBy("s").agg(F.sum("size").alias("source_size"))
    w = weights.select(F.col(weights.columns[0]).alias("ws"), F.col(weights.columns[1]).cast("double").alias("weight"))
    sources = written(
        sizes.join(w, F.expr("s <=> ws"), "left").drop("ws")
        .withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0))
        .withColumn("cap", F.when(F.col("weight") > 0, F.lit(float(max_epochs)) * F.col("source_size")).otherwise(0.0)))
    total = float(budget) * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(sources.filter("weight > 0"), total)
    plan = (sources.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))
                               if level != float("inf") else F.col("cap"))
            .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                        .otherwise(0).cast("long"))
            .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
            .select("s", "source_size", "target", "whole", "need"))
    plan = written(plan)

    # The histogram cell in which a source's fraction ends, and the words before it.
    before = Window.partitionBy("s").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cut = (cells.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
           .alias("a").join(broadcast_if_small(plan).alias("p"), F.expr("a.s <=> p.s"))
           .filter("before < need and before + size >= need").select("a.s", "cell", "before", "need"))
    cut = written(cut)
    edge = (slim.withColumn("cell", F.substring("key", 1, CELL)).alias("d")
            .join(broadcast_if_small(cut).alias("c"), F.expr("d.s <=> c.s and d.cell = c.cell"))
            .select("d.s", "key", "d.size", "before", "need")
            .groupBy("s", "key", "before", "need").agg(F.sum("size").alias("size")))
    upto = Window.partitionBy("s").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    last = (edge.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
            .filter("start + size / 2 <= need").groupBy("s").agg(F.max("key").alias("last")))
    ends = (plan.alias("p").join(cut.alias("c"), F.expr("p.s <=> c.s"), "left")
            .join(last.alias("l"), F.expr("p.s <=> l.s"), "left")
            .select(F.col("p.s").alias("__mix_s"), F.col("source_size").alias("__mix_n"),
                    F.col("target").alias("__mix_t"), F.col("whole").alias("__mix_whole"),
                    # up to this key, inclusive; only the cells before the cut if none of the cell's documents fit
                    F.coalesce("last", "cell", F.lit("")).alias("__mix_last")))
    ends = broadcast_if_small(written(ends))
    extra = (F.col("__mix_last") != "") & (key <= F.col("__mix_last"))
    return (docs.withColumn("size", word_count(F.col(text_col)))
            .join(ends, docs[source_col].eqNullSafe(F.col("__mix_s")), "left")
            .withColumn("source_size", F.col("__mix_n"))
            .withColumn("target", F.col("__mix_t"))
            .withColumn("copies", F.col("__mix_whole") + extra.cast("long"))
            .select(*docs.columns, *new))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mixed documents themselves: each row as often as ``copies`` says."""
    return (mixed.filter("copies > 0")
            .withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))


def cycled_weights(docs: DataFrame, source_col: str = "source", cycle: tuple = (3.0, 1.0, 2.0)) -> DataFrame:
    """(source, weight): the distinct sources by code point, null last, with
    the weights of ``cycle`` in turn.  The place of a source is counted per
    partition of a range partitioning, without a one-task window."""
    from wordloom.operators.ordering import dense_index

    found = written(docs.select(F.col(source_col).alias("s")).groupBy("s").count())
    placed = dense_index(found.select("s", F.col("s").isNull().alias("none")),
                         [F.col("none").asc(), F.col("s").asc()], "place")
    return placed.select("s", F.element_at(F.array(*[F.lit(float(x)) for x in cycle]),
                                           (F.col("place") % len(cycle) + 1).cast("int")).alias("weight"))
