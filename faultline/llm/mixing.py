"""Operator 13: mixing sources to target weights by capped water-filling.

Every source has a weight and a size in words. The mix holds a given share of all words; a source's
target is its share by weight, but never more than ``epochs`` times its size. Sources above that are clamped there, and
what they leave is dealt again to the others by weight until none is above (``water_fill``). The rounds are aggregates
over the table of sources in whole numbers, so they are exact; each clamps one more source at least.

A target is met by whole repetitions of every document and a seeded fraction: documents of a source stand in the
order of a digest of their id, and one more copy goes to the first ones whose words fill
the rest (a document counts if its middle lies within it, so a source misses its target by half a document at most).
Where each document stands comes from running totals over a range-partitioned order, so a source that holds a
third of all rows is cut like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import flat_text, is_space, prepare, same_or_new, stage
from faultline.operators.ordered import global_rank, running_totals
from faultline.session import broadcast_if_small

WEIGHTS = (5, 2, 1)  # of the sources in code-point order, repeating
EPOCHS = 3
SHARE = 1.0  # of all words
SEED = 42
_WHOLE = "decimal(19,0)"


def _sizes(batches):
    for b in batches:
        raw, off = flat_text(b.column(0))
        begins = np.zeros(len(raw), bool)
        if len(raw):
            word = ~is_space(raw)
            begins[0], begins[1:] = word[0], word[1:] & ~word[:-1]
            first = off[:-1][np.diff(off) > 0]
            begins[first] = word[first]
        at = np.flatnonzero(begins)
        size = np.searchsorted(at, off[1:]) - np.searchsorted(at, off[:-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(size, pa.int64())], names=[*b.schema.names, "size"])


def sized(docs: DataFrame, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs(doc_id, source, text)`` -> ``doc_id, source, size, draw, tie`` (and ``row``, a struct of ``keep``).

    ``size`` counts the words of the whole text, ``draw`` is the seeded place of the id, ``tie`` tells repeated rows apart.
    """
    prepare(docs.sparkSession)
    row = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")] if keep else []
    d = same_or_new(docs, [("text", "binary"), ("doc_id", "bigint"), ("source", "string")], row)
    schema = ", ".join(f"`{n}` {t}" for n, t in d.dtypes) + ", size bigint"
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return d.mapInArrow(_sizes, schema).select(
        "doc_id", "source", "size", F.substring(digest, 1, 16).alias("draw"),
        F.monotonically_increasing_id().alias("tie"), *(["row"] if keep else []))


def _above(level: tuple[int, int], epochs: int) -> Column:
    """The sources whose cap the level (words per weight, as a fraction) reaches."""
    words, weight = (F.lit(x).cast(_WHOLE) for x in level)
    return (F.col("size") * epochs).cast(_WHOLE) * weight <= F.col("weight").cast(_WHOLE) * words


def water_fill(sources: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``sources(source, size, weight)`` -> with ``target double, copies bigint, rest bigint``.

    ``copies`` whole repetitions and ``rest`` further words make up the target, rounded down to
    whole words. Weights are positive whole numbers. A source without words has target 0; if the caps
    of all sources fall short of the share, every target is its cap.
    """
    s = sources.select("source", "size", "weight")
    cap = F.col("size") * epochs
    sums = s.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    wanted = int((sums["size"] or 0) * share)
    level, above = (wanted, sums["weight"] or 1), None
    while True:
        above = _above(level, epochs)
        got = s.agg(F.sum(F.when(above, cap).otherwise(0)).alias("caps"),
                    F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight")).first()
        new = (wanted - (got["caps"] or 0), got["weight"] or 0)
        if not new[1] or new == level:  # all at their caps, or no further source
            break
        level = new
    raised = (F.lit(level[0]).cast(_WHOLE) * F.col("weight").cast(_WHOLE)).alias("_raised")
    out = s.select("*", above.alias("_above"), raised).withColumn(
        "target", F.when(F.col("_above"), cap.cast("double")).otherwise(
            F.col("_raised").cast("double") / F.lit(float(level[1]))))
    words = F.when(F.col("_above"), cap).otherwise(F.expr(f"_raised div cast({level[1]} as {_WHOLE})"))
    copies = F.when(F.col("size") > 0, F.expr("_words div size")).otherwise(0)
    return (out.withColumn("_words", words).withColumn("copies", copies.cast("bigint"))
            .withColumn("rest", F.col("_words") - F.col("copies") * F.col("size")).drop("_words", "_above", "_raised"))


def mixture(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs(doc_id, source, text)`` -> ``doc_id, source, size, source_size, target, copies, taken``, one row per row.

    ``copies`` says how often the mix repeats the document, ``taken`` how many words that makes. NULL text has
    no words; NULL is a source of its own, in the last place; NULL ids share one place in the seeded order. Repeated
    rows are rows of their own. Columns named in ``keep`` travel along as the struct ``row``,
    so that ``repeated`` can write the mix; without it no text is shuffled. Others are ignored.
    """
    rows = stage(sized(docs, seed, keep), "sized")
    per = rows.groupBy("source").agg(F.sum("size").alias("size"))
    per = global_rank(per, [F.col("source").asc_nulls_last()], "place")
    kinds = F.array(*[F.lit(w).cast("bigint") for w in weights])
    per = per.withColumn("weight", F.element_at(kinds, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    filled = water_fill(stage(per, "sources"), share, epochs)
    run = running_totals(rows, ["source", "draw", "doc_id", "size", "tie"], ["size"])
    begin = run.groupBy("source").agg(F.min("before_size").alias("begin")).withColumnRenamed("source", "_source")
    table = (filled.withColumnRenamed("size", "source_size").join(begin, F.expr("source <=> _source")).drop("source"))
    middle = 2 * (F.col("before_size") - F.col("begin")) + F.col("size")
    more = (F.col("rest") > 0) & (middle <= 2 * F.col("rest"))
    got = run.join(broadcast_if_small(stage(table, "targets")), F.expr("source <=> _source"))
    copies = F.col("copies") + more.cast("bigint")
    return got.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"), *(["row"] if keep else []))


def repeated(mix: DataFrame) -> DataFrame:
    """The mix itself: the kept columns of every document as often as it is taken, with ``epoch`` from 1."""
    return (mix.where("copies > 0").select("row", F.explode(F.expr("sequence(1, cast(copies as int))")).alias("epoch"))
            .select("row.*", "epoch"))
