"""Mixing sources to target weights.  [native]

Main path: DataFrame functions only.  Documents get a hash-random key; ordering by (source, key) deals a hot source
over as many ranges as it fills; prefix sums of word counts say where a document lies within its source, and the
source's budget is a cut through that line.  A budget above the source's size takes the whole source once for every
full epoch and cuts the next.

The cut is exact: the document on the budget's line is taken for the words that still fit, so the words taken from a
source are the whole part of its target.

Defined results: a null text has no words.  A null source is a source of its own, last in order.  Sources without
words have the target 0.  Repeated rows are documents of their own; they tie and follow each other.  An empty table
gives an empty mix.  Other columns are carried only where asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, materialise, prefix_sums, word_count

#: Weights by rank of the source, repeating; the mix's size as a share of all words; and a source's most epochs.
WEIGHTS, SHARE, EPOCHS = (5, 2, 1), 1.5, 2


#: Columns of the result; a carried column of such a name gives way.
OUT = ("size", "source_size", "target", "taken", "whole")


def random_key(id_col: str, seed: int = 0) -> Column:
    """Hash-random and the same in every run."""
    key = F.col(id_col).cast("string")
    return F.md5(F.concat(F.lit(f"{seed}:"), key) if seed else key)


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Targets of ``sources (source, source_size, n)``: share by weight, stop at ``epochs`` sizes, reshare the excess.

    Each round fixes the sources whose share reaches their stop; the rest share what is left by weight.  Rounds are
    aggregations over the table of sources; they end when no further source stops.
    """
    ranked = prefix_sums(sources.withColumn("one", F.lit(1)), [F.col("source").isNull(), F.col("source")], "one", "rank")
    weight = F.element_at(F.lit([float(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialise(ranked.select("source", "source_size", "n", weight.alias("weight"), (F.col("source_size") * epochs).alias("stop")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    left, rate, stopped = share * total, 0.0, -1
    while True:
        # a stopped source stays stopped: the rate only rises
        is_stopped = F.col("weight") * left / F.lit(rate) > F.col("stop") if rate else F.lit(False)
        row = ranked.agg(
            F.coalesce(F.sum(F.when(~is_stopped, F.col("weight"))), F.lit(0.0)).alias("w"),
            F.coalesce(F.sum(F.when(is_stopped, F.col("stop"))), F.lit(0)).alias("fixed"),
            F.count_if(is_stopped).alias("n"),
        ).first()
        if row["n"] == stopped or not row["w"]:
            break
        stopped, left, rate = row["n"], share * total - row["fixed"], row["w"]
    if not rate:
        target = F.lit(0.0)
    else:
        shared = F.col("weight") * F.lit(float(left)) / F.lit(float(rate))
        target = F.when(shared > F.col("stop"), F.col("stop").cast("double")).otherwise(shared)
    return ranked.select("source", "source_size", "n", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = 0,
    keep: list[str] | None = None,
) -> DataFrame:
    """Return the columns ``keep`` (the id, by default) with ``size, source_size, target, taken`` for every document.

    ``taken`` counts the words the mix takes, repeats included; ``whole`` is the number of full passes over the source.
    """
    carried = [c for c in ([id_col] if keep is None else keep) if c not in OUT]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)])
    sized = docs.select(
        row.alias("row"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        random_key(id_col, seed).alias("key"),
        F.xxhash64(text).alias("tie"),
    )
    sized = materialise(sized, "sized")
    sources = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    targets = materialise(source_targets(sources, weights, share, epochs), "targets")
    # rows alike in all of this are told apart by their place in the written table, so a range can cut them
    order = [F.col("source").isNull(), F.col("source"), F.col("key"), F.col("tie"), F.col("place")]
    placed = prefix_sums(sized.withColumn("place", F.monotonically_increasing_id()), order, "size", "before")
    starts = prefix_sums(targets, [F.col("source").isNull(), F.col("source")], "source_size", "start")
    key = {"__null": F.col("source").isNull(), "__name": F.coalesce("source", F.lit(""))}
    starts = materialise(starts.withColumns(key).drop("source"), "starts")
    joined = heavy_join(placed.withColumns(key), starts, list(key), "n")
    at = F.col("before") - F.col("start")
    budget = F.floor(F.col("target")).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - passes * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - at)).cast("long")
    return joined.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carried)],
        "size",
        "source_size",
        "target",
        (passes * F.col("size") + part).cast("long").alias("taken"),
        passes.alias("whole"),
    )


def copies_taken(docs: DataFrame, plan: DataFrame, row: str, text: str = "text") -> DataFrame:
    """Rows of ``docs``, one for each time the ``plan`` that :func:`mix` made of them takes the document.

    ``row`` is a column of both that numbers the rows.  A document taken in part ends with the last word taken, so the
    words here are those that the plan counts.  The text is moved once, by the join; it takes no part in the ordering.
    """
    taken = plan.where("taken > 0").select(F.col(row), F.col("size").alias("__size"), F.col("taken").alias("__taken"))
    rows = docs.join(taken.hint("merge"), row)
    whole = F.floor(F.col("__taken") / F.col("__size"))
    each = F.array_repeat(F.col("__size"), whole.cast("int"))
    part = F.col("__taken") - whole * F.col("__size")
    rows = rows.withColumn("__words", F.explode(F.when(part > 0, F.concat(each, F.array(part))).otherwise(each)))
    words = F.split(F.regexp_replace(F.col(text), r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    cut = F.array_join(F.slice(words, 1, F.col("__words").cast("int")), " ")
    return rows.withColumn(text, F.when(F.col("__words") == F.col("__size"), F.col(text)).otherwise(cut)).select(*[F.col(f"`{c}`") for c in docs.columns])
