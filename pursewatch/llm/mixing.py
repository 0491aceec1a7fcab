"""Mixing of sources to target weights, cut exactly at each source's budget of words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pursewatch.llm.common import key60, n_words, stored

#: Rows of a range of keys; in each source one task sorts the one range that has the cut.
ROWS_PER_RANGE = 4_000


def targets(sources: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """source, n, source_size with the source's target: ``target`` and, as whole words, ``budget``.

    Sources by code point, null last, weigh ``weights`` in turn. They share the sum of all sizes;
    a target stops at ``most`` times the source's size and the excess is shared by weight among
    the others, until none is above. That is one level for all the others: in the order of
    (most x size) / weight, the first source that its share does not fill sets it. The table has
    one row per source, however many documents there are.
    """
    every = Window.partitionBy(F.lit(0))
    ranked = F.row_number().over(every.orderBy(F.asc_nulls_last("source"))) - 1
    lcm = 1
    for w in weights:
        lcm = lcm * w
    in_turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("k") + 1).cast("long")
    rising = every.orderBy((F.col("cap") * (F.lit(lcm) / F.col("weight")).cast("long")), "rank")
    shared = (
        sources.withColumn("rank", ranked)
        .withColumn("k", F.col("rank") % len(weights))
        .withColumn("weight", in_turn)
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("left", F.sum("source_size").over(every) - (F.sum("cap").over(rising) - F.col("cap")))
        .withColumn(
            "weights_left",
            F.sum("weight").over(every) - (F.sum("weight").over(rising) - F.col("weight")),
        )
        .withColumn("open", F.col("left") * F.col("weight") <= F.col("cap") * F.col("weights_left"))
    )
    first = F.max(F.when(F.col("open"), F.struct("weights_left", "left"))).over(every)
    level = shared.withColumn("level", first)
    num = F.col("weight") * F.col("level.left")
    den = F.col("level.weights_left")
    return level.select(
        "source",
        "n",
        "source_size",
        F.when(F.col("open"), num.cast("double") / den.cast("double"))
        .otherwise(F.col("cap").cast("double"))
        .alias("target"),
        F.when(F.col("open"), F.expr("(2 * weight * level.left + level.weights_left) div (2 * level.weights_left)"))
        .otherwise(F.col("cap"))
        .alias("budget"),
    )


def mix(
    docs: DataFrame,
    keep: Sequence[str] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Every row with what the mix takes of it.

    Returns doc_id, size, source_size, target, taken, epochs, part and, in ``kept``, the columns
    named in ``keep``. A document's order in its source is a hash of its id. The source is taken
    ``epochs`` times whole, and once more from the start up to the budget's last word: ``part`` is
    the number of words of that last round, all or none of a document but for the one at the cut.
    taken = epochs x size + part; the taken words of a source add up to its target, rounded.

    Keys are dealt into ranges by value, as many as the source has rows for; each range starts at
    the sum of the ranges before it. One range of a source has the cut, and it alone is sorted. Any
    other row is before or after the cut by its key, id and size, so texts and ``keep`` are neither
    shuffled nor stored; only rows that equal the one at the cut in all three are, in the order of
    their texts. Reruns agree.

    With ``keep`` the table is read again for these columns, so one that is costly to make should
    be stored first. Null texts have size 0, null sources are one source, null ids order as the
    empty text; repeated rows are rows of their own; an empty table or one without words gives
    targets of 0.
    """
    sized = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"),
            key60(F.col(id_col)).alias("key"),
        ),
        "sized",
    )
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    plan = stored(targets(sources, weights, most), "targets").withColumnRenamed("source", "of")
    plan = _with_cuts(sized, plan, rows_per_range)
    row = F.struct("key", "doc_id", "size")
    ours = F.col("source").eqNullSafe(F.col("of"))
    if keep:
        rows = docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.col(text_col).alias("text"),
            key60(F.col(id_col)).alias("key"),
            F.struct(*[F.col(c) for c in keep]).alias("kept"),
        )
        counted = rows.withColumn("size", n_words(F.col("text")))
    else:
        rows = counted = sized.withColumns({"text": F.lit(None).cast("string"), "kept": F.lit(None).cast("boolean")})
    apart = counted.join(plan, ours).where(~row.eqNullSafe(F.col("cut")))
    part = F.when(row < F.col("cut"), F.col("size")).otherwise(F.lit(0))
    # words are counted only of rows found by key and id: an equal size would be one more join key
    by_id = ours & (F.col("key") == F.col("cut.key")) & F.col("doc_id").eqNullSafe(F.col("cut.doc_id"))
    alike = rows.join(plan.where("cut is not null"), by_id)
    alike = alike.withColumn("size", n_words(F.col("text"))) if keep else alike
    alike = alike.where(F.col("size").between(F.col("cut.size"), F.col("cut.size")))
    alike = alike.withColumn("nth", F.row_number().over(Window.partitionBy("source").orderBy("text")) - 1)
    part_alike = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("nth") * F.col("size")))

    def taken(found: DataFrame, part: Column) -> DataFrame:
        out = found.withColumn("part", part.cast("long"))
        return out.select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
            "epochs",
            "part",
            "kept",
        )

    return taken(apart, part).unionByName(taken(alike, part_alike))


def _with_cuts(sized: DataFrame, plan: DataFrame, rows_per_range: int) -> DataFrame:
    """The plan with ``epochs``, whole rounds of each source, and where its last round ends.

    ``cut`` is the key, id and size of the row with that round's last word, null where all rounds
    are whole. ``left`` is the number of words that the round has for this row and those alike.
    """
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    rest = F.when(F.col("source_size") > 0, F.col("budget") % F.col("source_size")).otherwise(F.lit(0))
    plan = plan.withColumns({"epochs": whole.cast("long"), "rest": rest.cast("long")})
    # 40 bits of the key times the number of ranges, so that ranges follow the keys' order
    ranges = F.expr(f"cast(ceil(n / {int(rows_per_range)}) as bigint)")
    rows = sized.join(plan.select("of", "n"), F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "range", F.shiftright(F.shiftright("key", 20) * ranges, 40)
    )
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    before = Window.partitionBy("source").orderBy("range")
    starts = sums.withColumn("start", F.sum("in_range").over(before) - F.col("in_range"))
    here = (F.col("start") < F.col("rest")) & (F.col("rest") <= F.col("start") + F.col("in_range"))
    last = stored(
        starts.join(plan.select("of", "rest"), F.col("source").eqNullSafe(F.col("of")))
        .where(here)
        .select("of", F.col("range").alias("nth"), (F.col("rest") - F.col("start")).alias("left")),
        "ranges",
    )
    within = rows.drop("of").join(
        last, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("nth"))
    )
    row = F.struct("key", "doc_id", "size")
    inside = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    # rows alike count as one step: all of them start where the first does
    through = F.sum("size").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    alike = F.sum("size").over(Window.partitionBy("source", "key", "doc_id", "size"))
    steps = within.withColumn("through", through).withColumn("from", F.col("through") - alike)
    cuts = (
        steps.where((F.col("from") < F.col("left")) & (F.col("left") <= F.col("through")))
        .select(F.col("source").alias("cut of"), row.alias("cut"), (F.col("left") - F.col("from")).alias("left"))
        .distinct()
    )
    return stored(plan.join(cuts, F.col("of").eqNullSafe(F.col("cut of")), "left").drop("cut of", "rest"), "cuts")
