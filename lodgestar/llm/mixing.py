"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws the key ``-ln(u) / quality`` (Efraimidis and Spirakis, 2006), ``u`` from a hash
of its id. Within a source the documents are taken in the order of their keys until the words of the
source's budget are used. A budget above the source's size first takes complete epochs; only the rest
is such a selection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgestar.llm.text import word_count
from lodgestar.session import stage

#: Key ranges per doubling of the key. A source's prefix sum over ranges is exact, and only the range in
#: which its budget ends is sorted. The logarithm of a key is spread alike whatever the weight's scale,
#: and a range holds at most 1 / (e * RANGES / ln 2) of the keys drawn, 0.007 %.
RANGES = 4_096
#: Doublings beyond these bounds share the last range.
_DOUBLINGS = 1_100


def text_quality(text: Column, size: Column) -> Column:
    """Weight of a document: 1 with words of ordinary mean length, else a quarter."""
    length = F.length(text)
    odd = (size > 0) & ((length < size * 3) | (length > size * 12))
    return F.when(odd, F.lit(0.25)).otherwise(F.lit(1.0))


def with_draws(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    quality: Column | None = None,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with a column ``mix_``: source, size, and the place in the order of its source.

    Rows with equal id and text draw equal places and are treated alike. A null id draws like the
    empty string, a null text has size 0.
    """
    size = word_count(F.col(text))
    weight = quality if quality is not None else text_quality(F.col(text), size)
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    digits = F.substring(F.md5(F.concat(name, F.lit(seed)).cast("binary")), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    place = F.struct(
        (-F.log(uniform) / F.coalesce(weight, F.lit(1.0))).alias("draw"),
        F.col(key).alias("id"),
        F.xxhash64(F.col(text)).alias("content"),
    )
    return docs.withColumn(
        "mix_", F.struct(F.col(source).alias("source"), size.alias("size"), place.alias("place"))
    )


def source_targets(
    drawn: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3
) -> DataFrame:
    """Per source its size and target: shares of all words by weight, at most ``max_epochs`` sizes.

    Weights are dealt in turn to the sources by code point, null last. What a source cannot take is
    shared among the others by weight: sorted by how soon they fill, the first few are full, and the
    level of the others is what is left per weight. One short row per source is sorted here, never documents.
    """
    weight = F.array(*[F.lit(w) for w in weights])
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sources = drawn.groupBy(F.col("mix_.source").alias("source")).agg(
        F.sum("mix_.size").alias("source_size")
    )
    sources = sources.withColumn(
        "weight", F.element_at(weight, ((number - 1) % len(weights) + 1).cast("int"))
    ).withColumn("most", F.col("source_size") * max_epochs)
    everything = Window.partitionBy()
    soonest = Window.orderBy(
        F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    sources = sources.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(soonest), none))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(soonest), none)),
    )
    # Words per weight if all sources before are full: grows while they are, falls after that.
    level = F.max("level").over(everything)
    target = F.least(F.col("most").cast("double"), level * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def source_cuts(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: target, complete epochs, and the place where the selection of the rest ends.

    Sizes are summed per key range within each task first, so a source with a third of all rows is
    as cheap as any. Only rows of the one range where a budget ends are sorted, which are few with
    weights of any scale.
    """
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    budgets = targets.withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("long")).withColumn(
        "budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    )
    budgets = stage(budgets, "mix-budgets")
    # A key of zero has no logarithm.
    doublings = F.greatest(F.log2(F.col("mix_.place.draw")), F.lit(-float(_DOUBLINGS)))
    span = F.floor(F.least(doublings, F.lit(float(_DOUBLINGS))) * RANGES)
    rows = drawn.select("mix_.*", span.alias("span"))
    spans = rows.groupBy("source", "span").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("span")
    spans = spans.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    ends = spans.alias("s").join(
        budgets.where("budget > 0").alias("b"),
        F.col("s.source").eqNullSafe(F.col("b.source"))
        & (F.col("before") < F.col("budget"))
        & (F.col("before") + F.col("words") >= F.col("budget")),
    )
    ends = ends.select("s.source", "span", (F.col("budget") - F.col("before")).alias("left"))
    inside = rows.alias("r").join(
        stage(ends, "mix-ends").alias("e"),
        F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.span") == F.col("e.span")),
    )
    places = inside.groupBy("r.source", "left", "place").agg(
        F.sum("size").alias("words"), F.count("*").alias("rows")
    )
    order = Window.partitionBy("source").orderBy("place")
    places = places.withColumn("before", F.sum("words").over(order) - F.col("words"))
    cut = places.where("before < left AND before + words >= left").select(
        "source",
        F.col("place").alias("cut"),
        # Equal rows share what is left.
        F.expr("(left - before) div rows").alias("part"),
    )
    return budgets.alias("b").join(
        cut.alias("c"), F.col("b.source").eqNullSafe(F.col("c.source")), "left"
    ).select("b.*", "cut", "part")


def apply_cuts(drawn: DataFrame, cuts: DataFrame) -> DataFrame:
    """``drawn`` with its source's figures, ``selected`` (part of the rest) and ``taken`` words.

    The document in which a budget ends gives only the words that are left.
    """
    joined = drawn.join(cuts.alias("m"), F.col("mix_.source").eqNullSafe(F.col("m.source")), "left")
    place, cut, size = F.col("mix_.place"), F.col("m.cut"), F.col("mix_.size")
    selected = F.coalesce(place <= cut, F.lit(False))
    rest = F.when(place < cut, size).when(place == cut, F.col("m.part")).otherwise(F.lit(0))
    return joined.select(
        *[drawn[name] for name in drawn.columns],
        F.col("m.source_size"),
        F.col("m.target"),
        F.col("m.epochs"),
        selected.alias("selected"),
        (F.col("m.epochs") * size + F.coalesce(rest, F.lit(0))).cast("long").alias("taken"),
    )


def mix_drawn(
    drawn: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    max_epochs: int = 3,
    *,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """``drawn`` with the figures of the mix; ``narrow`` is the staged column ``mix_``, if there is one."""
    if narrow is None:
        narrow = stage(drawn.select("mix_"), "mix-draws")
    cuts = stage(source_cuts(narrow, source_targets(narrow, weights, max_epochs)), "mix-cuts")
    return apply_cuts(drawn, cuts).withColumn("size", F.col("mix_.size")).drop("mix_")


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, **columns
) -> DataFrame:
    """The columns of ``docs`` with ``size``, ``source_size``, ``target``, ``epochs``, ``selected``, ``taken``.

    Built-in expressions only. Every row is returned; ``taken`` says how many of its words the mix
    takes, repeats counted. Rows without words take nothing. The id, source, text and quality are
    ``columns`` as for :func:`with_draws`. An empty table has an empty result. Columns of ``docs``
    with the names of the added ones are replaced.
    """
    added = ("mix_", "size", "source_size", "target", "epochs", "selected", "taken")
    return mix_drawn(with_draws(docs.drop(*added), **columns), weights, max_epochs)


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it: once per epoch, once more if selected.

    The document in which a budget ends is taken whole.
    """
    copies = (F.col("epochs") + F.col("selected").cast("int")).cast("int")
    times = F.when(copies > 0, F.sequence(F.lit(1), copies))
    return mixed.withColumn("epoch", F.explode(times))
