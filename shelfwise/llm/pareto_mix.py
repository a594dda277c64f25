"""Mixing sources to target weights by Pareto order sampling."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stage, whole_text

#: Ranks have this many bits and are searched so many bits at a time.
RANK_BITS, STEP_BITS = 48, 12


def words(text: Column) -> Column:
    """Number of words between ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_copies: int) -> DataFrame:
    """source_key, source_size, target: shares of the whole by weight, none above `max_copies` times its source.

    Sources by code point, null last, take the weights in turn. With caps c and weights w the targets are
    min(c, level * w): sources in order of c / w are full until the level of the rest is below their own c / w;
    from there on the levels only fall, so it is the largest of those.
    One row per source, so the windows over all rows hold a small table.
    """
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), F.pmod(F.row_number().over(Window.orderBy("source_key")) - 1, F.lit(len(weights))) + 1)
    by_level = Window.orderBy("level_of_cap", "source_key")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    own = sizes.withColumn("w", w).withColumn("cap", F.col("source_size").cast("double") * max_copies)
    own = own.withColumn("level_of_cap", F.col("cap") / F.col("w"))
    own = own.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    own = own.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    own = own.withColumn("level", F.max(F.when(F.col("level") <= F.col("level_of_cap"), F.col("level"))).over(everything))
    return own.select("source_key", "source_size", F.round(F.least("cap", F.col("level") * F.col("w")), 6).alias("target"))


def _threshold(ranked: DataFrame, needs: DataFrame) -> DataFrame:
    """Per source the rank up to which documents are taken: source_key, last_rank, take_last.

    The rank where the running size passes `need` is found STEP_BITS at a time: sizes are summed by source and
    bin, and only the bin that holds the passing is looked into again. No source is sorted as a whole.
    """
    cut = needs.select("source_key", "need", F.lit(0).cast("long").alias("prefix"))
    for shift in range(RANK_BITS - STEP_BITS, -1, -STEP_BITS):
        inside = ranked.join(cut, "source_key").where(F.shiftright("rank", shift + STEP_BITS) == F.col("prefix"))
        bins = inside.groupBy("source_key", "need", F.shiftright("rank", shift).alias("prefix")).agg(F.sum("size").alias("own"))
        running = F.sum("own").over(Window.partitionBy("source_key").orderBy("prefix"))
        passing = bins.withColumn("passed", running).where((F.col("passed") >= F.col("need")) & (F.col("passed") - F.col("own") < F.col("need")))
        cut = passing.select("source_key", (F.col("need") - (F.col("passed") - F.col("own"))).alias("need"), "prefix", "own")
    return cut.select("source_key", F.col("prefix").alias("last_rank"), (F.col("need") * 2 >= F.col("own")).alias("take_last"))


def by_length(size: Column) -> Column:
    """A preference for longer documents: the binary digits of the number of words."""
    return F.length(F.bin(size)).cast("double")


def _expected(cells: DataFrame, max_copies: int) -> DataFrame:
    """source_key, preference, expected: copies wanted of each document of a source, in proportion to its preference.

    `cells` has one row per source and preference (cell_size, target). The copies are min(max_copies, level *
    preference) with the level that makes the source's words reach its target; the preferences that are cut off
    first are the highest, so the level is found as that of `source_targets`, within the source.
    """
    most, mass = F.col("cell_size").cast("double") * max_copies, F.col("preference") * F.col("cell_size").cast("double")
    own = Window.partitionBy("source_key")
    by_level = own.orderBy(F.desc("preference"))
    cells = cells.where("cell_size > 0").withColumns({"_most": most, "_mass": mass})
    before = F.coalesce(F.sum("_most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_mass").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    cells = cells.withColumn("_level", (F.col("target") - before) / rest)
    fits = F.when(F.col("_level") <= float(max_copies) / F.col("preference"), F.col("_level"))
    level = F.coalesce(F.max(fits).over(own), float(max_copies) / F.min("preference").over(own))
    return cells.select("source_key", "preference", "cell_size", F.least(F.lit(float(max_copies)), level * F.col("preference")).alias("expected"))


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_copies: int = 3, seed: str = "mix", preference: Callable[[Column], Column] | str | None = None
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (copies times size) of every row of `docs`.

    A document's expected copies are in proportion to its preference (a column of `docs`, or made from the number of
    words; equal without one), so that a source's words reach its target, and at most `max_copies`. It gets the
    whole part of them for certain. The fractions are inclusion probabilities of a sample of fixed size: one more
    copy goes to the documents of lowest Pareto rank, odds(u) / odds(p), with u a fixed random number of the
    document, until the source's target is reached as closely as whole documents allow.

    Reruns agree: u is made from seed, doc_id, text and a number within rows that are alike in these, which are
    numbered as they are counted, never gathered. A null text has size 0 and a null source is a source of its own;
    a preference that is null or not positive counts as 1e-9. No rows give no rows. The document rows are stored
    once, narrow; all further steps sum them by source and preference, or bin of ranks, before they shuffle.
    """
    source = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))
    own = docs.select(
        "doc_id", "source", F.md5(whole_text()).alias("text_md5"), words(whole_text()).alias("size"),
        *([F.col(preference).cast("double").alias("wanted")] if isinstance(preference, str) else []),
    )
    if not isinstance(preference, str):
        own = own.withColumn("wanted", F.lit(1.0) if preference is None else preference(F.col("size")))
    alike = own.groupBy("doc_id", "source", "text_md5", "size", "wanted").agg(F.count("*").alias("n"))
    placed = alike.withColumn("place", F.explode(F.sequence(F.lit(1), F.col("n"))))
    named = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_md5", F.col("place").cast("string"))
    bits = F.conv(F.substring(F.md5(named), 1, RANK_BITS // 4), 16, 10).cast("long")
    rows = stage(
        placed.select("doc_id", "source", source.alias("source_key"), "size", bits.alias("bits"), F.greatest(F.coalesce("wanted", F.lit(0.0)), F.lit(1e-9)).alias("preference")),
        "mix",
    )
    cells = rows.groupBy("source_key", "preference").agg(F.sum("size").alias("cell_size"))
    cells = stage(cells, "cells")
    sizes = cells.groupBy("source_key").agg(F.sum("cell_size").alias("source_size"))
    targets = stage(source_targets(sizes, weights, max_copies), "targets")
    expected = _expected(cells.join(targets, "source_key"), max_copies)
    whole = F.floor(F.col("expected") + 1e-9)
    copies = expected.select("source_key", "preference", "cell_size", whole.alias("whole"), F.greatest(F.col("expected") - whole, F.lit(0.0)).alias("part"))
    copies = stage(copies, "copies")
    u = (F.col("bits") + 0.5) / float(1 << RANK_BITS)
    part = F.when(F.col("part") > 0, F.col("part"))  # without a fraction there is no rank
    order = u / (1 - u) / (part / (1 - part))
    rank = F.floor(order / (1 + order) * float(1 << RANK_BITS)).cast("long")
    given = rows.join(copies.drop("cell_size"), ["source_key", "preference"], "left")
    ranked = given.where("part > 0").select("source_key", "size", rank.alias("rank"))
    certain = copies.groupBy("source_key").agg(F.sum(F.col("whole") * F.col("cell_size")).alias("certain"), F.max("part").alias("most"))
    needs = targets.join(certain.where("most > 0"), "source_key").select("source_key", (F.col("target") - F.col("certain")).alias("need"))
    limits = stage(_threshold(ranked, needs), "limits")
    extra = (F.col("part") > 0) & ((rank < F.col("last_rank")) | ((rank == F.col("last_rank")) & F.col("take_last")))
    return (
        given.join(targets, "source_key").join(limits, "source_key", "left")
        .withColumn("copies", F.coalesce("whole", F.lit(0)) + F.coalesce(extra, F.lit(False)).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
