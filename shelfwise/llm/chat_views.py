"""Chat formatting by perspective rotation: every dialogue once for each of its speakers."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns of a conversation whose lengths one window sums; the sums of blocks are summed in a second window.
BLOCK_TURNS = 256
NAMELESS = "unknown"


def _header(speaker: Column, perspective: Column) -> Column:
    return (
        F.when(speaker == "system", "<|system|>\n")
        .when(speaker == perspective, "<|assistant|>\n")
        .otherwise(F.concat(F.lit("<|user:"), speaker, F.lit("|>\n")))
    )


def rotate_perspectives(turns: DataFrame, end: str = "<|end|>\n") -> DataFrame:
    """The messages of each dialogue as seen by each of its speakers, with their places in the rendered dialogue.

    `turns`: conv_id, turn, role (the speaker), text. Returns conv_id, perspective, turn, position (from 0), speaker,
    rendered, start, stop (code points in the dialogue, stop exclusive), in_loss, and mask_start, mask_stop: the text
    and end mark of the perspective's own messages, an empty span at the end of others. The rendered dialogue is the concatenation of
    `rendered` by position; it is kept as messages, so a conversation of a third of all rows is never one value.

    System messages are shown to all and are nobody's perspective; a dialogue with no other speaker gives no rows.
    A null role speaks as "unknown" and a null text is empty. Messages are ordered by turn (null last), speaker and
    text; repeated rows are separate messages. A row without conv_id is a dialogue of its own.
    """
    rows = turns.select(
        "conv_id",
        F.coalesce(F.col("conv_id").cast("long"), -F.lit(1) - F.xxhash64("turn", "role", "text").bitwiseAND(F.lit((1 << 62) - 1))).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(NAMELESS)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit((1 << 62))))
    speakers = rows.where("speaker != 'system'").select("conv", F.col("speaker").alias("perspective")).distinct()
    seen = rows.join(speakers, "conv").withColumn("head", _header(F.col("speaker"), F.col("perspective")))
    seen = seen.withColumn("rendered", F.concat("head", "text", F.lit(end))).withColumn("size", F.char_length("rendered").cast("long"))
    inside = Window.partitionBy("conv", "block", "perspective").orderBy(F.col("turn").asc_nulls_last(), "speaker", "text")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumns({"own_position": F.row_number().over(inside) - 1, "own_start": F.coalesce(F.sum("size").over(before), F.lit(0))})
    blocks = rows.join(speakers, "conv").select("conv", "perspective", "block", (F.char_length(_header(F.col("speaker"), F.col("perspective"))) + F.char_length("text") + len(end)).alias("size"))
    blocks = blocks.groupBy("conv", "perspective", "block").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    earlier = Window.partitionBy("conv", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "conv", "perspective", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before")
    )
    placed = seen.join(offsets, ["conv", "perspective", "block"]).withColumn("start", F.col("before") + F.col("own_start"))
    own = F.col("speaker") == F.col("perspective")
    return placed.select(
        "conv_id", "perspective", "turn", (F.col("n_before") + F.col("own_position")).cast("long").alias("position"), "speaker", "rendered",
        F.col("start").cast("long").alias("start"), (F.col("start") + F.col("size")).cast("long").alias("stop"), own.alias("in_loss"),
        (F.col("start") + F.when(own, F.char_length("head")).otherwise(F.col("size"))).cast("long").alias("mask_start"),
        (F.col("start") + F.col("size")).cast("long").alias("mask_stop"),
    )
