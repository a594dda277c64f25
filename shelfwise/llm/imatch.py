"""Document fingerprints by I-Match: hashes of the terms of a band of inverse document frequency.

All columns are built-in expressions; the only shuffles are the term counts and one pass that sets each document
beside the next.
"""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import lower_ascii, row_id, stage, whole_text

#: Terms count by hash slot. The lexicon is one bit for each slot: 512 KB, whatever the corpus.
SLOT_BITS = 22
#: The band, as inverse document frequency ln(N / df): without the most frequent terms and without rare ones.
IDF_BAND = (4.0, 7.0)
#: Each subset keeps a term with probability 2 ** -bits. The first is the whole lexicon, as in plain I-Match; small
#: subsets outlast larger edits.
SUBSET_BITS = (0,) + (1,) * 2 + (2,) * 2 + (3,) * 3 + (4,) * 4 + (5,) * 5 + (6,) * 5 + (7,) * 5 + (8,) * 5
EMPTY = "--------"
#: Ranges of ids in which each document meets its next: one for so many documents, and no more than MAX_RANGES.
ROWS_PER_RANGE, MAX_RANGES = 500, 4096


def terms(text: Column) -> Column:
    """The distinct words in lower case: runs of digits, letters and characters beyond ASCII."""
    return F.array_distinct(F.array_remove(F.split(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), ""))


def _slot(term_hash: Column) -> Column:
    return F.shiftrightunsigned(term_hash, 64 - SLOT_BITS)


def fit_lexicon(docs: DataFrame, idf_band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """One row `bits`: an array of longs with a bit for each slot whose document frequency lies in the band.

    Frequencies count all documents; the counts are summed map-side before they are shuffled.
    """
    low, high = idf_band
    seen = docs.select(F.explode(terms(whole_text())).alias("term"))
    counts = seen.groupBy(_slot(F.xxhash64("term")).alias("slot")).agg(F.count("*").alias("df"))
    inside = counts.where(F.log(F.lit(float(docs.count())) / F.col("df")).between(low, high))
    words = inside.groupBy(F.shiftrightunsigned("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")
    )
    every = docs.sparkSession.range(1 << (SLOT_BITS - 6)).withColumnRenamed("id", "word").join(words, "word", "left")
    pairs = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return stage(every.agg(F.transform(pairs, lambda p: p["bits"]).alias("bits")), "lexicon")


def with_fingerprint(docs: DataFrame, text: str, lexicon: DataFrame, name: str) -> DataFrame:
    """Adds 32 hashes of 8 hex digits, one for each lexicon subset, as one string.

    A text without a term in the band uses all its terms, and one without any term its own hash, so only equal
    texts without terms agree. A subset that none of the terms is in gives dashes.
    """
    def inside(h: Column) -> Column:
        slot = _slot(h)
        word = F.get(F.col("__lexicon"), F.shiftrightunsigned(slot, 6).cast("int"))
        return F.call_function("bit_get", word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1

    def in_subset(k: int, mask: Column):
        return lambda h: F.xxhash64(h, F.lit(k)).bitwiseAND(mask) == 0

    # each step is a column of its own, which the steps after it read more than once and which is made once
    docs = docs.withColumn("__hashed", F.transform(terms(F.col(text)), lambda w: F.xxhash64(w)))
    docs = docs.withColumn("__lexicon", lexicon.scalar()).withColumn("__band", F.filter("__hashed", inside)).drop("__lexicon")
    kept = F.when(F.size("__band") > 0, F.col("__band")).when(F.size("__hashed") > 0, F.col("__hashed"))
    docs = docs.withColumn("__terms", F.sort_array(F.array_distinct(kept.otherwise(F.array(F.xxhash64(F.lit("no terms"), text))))))
    subsets = F.array(*(F.filter("__terms", in_subset(k, F.lit((1 << bits) - 1).cast("long"))) for k, bits in enumerate(SUBSET_BITS)))
    docs = docs.withColumn("__subsets", subsets)
    # a lambda and not 32 columns: their generated code would be too long to be compiled
    part = lambda s: F.when(F.size(s) == 0, EMPTY).otherwise(F.lower(F.substring(F.lpad(F.hex(F.xxhash64(s)), 16, "0"), 1, 8)))
    return docs.withColumn(name, F.array_join(F.transform("__subsets", part), "")).drop("__hashed", "__band", "__terms", "__subsets")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets in which either fingerprint has terms."""
    def piece(s: Column, i: Column) -> Column:
        return F.substring(s, i * 8 + 1, F.lit(8))

    at = F.sequence(F.lit(0), F.lit(len(SUBSET_BITS) - 1))
    used = F.filter(at, lambda i: (piece(a, i) != EMPTY) | (piece(b, i) != EMPTY))
    same = F.filter(used, lambda i: piece(a, i) == piece(b, i))
    return F.when(F.size(used) == 0, 1.0).otherwise(F.size(same) / F.size(used))


def fingerprints(docs: DataFrame, idf_band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """All rows and columns of `docs` with `fingerprint`."""
    lexicon = fit_lexicon(docs.select("text"), idf_band)
    return with_fingerprint(docs.withColumn("__text", whole_text()), "__text", lexicon, "fingerprint").drop("__text")


def with_next(docs: DataFrame, *columns: str) -> DataFrame:
    """`docs` (with rid and text) and next_<column>: the value of the row after it by rid, then text; after the last, the first.

    Ids are cut at their quantiles into ranges; a window finds the next row within a range, and a copy of the
    first row of the following range stands at each range's end. At most MAX_RANGES rows are copied.
    """
    total = docs.agg(F.count("*").alias("n")).first()["n"]
    ranges = max(1, min(MAX_RANGES, total // ROWS_PER_RANGE))
    wanted = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("rid", wanted, 20 * ranges).alias("cuts")).first()["cuts"] if wanted and total else []
    splits = [-math.inf, *sorted({float(c) for c in cuts or []}), math.inf]
    dealt = Bucketizer(splits=splits if len(splits) > 2 else [-math.inf, 0.0, math.inf], inputCol="__rid", outputCol="__range").transform(
        docs.withColumn("__rid", F.col("rid").cast("double"))
    ).drop("__rid")
    firsts = stage(dealt.groupBy("__range").agg(F.min("rid").alias("rid")), "firsts")
    by_range = Window.orderBy("__range")
    last_range = F.max("__range").over(Window.partitionBy(F.lit(0)))
    before = stage(firsts.select("rid", F.coalesce(F.lag("__range").over(by_range), last_range).alias("__range")), "before")
    copies = docs.join(F.broadcast(before), "rid").withColumn("__copy", F.lit(1))
    both = dealt.withColumn("__copy", F.lit(0)).unionByName(copies)
    order = Window.partitionBy("__range").orderBy("__copy", "rid", "text")
    return both.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}).where("__copy = 0").drop("__copy", "__range")


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many (or all) of another."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(following, half))


def fingerprint_report(docs: DataFrame, idf_band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likeness and that to the next document's.

    A null text counts as empty. Rows without an id come first, in an order made from their texts; rows of equal
    id follow each other by text. No rows give no rows; a single row is its own next.
    """
    lexicon = fit_lexicon(docs.select("text"), idf_band)
    own = docs.select("doc_id", row_id().alias("rid"), whole_text().alias("text"))
    own = with_fingerprint(own, "text", lexicon, "fingerprint")
    beside = with_next(own, "text", "fingerprint")
    beside = beside.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    beside = with_fingerprint(beside, "edited", lexicon, "edited_fingerprint")
    return beside.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
