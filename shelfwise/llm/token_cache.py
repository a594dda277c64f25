"""Token counts through a digest cache: only content that no earlier run has counted is encoded."""

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import lower_ascii, row_id, ship, stage, whole_text

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
#: White space of ASCII, all of which the tokenizer drops: texts can be cut there without changing a count.
ASCII_SPACE = " \t\n\x0b\f\r"
#: Counts of this many distinct space-separated pieces are kept per Python worker, then the memo starts anew.
MEMO_PIECES = 400_000


def tokenizer_version(tokenizer_file: str) -> str:
    """Digest of the tokenizer's file: counts of another version are never mixed in."""
    with open(tokenizer_file, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text: Column) -> Column:
    """SHA-256 of the text normalised by steps that can't change its count under `word_bpe_49k`.

    Runs of ASCII white space become one space and A-Z become lower case, both of which the tokenizer does
    itself; a text with a special token's string in any case keeps its letters, because the library matches
    those strings before it lower-cases.
    """
    special = text.rlike(r"(?i)<\|(?:start|end)oftext\|>")
    plain = F.when(special, text).otherwise(lower_ascii(text))
    return F.unhex(F.sha2(F.trim(F.regexp_replace(plain, r"[ \t\n\x0B\f\r]+", " ")), 256))


def _counter(tokenizer_file: str):
    """A function from texts to token counts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    memo: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        # no token spans white space, so a text's count is the sum over its pieces
        if len(memo) > MEMO_PIECES:
            memo.clear()
        pieces = [text.translate(_TO_SPACE).split(" ") for text in texts]
        misses = list({p for own in pieces for p in own if p not in memo})
        for at in range(0, len(misses), 5000):
            block = misses[at : at + 5000]
            memo.update(zip(block, map(len, tokenizer.encode_batch_fast(block, add_special_tokens=False)), strict=True))
        return [sum(map(memo.__getitem__, own)) for own in pieces]

    return count


_TO_SPACE = {ord(c): " " for c in ASCII_SPACE}


def _encode(tokenizer_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), pa.array(count(part.column("text").to_pylist()), pa.int64())],
                    names=["digest", "n_tokens"],
                )

    return run


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row for each digest; empty if nothing was stored yet.

    Two runs that append at once may store a digest twice, with the same count.
    """
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
        stored.limit(0).collect()
    except AnalysisException:
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_file: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and digest for every row of `docs` (doc_id, text, others ignored).

    The digests of all rows are stored as a narrow table; the digests that the cache lacks pick one row each,
    only those rows' texts are encoded, and their counts are appended to the cache before it is joined. Content
    that fills a third of the table is encoded once: its digest is reduced map-side. Null texts count as empty
    (0 tokens); rows with a null or repeated doc_id each keep their row.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer_file)
    ship(spark)
    texts = docs.select("doc_id", row_id().alias("rid"), F.xxhash64(whole_text()).alias("row"), whole_text().alias("text"))
    keyed = stage(
        texts.select("doc_id", "rid", "row", F.octet_length("text").cast("long").alias("n_bytes"), content_digest(F.col("text")).alias("digest")),
        "digests",
    )
    misses = (
        keyed.groupBy("digest").agg(F.min(F.struct("rid", "row")).alias("first"))
        .join(read_cache(spark, cache_path, version), "digest", "left_anti").select("digest", "first.*")
    )
    # by a hash of the text as well: rows that share a doc_id must not lend their text to another row's digest
    encoded = (
        texts.select("rid", "row", "text").join(misses, ["rid", "row"]).select("digest", "text")
        .mapInArrow(_encode(tokenizer_file), "digest binary, n_tokens long")
    )
    encoded.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")).select(
        "digest", F.lit(version).alias("tokenizer"), "n_tokens"
    ).write.mode("append").parquet(cache_path)
    # stored, so that both sides of the join are plain shuffles, whose hot digests AQE can split
    counts = stage(read_cache(spark, cache_path, version), "counts")
    return keyed.join(counts, "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), F.lower(F.hex("digest")).alias("digest")
    )
