import uuid

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm.token_cache import _counter, content_digest, count_tokens, read_cache, tokenizer_version
from shelfwise.session import shared_dir

FILE = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)


def plain_count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False))


def cache(spark):
    return f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n ̈'sStTx<|endoftext|>"))))
def test_pieces_count_as_the_whole(text):
    assert _counter(FILE)([text]) == [plain_count(text)]


def test_counts_as_the_library(spark, make, odd_rows):
    rows = [*odd_rows, (7, "It's <|endoftext|> and <|EndOfText|>"), (8, "Hello   World"), (9, "hello world"), (10, "ΑΣ ß İ ﬁ")]
    got = count_tokens(make(rows), cache(spark), FILE).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_bytes, r.over_limit) for r in got) == sorted(
        (i or 0, plain_count(t), len((t or "").encode()), plain_count(t) > 2048) for i, t in rows
    )


def test_second_run_encodes_misses_only(spark, make):
    path = cache(spark)
    count_tokens(make([(1, "Some Words"), (2, "some  words")]), path, FILE).collect()
    stored = spark.read.parquet(path)
    assert stored.count() == 1
    # a stored count is used as it is: falsify it to see that nothing is encoded again
    version = tokenizer_version(FILE)
    other = cache(spark)
    stored.selectExpr("digest", "tokenizer", "n_tokens + 100 AS n_tokens").write.parquet(other)
    got = {r.doc_id: r.n_tokens for r in count_tokens(make([(1, "SOME words"), (2, "new text")]), other, FILE).collect()}
    assert got == {1: plain_count("some words") + 100, 2: plain_count("new text")}
    assert read_cache(spark, other, version).count() == 2
    assert read_cache(spark, other, "another version").count() == 0


def test_digest_keeps_letters_beside_special_strings(spark, make):
    texts = ["A <|endoftext|>", "a <|endoftext|>", "A <|ENDOFTEXT|>", "A B", "a b"]
    df = make(list(enumerate(texts))).select("doc_id", content_digest(F.col("text")).alias("d"))
    d = {r.doc_id: bytes(r.d) for r in df.collect()}
    assert d[3] == d[4] and len({d[0], d[2], d[3]}) == 3


def test_no_rows(spark, make):
    assert count_tokens(make([]), cache(spark), FILE).collect() == []
