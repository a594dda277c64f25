"""Phrase collocations from a weighted de Bruijn graph of the words of each language.

Every word position gives one gram: three words, an edge between two overlapping nodes of two words, or fewer where
the piece ends. A node occurs as often as the edges out of it and the piece ends at it. Words of fewer occurrences
than a candidate needs end a piece too, as no candidate holds one. Paths of edges without a branch, start or end are
compacted; the nodes inside one are always part of something longer that is as frequent.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import ship, shuffle_partitions, stage, whole_text
from shelfwise.llm.encoded import PART_TOKENS, chunked, dictionary, free, numbered, packed, unpacked, with_words
from shelfwise.llm.shingles import mixed

#: A-Z to lower case, ends of pieces to a line feed, tabs to spaces.
_CODES = bytearray(range(256))
_CODES[65:91] = range(97, 123)
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _CODES[_c] = 10
_CODES[9] = 32
_CODES = bytes(_CODES)
#: Places of the first entries of each vocabulary: end of a piece, and nothing between two spaces.
END, NOTHING = 0, 1
#: Bits of a word's number within a chunk.
_WIDE = np.int64(32)


def _encode(texts: list[tuple]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Entries are `lang TAB word`; a language's texts come together, each piece with its end."""
    by_lang: dict[str, list[bytes]] = {}
    for _, _, lang, text in texts:
        by_lang.setdefault(lang, []).append(text.translate(_CODES))
    entries, streams, n = [pa.array([b"", b""], pa.binary())], [], 2
    for lang, own in by_lang.items():
        tokens, words = numbered(b"\n".join([*own, b""]).replace(b"\n", b" \n "), (b"\n", b""))
        streams.append(np.where(tokens > NOTHING, tokens + (n - 2), tokens)[tokens != NOTHING])
        tagged = pc.binary_join_element_wise(pa.scalar(lang.encode() + b"\t", pa.binary()), words.slice(2), pa.scalar(b"", pa.binary()))
        entries.append(tagged)
        n += len(tagged)
    tokens = np.concatenate(streams)
    counts = np.bincount(tokens, minlength=n)
    counts[:2] = 0
    return pa.concat_arrays(entries), counts, tokens


def _coded(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places among the different numbers, and these."""
    coded = pa.array(numbers).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False)


_BLOCKS = "bucket int, n int, first binary, second binary, third binary, f binary"


def _grams(buckets: int):
    """(bucket, n, first, second, third, f): the chunk's grams by bucket of their first two words; -1 for no word."""

    def work(ids: np.ndarray, counts: np.ndarray, tokens: np.ndarray, documents: list) -> Iterator[pa.RecordBatch]:
        padded = np.concatenate([tokens, np.full(2, END, np.int32)])
        for start in range(0, len(tokens), PART_TOKENS):
            yield from part(ids, padded[start : start + PART_TOKENS + 2])

    def part(ids: np.ndarray, padded: np.ndarray) -> Iterator[pa.RecordBatch]:
        known = ids >= 0
        at = np.flatnonzero(known[padded[:-2]])
        second, third = padded[at + 1], padded[at + 2]
        second = np.where(known[second], second, END)
        third = np.where(known[third] & (second != END), third, END)
        node, nodes = _coded(padded[at].astype(np.int64) << _WIDE | second)
        gram, grams = _coded(node << _WIDE | third)
        f, low = np.bincount(gram, minlength=len(grams)), np.int64(0xFFFFFFFF)
        node = nodes[grams >> _WIDE]
        words = [ids[node >> _WIDE], ids[node & low], ids[grams & low]]
        bucket = mixed(words[0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ words[1].astype(np.uint64)) % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.uint16 if buckets < 1 << 16 else np.uint32), kind="stable")
        bucket, words, f = bucket[order].astype(np.int64), [w[order] for w in words], f[order]
        edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else [0]
        rows = [(int(bucket[a]), b - a, *(packed(x[a:b]) for x in (*words, f))) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        if rows:
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in _BLOCKS.split(", ")])

    return work


def _flow(least: int):
    """Frequent nodes and edges of each bucket: (first, second, third, f), third null for nodes; rows come by bucket."""

    def close(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        (first, firsts), (second, seconds), (third, thirds) = (_coded(c) for c in columns[:3])
        node, nodes = _coded(first << _WIDE | second)
        gram, grams = _coded(node << _WIDE | third)
        # through a node go the edges out of it and the piece ends at it
        through, weight = (np.bincount(which, columns[3], len(all_)).astype(np.int64) for which, all_ in ((node, nodes), (gram, grams)))
        low = np.int64(0xFFFFFFFF)
        node_first, node_second, of = firsts[nodes >> _WIDE], seconds[nodes & low], grams >> _WIDE
        node, edge = np.flatnonzero((node_second >= 0) & (through >= least)), np.flatnonzero((thirds[grams & low] >= 0) & (weight >= least))
        out = [np.concatenate([x[node], x[of[edge]]]) for x in (node_first, node_second)]
        out += [np.concatenate([np.zeros(len(node), np.int64), thirds[grams & low][edge]]), np.concatenate([through[node], weight[edge]])]
        gap = np.concatenate([np.ones(len(node), bool), np.zeros(len(edge), bool)])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64(), mask=gap if i == 2 else None) for i, c in enumerate(out)], names=["first", "second", "third", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for i, (bucket, n) in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("n").to_pylist(), strict=True)):
                if bucket != at and held:
                    yield close(held)
                    held = []
                    free()
                at = bucket
                held.append([unpacked(batch.column(c)[i].as_py(), n, np.int64) for c in ("first", "second", "third", "f")])
        if held:
            yield close(held)
            del held
        free()

    return run


#: Grams of a bucket, about: what a task holds at a time.
BUCKET_GRAMS = 1_000_000


@dataclass(frozen=True)
class PhraseGraph:
    """The frequent part of the graph; words are numbers of `words` (id, lang, word, f).

    `nodes` (first, second, f, l, r, score) and `edges` (first, second, third, f, cut, l, r, score, from_f, to_f), with the
    occurrences of the parts of the lowest-scoring cut; `paths` (path, f, words) of the compacted edges;
    `totals` (lang, n) of all words.
    """

    words: DataFrame
    totals: DataFrame
    nodes: DataFrame
    edges: DataFrame
    paths: DataFrame


def _cut_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact in 38 digits."""
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    return F.expr(f"CAST((CAST(1000000 AS DECIMAL(7, 0)) * ({wide(a)} * {wide(a)})) div ({wide(left)} * {wide(right)}) AS BIGINT)")


def _cut(k: int, left: str, right: str) -> Column:
    return F.struct(_cut_score("f", left, right).alias("score"), F.lit(k).alias("cut"), F.col(left).alias("l"), F.col(right).alias("r"))


def compacted_paths(edges: DataFrame) -> DataFrame:
    """path, f, words: maximal paths of `edges` over nodes without branch, start or end, as lists of word numbers.

    All occurrences of a node go through the one edge before it and the one after it if both are as frequent as the
    node. Such edges are linked, and each finds the first of its path by doubling: a link is replaced by the link of
    what it links to, in as many rounds as the longest path has digits in binary. A path can't be a ring, as every
    occurrence begins somewhere, and lies inside one piece of a text.
    """
    key = ["first", "second", "third"]
    own = stage(edges.select(F.struct(*key).alias("edge"), *key, "f", "from_f", "to_f"), "edges")
    after = own.where("f = from_f").select(F.struct("first", "second").alias("node"), F.col("edge").alias("next"))
    before = own.where("f = to_f").select(F.struct(F.col("second").alias("first"), F.col("third").alias("second")).alias("node"), "edge")
    open_ = stage(before.join(after, "node").select(F.col("next").alias("edge"), F.col("edge").alias("head"), F.lit(1).alias("steps")), "links")
    done = own.select("edge").join(open_.select("edge"), "edge", "left_anti").select("edge", F.col("edge").alias("head"), F.lit(0).alias("steps"))
    while open_.limit(1).count():
        known = done.select(F.col("edge").alias("head"), F.col("head").alias("root"), F.col("steps").alias("more"), F.lit(True).alias("ended"))
        hops = open_.select(F.col("edge").alias("head"), F.col("head").alias("root"), F.col("steps").alias("more"), F.lit(False).alias("ended"))
        moved = open_.join(known.unionByName(hops), "head").select("edge", F.col("root").alias("head"), (F.col("steps") + F.col("more")).alias("steps"), "ended")
        moved = stage(moved, "links")
        done = stage(done.unionByName(moved.where("ended").drop("ended")), "heads")
        open_ = moved.where("not ended").drop("ended")
    tail = F.transform(F.array_sort(F.collect_list(F.when(F.col("steps") > 0, F.struct("steps", F.col("edge.third").alias("third"))))), lambda x: x["third"])
    paths = done.join(own.select("edge", "f"), "edge").groupBy("head").agg(F.first("f").alias("f"), tail.alias("tail"))
    path = F.concat(F.array("head.first", "head.second", "head.third"), "tail")
    return paths.select(path.alias("path"), "f", F.size(path).alias("words"))


def _split() -> dict[str, Column]:
    """Language and word of an entry; no word holds a tab."""
    entry = F.col("entry").cast("string")
    word = F.substring_index(entry, "\t", -1)
    return {"lang": F.left(entry, F.char_length(entry) - F.char_length(word) - 1), "word": word}


def phrase_graph(docs: DataFrame, least: int = 10) -> PhraseGraph:
    """The graph of all texts: nodes and edges of at least `least` occurrences, with exact counts.

    A-Z are lower-cased; texts are cut at `.,;:!?` and line breaks, words lie between spaces and tabs. A null text
    has no words, a null language is `und`; repeated rows count as often as they occur.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(True).alias("counted"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("tag"),
        whole_text().cast("binary").alias("text"),
    )
    chunks = stage(chunked(texts, _encode), "chunks")
    counted, places = dictionary(chunks, least)
    words = counted.select("id", "entry", F.col("count").alias("f"))
    totals = chunks.select(F.explode(F.arrays_zip("entries", "counts")).alias("e")).where("e.counts > 0").select(F.col("e.entries").alias("entry"), "e.counts")
    totals = totals.withColumns(_split()).groupBy("lang").agg(F.sum("counts").alias("n"))
    totals = stage(totals, "totals")
    size = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(shuffle_partitions(spark), -(-size // BUCKET_GRAMS))
    blocks = with_words(chunks, places, _grams(buckets), _BLOCKS)
    dealt = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    grams = stage(dealt.mapInArrow(_flow(least), "first long, second long, third long, f long"), "flow")
    nodes, edges = grams.where("third is null").drop("third"), grams.where("third is not null")
    f_of = lambda c, name: words.select(F.col("id").alias(c), F.col("f").alias(name))
    nodes = nodes.join(f_of("first", "f1"), "first").join(f_of("second", "f2"), "second").withColumn("best", _cut(1, "f1", "f2"))
    nodes = stage(nodes.select("first", "second", "f", "best.*"), "nodes")
    edges = edges.join(nodes.select("first", "second", F.col("f").alias("from_f")), ["first", "second"])
    edges = edges.join(nodes.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("f").alias("to_f")), ["second", "third"])
    edges = edges.join(f_of("first", "f1"), "first").join(f_of("third", "f3"), "third").withColumn("best", F.least(_cut(1, "f1", "to_f"), _cut(2, "from_f", "f3")))
    edges = stage(edges.select("first", "second", "third", "f", "best.*", "from_f", "to_f"), "edges")
    return PhraseGraph(words.withColumns(_split()).drop("entry"), totals, nodes, edges, stage(compacted_paths(edges), "paths"))


def _inside_longer(graph: PhraseGraph, percent: int) -> DataFrame:
    """Nodes inside an edge that has at least `percent` hundredths of their occurrences.

    All nodes of a path are within edges of its weight, so each is looked up once for a path, not once for an edge.
    """
    pairs = F.transform(F.sequence(F.lit(0), F.col("words") - 2), lambda i: F.struct(F.get("path", i).alias("first"), F.get("path", i + 1).alias("second")))
    inside = graph.paths.select(F.explode(pairs).alias("node"), F.col("f").alias("longer_f")).select("node.*", "longer_f")
    most = inside.groupBy("first", "second").agg(F.max("longer_f").alias("longer_f"))
    own = graph.nodes.select("first", "second", "f").join(most, ["first", "second"])
    return own.where(F.col("longer_f") * 100 >= F.col("f") * percent).select("first", "second")


def collocations(docs: DataFrame, least: int = 10, percent: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of two or three words of each language.

    a, l, r are the occurrences of the phrase and of the parts of its lowest-scoring cut, n those of all words.
    Phrases inside a longer candidate with `percent` hundredths of their occurrences are left out. Order: score and a
    descending, then the phrase by bytes. No words give no rows.
    """
    graph = phrase_graph(docs, least)
    pairs = graph.nodes.join(_inside_longer(graph, percent), ["first", "second"], "left_anti").withColumn("third", F.lit(None).cast("long"))
    columns = ["first", "second", "third", "f", "l", "r", "score"]
    every = pairs.select(*columns).unionByName(graph.edges.select(*columns))
    words = graph.words
    for c in ("first", "second", "third"):
        own = words.select(F.col("id").alias(c), F.col("word").alias(f"{c}_word"), *(["lang"] if c == "first" else []))
        every = every.join(own, c, "left")
    every = every.withColumn("phrase", F.concat_ws(" ", "first_word", "second_word", "third_word"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase"))
    first = every.select("lang", "phrase", "f", "l", "r", "score").withColumn("rank", place).where(F.col("rank") <= top)
    return first.join(graph.totals, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
