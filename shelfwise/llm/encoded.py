"""Texts as numbers: chunks with a vocabulary of their own, and the corpus's numbers and counts of its entries.

A task turns its texts into chunks of about CHUNK bytes; a chunk's tokens are places in its vocabulary. What is
counted or looked up over the corpus is then one row per chunk and entry instead of one per token.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import shuffle_partitions, stage

#: Bytes of text of a chunk, each text counting TEXT more; a longer text is a chunk of its own.
CHUNK, TEXT = 8 << 20, 16
#: Rows of entries that a task counts together, about, and tokens of a chunk that are worked on at a time.
TASK_ROWS, PART_TOKENS = 1_000_000, 1 << 19
_DOCUMENTS = pa.list_(pa.struct([("doc_id", pa.int64()), ("counted", pa.bool_())]))
_CHUNK = pa.schema([("chunk", pa.int64()), ("entries", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("n", pa.int32()), ("tokens", pa.binary()), ("documents", _DOCUMENTS)])
CHUNKS = "chunk long, entries array<binary>, counts array<long>, n int, tokens binary, documents array<struct<doc_id:long,counted:boolean>>"


def packed(numbers: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(numbers).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=np.dtype(kind).itemsize * n, codec="zstd", asbytes=True), kind)


def free() -> None:
    """Gives memory that Arrow keeps for later back to the machine: idle workers stay alive beside the next stage's."""
    pa.default_memory_pool().release_unused()


def numbered(data: bytes, first: tuple[bytes, ...]) -> tuple[np.ndarray, pa.Array]:
    """What lies between the spaces of `data` as numbers of a vocabulary that begins with the entries `first`."""
    data = b" ".join([*first, data])
    bounds = pa.py_buffer(np.array([0, len(data)], np.int64))
    whole = pa.Array.from_buffers(pa.large_binary(), 1, [None, bounds, pa.py_buffer(data)])
    coded = pc.split_pattern(whole, b" ").flatten().dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False)[len(first) :], coded.dictionary.cast(pa.binary())


def _chunk_row(number: int, texts: list[tuple], encode: Callable) -> pa.RecordBatch:
    entries, counts, tokens = encode(texts)
    lists = [pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), x) for x in (entries, pa.array(counts, pa.int64()))]
    documents = pa.array([[{"doc_id": t[0], "counted": t[1]} for t in texts]], _DOCUMENTS)
    columns = [pa.array([number], pa.int64()), *lists, pa.array([len(tokens)], pa.int32()), pa.array([packed(tokens.astype(np.int32))], pa.binary()), documents]
    return pa.RecordBatch.from_arrays(columns, schema=_CHUNK)


def chunked(texts: DataFrame, encode: Callable[[list[tuple]], tuple[pa.Array, np.ndarray, np.ndarray]]) -> DataFrame:
    """Chunks of `texts` (doc_id, counted, tag, text as binary); the caller stores them, as their numbers are those of the task.

    `encode` gets (doc_id, counted, tag, text) of a chunk's texts and gives its entries, how often each
    is counted, and its tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "counted", "tag", "text")]
            for i in range(batch.num_rows):
                row = tuple(c[i].as_py() for c in columns)
                if held and size + len(row[3]) + TEXT > CHUNK:
                    yield _chunk_row(number, held, encode)
                    number, held, size = number + 1, [], 0
                    free()
                held.append(row)
                size += len(row[3]) + TEXT
        if held:
            yield _chunk_row(number, held, encode)
            del held
        free()

    return texts.select("doc_id", "counted", "tag", "text").mapInArrow(run, CHUNKS)


_WORDS = "entry binary, id long, count long, chunk long, n int, places binary, ids binary, counts binary"


def _counted(least: int):
    """Counts and numbers of a partition's entries, and for each chunk what its entries have got."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        coded = rows.column("entry").cast(pa.large_binary()).combine_chunks().dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        totals = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(totals, which, rows.column("count").to_numpy())
        known = totals >= least
        ids = np.where(known, (np.int64(TaskContext.get().partitionId()) << 32) + np.cumsum(known) - 1, -1)
        none = lambda n, kind: pa.nulls(n, kind)
        kept = np.flatnonzero(known)
        for at in range(0, len(kept), 50_000):
            part = kept[at : at + 50_000]
            n = len(part)
            columns = [coded.dictionary.take(pa.array(part)).cast(pa.binary()), pa.array(ids[part]), pa.array(totals[part])]
            yield pa.RecordBatch.from_arrays([*columns, none(n, pa.int64()), none(n, pa.int32()), *[none(n, pa.binary())] * 3], names=[c.split()[0] for c in _WORDS.split(", ")])
        use = np.flatnonzero(known[which])
        chunk, place, which = rows.column("chunk").to_numpy()[use], rows.column("place").to_numpy()[use], which[use]
        order = np.lexsort((place, chunk))
        chunk, place, which = chunk[order], place[order], which[order]
        edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)] if len(chunk) else [0]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            row = [int(chunk[a]), b - a, packed(place[a:b]), packed(ids[which[a:b]]), packed(totals[which[a:b]])]
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            columns = [none(1, pa.binary()), none(1, pa.int64()), none(1, pa.int64()), *(pa.array([v], k) for v, k in zip(row, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _WORDS.split(", ")])
        del held, rows, coded, which, chunk, place, order
        free()

    return run


def dictionary(chunks: DataFrame, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """The corpus's words (entry, id, count) of `least` counts or more, and their places in the chunks.

    The entries of all chunks are dealt out by entry, so many to a task that it can hold them; a frequent one has a
    row for each chunk and no more. Both results are one stored table.
    """
    size = chunks.agg(F.sum(F.size("entries"))).first()[0] or 0
    tasks = max(shuffle_partitions(chunks.sparkSession), -(-size // TASK_ROWS))
    rows = chunks.select("chunk", "counts", F.posexplode("entries").alias("place", "entry"))
    rows = rows.select("chunk", "place", "entry", F.get("counts", F.col("place")).alias("count")).repartition(tasks, "entry")
    words = stage(rows.mapInArrow(_counted(least), _WORDS), "words")
    return words.where("chunk is null").select("entry", "id", "count"), words.where("chunk is not null").select("chunk", "n", "places", "ids", "counts")


def with_words(chunks: DataFrame, places: DataFrame, work: Callable, schema: str, context: Callable | None = None) -> DataFrame:
    """What `work(ids, counts, tokens, documents)` gives for each chunk, as record batches.

    `ids` and `counts` are those of the chunk's entries in the corpus, -1 and 0 for entries that the dictionary lacks.
    Places and tokens meet by chunk: the places come first, then the chunk's one row of tokens. `context` is
    called once in a task; what it gives is a further argument.
    """
    spark = chunks.sparkSession
    blank = {"tokens": "binary", "size": "int", "documents": "array<struct<doc_id:long,counted:boolean>>"}
    own = chunks.select("chunk", "n", *[F.lit(None).cast("binary").alias(c) for c in ("places", "ids", "counts")], "tokens", F.size("entries").alias("size"), "documents")
    rows = places.withColumns({k: F.lit(None).cast(v) for k, v in blank.items()}).unionByName(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, at, held = [context()] if context else [], None, []
        for batch in batches:
            numbers, sizes, ns = (batch.column(c).to_pylist() for c in ("chunk", "size", "n"))
            for i, number in enumerate(numbers):
                if number != at:
                    at, held = number, []
                if sizes[i] is None:
                    held.append((*(unpacked(batch.column(c)[i].as_py(), ns[i], k) for c, k in (("places", np.int32), ("ids", np.int64), ("counts", np.int64))),))
                    continue
                ids, counts = np.full(sizes[i], -1, np.int64), np.zeros(sizes[i], np.int64)
                for place, id_, count in held:
                    ids[place], counts[place] = id_, count
                held = []
                yield from work(ids, counts, unpacked(batch.column("tokens")[i].as_py(), ns[i]), batch.column("documents")[i].as_py(), *given)
                free()

    dealt = rows.repartition(shuffle_partitions(spark), "chunk").sortWithinPartitions("chunk", F.col("size").asc_nulls_first())
    return dealt.mapInArrow(run, schema)
