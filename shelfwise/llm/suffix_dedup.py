"""Removal of byte strings that occur earlier, by sorted suffixes compared through prefix hashes.

Every window of LENGTH bytes holds one anchor, its k-mer of least hash, and windows in a row with one anchor make a
segment. Equal segments are found by anchor and a digest of 128 bits. Segments that share an anchor but differ, as at the
ends of a repeated passage, are sorted by what follows the anchor: a mergesort whose comparisons find the common
extension of two suffixes by binary search over prefix polynomial hashes, with the found windows verified byte by byte.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import row_id, ship, shuffle_partitions, stage, whole_text
from shelfwise.llm.shingles import BASE, INVERSE, mixed, powers

#: Length of an anchor; shorter ones give fewer segments and more anchors that agree by chance.
K = 24
#: Bytes of text whose hashes are in memory at a time.
PIECE = 4 << 20
#: Segments of one anchor that a task sorts together; more are dealt out and their windows compared by anchor and digest.
SPLIT = 50_000
#: Suffixes that are sorted at a time, whole anchors each.
SORT_ROWS = 20_000
#: Fields of `at`: byte position (31 bits), anchor's offset (7), windows less one (7).
POS, OFF = 14, 7


def digests(pieces: Iterator[bytes | memoryview]) -> np.ndarray:
    """128-bit digests as rows of two signed numbers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, pieces)), ">i8").astype(np.int64).reshape(-1, 2)


class PrefixHashes:
    """Polynomial hashes of any part of a buffer in constant time, modulo 2 ** 64."""

    def __init__(self, buffer: np.ndarray):
        n = len(buffer)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=self.sums[1:])
        self.inverse = powers(INVERSE, n + 1)

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def all_of(self, size: int) -> np.ndarray:
        return (self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` values in a row, from running minima of blocks in both directions."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _pieces(rids: list[int], rows: list[int], texts: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int, int, int]], bytes]]:
    """Buffers of about PIECE bytes with their texts (rid, row, position of the part in its text, size).

    A longer text comes in parts that overlap by length - 1, so each window is in one of them.
    """
    parts: list[tuple[int, int, int, int]] = []
    held: list[bytes] = []
    size = 0
    for rid, row, text in zip(rids, rows, texts, strict=True):
        for start in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[start : start + PIECE + length - 1]
            if len(part) < length:
                continue
            parts.append((rid, row, start, len(part)))
            held.append(part)
            size += len(part)
            if size >= PIECE:
                yield parts, b"".join(held)
                parts, held, size = [], [], 0
    if parts:
        yield parts, b"".join(held)


def _segments(parts: list[tuple[int, int, int, int]], data: bytes, length: int) -> tuple[np.ndarray, ...]:
    """anchor, segment digest, rid, row, at of all segments of a buffer."""
    buffer = np.frombuffer(data, np.uint8)
    hashes = mixed(PrefixHashes(buffer).all_of(K))
    low = np.uint64((1 << 24) - 1)
    coded = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)  # of equal hashes the first
    anchor_at = (sliding_least(coded, length - K + 1) & low).astype(np.int64)
    sizes = np.array([p[3] for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    own = np.repeat(np.arange(len(parts)), sizes - length + 1)
    windows = np.arange(len(own)) - np.repeat(np.concatenate([[0], np.cumsum(sizes - length + 1)[:-1]]), sizes - length + 1) + starts[own]
    anchors = anchor_at[windows]
    first = np.flatnonzero(np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (own[1:] != own[:-1])]))
    last = np.concatenate([first[1:], [len(own)]]) - 1
    begin, end, anchors, own = windows[first], windows[last], anchors[first], own[first]
    view = memoryview(data)
    segment = digests(view[a:b] for a, b in zip(begin.tolist(), (end + length).tolist(), strict=True))
    at = ((begin - starts[own] + np.array([p[2] for p in parts])[own]) << POS) | ((anchors - begin) << OFF) | (end - begin)
    rids, rows = (np.array([p[i] for p in parts], np.int64)[own] for i in (0, 1))
    return hashes[anchors], segment, rids, rows, at


_SEGMENTS = "key long, segment long, segment2 long, rid long, row long, at long, removed boolean"


def _find_segments(length: int):
    """One row for each different segment of a batch, its earliest; the others, in joined runs, as removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (batch.column(c).to_pylist() for c in ("rid", "row", "text"))
            found = [_segments(parts, data, length) for parts, data in _pieces(*texts, length)]
            if not found:
                continue
            anchor, segment, rid, row, at = (np.concatenate(c) for c in zip(*found, strict=True))
            one, two = segment[:, 0], segment[:, 1]
            order = np.lexsort((at, row, rid, two, one, anchor))
            anchor, one, two, rid, row, at = (c[order] for c in (anchor, one, two, rid, row, at))
            new = lambda *columns: np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])
            own = new(anchor, one, two, rid, row, at)  # else the same place of a repeated row, which repeats nothing
            anchor, one, two, rid, row, at = (c[own] for c in (anchor, one, two, rid, row, at))
            first = new(anchor, one, two)
            begin = at[~first] >> POS
            gone_rid, gone_row, gone_at, gone_end = _runs(rid[~first], row[~first], begin, begin + (at[~first] & 0x7F) + length)
            n, m = int(first.sum()), len(gone_rid)
            columns = [
                # removed runs are dealt by document; they end at `segment`
                (anchor[first].view(np.int64), mixed(gone_rid.astype(np.uint64)).view(np.int64)), (one[first], gone_end), (two[first], np.zeros(m, np.int64)),
                (rid[first], gone_rid), (row[first], gone_row), (at[first], gone_at << POS), (np.zeros(n, bool), np.ones(m, bool)),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=[c.split()[0] for c in _SEGMENTS.split(", ")])

    return run


def _runs(rid: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of bytes joined where they touch: rid, row, start, end."""
    order = np.lexsort((start, row, rid))
    rid, row, start, end = rid[order], row[order], start[order], end[order]
    if not len(rid):
        return rid, row, start, end
    doc = np.concatenate([[True], (rid[1:] != rid[:-1]) | (row[1:] != row[:-1])])
    group = np.cumsum(doc) - 1
    wide = np.int64(1) << np.int64(32)
    reach = np.maximum.accumulate(end + group * wide) - group * wide  # of the same document so far
    new = doc | np.concatenate([[True], start[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:], [len(rid)]]) - 1
    return rid[new], row[new], start[new], reach[last]


class SortedSuffixes:
    """Suffixes that start at the anchors of some contexts, sorted by group and then by content."""

    def __init__(self, contexts: list[bytes], offsets: np.ndarray, groups: np.ndarray):
        self.buffer = np.frombuffer(b"".join(contexts) + b"\0", np.uint8)
        sizes = np.array([len(c) for c in contexts])
        self.start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.suffix, self.end = self.start + offsets, self.start + sizes
        self.hashes, self.groups = PrefixHashes(self.buffer), groups
        self.order = self._sorted()

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes a and b, by binary search on their hashes."""
        s, t = self.suffix[a], self.suffix[b]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.end[a] - s, self.end[b] - t)
        while np.any(low < high):
            middle = (low + high + 1) >> 1
            same = self.hashes.part(s, s + middle) == self.hashes.part(t, t + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a sorts before b; a shorter suffix goes before a longer one that it begins, equal ones by number."""
        out = self.groups[a] < self.groups[b]
        same = np.flatnonzero(self.groups[a] == self.groups[b])
        x, y = a[same], b[same]
        common = self.extension(x, y)
        ends_x, ends_y = self.suffix[x] + common == self.end[x], self.suffix[y] + common == self.end[y]
        byte_x, byte_y = self.buffer[self.suffix[x] + common], self.buffer[self.suffix[y] + common]
        out[same] = np.where(ends_x & ends_y, x < y, np.where(ends_x | ends_y, ends_x, byte_x < byte_y))
        return out

    def _sorted(self) -> np.ndarray:
        """Bottom-up mergesort; all pairs of runs of a level merge at once, each element ranked in the other run."""
        n, order, size = len(self.suffix), np.arange(len(self.suffix)), 1
        while size < n:
            place = np.arange(n)
            run = place // size
            other = run ^ 1
            low = np.minimum(other * size, n)
            high = np.minimum(low + size, n)
            base = low.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                smaller = self.before(order[middle], order[open_])
                low[open_[smaller]] = middle[smaller] + 1
                high[open_[~smaller]] = middle[~smaller]
            target = (run & ~1) * size + (place - run * size) + (low - base)
            merged = np.empty_like(order)
            merged[target] = order
            order, size = merged, size * 2
        return order


def repeated_windows(contexts: list[bytes], offsets: np.ndarray, counts: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context and window start: whether an earlier context of its group has the window; whether it is the first.

    Contexts come in order of group and of place in the corpus. A window that starts l bytes before the anchor is
    fixed by its l bytes on the left and length - l on the right: contexts next to each other in the sorted order
    whose common extension is that long agree on the right, and the hash of the left part does the rest.
    """
    n = len(contexts)
    repeated, firsts = np.zeros((n, length - K + 1), bool), np.zeros((n, length - K + 1), bool)
    if n < 2:
        return repeated, firsts
    sorted_ = SortedSuffixes(contexts, offsets, groups)
    order = sorted_.order
    common = np.concatenate([[0], np.where(groups[order[1:]] == groups[order[:-1]], sorted_.extension(order[:-1], order[1:]), -1)])
    column = np.arange(length)
    for left in range(length - K + 1):
        mine = np.flatnonzero((offsets >= left) & (offsets - left < counts))
        if not len(mine):
            continue
        right = np.empty(n, np.int64)
        right[order] = np.cumsum(common < length - left)
        at = sorted_.suffix[mine] - left
        key = mixed(sorted_.hashes.part(at, sorted_.suffix[mine]) + mixed(right[mine].astype(np.uint64)))
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        again = np.flatnonzero(first[back] != np.arange(len(mine)))
        firsts[mine[first], offsets[mine[first]] - left] = True
        for block in range(0, len(again), 50_000):
            part = again[block : block + 50_000]
            source = first[back[part]]
            good = (sorted_.buffer[at[part][:, None] + column] == sorted_.buffer[at[source][:, None] + column]).all(axis=1)
            repeated[mine[part[good]], offsets[mine[part[good]]] - left] = True
            for i in part[~good].tolist():  # a collision of hashes: compare with all earlier ones
                window = sorted_.buffer[at[i] : at[i] + length]
                hit = any((sorted_.buffer[at[j] : at[j] + length] == window).all() for j in np.flatnonzero((groups[mine] == groups[mine[i]]) & (np.arange(len(mine)) < i)))
                repeated[mine[i], offsets[mine[i]] - left] = hit
                firsts[mine[i], offsets[mine[i]] - left] = not hit
    return repeated, firsts


_FOUND = "rid long, row long, start long, `end` long, key long, hash long, hash2 long"


def _contexts(length: int):
    """The bytes of each edge. Of repeated rows that follow each other, as a join by rid and row leaves them, only the first gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            out = []
            for rid, row, text, edges in zip(*(batch.column(c).to_pylist() for c in ("rid", "row", "text", "edges")), strict=True):
                if (rid, row) == current:
                    continue
                current = (rid, row)
                for edge in edges:
                    at = edge["at"]
                    pos = at >> POS
                    out.append((edge["key"], edge["salt"], rid, row, at, text[pos : pos + (at & 0x7F) + length]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "salt", "rid", "row", "at", "context"])

    return run


def _sort_groups(length: int):
    """Removed runs of the contexts of a partition; rows come sorted by key, salt, rid, row, at. For dealt anchors
    also the windows not seen before, by anchor and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for own in zip(*(batch.column(c).to_pylist() for c in ("key", "salt", "rid", "row", "at", "context")), strict=True):
                if len(held) >= SORT_ROWS and own[:2] != held[-1][:2]:
                    yield from _sort_held(held, length)
                    held = []
                if not held or own[:5] != held[-1][:5]:  # else the same place of a repeated row
                    held.append(own)
        if held:
            yield from _sort_held(held, length)

    return run


def _sort_held(held: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    key, salt, rid, row, at = (np.array([r[i] for r in held], np.int64) for i in range(5))
    groups = np.cumsum([True, *(a[:2] != b[:2] for a, b in zip(held, held[1:], strict=False))])
    contexts = [r[5] for r in held]
    offsets, counts, pos = at >> OFF & 0x7F, (at & 0x7F) + 1, at >> POS
    repeated, firsts = repeated_windows(contexts, offsets, counts, groups, length)
    i, w = np.nonzero(repeated)
    yield _found(*_runs(rid[i], row[i], pos[i] + w, pos[i] + w + length))
    i, w = np.nonzero(firsts & (salt >= 0)[:, None])
    if len(i):
        sizes = np.array([len(c) for c in contexts])
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])[i] + w
        data = b"".join(contexts)
        yield _found(rid[i], row[i], pos[i] + w, pos[i] + w + length, key[i], digests(data[b : b + length] for b in begin.tolist()))


def _found(rid: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray | None = None, digest: np.ndarray | None = None) -> pa.RecordBatch:
    none = pa.nulls(len(rid), pa.int64())
    dealt = [none] * 3 if key is None else [pa.array(c) for c in (key, digest[:, 0], digest[:, 1])]
    return pa.RecordBatch.from_arrays([*map(pa.array, (rid, row, start, end)), *dealt], names=["rid", "row", "start", "end", "key", "hash", "hash2"])


def repeated_spans(texts: DataFrame, length: int = 100) -> DataFrame:
    """rid, row, start, end: runs of bytes that repeat earlier ones, of `texts` (rid, row, text as binary).

    Documents go by rid, then by row, a 64-bit hash of the text, so that rows of equal id and text count as one: equal
    segments of the same rid, row and at are taken once, and so are equal contexts.
    """
    spark = texts.sparkSession
    ship(spark)
    rows = texts.mapInArrow(_find_segments(length), _SEGMENTS)
    by_key = Window.partitionBy("key")
    order = ["removed", "segment", "segment2", "rid", "row", "at"]
    digest = F.struct("segment", "segment2")
    rows = rows.select(
        "*", F.lag(F.struct(*order)).over(by_key.orderBy(*order)).alias("before"),
        *(f(F.when(~F.col("removed"), digest)).over(by_key).alias(n) for f, n in ((F.min, "least"), (F.max, "most"))),
    )
    rows = rows.where(F.col("removed") | F.col("before").isNull() | (F.struct(*order) != F.col("before")))
    again = ~F.col("removed") & (F.col("segment") == F.col("before.segment")) & (F.col("segment2") == F.col("before.segment2"))
    ends = F.when(F.col("removed"), F.col("segment")).when(again, F.shiftright("at", POS) + F.col("at").bitwiseAND(F.lit(0x7F)) + length)
    marked = stage(
        rows.select("key", "rid", "row", "at", ends.alias("end"), (F.col("least") != F.col("most")).alias("edge")).where("end is not null or edge"), "segments"
    )
    edges = marked.where("end is null")
    hot = edges.groupBy("key").count().where(F.col("count") > SPLIT).select("key", F.ceil(F.col("count") / SPLIT).alias("parts"))
    salt = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("rid", "row", "at"), "parts")).otherwise(-1).cast("int")
    dealt = edges.join(hot, "key", "left").select("rid", "row", F.struct("key", salt.alias("salt"), "at").alias("edge"))
    # no longer than the document that they lie in
    own = dealt.groupBy("rid", "row").agg(F.collect_list("edge").alias("edges"))
    contexts = texts.join(own, ["rid", "row"]).select("rid", "row", "text", "edges")
    contexts = contexts.mapInArrow(_contexts(length), "key long, salt int, rid long, row long, at long, context binary")
    n = shuffle_partitions(spark)
    found = stage(
        contexts.repartition(n, "key", "salt").sortWithinPartitions("key", "salt", "rid", "row", "at").mapInArrow(_sort_groups(length), _FOUND), "suffixes"
    )
    same = ["key", "hash", "hash2"]
    windows = found.where("hash is not null")
    earliest = windows.groupBy(*same).agg(F.min(F.struct("rid", "row", "start")).alias("first"))
    later = windows.join(earliest, same).where(F.struct("rid", "row", "start") > F.col("first"))
    columns = ["rid", "row", "start", "end"]
    plain = marked.where("end is not null").withColumn("start", F.shiftright("at", POS))
    return plain.select(*columns).unionByName(found.where("hash is null").select(*columns)).unionByName(later.select(*columns))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            runs: list[list[int]] = []
            for s in sorted((s["start"], s["end"]) for s in spans or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            digest, last = hashlib.sha256(), 0
            for a, b in runs:
                digest.update(text[last:a])
                last = b
            digest.update(text[last:])
            out.append((len(text), sum(b - a for a, b in runs), len(runs), digest.hexdigest(), [{"start": a, "end": b} for a, b in runs]))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span)
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", *names])


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256 and removed, its maximal removed runs (start, end).

    A byte goes if a `length`-byte string over it also starts earlier, in a document of smaller id or earlier in
    the same one. A null text counts as empty; rows without an id come before all others; rows of equal id are
    ordered by a hash of their text, and those of equal text too are one document with one result.
    """
    text = whole_text()
    texts = docs.select("doc_id", row_id().alias("rid"), F.xxhash64(text).alias("row"), text.cast("binary").alias("text"))
    spans = repeated_spans(texts.select("rid", "row", "text"), length)
    own = spans.groupBy("rid", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,`end`:long>>"
    return texts.join(own, ["rid", "row"], "left").select("doc_id", "text", "spans").mapInArrow(_kept, schema)
