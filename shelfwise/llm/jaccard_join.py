"""Exact n-gram Jaccard join with set-relation skipping.

Sets that are equal are one class. Classes that share enough tokens of their prefixes, rarest tokens first, meet in
a candidate cluster; each cluster is joined in tasks of bounded size, where index lists are skipped by block and
a set takes over the answers of the set it is most alike.
"""

from collections.abc import Iterator
from dataclasses import dataclass, replace
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import row_id, ship, shuffle_partitions, stage, whole_text
from shelfwise.llm.components import components
from shelfwise.llm.shingles import Shingler, mixed, set_digest

#: Shingles and words are counted in so many slots, a fixed 5 MB, to take rare ones first; any order gives right results.
SLOT_BITS, WORD_BITS, SLOTS_PER_ROW = 20, 18, 4096
#: Shingles that are frequent among prefixes are marked in so many bits, a fixed 4 MB.
FREQUENT_BITS = 25
#: Logarithms of counts are taken in so many steps for each factor of two: whole numbers, so that all tasks order alike.
LOG_STEPS = 64
#: Sets, and shingles in them, that one task joins with each other; at most about twice so many.
BLOCK_SETS, BLOCK_SHINGLES = 2048, 1_000_000
#: Prefixes are so much longer than needed to share one token that linked sets share this many, or all they must.
SHARED = 3
#: Sets of one prefix token whose pairs are counted; more are tied to one of them, to meet in one cluster.
PAIRED = 16
#: Entries of an index list that are skipped or looked at together.
LIST_BLOCK = 64


def _least_overlap(a: int, b: int, num: int, den: int) -> int:
    """Least intersection of sets of sizes a, b with Jaccard at least num / den."""
    return -(-(a + b) * num // (num + den))


def _prefix(n: int, num: int, den: int) -> int:
    """So many first tokens of a set of n meet those of every linked set."""
    return n - -(-n * num // den) + 1


def _slots() -> int:
    """Slots of shingles and, behind them, of words."""
    return (1 << SLOT_BITS) + (1 << WORD_BITS)


def _slot_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _slot_counts(width: int):
    """For each task, how often its documents' shingles and words fall in each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(width), np.zeros(_slots(), np.int64)
        for batch in batches:
            found = [(_slot_of(own, SLOT_BITS), _slot_of(words, WORD_BITS) + (1 << SLOT_BITS)) for own, words, _ in shingler.with_words(batch.column("text").to_pylist())]
            if found:
                counts += np.bincount(np.concatenate([s for both in found for s in both]), minlength=_slots())
        if counts.any():
            rows = counts.reshape(-1, SLOTS_PER_ROW)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(rows)), pa.int32()), pa.array([r.astype("<i8").tobytes() for r in rows], pa.binary())], names=["part", "counts"]
            )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            own = np.frombuffer(counts, "<i8")
            sums[part] = sums[part] + own if part in sums else own
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.astype("<i8").tobytes() for v in sums.values()], pa.binary())], names=["part", "counts"]
        )


def slot_counts(texts: DataFrame, width: int) -> np.ndarray:
    """Counts of all documents' shingles by slot, then of their words: 10 MB at the driver, whatever the corpus."""
    schema = "part int, counts binary"
    parts = _slots() // SLOTS_PER_ROW
    rows = texts.select("text").mapInArrow(_slot_counts(width), schema)
    rows = rows.repartition(min(parts, shuffle_partitions(texts.sparkSession)), "part").mapInArrow(_summed, schema)
    out = np.zeros((parts, SLOTS_PER_ROW), np.int64)
    for row in rows.collect():
        out[row["part"]] = np.frombuffer(row["counts"], "<i8")
    return out.ravel()


@dataclass(frozen=True)
class Rarity:
    """What orders shingles by an estimate of how often they occur, the same in all tasks.

    A slot's count is the most that a shingle of it can occur; what the count has beyond that of usual slots and their
    scatter, the least that one of them does. In a large corpus all slots are full and these are far apart; between them
    goes how often the shingle's words would stand together by chance, from counts of words, of which a corpus has far
    fewer than shingles. Where that is wrong, a shingle of many sets comes among the first: those that are found there
    are marked in `frequent`, 64 to a number, and come last.
    """

    most: np.ndarray
    least: np.ndarray
    words: np.ndarray
    all_words: int
    frequent: np.ndarray | None = None

    @staticmethod
    def of_counts(counts: np.ndarray) -> "Rarity":
        shingles, words = counts[: 1 << SLOT_BITS].astype(float), counts[1 << SLOT_BITS :]
        usual = float(np.median(shingles))
        beyond = shingles - usual - 3 * usual**0.5
        return Rarity(_log_steps(shingles), np.where(beyond > 0, _log_steps(beyond), np.iinfo(np.int16).min).astype(np.int16), _log_steps(words), int(_log_steps(words.sum())))

    def of(self, own: np.ndarray, words: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
        """The estimates, in steps of a logarithm, of a text's shingles; `first` is the place of each one's first word."""
        width = min(width, len(words))
        sums = np.concatenate([[0], np.cumsum(self.words[_slot_of(words, WORD_BITS)], dtype=np.int64)])
        slots = _slot_of(own, SLOT_BITS)
        chance = sums[first + width] - sums[first] - (width - 1) * self.all_words
        found = np.minimum(np.maximum(chance, self.least[slots]), self.most[slots])
        return found if self.frequent is None else found + (_marked(self.frequent, own) << 32)


def _marked(frequent: np.ndarray, own: np.ndarray) -> np.ndarray:
    """1 for shingles whose bit is set, 0 for the others."""
    bits = _slot_of(own, FREQUENT_BITS)
    return (frequent[bits >> 6] >> (bits & 63)) & 1


def _log_steps(counts: np.ndarray) -> np.ndarray:
    return np.round(LOG_STEPS * np.log2(np.maximum(counts, 1.0))).astype(np.int16)


def _first_shingles(shingler: Shingler, rarity: Rarity, texts: list[bytes], num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text the set and its prefix."""
    for own, words, first in shingler.with_words(texts):
        if len(own):
            # stable sort: ties stay in the order of the hashes
            rare = np.argsort(rarity.of(own, words, first, shingler.width), kind="stable")
            yield own, own[rare[: _prefix(len(own), num, den) + SHARED - 1]].view(np.int64)
        else:
            yield own, own.view(np.int64)


def _prefix_counts(width: int, num: int, den: int, shared):
    """For each batch, how many of its texts have a shingle in their prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            prefixes = [prefix for _, prefix in _first_shingles(shingler, shared.value, batch.column("text").to_pylist(), num, den)]
            if prefixes:
                tokens, n = np.unique(np.concatenate(prefixes), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(n)], names=["token", "n"])

    return run


def frequent_shingles(texts: DataFrame, width: int, num: int, den: int, shared) -> np.ndarray:
    """A bit for every shingle that stands in the prefixes of more than PAIRED texts: 4 MB at the driver, whatever the corpus."""
    counts = texts.select("text").mapInArrow(_prefix_counts(width, num, den, shared), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    place = F.shiftrightunsigned("token", 64 - FREQUENT_BITS).cast("int")
    bits = counts.where(F.col("n") > PAIRED).select(place.alias("place")).selectExpr("place >> 6 AS place", "shiftleft(1L, place & 63) AS bit")
    marks = bits.groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FREQUENT_BITS - 6), np.int64)
    out[marks["place"].to_numpy()] = marks["bits"].to_numpy()
    return out


def _describe(width: int, num: int, den: int, shared):
    """Per document: size and digest of its set and the set's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sizes, digests, prefixes = [], [], []
            for own, prefix in _first_shingles(shingler, shared.value, batch.column("text").to_pylist(), num, den):
                sizes.append(len(own))
                digests.append(set_digest(own) if len(own) else 0)
                prefixes.append(prefix)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rid"), batch.column("row"), pa.array(sizes, pa.int64()), pa.array(digests, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "rid", "row", "n", "sid", "prefix"],
            )

    return run


def _local_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, sid, n, many) of the prefixes of a batch. Of a token of more than PAIRED sets only one row leaves,
    marked; its other sets are tied to that one, under keys of their own, two rows of which are marked.

    So a token of a third of all sets leaves a task in one row and not in one for each set.
    """
    for batch in batches:
        lists = batch.column("prefix")
        tokens = lists.flatten().to_numpy(zero_copy_only=False)
        counts = np.diff(lists.offsets.to_numpy())
        sids, sizes = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), counts) for c in ("sid", "n"))
        order = np.lexsort((sids, tokens))
        tokens, sids, sizes = tokens[order], sids[order], sizes[order]
        if not len(tokens):
            continue
        first = np.concatenate([[True], tokens[1:] != tokens[:-1]])
        group = np.cumsum(first) - 1
        many = np.bincount(group)[group] > PAIRED
        tied = many & ~first
        heads = sids[first][group]
        ties = np.unique(np.stack([heads[tied], sids[tied]], 1), axis=0)
        keys = mixed(ties[:, 0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ ties[:, 1].astype(np.uint64)).view(np.int64)
        n = len(ties)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([tokens[~tied], keys, keys])),
                pa.array(np.concatenate([sids[~tied], ties[:, 0], ties[:, 1]])),
                pa.array(np.concatenate([sizes[~tied], np.zeros(2 * n, np.int64)])),
                pa.array(np.concatenate([many[~tied], np.ones(2 * n, bool)])),
            ],
            names=["token", "sid", "n", "many"],
        )


def _pairs(num: int, den: int):
    """Candidate pairs (a, b, shared, need) of rows sorted by token, sid.

    Sets of a token are paired if their sizes allow a link; with more than PAIRED or a marked row among them, each
    is tied to the first, and no more than PAIRED rows are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, held, tied_to = None, [], None
        out: list[tuple[int, int, int, int]] = []

        def close() -> None:
            for j, (b, m, _) in enumerate(held):
                for a, n, _ in held[:j]:
                    if a != b and n * den >= m * num and m * den >= n * num:
                        out.append((a, b, 1, min(SHARED, _least_overlap(n, m, num, den))))

        for batch in batches:
            tokens = batch.column("token").to_numpy(zero_copy_only=False)
            # rows of a token alone in the batch's middle need no look
            same = np.concatenate([[True], tokens[1:] == tokens[:-1]])
            keep = np.flatnonzero(same | np.concatenate([same[1:], [True]]))
            part = batch.take(pa.array(keep))
            rows = zip(*(part.column(c).to_pylist() for c in ("token", "sid", "n", "many")), strict=True)
            for key, sid, n, many in rows:
                if key != token:
                    close()
                    token, held, tied_to = key, [], None
                if tied_to is not None:
                    if sid != tied_to:
                        out.append((tied_to, sid, SHARED, 0))
                    continue
                held.append((sid, n, many))
                if len(held) > PAIRED or many:
                    tied_to = held[0][0]
                    out.extend((tied_to, b, SHARED, 0) for b, _, _ in held if b != tied_to)
                    held = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b", "shared", "need"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b", "shared", "need"])

    return run


class SkipJoin:
    """Joins sets in memory until every pair is compared, ruled out, or known to be connected already."""

    def __init__(self, sids: list[int], sets: list[np.ndarray], num: int, den: int):
        self.num, self.den = num, den
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sids[i]))
        self.sids, sets = [sids[i] for i in order], [sets[i] for i in order]
        self.sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(count), np.int64)
        rank[np.argsort(count, kind="stable")] = np.arange(len(count))
        self.n_tokens, self.starts = len(count), np.concatenate([[0], np.cumsum(self.sizes)])
        self.flat = rank[code]
        for i in range(len(sets)):
            self.flat[self.starts[i] : self.starts[i + 1]].sort()  # rarest first
        self.root = np.arange(len(sets))

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def _candidates(self, i: int, lists: dict, prefix: np.ndarray) -> np.ndarray:
        """Earlier sets that share a prefix token at places that leave enough tokens, most shared tokens first."""
        n, found = self.sizes[i], []
        for place, token in enumerate(prefix.tolist()):
            for ids, places, largest, least_place in lists.get(token, ()):
                # the block's largest set is too small, or even its first place leaves too few tokens for any set
                if largest * self.den < n * self.num:
                    continue
                small = self.sizes[ids[0]]
                rest = min(n - place, largest - least_place)
                if rest < _least_overlap(int(n), int(max(small, -(-n * self.num // self.den))), self.num, self.den):
                    continue
                own, at = np.array(ids), np.array(places)
                sizes = self.sizes[own]
                need = -(-(n + sizes) * self.num // (self.num + self.den))
                found.append(own[(sizes * self.den >= n * self.num) & (np.minimum(n - place, sizes - at) >= need)])
        if not found:
            return np.zeros(0, np.int64)
        ids, shared = np.unique(np.concatenate(found), return_counts=True)
        return ids[np.argsort(-shared, kind="stable")]

    def links(self) -> list[tuple[int, int]]:
        """Links that connect all sets that links connect, each verified on the whole sets."""
        lists: dict[int, list] = {}
        marks, out = np.zeros(self.n_tokens, bool), []
        for i in range(len(self.sids)):
            own = self.flat[self.starts[i] : self.starts[i + 1]]
            n = len(own)
            prefix = own[: _prefix(n, self.num, self.den)]
            left = self._candidates(i, lists, prefix)
            marks[own] = True
            step = 1
            while len(left):
                # first the most alike set alone: once linked, the sets it is connected with need no look
                block, left = left[:step], left[step:]
                step = 64
                pieces = [self.flat[self.starts[j] : self.starts[j + 1]] for j in block]
                at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]])
                overlap = np.add.reduceat(marks[np.concatenate(pieces)].astype(np.int64), at)
                sizes = self.sizes[block]
                for j in block[overlap * (self.num + self.den) >= (n + sizes) * self.num].tolist():
                    a, b = self._find(i), self._find(j)
                    if a != b:
                        self.root[max(a, b)] = min(a, b)
                        out.append((self.sids[i], self.sids[j]))
                if len(left):
                    mine = self._find(i)
                    left = left[np.array([self._find(j) != mine for j in left.tolist()])]
            marks[own] = False
            for place, token in enumerate(prefix.tolist()):
                blocks = lists.setdefault(token, [])
                if not blocks or len(blocks[-1][0]) >= LIST_BLOCK:
                    blocks.append([[], [], 0, n])
                last = blocks[-1]
                last[0].append(i)
                last[1].append(place)
                last[2], last[3] = n, min(last[3], place)
        return out


def _join_tasks(num: int, den: int):
    """Links within each (cluster, task) of the partition; rows come sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sids, sets = None, [], []

        def done() -> list[tuple[int, int]]:
            return SkipJoin(sids, sets, num, den).links() if len(sids) > 1 else []

        for batch in batches:
            found: list[tuple[int, int]] = []
            keys = zip(batch.column("cluster").to_pylist(), batch.column("task").to_pylist(), strict=True)
            for key, sid, tokens in zip(keys, batch.column("sid").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                if key != current:
                    found += done()
                    current, sids, sets = key, [], []
                if not sids or sids[-1] != sid:
                    sids.append(sid)
                    sets.append(np.frombuffer(tokens, np.uint64))
            if found:
                yield _links(found)
        if found := done():
            yield _links(found)

    return run


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])


def _tokens(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            tokens = pa.array([s.tobytes() for s in shingler.of_texts(batch.column("text").to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cluster", "task", "sid")), tokens], names=["cluster", "task", "sid", "tokens"])

    return run


def _verified(texts: DataFrame, dealt: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Links among the classes of each (cluster, task) of `dealt` (cluster, task, sid, rid, row).

    A class's set is that of its row by rid and hash of the text, as rows of one id may differ in text.

    The texts are shuffled at every size of `dealt`: a plan that broadcasts it while it is small does not show what
    the join will need.
    """
    homes = dealt.groupBy("rid", "row", "sid", "cluster").agg(F.collect_list("task").alias("tasks"))
    schema = "cluster long, task array<long>, sid long, tokens binary"
    sets = (
        texts.select("rid", "row", "text").join(homes.hint("merge"), ["rid", "row"]).select("cluster", F.col("tasks").alias("task"), "sid", "text")
        .mapInArrow(_tokens(width), schema)
    )
    rows = sets.withColumn("task", F.explode("task"))
    n = shuffle_partitions(texts.sparkSession)
    return rows.repartition(n, "cluster", "task").sortWithinPartitions("cluster", "task", "sid").mapInArrow(_join_tasks(num, den), "a long, b long")


def jaccard_classes(docs: DataFrame, width: int, threshold: str) -> DataFrame:
    """doc_id, rid, row (a hash of the text), n_shingles and component (the same for all that links connect; null for empty sets).

    `threshold` is a decimal or fraction as text. Rows of equal sets are one class; classes link when their sets'
    Jaccard similarity reaches it, exactly: prefixes and clusters only rule out pairs that can't.

    Null and empty texts have empty sets, which link with nothing; repeated rows are of one class. A cluster of
    more than BLOCK_SETS classes, or BLOCK_SHINGLES in them, is dealt in blocks, first each with the first, then those classes that this
    leaves outside the cluster's largest component with every block.
    """
    spark = docs.sparkSession
    ship(spark)
    part = Fraction(threshold)
    num, den = part.numerator, part.denominator
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id().alias("rid"), F.xxhash64(whole_text()).alias("row"), whole_text().cast("binary").alias("text"))
    rarity = Rarity.of_counts(slot_counts(texts, width))
    frequent = frequent_shingles(texts, width, num, den, spark.sparkContext.broadcast(rarity))
    shared = spark.sparkContext.broadcast(replace(rarity, frequent=frequent))
    described = stage(texts.mapInArrow(_describe(width, num, den, shared), "doc_id long, rid long, row long, n long, sid long, prefix array<long>"), "sets")
    full = described.where("n > 0")
    # a class's prefix does not depend on the row that gives it
    classes = full.groupBy("sid").agg(F.min(F.struct("rid", "row")).alias("home"), F.first("n").alias("n"), F.min_by("prefix", F.struct("rid", "row")).alias("prefix"))
    classes = stage(classes.select("sid", "home.*", "n", "prefix"), "classes")
    lists = classes.select("sid", "n", "prefix").mapInArrow(_local_lists, "token long, sid long, n long, many boolean")
    lists = lists.repartition(shuffle_partitions(spark), "token").sortWithinPartitions("token", "sid")
    pairs = lists.mapInArrow(_pairs(num, den), "a long, b long, shared long, need long")
    ties = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need")).where("shared >= need").select("a", "b")
    clusters = components(ties).withColumnRenamed("root", "cluster").join(classes.select(F.col("sid").alias("node"), "rid", "row", "n"), "node")
    dealt = stage(_dealt(clusters.select(F.col("node").alias("sid"), "rid", "row", "n", "cluster")), "dealt")
    first = dealt.select("cluster", F.col("block").alias("task"), "sid", "rid", "row")
    hubs = dealt.where("block = 0 and blocks > 1").select("cluster", F.explode(F.expr("sequence(1, blocks - 1)")).alias("task"), "sid", "rid", "row")
    links = stage(_verified(texts, first.unionByName(hubs), width, num, den), "verified")
    if dealt.where("blocks > 1").limit(1).count():
        links = links.unionByName(stage(_verified(texts, _unresolved(dealt, links), width, num, den), "verified"))
    # stored, so that both sides of the join are plain shuffles, whose hot classes AQE can split
    roots = stage(components(links).select(F.col("node").alias("sid"), "root"), "roots")
    return described.join(roots, "sid", "left").select("doc_id", "rid", "row", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("root", "sid")).alias("component"))


def _blocks() -> Column:
    return F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("long")


def _dealt(clusters: DataFrame) -> DataFrame:
    """Each class of a cluster in one of its blocks, by a hash of the class."""
    sizes = clusters.groupBy("cluster").agg(_blocks().alias("blocks"))
    return clusters.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("sid"), "blocks"))


def _unresolved(dealt: DataFrame, links: DataFrame) -> DataFrame:
    """For clusters of several blocks: the classes outside the largest component, in blocks, each with every block."""
    many = dealt.where("blocks > 1")
    own = many.join(components(links).select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    largest = own.groupBy("cluster", "root").count().groupBy("cluster").agg(F.max_by("root", "count").alias("largest"))
    left = own.join(largest, "cluster").where("root != largest")
    parts = left.groupBy("cluster").agg(_blocks().alias("parts"))
    left = left.join(parts, "cluster").withColumn("part", F.pmod(F.xxhash64(F.lit(1), "sid"), "parts"))
    ours = left.select("cluster", F.explode(F.expr("sequence(part * blocks, part * blocks + blocks - 1)")).alias("task"), "sid", "rid", "row")
    theirs = many.join(parts, "cluster").select("cluster", F.explode(F.expr("transform(sequence(0, parts - 1), p -> p * blocks + block)")).alias("task"), "sid", "rid", "row")
    return ours.unionByName(theirs).distinct()


def jaccard_components(docs: DataFrame, width: int = 3, threshold: str = "0.9") -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest doc_id that links reach from it."""
    found = stage(jaccard_classes(docs, width, threshold), "components")
    least = stage(found.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least")), "least")
    return found.join(least, "component", "left").select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
