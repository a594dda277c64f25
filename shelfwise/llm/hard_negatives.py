"""Hard negatives by a vertical scan of columnar blocks, after the branch-and-bound on decomposed vectors.

Each task holds one block of vectors, an array per dimension. For an anchor the dimensions are read in descending
magnitude of its own components; after some of them, the least and largest that the unread ones can still add bound
every candidate's score, and candidates that can no longer be an answer leave the bitmap. What is left when all
dimensions are read has exact scores.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import ship, shuffle_partitions, stage

#: Components of the vectors of one block, at most about.
BLOCK_CELLS = 4_000_000
#: Dimensions that are read between two looks at the bounds.
STEP = 8
#: Quantised components stay below this, so that inner products of up to 32,768 dimensions fit in 63 bits.
MOST = 1 << 24
#: Kinds of rows that a task reads: a block's vectors, then the anchors that ask it.
ROW, ANCHOR = 0, 1


class ColumnBlock:
    """Vectors as columns, in order of id, with the least and largest component of each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.low = self.columns.min(axis=1, initial=0) if len(ids) else np.zeros(len(self.columns), np.int64)
        self.high = self.columns.max(axis=1, initial=0) if len(ids) else np.zeros(len(self.columns), np.int64)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, needed: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the candidates that `needed`, given lower and upper bounds of the scores, leaves."""
        anchor = np.pad(anchor, (0, max(0, len(self.columns) - len(anchor))))
        own = anchor[: len(self.columns)]
        order = np.argsort(-np.abs(own), kind="stable")
        least, most = np.minimum(own * self.low, own * self.high)[order], np.maximum(own * self.low, own * self.high)[order]
        # what the dimensions from a place in the order on can add
        rest_low, rest_high = (np.concatenate([np.cumsum(x[::-1])[::-1], [0]]) for x in (least, most))
        scores = np.zeros(len(alive), np.int64)
        for place in range(0, len(order), STEP):
            if not len(alive):
                break
            for d in order[place : place + STEP].tolist():
                column = self.columns[d]
                scores += (column if len(alive) == len(column) else column[alive]) * own[d]
            read = min(place + STEP, len(order))
            left = needed(scores + rest_low[read], scores + rest_high[read])
            if not left.all():
                alive, scores = alive[left], scores[left]
        return alive, scores

    def _first(self, alive: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best: higher scores first, then smaller ids."""
        first = np.lexsort((self.ids[alive], -scores))[:k]
        return self.ids[alive[first]], scores[first]

    def best(self, anchor_id: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows of the anchor's label, itself left out."""
        alive = np.flatnonzero((self.labels == label) & (self.ids != anchor_id))
        return self._first(*self.scan(anchor, alive, lambda low, high: high >= _kth(low, k)), k)

    def in_windows(self, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores (both ends within) the k best rows of other labels."""

        def needed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            out = np.zeros(len(low), bool)
            for bottom, top in windows:
                open_ = (high >= bottom) & (low <= top)
                sure = low[(low >= bottom) & (high <= top)]
                out |= open_ & (high >= _kth(sure, k)) if len(sure) >= k else open_
            return out

        alive, scores = self.scan(anchor, np.flatnonzero(self.labels != label), needed)
        inside = [(scores >= bottom) & (scores <= top) for bottom, top in windows]
        return [self._first(alive[x], scores[x], k) for x in inside]


def _kth(values: np.ndarray, k: int) -> int:
    """The k-th largest value; with fewer values, less than any score."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else np.iinfo(np.int64).min


def _vectors(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of `dims` components, shorter ones filled with zeros."""
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(column.offsets.to_numpy())
    if np.all(lengths == dims):
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


_ANSWERS = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def _answers(dims: int, k: int):
    """Answers of each block to its anchors; rows come sorted by block, a block's vectors before its anchors.

    An anchor without windows asks for its k best rows of its label, one with windows for rows of others inside them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for batch in batches:
            found: list[tuple] = []
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(blocks)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                vectors = _vectors(part.column("vector"), dims)
                if blocks[a] != at:
                    at, held, block = blocks[a], [], None
                if kinds[a] == ROW:
                    held.append((ids, labels, vectors))
                    continue
                if block is None and held:
                    block = ColumnBlock(*(np.concatenate(c) for c in zip(*held, strict=True)))
                    held = []
                if block is None:  # no vectors here
                    continue
                for i, windows in enumerate(part.column("windows").to_pylist()):
                    if windows is None:
                        ids_, scores = block.best(ids[i], labels[i], vectors[i], k)
                        found += [(ids[i], None, None, x, s) for x, s in zip(ids_.tolist(), scores.tolist(), strict=True)]
                        continue
                    answers = block.in_windows(labels[i], vectors[i], [(w["bottom"], w["score"]) for w in windows], k)
                    for w, (ids_, scores) in zip(windows, answers, strict=True):
                        found += [(ids[i], w["id"], w["score"], x, s) for x, s in zip(ids_.tolist(), scores.tolist(), strict=True)]
            if found:
                names = [c.split()[0] for c in _ANSWERS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

    return run


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, vector: floor(scale * x) of each component, as ints.

    Left out are rows without id, label or vector, and those with a component that is null, not finite or whose
    quantised value is 2 ** 24 or more in magnitude, for which exact scores would not fit in 63 bits. Rows that
    share an id count as one, that of least label and vector.
    """
    fits = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) * scale < float(MOST)))
    own = vectors.where("vec_id is not null and label is not null and embedding is not null").where(fits)
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    rows = own.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("long").alias("label"), vector.alias("vector")).alias("own"))
    return rows.groupBy("vec_id").agg(F.min("own").alias("own")).select("vec_id", "own.*")


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of each key with their rank."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, share: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows (vec_id, label, vector) where `anchors`.

    Scores are inner products; higher ones come first, equal ones by smaller vec_id. An anchor's positives are its
    first rows of its label, a positive's negatives the first of the rows of other labels whose score is not above
    the positive's and at least `share` hundredths of it. Fewer are given where there are fewer; a positive score
    below zero has none. Vectors of other lengths count as filled with zeros.

    Rows lie in blocks of bounded size, whatever their labels, and each anchor visits every block: the anchors
    travel, the rows are shuffled once for the positives and once for the negatives. Each block gives at most
    k rows for an anchor and window.
    """
    spark = rows.sparkSession
    ship(spark)
    rows = stage(rows, "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dims")).first()
    dims = max(1, size["dims"] or 0)
    blocks = max(1, shuffle_partitions(spark), -(-size["n"] * dims // BLOCK_CELLS))
    window = "array<struct<id:long,score:long,bottom:long>>"
    asking = rows.where(anchors)

    def answers(requests: DataFrame, k: int) -> DataFrame:
        visits = requests.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(ANCHOR))
        home = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
        given = rows.withColumns({"windows": F.lit(None).cast(window), "block": home, "kind": F.lit(ROW)})
        both = given.unionByName(visits.select(*given.columns)).repartition(blocks, "block").sortWithinPartitions("block", "kind")
        return both.select("block", "kind", "vec_id", "label", "vector", "windows").mapInArrow(_answers(dims, k), _ANSWERS)

    near = stage(_best(answers(asking.withColumn("windows", F.lit(None).cast(window)), positives), ["anchor_id"], positives), "positives")
    # ceil(score * share / 100) of scores that are not negative
    bottom = F.expr(f"(score * {share} + 99) div 100")
    own = near.select(F.col("anchor_id").alias("vec_id"), F.struct(F.col("vec_id").alias("id"), "score", bottom.alias("bottom")).alias("window"))
    windows = own.where("window.score >= 0").groupBy("vec_id").agg(F.array_sort(F.collect_list("window")).alias("windows"))
    far = _best(answers(asking.join(windows, "vec_id"), negatives), ["anchor_id", "positive_id"], negatives)
    return far.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(embeddings: DataFrame, every: int = 100, noisy: int = 7, classes: int = 10, **limits: int) -> DataFrame:
    """Hard negatives for the rows whose vec_id is divisible by `every`, against all rows.

    Where vec_id is divisible by `noisy`, the label first becomes (label + 1) % `classes`.
    """
    label = F.when(F.col("vec_id") % noisy == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    rows = quantised(embeddings.select("vec_id", label.alias("label"), "embedding"))
    return mine(rows, F.col("vec_id") % every == 0, **limits)
