"""Quality classifier: a generalised additive model with pairwise interactions over features of the text.

Cyclic boosting adds shallow trees, one feature or pair at a time, to lookup tables over bins; a score is the sum of
one table entry per feature and pair.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import row_id, ship, stage, whole_text

FEATURES = (
    "log_bytes", "log_words", "word_length", "letters", "upper", "digits", "symbols", "exclaims", "points", "spaces", "lines",
    "byte_entropy", "distinct_words", "top_word", "same_as_before", "clean_words", "all_caps_words", "distinct_pairs", "log_line",
)
#: Labelled rows that are learned from, at most: those of least hash of their id.
MAX_TRAINING_ROWS = 50_000
MAIN_BINS, PAIR_BINS = 64, 12
MAIN_ROUNDS, PAIR_ROUNDS, PAIRS = 200, 60, 8
RATE, LEAVES, L2 = 0.08, 4, 1.0

_CLASSES = np.zeros((7, 256))
for _row, _bytes in enumerate((
    [*range(65, 91), *range(97, 123), *range(128, 256)], range(65, 91), range(48, 58), b"#$%&*@^~|<>=+_\\/{}[]`", b"!?", b".,;:", b" \t\r\f\v",
)):
    _CLASSES[_row, list(_bytes)] = 1


def text_features(text: bytes) -> list[float]:
    """The features of one text; an empty one has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters, upper, digits, symbols, exclaims, points, spaces = (_CLASSES @ counts / n).tolist()
    share = counts[counts > 0] / n
    words = text.split()
    w = max(1, len(words))
    kinds = Counter(words)
    pairs = list(zip(words, words[1:], strict=False))
    lines = int(counts[10])
    return [
        math.log1p(n), math.log1p(len(words)), sum(map(len, words)) / w, letters, upper, digits, symbols, exclaims, points, spaces, lines / n,
        float(-(share * np.log2(share)).sum()), len(kinds) / w, max(kinds.values(), default=0) / w, sum(a == b for a, b in pairs) / w,
        sum(map(bytes.isalpha, kinds)) / max(1, len(kinds)), sum(map(bytes.isupper, kinds)) / max(1, len(kinds)),
        len(set(pairs)) / max(1, len(pairs)), math.log1p(n / (lines + 1)),
    ]


@dataclass
class GamModel:
    """Bin edges, one table per feature, one per pair, and the intercept."""

    edges: list[np.ndarray]
    pair_edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features, by bin additions."""
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.pair_edges[i], x[:, i], "right"), np.searchsorted(self.pair_edges[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values of a tree of so many leaves over ordered bins with gradients g and curvatures h."""
    gain = lambda a, b: a * a / (b + L2)
    parts = [(0, len(g))]
    for _ in range(leaves - 1):
        best = (1e-12, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            won = gain(cg[:-1], ch[:-1]) + gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - gain(cg[-1], ch[-1])
            at = int(won.argmax())
            if won[at] > best[0]:
                best = (won[at], k, a + at + 1)
        if best[1] is None:
            break
        a, b = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + L2)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree of one cut on each side of a pair's table (four leaves) and what it gains."""
    gain = lambda a, b: a * a / (b + L2)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return np.zeros(g.shape), 0.0
    G, H = cg[-1, -1], ch[-1, -1]
    corner = lambda c, t: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], t - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
    won = sum(gain(a, b) for a, b in zip(corner(cg, G), corner(ch, H), strict=True)) - gain(G, H)
    i, j = np.unravel_index(int(won.argmax()), won.shape)
    out = np.zeros(g.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + L2)
    return out, float(won[i, j])


def fit_gam(x: np.ndarray, y: np.ndarray) -> GamModel:
    """Learns the tables. With one class or no rows the score is the smoothed share of label 1."""
    m = x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    edges = [_edges(x[:, j], MAIN_BINS) if len(x) else np.zeros(0) for j in range(m)]
    pair_edges = [_edges(x[:, j], PAIR_BINS) if len(x) else np.zeros(0) for j in range(m)]
    model = GamModel(edges, pair_edges, math.log(share / (1 - share)), [np.zeros(len(e) + 1) for e in edges])
    if len(y) == 0 or y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(MAIN_ROUNDS):
        for j in range(m):
            g, h = slopes()
            size = len(model.tables[j])
            step = RATE * _shallow_tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size), LEAVES)
            model.tables[j] += step
            total += step[bins[j]]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(pair_edges)]
    shape = lambda i, j: (len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        rows, cols = shape(i, j)
        return np.bincount(coarse[i] * cols + coarse[j], values, rows * cols).reshape(rows, cols)

    g, h = slopes()
    gains = {(i, j): _pair_tree(grid(i, j, g), grid(i, j, h))[1] for i in range(m) for j in range(i + 1, m)}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    model.pair_tables = [np.zeros(shape(i, j)) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h))[0]
            model.pair_tables[k] += step
            total += step[coarse[i], coarse[j]]
    return model


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [text_features(t.as_py() or b"") for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rid"), pa.array(made, pa.list_(pa.float64()))], names=["doc_id", "rid", "features"])


def features(docs: DataFrame) -> DataFrame:
    """doc_id, rid, features of every row; the text is the only input of the features."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id().alias("rid"), whole_text().cast("binary").alias("text"))
    return texts.mapInArrow(_measure, "doc_id long, rid long, features array<double>")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(measured: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> GamModel:
    """Learns from the labelled rows that are not held out, at most `max_rows` of them, by hash of the id.

    Labels without a quality are left out, several of one document are averaged.
    """
    known = labels.where("quality is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    rows = measured.join(known, "doc_id").select("features", "quality", F.xxhash64("doc_id").alias("place"), "rid")
    found = rows.orderBy("place", "rid", F.col("features")).limit(max_rows).select("features", "quality").collect()
    x = np.array([r["features"] for r in found], float).reshape(-1, len(FEATURES))
    return fit_gam(x, np.array([r["quality"] for r in found], float))


def _scored(model: GamModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from `threshold` on) of every row.

    A null text counts as empty and is scored as such; repeated rows get the same score. No labels give a score of
    one half, labels of one class nearly that class.
    """
    measured = stage(features(docs), "features")
    scored = measured.mapInArrow(_scored(train(measured, labels)), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _keep(model: GamModel, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([text_features((t.as_py() or "").encode()) for t in batch.column("text")], float)
                yield batch.filter(pa.array(model.score(x) >= threshold))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs`, all columns, that the classifier learned from `labels` accepts.

    Moves no text: features are made in the scan, once to learn from and once to judge.
    """
    model = train(stage(features(docs), "features"), labels)
    return docs.mapInArrow(_keep(model, threshold), docs.schema)
