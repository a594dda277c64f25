"""Language-model scores of texts from a log-bilinear neural model, learned by noise-contrastive estimation.

The vectors of the words before a token, each weighted by its place, add up to a prediction; its products with the
output vectors, plus biases, are the logits of the most frequent words and of `any other word`. Tasks learn on all
their training tokens from common starting values, and the parameters are averaged by tokens, so what is learned from
grows with the corpus and what is sent does not. Scoring normalises over all outputs; a rare word has its share of
`any other word` by its count in the whole corpus.
"""

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ship, shuffle_partitions, stage, whole_text
from shelfwise.llm.encoded import PART_TOKENS, chunked, dictionary, free, numbered, unpacked, with_words

#: A-Z to lower case, white space to spaces.
_CODES = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The end of a text as an entry, which no word can be, and the places of the first entries of each vocabulary.
END_ENTRY, END, NOTHING = b"\n", 0, 1
#: Numbers of parameters that are summed together.
PART = 8192


@dataclass(frozen=True)
class Shape:
    """Size of a model and how it is learned: `outputs` frequent words, `width` of the vectors, `context` words before."""

    outputs: int = 1000
    width: int = 16
    context: int = 3
    noise: int = 48
    batch: int = 2048
    rate: float = 0.1
    rounds: int = 1
    seed: int = 13


@dataclass(frozen=True)
class LogBilinear:
    """The parameters. Words are numbered by frequency; `other` stands for all further ones, `start` for none."""

    shape: Shape
    inputs: np.ndarray
    places: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray
    noise: np.ndarray

    @classmethod
    def fresh(cls, shape: Shape, counts: np.ndarray) -> "LogBilinear":
        """Predicts words by their counts (the last is that of all others) until it has learned."""
        rng, n = np.random.default_rng(shape.seed), len(counts)
        share = ((counts + 1) / (counts + 1).sum()).astype(np.float64)
        inputs = rng.normal(0, 0.3, (n + 1, shape.width)).astype(np.float32)
        places = np.full((shape.context, shape.width), 1 / shape.context, np.float32)
        return cls(shape, inputs, places, np.zeros((n, shape.width), np.float32), np.log(share).astype(np.float32), share)

    @property
    def other(self) -> int:
        return len(self.bias) - 1

    def contexts(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each token the numbers of the words before it, the nearest first; `start` before a text's first.

        `ends` marks the last token of each text.
        """
        start = len(self.bias)
        out = np.full((len(ids), self.shape.context), start, np.int32)
        first = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
        place = np.arange(len(ids)) - np.repeat(first, np.diff(np.concatenate([first, [len(ids)]])))
        for back in range(1, self.shape.context + 1):
            out[back:, back - 1] = np.where(place[back:] >= back, ids[:-back], start) if len(ids) > back else out[back:, back - 1]
        return out

    def predictions(self, contexts: np.ndarray) -> np.ndarray:
        """Predicted vectors of contexts."""
        q = self.inputs[contexts[:, 0]] * self.places[0]
        for i in range(1, contexts.shape[1]):
            q += self.inputs[contexts[:, i]] * self.places[i]
        return q

    def log10_probabilities(self, ids: np.ndarray, contexts: np.ndarray, block: int = 2048) -> np.ndarray:
        """Of each token, normalised over all outputs; each different context of PART_TOKENS tokens is normalised once."""
        parts = range(0, len(ids), PART_TOKENS)
        return np.concatenate([np.zeros(0), *(self._log10(ids[a : a + PART_TOKENS], contexts[a : a + PART_TOKENS], block) for a in parts)])

    def _log10(self, ids: np.ndarray, contexts: np.ndarray, block: int) -> np.ndarray:
        base = len(self.bias) + 1
        key = np.zeros(len(ids), np.int64)
        for i in range(contexts.shape[1]):
            key = key * base + contexts[:, i]
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        own = self.predictions(contexts[first])
        total = np.empty(len(own), np.float64)
        weights = np.ascontiguousarray(self.outputs.T)
        for at in range(0, len(own), block):
            logits = own[at : at + block] @ weights
            logits += self.bias
            most = logits.max(axis=1, keepdims=True)
            logits -= most
            np.exp(logits, out=logits)
            total[at : at + block] = np.log(logits.sum(axis=1)) + most[:, 0]
        out = np.empty(len(ids))
        for at in range(0, len(ids), 1 << 16):
            part = slice(at, at + (1 << 16))
            out[part] = np.einsum("ij,ij->i", own[which[part]], self.outputs[ids[part]]) + self.bias[ids[part]] - total[which[part]]
        return out / np.log(10)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.inputs, self.places, self.outputs, self.bias)]).astype(np.float64)

    def with_flat(self, values: np.ndarray) -> "LogBilinear":
        new, at = {}, 0
        for name in ("inputs", "places", "outputs", "bias"):
            old = getattr(self, name)
            new[name] = values[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
        return replace(self, **new)


class Learner:
    """Noise-contrastive steps on a copy of a model: tell a token from noise words drawn by frequency.

    All tokens of a batch share their noise words, so the steps are products of matrices.
    """

    def __init__(self, model: LogBilinear, seed: int):
        self.model = replace(model, inputs=model.inputs.copy(), places=model.places.copy(), outputs=model.outputs.copy(), bias=model.bias.copy())
        self.rng, self.tokens = np.random.default_rng([model.shape.seed, seed]), 0
        self.squares = [np.full(x.shape, 0.1, np.float32) for x in (model.inputs, model.places, model.outputs, model.bias)]
        self.odds = np.log(model.shape.noise * model.noise).astype(np.float32)
        self.steps = np.cumsum(model.noise)

    def _move(self, which: int, gradient: np.ndarray) -> None:
        parameters = (self.model.inputs, self.model.places, self.model.outputs, self.model.bias)[which]
        self.squares[which] += gradient * gradient
        parameters += self.model.shape.rate * gradient / np.sqrt(self.squares[which])

    def _gathered(self, n: int, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums of the rows of `values` by their numbers."""
        width = values.shape[1]
        place = (rows[:, None] * width + np.arange(width)).ravel()
        return np.bincount(place, values.ravel(), n * width).reshape(n, width).astype(np.float32)

    def learn(self, ids: np.ndarray, contexts: np.ndarray) -> None:
        """One pass over tokens and their contexts, in a random order."""
        order = self.rng.permutation(len(ids))
        for at in range(0, len(ids), self.model.shape.batch):
            part = order[at : at + self.model.shape.batch]
            self._step(ids[part], contexts[part])
        self.tokens += len(ids)

    def _step(self, ids: np.ndarray, contexts: np.ndarray) -> None:
        m = self.model
        noise = np.minimum(np.searchsorted(self.steps, self.rng.random(m.shape.noise) * self.steps[-1]), m.other)
        q, own, drawn = m.predictions(contexts), m.outputs[ids], m.outputs[noise]
        true = 1 / (1 + np.exp(np.einsum("ij,ij->i", q, own) + m.bias[ids] - self.odds[ids]))  # 1 less its probability
        false = -1 / (1 + np.exp(-(q @ drawn.T + (m.bias[noise] - self.odds[noise]))))
        scale = np.float32(1 / len(ids) ** 0.5)
        true, false = true.astype(np.float32) * scale, false * scale
        for_q = true[:, None] * own + false @ drawn
        n, k = len(m.bias), m.shape.context
        for_outputs = self._gathered(n, np.concatenate([ids, noise]), np.concatenate([true[:, None] * q, false.T @ q]))
        for_bias = (np.bincount(ids, true, n) + np.bincount(noise, false.sum(axis=0), n)).astype(np.float32)
        vectors = [m.inputs[contexts[:, i]] for i in range(k)]
        for_inputs = self._gathered(n + 1, contexts.T.ravel(), np.concatenate([for_q * m.places[i] for i in range(k)]))
        for_places = np.stack([(for_q * v).sum(axis=0) for v in vectors])
        for which, gradient in enumerate((for_inputs, for_places, for_outputs, for_bias)):
            self._move(which, gradient)


def _encode(texts: list[tuple]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words and an end for each text; counted are those of the texts that are learned from."""
    tokens, entries = numbered(b" \n ".join([*(t[3].translate(_CODES) for t in texts), b""]), (END_ENTRY, b""))
    tokens = tokens[tokens != NOTHING]
    learned = np.repeat([t[1] for t in texts], _lengths(tokens))
    return entries, np.bincount(tokens[learned], minlength=len(entries)), tokens


def _lengths(tokens: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[-1], np.flatnonzero(tokens == END)]))


def _learned(shared, numbers):
    """Each task's parameters, times the tokens it learned from, in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = None
        for batch in batches:
            for i in range(batch.num_rows):
                entries = batch.column("entries").slice(i, 1).flatten()
                tokens = unpacked(batch.column("tokens")[i].as_py(), batch.column("n")[i].as_py())
                counted = np.repeat([d["counted"] for d in batch.column("documents")[i].as_py()], _lengths(tokens))
                learner = learner or Learner(shared.value, batch.column("chunk")[i].as_py())
                model = learner.model
                known = pc.index_in(entries, value_set=pa.array(numbers.value, pa.binary())).fill_null(model.other)
                ids = known.to_numpy(zero_copy_only=False)[tokens]
                contexts = model.contexts(ids, tokens == END)
                learner.learn(ids[counted], contexts[counted])
                free()
        if learner and learner.tokens:
            values = learner.model.flat() * learner.tokens
            parts = range(-(-len(values) // PART))
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array([float(learner.tokens)] * len(parts)), pa.array([values[p * PART : (p + 1) * PART].tobytes() for p in parts], pa.binary())],
                names=["part", "tokens", "values"],
            )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for part, tokens, values in zip(*(batch.column(c).to_pylist() for c in ("part", "tokens", "values")), strict=True):
            own = sums.setdefault(part, [0.0, 0.0])
            own[0] += tokens
            own[1] = own[1] + np.frombuffer(values)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v[0] for v in sums.values()]), pa.array([v[1].tobytes() for v in sums.values()], pa.binary())],
            names=["part", "tokens", "values"],
        )


@dataclass(frozen=True)
class TextModel:
    """A model with the corpus's numbers of its words (the others have none) and the sums that scoring needs."""

    model: LogBilinear
    ids: np.ndarray
    tokens: int
    kinds: int
    other_tokens: int
    other_kinds: int

    def numbers(self, ids: np.ndarray) -> np.ndarray:
        """The model's numbers of words by those of the corpus."""
        order = np.argsort(self.ids)
        place = np.minimum(np.searchsorted(self.ids[order], ids), max(0, len(order) - 1))
        return np.where(self.ids[order][place] == ids, order[place], self.model.other) if len(order) else np.full(len(ids), self.model.other)


def train(chunks: DataFrame, words: DataFrame, shape: Shape = Shape()) -> TextModel:
    """Learns from all counted tokens of `chunks`, whose words are `words` (entry, id, count).

    The driver holds the `outputs` most frequent words and the parameters, whose size `shape` sets.
    """
    top = words.orderBy(F.desc("count"), "entry").limit(shape.outputs).collect()
    sums = words.agg(F.sum("count").alias("tokens"), F.count("*").alias("kinds")).first()
    tokens, kinds = sums["tokens"] or 0, sums["kinds"]
    other_tokens, other_kinds = tokens - sum(r["count"] for r in top), kinds - len(top)
    model = LogBilinear.fresh(shape, np.array([*(r["count"] for r in top), other_tokens], np.float64))
    known = chunks.sparkSession.sparkContext.broadcast([bytes(r["entry"]) for r in top])
    for _ in range(shape.rounds if tokens else 0):
        model = _averaged(chunks, model, known)
    return TextModel(model, np.array([r["id"] for r in top], np.int64), tokens, kinds, other_tokens, other_kinds)


def _averaged(chunks: DataFrame, model: LogBilinear, known) -> LogBilinear:
    schema = "part int, tokens double, values binary"
    spark = chunks.sparkSession
    rows = chunks.select("chunk", "entries", "n", "tokens", "documents").mapInArrow(_learned(spark.sparkContext.broadcast(model), known), schema)
    parts = rows.repartition(shuffle_partitions(spark), "part").mapInArrow(_summed, schema).collect()
    return model.with_flat(np.concatenate([np.frombuffer(r["values"]) / r["tokens"] for r in sorted(parts, key=lambda r: r["part"])]))


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(word_ids: np.ndarray, counts: np.ndarray, tokens: np.ndarray, documents: list, trained: TextModel) -> Iterator[pa.RecordBatch]:
    model, ids = trained.model, trained.numbers(word_ids)
    base = np.log10((counts + 1) / (trained.tokens + 1 * (trained.kinds + 1)))
    among_others = np.where(ids == model.other, np.log10((counts + 1) / (trained.other_tokens + trained.other_kinds + 1)), 0.0)
    own = model.log10_probabilities(ids[tokens], model.contexts(ids[tokens], tokens == END)) + among_others[tokens]
    lengths = _lengths(tokens)
    first = np.cumsum(lengths) - lengths
    sums = [np.add.reduceat(x, first) for x in ((counts > 0)[tokens].astype(np.int64), base[tokens], own)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([d["doc_id"] for d in documents], pa.int64()), pa.array([not d["counted"] for d in documents]), pa.array(lengths), *map(pa.array, sums)],
        names=[c.split()[0] for c in _SCORES.split(", ")],
    )


def score_texts(docs: DataFrame, held_out: Column, shape: Shape = Shape()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of `docs`.

    Learned is from the rows that are not held out. Words lie between ASCII white space, A-Z lower-cased; a text's
    end is a token. `base_score` sums log10 of (c + 1) / (N + V + 1) over the tokens, with c a token's count
    among the N learned ones of V kinds; `n_known` are those with a count; `score` is the model's log10 probability
    of the text. A null text is empty, a row without an id is scored too, repeated rows each; without rows
    to learn from both scores are 0.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (~F.coalesce(held_out, F.lit(False))).alias("counted"), F.lit("").alias("tag"), whole_text().cast("binary").alias("text"),
    )
    chunks = stage(chunked(texts, _encode), "chunks")
    words, places = dictionary(chunks)
    trained = train(chunks, words, shape)
    shared = spark.sparkContext.broadcast(trained)
    found = with_words(chunks, places, _scores, _SCORES, lambda: shared.value)
    return found.withColumn("train_tokens", F.lit(trained.tokens).cast("long"))


def language_model_scores(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """`score_texts` with the rows held out whose crc32 of the id as text leaves `fold` modulo `folds`."""
    return score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % folds == fold)
