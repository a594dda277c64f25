"""Benchmark decontamination with a generalised suffix automaton over the words of the test items."""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import aside, ship, whole_text, with_text

#: Words: runs of digits, ASCII letters and all characters beyond ASCII.
WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_WORDS = re.compile(WORD)
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Test items are dealt into automata of about so many words; each is built and broadcast on its own.
WORDS_PER_AUTOMATON = 200_000


def _lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


class SuffixAutomaton:
    """All substrings of several word sequences; answers which windows of them end at a word of a stream.

    A window is `window` consecutive words of an item, or a whole item that is shorter.
    """

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window, self.vocabulary = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for name, words in items if words]
        for _, words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(coded)

    def _extend(self, last: int, word: int) -> int:
        following, link, length = self.next, self.link, self.length
        if word in following[last]:
            found = following[last][word]
            return found if length[found] == length[last] + 1 else self._split(last, word, found)
        new = self._state(length[last] + 1, {})
        at = last
        while at >= 0 and word not in following[at]:
            following[at][word] = new
            at = link[at]
        if at < 0:
            link[new] = 0
        else:
            found = following[at][word]
            link[new] = found if length[found] == length[at] + 1 else self._split(at, word, found)
        return new

    def _state(self, length: int, following: dict) -> int:
        self.length.append(length)
        self.next.append(following)
        self.link.append(0)
        return len(self.length) - 1

    def _split(self, at: int, word: int, found: int) -> int:
        """A state for the shorter strings of `found`, those that continue state `at`."""
        clone = self._state(self.length[at] + 1, dict(self.next[found]))
        self.link[clone] = self.link[found]
        self.link[found] = clone
        while at >= 0 and self.next[at].get(word) == found:
            self.next[at][word] = clone
            at = self.link[at]
        return clone

    def _mark(self, coded: list[tuple[str, list[int]]]) -> None:
        """Names of items by the state of each window; for each state the window state among its suffixes."""
        states = range(len(self.length))
        by_length = sorted(states, key=self.length.__getitem__)
        self.window_state = [-1] * len(self.length)
        for s in by_length:
            if self.length[s] >= self.window:
                self.window_state[s] = s if self.length[self.link[s]] < self.window else self.window_state[self.link[s]]
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for name, words in coded:
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= self.window:
                    self.items.setdefault(self.window_state[state], set()).add(name)
            if len(words) < self.window:
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(name)
        self.short_above = [-1] * len(self.length)  # the nearest state with short items: itself or a suffix
        for s in by_length[1:]:
            self.short_above[s] = s if s in self.short else self.short_above[self.link[s]]

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs [start, end) of words inside windows, in order and merged, and the items whose windows occur."""
        following, link, length, window = self.next, self.link, self.length, self.window
        window_state, short_above = self.window_state, self.short_above
        runs: list[list[int]] = []
        names: set[str] = set()
        state = matched = 0
        for i, word in enumerate(map(self.vocabulary.get, words)):
            if word is None:
                state = matched = 0
                continue
            while word not in following[state]:  # the root has every word of the vocabulary
                state = link[state]
                matched = length[state]
            state = following[state][word]
            matched += 1
            start = -1
            if matched >= window:
                start = i + 1 - matched
                names |= self.items[window_state[state]]
            s = short_above[state]
            while s >= 0:
                for size, own in self.short[s].items():
                    if size <= matched:
                        start = i + 1 - size if start < 0 else min(start, i + 1 - size)
                        names |= own
                s = short_above[link[s]] if link[s] > 0 else -1
            if start >= 0:
                while runs and runs[-1][1] >= start:
                    start = min(start, runs.pop()[0])
                runs.append([start, i + 1])
        return [(a, b) for a, b in runs], names


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan_block(shared):
    """Adds one automaton's finds to the columns runs, items and spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            n_words, runs, items, spans = [], [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("__text", "__runs", "__items", "__spans")), strict=True)
            for text, old_runs, old_items, old_spans in rows:
                lowered = _lowered(text)
                words = _WORDS.findall(lowered)
                found, names = automaton.scan(words)
                n_words.append(len(words))
                if not found:
                    runs.append(old_runs)
                    items.append(old_items)
                    spans.append(old_spans)
                    continue
                all_runs = _merged([(r["a"], r["b"]) for r in old_runs] + found)
                at = [m.span() for m in _WORDS.finditer(lowered)]
                runs.append([{"a": a, "b": b} for a, b in all_runs])
                items.append(sorted(names.union(old_items)))
                spans.append([{"a": at[a][0], "b": at[b - 1][1]} for a, b in all_runs])
            pairs = batch.schema.field("__runs").type
            made = {
                "__n_words": pa.array(n_words, pa.int64()),
                "__runs": pa.array(runs, pairs),
                "__items": pa.array(items, batch.schema.field("__items").type),
                "__spans": pa.array(spans, pairs),
            }
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)], schema=batch.schema)

    return run


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 10, words_per_automaton: int = WORDS_PER_AUTOMATON) -> DataFrame:
    """All rows and columns of `docs`, and four more.

    `__n_words`; `__runs`: runs [a, b) of words inside windows of the items; `__spans`: the same as code points of
    the text; `__items`: ids, as text, of the items whose windows occur. Words are compared with A-Z lower-cased.

    The items are dealt into blocks by their total size, each block's automaton is built and broadcast on its
    own, and the documents stream through one after the other: no shuffle, whatever the number of blocks.
    A null or empty text or item has no words, an item without id is named "null", and repeated items count once.
    `docs` must have no columns of these names; `decontaminate` sets such columns aside.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), whole_text().alias("text"))
    total = items.agg(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")))).first()[0] or 0
    blocks = max(1, -(-int(total) // words_per_automaton))
    pair = "array<struct<a:int,b:int>>"
    found = docs.select(
        "*", whole_text().alias("__text"), F.lit(0).cast("long").alias("__n_words"), F.array().cast(pair).alias("__runs"),
        F.array().cast("array<string>").alias("__items"), F.array().cast(pair).alias("__spans"),
    )
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == block).collect()
        automaton = SuffixAutomaton([(r["name"], _WORDS.findall(_lowered(r["text"]))) for r in own], window)
        found = found.mapInArrow(_scan_block(spark.sparkContext.broadcast(automaton)), found.schema)
    return found.drop("__text")


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the code points of `spans`, which are in order and don't overlap."""
    n = F.size(spans)
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["b"]))
    ends = F.concat(F.transform(spans, lambda s: s["a"]), F.array(F.char_length(text)))
    kept = F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(text, F.get(starts, i) + 1, F.get(ends, i) - F.get(starts, i)))
    return F.when(n == 0, text).otherwise(F.array_join(kept, ""))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """`docs` without benchmark text: spans as long as a window are cut out, n_chars follows, and a document
    with more than `max_coverage` of its words in such spans goes. Documents without a find stay as they are."""
    docs, back = aside(docs)
    found = find_benchmark(docs, benchmark, window)
    hit = F.aggregate("__runs", F.lit(0), lambda s, r: s + r["b"] - r["a"])
    found = found.where(hit <= F.col("__n_words") * max_coverage)
    return back(with_text(found, F.size("__runs") > 0, without_spans(F.col("text"), F.col("__spans")), docs.columns))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: n_words, n_hit (words inside windows), the items found and whether there are any."""
    found = find_benchmark(docs.select("doc_id", "text"), benchmark, window)
    names = F.array_join(F.array_sort("__items"), ",")
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"),
        F.aggregate("__runs", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"]).alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
        (F.size("__runs") > 0).alias("contaminated"),
    )
