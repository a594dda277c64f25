"""Phrases, counts and compacted paths against plain counting."""

import re
from collections import Counter

import numpy as np

from shelfwise.llm import collocations as C


def pieces(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
        words = [w for w in re.split("[ \t]", piece) if w]
        if words:
            yield words


def brute(rows, least=10, percent=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        for words in pieces(text):
            n["und" if lang is None else lang] += len(words)
            for k in (1, 2, 3):
                f.update(("und" if lang is None else lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    gone = {part for g, a in candidates.items() if len(g) == 4 for part in (g[:3], (g[0], *g[2:])) if part in candidates and 100 * a >= percent * candidates[part]}
    found = []
    for g, a in candidates.items():
        if g not in gone:
            cuts = [(1_000_000 * a * a // (f[g[:k]] * f[(g[0], *g[k:])]), k - 1, f[g[:k]], f[(g[0], *g[k:])]) for k in range(2, len(g))]
            score, _, left, right = min(cuts)
            found.append((g[0], -score, -a, " ".join(g[1:]).encode(), left, right))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, text, lang, "s", 1, "x", 2) for i, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string, source string, f long, word string, n int")


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, size=300):
    rng = np.random.default_rng(seed)
    words = [*"abcdefgh", "É", "the", "The", "new", "york", "x\ty"]
    texts = []
    for _ in range(size):
        own = [str(w) for w in rng.choice(words, rng.integers(0, 30))]
        if rng.random() < 0.4:
            own[len(own) // 2 : len(own) // 2] = "in the city of new york today".split()
        texts.append((str(rng.choice(["en", "de"])) if rng.random() < 0.9 else None, str(rng.choice([" ", "  ", " , ", "\n"])).join(own)))
    return texts


def test_against_brute_force(spark):
    rows = corpus(1)
    want = brute(rows)
    assert len(want) > 20 and result(C.collocations(frame(spark, rows))) == want
    assert result(C.collocations(frame(spark, rows), least=25, percent=90, top=7)) == brute(rows, 25, 90, 7)


def test_small_chunks_and_a_common_line(spark, monkeypatch):
    monkeypatch.setattr("shelfwise.llm.encoded.CHUNK", 200)
    rows = corpus(2, 200) + [("en", "one very common line of words")] * 150  # over a third of all rows
    assert result(C.collocations(frame(spark, rows).repartition(5))) == brute(rows)


def test_paths_are_compacted(spark):
    rows = [("en", "in the long run we all pay.")] * 12 + [("en", "we all know")] * 11 + [("en", "so in the long run")] * 10
    graph = C.phrase_graph(frame(spark, rows))
    words = {r["id"]: r["word"] for r in graph.words.collect()}
    paths = sorted((" ".join(words[w] for w in r["path"]), r["f"], r["words"]) for r in graph.paths.collect())
    # `in the` starts pieces, `long run` ends some and `we all` branches: no path runs through them
    assert paths == [("in the long run", 22, 4), ("long run we all", 12, 4), ("so in the", 10, 3), ("we all know", 11, 3), ("we all pay", 12, 3)]


def test_long_path_and_inner_nodes(spark):
    line = " ".join(f"w{i}" for i in range(70))
    rows = [("en", line)] * 10 + [("en", "w3 w4 other")] * 3
    graph = C.phrase_graph(frame(spark, rows))
    words = {r["id"]: r["word"] for r in graph.words.collect()}
    paths = sorted([words[w] for w in r["path"]] for r in graph.paths.collect())
    assert paths == sorted([[f"w{i}" for i in range(0, 5)], [f"w{i}" for i in range(3, 70)]])
    assert result(C.collocations(frame(spark, rows))) == brute(rows)


def test_exact_beyond_64_bits(spark):
    big = 3_000_000_000
    row = spark.createDataFrame([(big, big + 1, big + 2)], "f long, l long, r long")
    assert row.select(C._cut_score("f", "l", "r")).first()[0] == 1_000_000 * big * big // ((big + 1) * (big + 2))


def test_odd_rows(spark):
    rows = [("en", None), ("en", ""), (None, "a b c " * 20), ("", "x\ty x y. X Y! x y " * 4), ("t\tab", "p q\n" * 12), ("en", "é ü " * 5 + "word" * 20_000)]
    assert result(C.collocations(frame(spark, rows))) == brute(rows)
    assert result(C.collocations(frame(spark, []))) == []
    assert result(C.collocations(frame(spark, [("en", None)]))) == []
