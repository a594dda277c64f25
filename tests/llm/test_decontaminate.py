import hashlib
import random
import re

from shelfwise.llm.decontaminate import SuffixAutomaton, contamination, decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    own, hit, names = words(text), set(), set()
    for name, item in items:
        w = words(item)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            part = w[i : i + window]
            for at in range(len(own) - len(part) + 1):
                if own[at : at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    names.add(str(name))
    return len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_automaton_against_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        letters = "abc"[: rng.randint(1, 3)]
        items = [(str(i), [rng.choice(letters) for _ in range(rng.randint(0, 14))]) for i in range(rng.randint(0, 5))]
        window = rng.randint(1, 6)
        automaton = SuffixAutomaton(items, window)
        own = [rng.choice(letters + "z") for _ in range(rng.randint(0, 60))]
        runs, names = automaton.scan(own)
        _, n_hit, n_items, _, _ = brute(" ".join(own), [(n, " ".join(w)) for n, w in items], window)
        assert (sum(b - a for a, b in runs), len(names)) == (n_hit, n_items)
        assert all(a[1] < b[0] for a, b in zip(runs, runs[1:]))


def test_contamination(spark, make, odd_rows):
    items = [(1, "One two three four five six seven eight nine ten eleven"), (2, "a b"), (3, None), (None, "ÉTÉ other"), (2, "a b"), (5, "...")]
    rows = [*odd_rows, (20, "x ONE two three four five six seven eight nine TEN, y"), (21, "one two three"), (22, "a-b; a_b éTÉ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [("null" if i is None else i, t) for i, t in items]
    for block in (200_000, 3):  # one automaton, several
        from shelfwise.llm.decontaminate import find_benchmark

        assert find_benchmark(make(rows), bench, words_per_automaton=block).count() == len(rows)
    got = contamination(make(rows), bench).collect()
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(((i, *brute(t, named)) for i, t in rows), key=key)
    assert contamination(make([]), bench).collect() == []
    assert [r.n_hit for r in contamination(make([(1, "a b")]), bench.limit(0)).collect()] == [0]


def test_blocks_give_the_same(spark, make):
    from shelfwise.llm.decontaminate import find_benchmark

    bench = spark.createDataFrame([(i, f"w{i} v{i} u{i}") for i in range(30)], "item_id long, text string")
    docs = make([(1, " ".join(f"w{i} v{i} u{i} x" for i in range(0, 30, 3))), (2, "w1 v1 u1 w2 v2 u2")])
    few, many = (find_benchmark(docs, bench, words_per_automaton=n).drop("__text").collect() for n in (10_000, 9))
    assert [r.asDict() for r in sorted(few)] == [r.asDict() for r in sorted(many)]


def test_spans_are_cut_and_covered_documents_go(spark, make):
    bench = spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(12)))], "item_id long, text string")
    leak = " ".join(f"Q{i}" for i in range(12))
    clean, mixed = "nothing to see here", "é" + " start " * 20 + leak + ", the end" + " end" * 20
    got = {r.doc_id: r for r in decontaminate(make([(1, clean), (2, mixed), (3, leak), (4, None)]), bench).collect()}
    assert sorted(got) == [1, 2, 4] and got[1].text == clean and got[4].text is None
    assert got[2].text == mixed.replace(leak, "") and got[2].n_chars == len(got[2].text) and got[2].score == "x"
