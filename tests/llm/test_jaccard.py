import random
from fractions import Fraction

import numpy as np

from shelfwise.llm import jaccard_join as J
from shelfwise.llm.components import components


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, width, threshold):
    part = Fraction(threshold)
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and len(x & y) * part.denominator >= part.numerator * len(x | y):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((str(i), len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)), key=str)


def corpus(rng, groups=12, copies=9):
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 50)}"
            texts.append(" ".join(own).upper() if rng.random() < 0.2 else " \t".join(own))
    return texts


def got(docs, width, threshold):
    return sorted(((str(r[0]), r[1], r[2]) for r in J.jaccard_components(docs, width, threshold).collect()), key=str)


def test_against_brute_force(spark, make):
    rng = random.Random(7)
    rows = list(enumerate(corpus(rng)))
    rng.shuffle(rows)
    for width, threshold in ((3, "0.9"), (5, "0.8"), (1, "0.5")):
        assert got(make(rows), width, threshold) == brute(rows, width, threshold)


def test_clusters_of_several_blocks(spark, make, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SETS", 3)
    rows = list(enumerate(corpus(random.Random(8), 5, 30)))
    assert got(make(rows), 3, "0.9") == brute(rows, 3, "0.9")


def test_words_that_defeat_polynomials(spark, make):
    """Thue-Morse words agree in every polynomial hash modulo 2 ** 64; long words and common beginnings are told apart too."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    words = [word, other, word[:256], other[:256], "x" * 255, "x" * 256, "x" * 257, "12345678", "123456789", "12345678\u00e9"]
    rows = [(i, f"one two {w}") for i, w in enumerate(words)] + [(100 + i, f"ONE two {w}") for i, w in enumerate(words)]
    assert got(make(rows), 3, "0.9") == brute(rows, 3, "0.9")


def test_odd_rows(spark, make, odd_rows):
    rows = [*odd_rows, (30, "A  b"), (31, "one two three"), (32, "ONE TWO\nTHREE")]
    assert got(make(rows), 3, "0.9") == brute(rows, 3, "0.9")
    assert got(make([]), 3, "0.9") == []
    assert got(make([(1, None)]), 3, "0.9") == [("1", 0, 1)]


def test_texts_of_one_id(spark, make):
    """Each class is compared by its own set, whichever text of a shared id arrives first."""
    rng = random.Random(10)
    rows = []
    for i in range(30):
        near, far = ([f"{k}{rng.randint(0, 10**6)}" for _ in range(60)] for k in "nf")
        pair = [(i, " ".join(near)), (i, " ".join(far))]
        rows += [*(pair if i % 2 else pair[::-1]), (100 + i, " ".join([*near[:-1], "other"]))]
        if i % 3 == 0:
            rows.append((200 + i, " ".join([*far[:-1], "other"])))
    for docs in (make(rows).coalesce(1), make(rows[::-1]).coalesce(1)):
        assert got(docs, 3, "0.9") == brute(rows, 3, "0.9")


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}
    for a, b in links:
        if a != b:
            merged = {x for x in (root.get(a, {a}) | root.get(b, {b}) | {a, b})}
            for x in merged:
                root[x] = merged
    assert found == {k: min(v) for k, v in root.items()}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_tell_rare_shingles_where_slots_are_full():
    """A slot's count says little once all are full; before, such shingles came in the order of their hashes."""
    shingler, text = J.Shingler(3), b"the of and the of and zebra and of the and of the"
    (own, words, first), = shingler.with_words([text])
    counts = np.full(J._slots(), 900, np.int64)
    counts[(1 << J.SLOT_BITS) + J._slot_of(words, J.WORD_BITS)] = 50_000_000
    counts[(1 << J.SLOT_BITS) + J._slot_of(words[6:7], J.WORD_BITS)] = 40
    found = J.Rarity.of_counts(counts).of(own, words, first, 3)
    with_zebra = np.isin(first, [4, 5, 6])
    assert found[with_zebra].max() < found[~with_zebra].min()
    counts[J._slot_of(own[:1], J.SLOT_BITS)] = 2  # no shingle is more frequent than its slot
    counts[J._slot_of(own[1:2], J.SLOT_BITS)] = 1900  # one far beyond all others is frequent whatever its words
    found = J.Rarity.of_counts(counts).of(own, words, first, 3)
    assert found[0] <= J.LOG_STEPS and found[1] >= J.LOG_STEPS * 9


def test_frequent_shingles_leave_the_prefixes(spark, make, monkeypatch):
    """With full slots a common passage ties unlike sets, until what is frequent among prefixes comes last."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(k, f"{' '.join(f'd{k}w{i}' for i in range(90))} {passage}") for k in range(60)]
    rows += [(100, rows[0][1] + " end"), (101, rows[7][1] + " end")]
    largest, dealt = [], J._dealt
    monkeypatch.setattr(J, "slot_counts", lambda texts, width: np.full(J._slots(), 1000, np.int64))
    monkeypatch.setattr(J, "_dealt", lambda clusters: largest.append(clusters.groupBy("cluster").count().agg({"count": "max"}).first()[0]) or dealt(clusters))
    assert got(make(rows), 3, "0.9") == brute(rows, 3, "0.9")
    monkeypatch.setattr(J, "frequent_shingles", lambda *args: np.zeros(1 << (J.FREQUENT_BITS - 6), np.int64))
    assert got(make(rows), 3, "0.9") == brute(rows, 3, "0.9")
    assert largest[0] <= 4 < J.PAIRED < largest[1]
