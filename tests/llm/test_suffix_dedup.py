import hashlib
import random

import numpy as np

from shelfwise.llm import suffix_dedup as S


def brute(docs, length=100):
    """docs: (id, bytes) in order. n_bytes, n_removed, n_spans, kept by id."""
    seen, out = set(), {}
    for i, b in docs:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        spans = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]]))) if len(b) else 0
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def corpus(rng, n):
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(60, 400))) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(0, 120))) for _ in range(rng.randint(0, 4))]
        parts += [p[rng.randint(0, 50) :] for p in rng.choices(passages, k=rng.randint(0, 3))]
        rng.shuffle(parts)
        texts.append("".join(parts))
    return texts + ["ab" * 400, "a" * 700, "a" * 99, "a" * 100, texts[0], texts[1] + "!" if len(texts) > 1 else ""]


def report(docs):
    return {r[0]: tuple(r)[1:] for r in S.remove_repeats(docs).drop("removed").collect()}


def test_against_brute_force(spark, make):
    texts = corpus(random.Random(1), 80)
    assert report(make(list(enumerate(texts)))) == brute([(i, t.encode()) for i, t in enumerate(texts)])


def test_small_pieces_and_dealt_anchors(spark, make, monkeypatch):
    """The ways for very long texts and very frequent anchors give the same."""
    monkeypatch.setattr(S, "PIECE", 300)
    monkeypatch.setattr(S, "SPLIT", 3)
    monkeypatch.setattr(S, "SORT_ROWS", 10)
    texts = corpus(random.Random(2), 60)
    assert report(make(list(enumerate(texts)))) == brute([(i, t.encode()) for i, t in enumerate(texts)])


def copies_with_brute(rng):
    """Rows of which some are repeated as they are, with an id or without, and what brute force makes of them as one document each."""
    texts = [t for t in dict.fromkeys(corpus(rng, 40)) if len(t.encode()) > 100]
    none = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(i, t) for i, t in enumerate(texts) for _ in range(1 + 2 * (i % 3 == 0))] + [(None, none)] * 3 + [(900, none[50:250] + "z" * 60)]
    rng.shuffle(rows)
    want = brute([(None, none.encode()), *((i, t.encode()) for i, t in enumerate(texts)), (900, (none[50:250] + "z" * 60).encode())])
    return rows, sorted(((i, *want[i]) for i, _ in rows), key=str)


def test_repeated_rows_are_one_document(spark, make):
    """In one batch and in batches of their own; nothing of them is lost."""
    rows, want = copies_with_brute(random.Random(5))
    for docs in (make(rows).coalesce(1), make(rows).repartition(8)):
        assert sorted((tuple(r) for r in S.remove_repeats(docs).drop("removed").collect()), key=str) == want


def test_repeated_rows_with_dealt_anchors(spark, make, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 300)
    monkeypatch.setattr(S, "SPLIT", 3)
    monkeypatch.setattr(S, "SORT_ROWS", 10)
    rows, want = copies_with_brute(random.Random(6))
    assert sorted((tuple(r) for r in S.remove_repeats(make(rows).repartition(8)).drop("removed").collect()), key=str) == want


def test_texts_of_one_id_are_told_apart(spark, make):
    """Many different texts of one id: nothing that is in one of them only goes."""
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passage = text(200)
    rows = [(1, passage), (5, passage + text(50))] + [(5, text(265)) for _ in range(300)]
    got = S.remove_repeats(make(rows)).collect()
    assert sorted(r.n_removed for r in got)[-2:] == [0, 200] and sum(r.n_bytes for r in got) == sum(len(t) for _, t in rows)


def test_sorted_suffixes():
    rng = random.Random(4)
    contexts = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 30))).encode() for _ in range(200)]
    groups = np.array([i // 50 for i in range(200)])
    order = S.SortedSuffixes(contexts, np.zeros(200, np.int64), groups).order.tolist()
    assert order == sorted(range(200), key=lambda i: (groups[i], contexts[i], i))


def test_hash_collisions_are_verified(monkeypatch):
    """With a hash that always agrees, wrong finds must be refused by the bytes."""
    monkeypatch.setattr(S, "mixed", lambda h: np.zeros(len(h), np.uint64))
    a, b = b"x" * 50 + b"k" * 24 + b"y" * 76, b"z" * 50 + b"k" * 24 + b"y" * 76
    repeated, _ = S.repeated_windows([a, b, a], np.array([50, 50, 50]), np.array([51, 51, 51]), np.zeros(3, int), 100)
    assert not repeated[0].any() and repeated[2][:51].all()
    assert repeated[1].tolist() == [w >= 50 and w < 51 for w in range(77)]


def test_odd_rows(spark, make, odd_rows):
    assert report(make([])) == {}
    got = S.remove_repeats(make(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    same = [r.kept_sha256 for r in got if r.doc_id == 4 and r.n_bytes == 3]
    assert len(same) == 2 and len(set(same)) == 1
    by_id = {r.doc_id: r for r in got if r.doc_id in (3, 6)}
    assert by_id[3].n_removed == 460_000 - 23  # all but the first period
    assert by_id[6].n_removed == 0
