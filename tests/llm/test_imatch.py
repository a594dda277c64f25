import hashlib
import math
import re
from collections import Counter

import xxhash

from shelfwise.llm.imatch import EMPTY, IDF_BAND, SLOT_BITS, SUBSET_BITS, fingerprint_report, fingerprints


def h64(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed=seed)


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def hash_long(value, seed=42):
    return h64((value & (1 << 64) - 1).to_bytes(8, "little"), seed)


def hash_int(value, seed):
    """The hash of a 4-byte whole number."""
    return h64((value & (1 << 32) - 1).to_bytes(4, "little"), seed)


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", low) if w]


def lexicon(texts):
    counts = Counter(h64(w.encode()) >> 64 - SLOT_BITS for t in texts for w in set(terms(t)))
    return {s for s, n in counts.items() if IDF_BAND[0] <= math.log(len(texts) / n) <= IDF_BAND[1]}


def brute(text, slots):
    hashed = [h64(w.encode()) for w in terms(text)]
    kept = [h for h in hashed if h >> 64 - SLOT_BITS in slots] or hashed or [h64(text.encode(), h64(b"no terms"))]
    kept, out = sorted({signed(h) for h in kept}), ""
    for k, bits in enumerate(SUBSET_BITS):
        chosen = [h for h in kept if hash_int(k, hash_long(h)) & (1 << bits) - 1 == 0]
        seed = 42
        for h in chosen:
            seed = hash_long(h, seed)
        out += f"{seed:016x}"[:8] if chosen else EMPTY
    return out


def like(a, b):
    pairs = [(a[i : i + 8], b[i : i + 8]) for i in range(0, len(a), 8)]
    used = [p for p in pairs if p != (EMPTY, EMPTY)]
    return sum(x == y for x, y in used) / len(used)


def test_against_brute_force(spark, make):
    texts = [" ".join(f"w{(i * j) % 37}" for j in range(5 + i % 40)) + " the" for i in range(60)] + ["", "...", "Ünïque É", "same same", "same same"]
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    slots = lexicon(texts)
    got = {r.doc_id: r for r in fingerprint_report(make(rows)).collect()}
    for i, (doc_id, text) in enumerate(rows):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        r = got[doc_id]
        assert r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest() and r.n_chars == len(text)
        assert r.fingerprint == brute(text, slots) and r.edited_fingerprint == brute(edit, slots)
        assert abs(r.near_edited - like(r.fingerprint, r.edited_fingerprint)) < 1e-12
        assert abs(r.near_next - like(r.fingerprint, brute(following, slots))) < 1e-12


def test_many_ranges_meet_their_next(spark, make):
    rows = [(i * i, f"text {i}") for i in range(2500)]
    got = {r.doc_id: r.edited_sha256 for r in fingerprint_report(make(rows)).collect()}
    for i, (doc_id, text) in enumerate(rows):
        following, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        assert got[doc_id] == hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()


def test_odd_rows(spark, make, odd_rows):
    assert fingerprint_report(make([])).collect() == []
    assert fingerprint_report(make([(1, "alone")])).first().near_next == 1.0
    got = fingerprint_report(make(odd_rows)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.near_edited <= 1 for r in got)
    same = [r.fingerprint for r in fingerprints(make(odd_rows)).collect() if r.text == "a b"]
    assert len(same) == 2 and len(set(same)) == 1
