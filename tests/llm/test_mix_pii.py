import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.llm.pareto_mix import by_length, mix_sources
from shelfwise.llm.pii import KINDS, find_pii, mod97, pii_digest, running_start


def fair_shares(sizes, weights, cap):
    """Targets by filling again and again, as one would by hand."""
    total, names = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
        open_ -= over
    return target


def test_targets_and_sizes(spark, make):
    rng = random.Random(5)
    for source_sizes in ([400, 3, 50, 0, 90], [10], [5, 5, 5, 700]):
        rows = [(i, "w " * rng.randint(1, 9), f"s{k}" if k else None) for k, n in enumerate(source_sizes) for i in range(n)]
        rows = [(i, t, s) for i, (_, t, s) in enumerate(rows)] + [(9999, None, "empty")]
        got = mix_sources(make(rows)).collect()
        sizes = {}
        for _, t, s in rows:
            sizes[s] = sizes.get(s, 0) + len((t or "").split())
        wanted = fair_shares(sizes, (1, 2, 3), 3)
        taken = dict.fromkeys(sizes, 0)
        assert len(got) == len(rows)
        for r in got:
            assert abs(r.target - wanted[r.source]) < 1e-5 and r.source_size == sizes[r.source] and r.taken <= 3 * r.size
            taken[r.source] += r.taken
        assert all(abs(taken[s] - wanted[s]) <= 9 for s in sizes)  # within one document
    assert sorted(map(tuple, mix_sources(make(rows)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_preference_raises_inclusion(spark, make):
    rows = [(i, "a b c", "s" if i < 2000 else "t") for i in range(2600)]
    docs = make(rows).withColumn("odds", F.when(F.col("doc_id") % 2 == 0, 8.0).otherwise(1.0))
    got = [r for r in mix_sources(docs, preference="odds").collect() if r.source == "s"]
    even, odd = (sum(r.copies for r in got if r.doc_id % 2 == k) for k in (0, 1))
    assert even > 1.5 * odd > 0 and len({r.target for r in got}) == 1


def test_rows_alike_meet_the_target(spark, make):
    rows = [(7, "a b c d e f g h i j", "s")] * 50 + [(None, "x y z", "s")] * 50 + [(8, f"w{i} " * 11, "t") for i in range(50)]
    got = mix_sources(make(rows)).collect()
    taken = {s: sum(r.taken for r in got if r.source == s) for s in ("s", "t")}
    assert all(abs(taken[r.source] - r.target) <= 11 for r in got) and len(got) == 150
    again = mix_sources(make(rows).repartition(3)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_copies_follow_the_preference(spark, make):
    """Certain copies are the whole parts of the expected ones; the others come as often as their fractions say."""
    rows = [(i, "w " * (1 + i % 60), "s" if i < 6000 else "t") for i in range(9000)]
    got = mix_sources(make(rows), preference=by_length).collect()
    by = {}
    for r in got:
        by.setdefault((r.source, len(bin(r.size)) - 2), []).append(r.copies)
    for source in ("s", "t"):
        mean = {x: sum(c) / len(c) for (s, x), c in by.items() if s == source}
        own = [r for r in got if r.source == source]
        level = own[0].target / sum(r.size * (len(bin(r.size)) - 2) for r in own)
        assert all(abs(mean[x] - level * x) < 0.2 for x in mean if level * x < 3), mean
        assert all(max(c) - min(c) <= 1 for (s, _), c in by.items() if s == source)
        assert abs(sum(r.taken for r in got if r.source == source) - next(r.target for r in got if r.source == source)) <= 60


def test_odd_rows_mix(spark, make, odd_rows):
    assert mix_sources(make([])).collect() == []
    got = mix_sources(make(odd_rows)).collect()
    assert len(got) == len(odd_rows) and all(r.taken == r.copies * r.size for r in got)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    odd = [int(c) for c in d[::-1]]
    return sum(odd[::2]) + sum(sum(divmod(2 * c, 10)) for c in odd[1::2])


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(p) <= 255 for p in v.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def base_spans(text):
    found = [(m.start(), k, m.end(), name) for k, (name, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if valid(name, m.group())]
    return [(name, a, b) for a, _, b, name in sorted(found)]


PIECES = ["a.b@c.de", "_x@y.z", "@", "1.2.3.4", ".5.6", "255.256.1.1", "4111 1111 1111 1111", "4111-1111", "-", " ", "+", "+49 (30) 1234567", "0", "é", "\n", "DE89370400440532013000", "123-45-6789", "ssn", "79927398713", "0000000000000"]


def test_base_spans_against_plain_patterns(spark, make, odd_rows):
    rng = random.Random(11)
    rows = [*odd_rows, *((100 + i, "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14)))) for i in range(600))]
    got = sorted(((r.doc_id or 0, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii_digest(make(rows)).collect()))
    wanted = []
    for i, t in rows:
        spans = base_spans(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        wanted.append((i or 0, hashlib.sha256(text.encode()).hexdigest(), *(sum(s[0] == k for s in spans) for k in BASE)))
    assert got == sorted(wanted)


def test_added_kinds_need_checksum_or_context(spark, make):
    good, bad = "DE89370400440532013000", "DE89370400440532013001"
    rows = [(1, f"iban {good}!"), (2, f"iban {bad}!"), (3, "GB29 NWBK 6016 1331 9268 19"), (4, "ssn 123-45-6789"), (5, "code 123-45-6789"), (6, "ssn 000-45-6789")]
    got = {r.doc_id: [(s.kind, s.start, s.end, round(s.score, 1)) for s in r.pii] for r in find_pii(make(rows)).collect()}
    assert got[1] == [("iban", 5, 27, 1.0)] and got[3] == [("iban", 0, 27, 0.7)] and got[4] == [("ssn", 4, 15, 0.7)]
    assert got[2] == got[5] == got[6] == []


def test_long_runs_are_linear(spark, make):
    runs = ["a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 100_000, "a@" + "b." * 150_000, "10.0.0.1 " * 30_000, "A1" * 200_000]
    got = {r.doc_id: r for r in pii_digest(make(list(enumerate(runs)))).collect()}
    assert [got[i].n_ip for i in (2, 5)] == [50_000, 30_000] and got[4].n_email == 1
    assert got[5].spans.split(",")[-1] == "ip:269991:269999"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 10**6), max_size=700))
def test_running_start(spark, sizes):
    df = spark.createDataFrame([(sizes,)], "s array<long>").select(running_start(F.col("s")).alias("b"))
    assert df.first().b == [sum(sizes[:i]) for i in range(len(sizes))]


def test_mod97(spark):
    values = ["DE89370400440532013000", "GB82WEST12345698765432", "DE12 3456"]
    got = [r.m for r in spark.createDataFrame([(v,) for v in values], "v string").select(mod97(F.col("v")).alias("m")).collect()]
    assert got == [int("".join(str(int(c, 36)) for c in v.replace(" ", "")[4:] + v[:4])) % 97 for v in values]
    assert len(KINDS) == 6
