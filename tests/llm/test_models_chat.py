import random

import numpy as np
import regex
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfwise.llm import secrets
from shelfwise.llm.chat_views import rotate_perspectives
from shelfwise.llm.common import table
from shelfwise.llm.decontaminate import decontaminate
from shelfwise.llm.pii import find_pii
from shelfwise.llm.quality_gam import FEATURES, fit_gam, held_out, keep_good, quality_scores, text_features


def test_gam_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit_gam(x[:3000], y[:3000])
    assert model.pairs[0] == (0, 1) and np.mean((model.score(x[3000:]) > 0.5) == y[3000:]) > 0.95


def test_gam_without_two_classes():
    assert np.allclose(fit_gam(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((2, 2))), 0.5)
    assert fit_gam(np.ones((50, 2)), np.ones(50)).score(np.ones((1, 2)))[0] > 0.9


def quality_data(rng, n):
    word = lambda: "".join(rng.choice("aeioutnrsl") for _ in range(rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        words = [word() for _ in range(rng.randint(20, 80))]
        rows.append((i, " ".join(words) + "." if good else " ".join(w + rng.choice(["###", "%%%", "!!"]) for w in words)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark, make):
    rows, labels = quality_data(random.Random(1), 400)
    known = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_scores(make(rows), known).collect()}
    out = [i for i, _ in rows if got[i].held_out]
    assert 50 < len(out) < 150 and sum(got[i].predicted == labels[i][1] for i in out) / len(out) > 0.97
    # labels of held-out rows change nothing
    turned = spark.createDataFrame([(i, 1 - q if got[i].held_out else q, 0) for i, q, _ in labels], "doc_id long, quality int, toxic int")
    again = {r.doc_id: r.score for r in quality_scores(make(rows), turned).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-12 for i in got)
    kept = keep_good(make(rows), known)
    assert kept.columns == make(rows).columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i].predicted}


def test_quality_odd_rows(spark, make, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_scores(make([]), none).collect() == [] and keep_good(make([]), none).collect() == []
    got = quality_scores(make(odd_rows), none).collect()
    assert len(got) == len(odd_rows) and {r.score for r in got} == {0.5}
    assert len(text_features(b"")) == len(text_features(b"\n")) == len(FEATURES)


def test_held_out_rule(spark):
    import zlib

    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def secret_rows(rng, n):
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows, real = [], {}
    for i in range(n):
        words = [rng.choice(["donaudampfschifffahrt", "the", "house", "4111111111111111", "and"]) for _ in range(12)]
        if i % 4 == 0:
            real[i] = key()
            words.insert(5, f'token = "{real[i]}"')
        rows.append((i, " ".join(words)))
    return rows, real


def test_secrets(spark, make):
    rows, real = secret_rows(random.Random(2), 200)
    extra = "".join(random.Random(3).choices("0123456789abcdef", k=40))
    docs = make([*rows, (900, f'my password: "{extra}" keep it'), (901, None), (902, ""), (None, "é" + rows[0][1])])
    got = {r.doc_id: r for r in secrets.secret_report(docs).collect()}
    for i, text in rows:
        assert got[i].n_secrets == (i in real)
        if i in real:
            start, stop = map(int, got[i].spans.split(":"))
            assert text[start:stop] == real[i]
    assert got[900].n_secrets == 1 and got[901].n_candidates == got[902].n_candidates == 0
    assert got[None].n_secrets == 1
    cleaned = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert cleaned[0].text == rows[0][1].replace(real[0], "<secret>") and cleaned[0].n_chars == len(cleaned[0].text)
    assert cleaned[1].text == rows[1][1] and cleaned[901].text is None and cleaned[0].score == "x"


def test_long_credential_names(spark, make):
    """Names of 16 or more key characters are candidates themselves and still stand before their values."""
    rng = random.Random(8)
    key = lambda: "".join(rng.choice("0123456789abcdefABCDEF") for _ in range(40))
    forms = ["AWS_SECRET_ACCESS_KEY={}", '"aws_secret_access_key": "{}"', "DATABASE_PASSWORD='{}'", "GITHUB_ACCESS_TOKEN: {}"]
    rows, real = [], {}
    for i in range(120):
        words = [rng.choice(["donaudampfschifffahrt", "the", "house", "4111111111111111", "é"]) for _ in range(9)]
        if i % 2:
            real[i] = key()
            words.insert(4, forms[i // 2 % 4].format(real[i]))
        rows.append((i, " ".join(words)))
    want = sorted((m[0], t[max(0, m.start() - 40) : m.start()], t[m.end() : m.end() + 40]) for _, t in rows for m in regex.finditer(secrets.CANDIDATE, t))
    assert sorted(tuple(r)[:3] for r in secrets.findings(make(rows)).collect()) == want
    got = {r.doc_id: r for r in secrets.secret_report(make(rows)).collect()}
    for i, text in rows:
        assert [text[slice(*map(int, s.split(":")))] for s in got[i].spans.split(",") if s] == ([real[i]] if i in real else [])


def test_secrets_without_findings(spark, make):
    assert secrets.secret_report(make([])).collect() == []
    got = secrets.secret_report(make([(1, "word word"), (2, "0123456789abcdef0123")])).collect()
    assert sorted((r.doc_id, r.n_candidates) for r in got) == [(1, 0), (2, 1)]


def test_harmless_findings_stay(spark, make):
    """Commit hashes, checksums, identifiers and placeholders are no secrets; short assigned passwords are."""
    rng = random.Random(9)
    key = lambda n, of="0123456789abcdef": "".join(rng.choice(of) for _ in range(n))
    rows, real = secret_rows(rng, 120)
    harmless = [f"commit {key(40)}", f"sha256 checksum: {key(64)}", f"uuid {key(8)}-{key(4)}-{key(4)}-{key(4)}-{key(12)}", 'token = "your-api-key-goes-here-please"', 'password: "changeme-changeme"', "import src/internal/transport/handler"]
    for i in range(60):
        rows.append((1000 + i, f"some text {harmless[i % 6]} and more"))
    for i in range(12):
        real[2000 + i] = key(9, "abcdefghkmnpqr23456789!$%") + "7"
        rows.append((2000 + i, f"my password: {real[2000 + i]} keep"))
    got = {r.doc_id: r for r in secrets.secret_report(make(rows)).collect()}
    assert not any(got[i].n_secrets for i, _ in rows if 1000 <= i < 2000)
    found = {i: [t[slice(*map(int, s.split(":")))] for s in got[i].spans.split(",") if s] for i, t in rows}
    assert sum(found[i] == [real[i]] for i in real) >= 0.95 * len(real)


def test_held_out_findings(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    q = secrets.held_out_quality(docs).first()
    assert q.precision >= 0.9 and q.recall >= 0.9 and q.n_secret > 100 and q.n_harmless > 100, q


def findings_to_learn(spark):
    rng = random.Random(4)
    good = ["".join(rng.choice("0123456789abcdefABCDEF") for _ in range(32)) for _ in range(150)]
    bad = ["".join(rng.choice(["house", "tree", "water"]) for _ in range(5)) for _ in range(150)]
    rows = [(v, "key: ", " end", "a/b.py", k) for k, vs in ((1, good), (0, bad)) for v in vs]
    return spark.createDataFrame(rows, "value string, before string, after string, path string, label int")


FINDING = ("value", "before", "after", "path")


def test_forest_drops_false_positives(spark):
    """Labelled findings in the same surroundings: the forest has to go by the characters."""
    labelled = findings_to_learn(spark)
    forest, _ = secrets.train_forest(labelled.where("value not like '%7'"), ["house", "tree", "water"])
    judged = labelled.select("label", forest.score(*(F.col(c) for c in FINDING)).alias("s")).collect()
    assert np.mean([(r.s >= 0.5) == bool(r.label) for r in judged]) > 0.97


def test_forest_scores_are_the_models(spark):
    known = ["house", "tree", "water"]
    labelled = secrets.seeded(spark, 600).unionByName(findings_to_learn(spark))
    forest, model = secrets.train_forest(labelled, known)
    rows = secrets.measured(labelled, known)
    both = model.transform(rows).select(vector_to_array("probability")[1].alias("want"), forest.score(*(F.col(c) for c in FINDING)).alias("got")).collect()
    assert np.allclose([r.want for r in both], [r.got for r in both], atol=1e-9)


def test_one_class_and_features(spark):
    labelled = findings_to_learn(spark).where("label = 1")
    forest, model = secrets.train_forest(labelled, [])
    assert model is None and labelled.select(forest.score(*(F.col(c) for c in FINDING)).alias("s")).distinct().first().s == 1.0
    # the label's own rule is no feature
    assert not any("assigned" in f for f in secrets.FEATURES) and len(secrets.FEATURES) == len(secrets.measures(*(F.col(c) for c in FINDING), []))


def test_clashing_columns_are_kept(spark, make):
    docs = make([(1, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'), (2, None)]).withColumns({"__finds": F.lit(5), "__text": F.lit("own"), "candidates__": F.lit(1.5), "__runs": F.lit("r")})
    cleaned = secrets.redact(docs)
    assert cleaned.columns == docs.columns and {(r["__finds"], r["__text"], r["candidates__"], r["__runs"]) for r in cleaned.collect()} == {(5, "own", 1.5, "r")}
    assert "<secret>" in cleaned.where("doc_id = 1").first().text
    assert set(find_pii(docs).columns) == {*docs.columns, "pii"} and find_pii(docs).first()["__text"] == "own"
    items = spark.createDataFrame([(1, "no such words")], "item_id long, text string")
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.first()["__runs"] == "r"


CHAT = "conv_id long, turn long, role string, text string, start string, position int"


def rendered_by_hand(rows):
    out = {}
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is None, t or 0, r or "unknown", x or ""))
    for c, turns in convs.items():
        turns.sort()
        for p in {r for _, _, r, _ in turns if r != "system"}:
            text, masks = "", []
            for _, _, r, x in turns:
                text += "<|system|>\n" if r == "system" else "<|assistant|>\n" if r == p else f"<|user:{r}|>\n"
                if r == p:
                    masks.append((len(text), len(text) + len(x) + 8))
                text += x + "<|end|>\n"
            out[c, p] = (text, masks)
    return out


def test_every_speaker_as_assistant(spark):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["ann", "bob", "system", None, "zoë"]), rng.choice(["hi", "", None, "é" * 5])) for c in range(6) for t in range(rng.randint(1, 9))]
    rows += [(50, t, "ann" if t % 2 else "bob", f"m{t}") for t in range(900)]  # several blocks
    rows += [(51, 1, "ann", "same"), (51, 1, "ann", "same"), (51, None, "bob", "last"), (52, 0, "system", "alone")]
    seen = rotate_perspectives(spark.createDataFrame([(*r, "x", 0) for r in rows], CHAT)).collect()
    got = {}
    for r in sorted(seen, key=lambda r: (r.conv_id, r.perspective, r.position)):
        text, masks = got.get((r.conv_id, r.perspective), ("", []))
        assert r.start == len(text) and r.stop == r.start + len(r.rendered) and r.in_loss == (r.speaker == r.perspective)
        got[r.conv_id, r.perspective] = (text + r.rendered, [*masks, (r.mask_start, r.mask_stop)] if r.in_loss else masks)
        assert r.in_loss or r.mask_start == r.mask_stop == r.stop
    assert got == rendered_by_hand(rows)


def test_chat_odd_rows(spark):
    assert rotate_perspectives(spark.createDataFrame([], CHAT)).collect() == []
    rows = [(None, 0, "ann", "a", "x", 0), (None, 0, "bob", "b", "x", 0)]
    got = rotate_perspectives(spark.createDataFrame(rows, CHAT)).collect()
    assert [(r.conv_id, r.position) for r in got] == [(None, 0), (None, 0)]
