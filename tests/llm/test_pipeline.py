import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from shelfwise.llm.queries import ORACLES, QUERIES  # noqa: E402

from .test_decontaminate import brute as contaminated  # noqa: E402
from .test_jaccard import shingles  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_their_promises(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = [docs]
    for _, function in corpus_pipeline.STAGES[:-1]:
        kept.append(function(spark, kept[-1], SMALL).cache())
        assert kept[-1].columns == docs.columns
    quality, unique, clean, safe = ({r.doc_id: r.text for r in k.collect()} for k in kept[1:])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert all(i not in quality for i, q in labels.items() if q == 0) and sum(i in quality for i, q in labels.items() if q) > 0.95 * sum(labels.values())
    # one of each group: what went is connected to something that stayed, and what stayed is not alike
    sets = {i: shingles(t, 5) for i, t in quality.items()}
    alike = lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    assert not any(alike(a, b) for a in unique for b in unique if a < b and sets[a] and sets[b])
    assert all(any(alike(a, b) for b in quality if b < a) for a in quality if a not in unique)
    for i, text in unique.items():
        n, hit, _, _, found = contaminated(text, items)
        if not found:
            assert clean[i] == text
        elif hit > n / 2:
            assert i not in clean
        else:
            assert len(clean[i]) < len(text)
    assert all("<secret>" in safe[i] or safe[i] == clean[i] for i in clean) and safe.keys() == clean.keys()
    mixed = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SMALL).collect()
    assert {r.doc_id for r in mixed} <= set(safe) and all(0 < r.copies <= 3 for r in mixed)


def test_one_row_stays_of_repeated_rows(spark, make, odd_rows):
    got = corpus_pipeline.near_duplicate_stage(spark, make(odd_rows), SMALL)
    rows = sorted((r.doc_id or 0, r.text or "") for r in got.collect())
    assert rows == sorted({(i or 0, t or "") for i, t in odd_rows}) and got.columns == make([]).columns


def test_whole_pipeline_on_odd_tables(spark, make, odd_rows, monkeypatch, tmp_path):
    """Empty, null and clashing tables go through all stages."""
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "a passage of the benchmark that is long enough to be found"), (None, None)], "item_id long, text string")
    monkeypatch.setattr(corpus_pipeline, "QUALITY", 0.4)
    for name, rows in (("none", []), ("odd", odd_rows)):
        given = {"documents": make(rows).withColumns({"__row": F.lit(1), "__text": F.lit("own")}), "labels": none, "benchmark": items}
        for k, df in given.items():
            df.write.parquet(str(tmp_path / name / f"{k}.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert len(out) <= len(rows) and all(0 < r.copies <= 3 for r in out)


def test_names():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES if n != "pipeline"} and set(ORACLES) < set(QUERIES)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
