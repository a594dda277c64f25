"""From raw documents to a training mixture: five stages, each stored before the next reads it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import aside, row_id, stage, table, whole_text
from shelfwise.llm.decontaminate import decontaminate
from shelfwise.llm.jaccard_join import jaccard_classes
from shelfwise.llm.pareto_mix import by_length, mix_sources
from shelfwise.llm.quality_gam import keep_good
from shelfwise.llm.secrets import redact

#: Near duplicates share five-word shingles with a Jaccard similarity of at least this.
WIDTH, SIMILARITY = 5, "0.8"
QUALITY = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels"), QUALITY)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of least doc_id, then of least hash of the text.

    Rows alike in id and text are one document. Documents without words are in no group and stay.
    """
    found = stage(jaccard_classes(docs, WIDTH, SIMILARITY).select("rid", "row", "component"), "groups")
    first = found.where("component is not null").groupBy("component").agg(F.min(F.struct("rid", "row")).alias("first")).select("first.*")
    kept = first.unionByName(found.where("component is null").select("rid", "row")).distinct()
    docs, back = aside(docs)
    keyed = docs.withColumns({"__rid": row_id(), "__row": F.xxhash64(whole_text())}).dropDuplicates(["__rid", "__row"])
    return back(keyed.join(kept.toDF("__rid", "__row"), ["__rid", "__row"], "left_semi").select(*docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by a mark."""
    return redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the number of copies that the mixture takes of each."""
    return mix_sources(docs, preference=by_length).where("copies > 0")


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: SQL can't express the trained models; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
