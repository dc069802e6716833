"""Corpus pipeline: four stages over the documents table.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
Between stages the rows are written to the shared checkpoint folder as Parquet and
read back, so a lost executor costs one stage's work at most.

1. toxicity       documents scored 0.3 or more go
2. near_duplicates one document of each group of similar texts stays: the one with
                  the smallest (id, text hash); of equal rows one
3. mixing         documents the mix takes stay, once per pass, with their training
                  position and pass as further columns (a Parquet read promises no order)
4. segmentation   every remaining text as distinct sampled SentencePiece segmentations,
                  seeded by id and pass, with position and pass

Null ids: such documents pass the first stage by their score; in a group they count as
smaller than any id.  Null and empty texts pass the first two stages unless their
score says otherwise, have size 0 and so aren't taken by the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from airq.llm import curriculum, ngram_join, pieces, toxicity
from airq.llm.queries import TOXIC_AT, id_remainder, share_code, small_batches
from airq.session import materialize
from airq.sources.tables import table

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
ORDER = ("position", "pass")    # of a mixed document: its training position, and which pass over it this is


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    small_batches(spark)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic", id_remainder("doc_id", 4) != 2)
    return toxicity.score(docs.select(*DOCUMENT), "text", model).filter(F.col("score") < TOXIC_AT).drop("score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    small_batches(spark)
    h = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    # a document is its id and text: ids may repeat with other texts
    keyed = docs.select(F.struct("doc_id", h.alias("h")).alias("id"), "text")
    groups = materialize(ngram_join.similar_groups(keyed, "id", "text").select("key", "component"), "groups")
    per_key = groups.groupBy("key").agg(F.first("component").alias("component"), F.count(F.lit(1)).alias("rows"))
    marks = per_key.select(F.col("key.doc_id").alias("id_"), F.col("key.h").alias("h_"), (F.col("key") == F.col("component")).alias("stays"), "rows")
    # both written first, so that Spark knows their sizes when it plans the joins
    gone = materialize(marks.filter(~F.col("stays")), "dropped")
    again = materialize(marks.filter(F.col("stays") & (F.col("rows") > 1)), "repeated")
    rows = docs.select(*DOCUMENT)
    same = lambda t: F.col("doc_id").eqNullSafe(t["id_"]) & (h == t["h_"])
    rows = rows.join(gone, same(gone), "left_anti")
    # of equal rows one stays
    return rows.join(again, same(again), "left_anti").union(rows.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(docs.select(*DOCUMENT), "doc_id", "text", "source")
    return curriculum.in_training_order(mixed, "doc_id").select(*DOCUMENT, *ORDER)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    share_code(spark)
    small_batches(spark)
    model = public_tokenizers.path(pieces.MODEL)
    order = [c for c in ORDER if c in docs.columns]
    # a second pass over a document draws other segmentations than the first
    seed_by = tuple(c for c in order if c == "pass")
    return pieces.encode(docs, "doc_id", "text", model, keep={c: F.col(c) for c in order}, seed_by=seed_by).withColumnRenamed("key", "doc_id")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("mixing", mix_sources), ("segmentation", segment)]
ORACLE_SQL = None  # the stages' models and searches have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
