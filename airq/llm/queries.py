"""The operators' registered queries and their DuckDB SQL.

Each query reads its whole table, applies its operator and derives the columns
its contract names.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from ..sources.tables import table
from . import curriculum, license_scan, mtree, ngram_join, onebit, pieces, ppm, resampling, spelling, token_counts, toxicity, warc, weak_rules
from .oracles import resampling_sql, spelling_sql, weak_rules_sql


def id_remainder(col: str, n: int):
    """crc32 of the id as text, modulo ``n`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))), F.lit(n))


def op1_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", F.col("id") % 50 == 0).drop("examined")


_MTREE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
      FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p) WHERE rank <= 5"""


def op2_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path(pieces.MODEL)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pieces.encode(docs, "doc_id", "text", model, round_trip=True).select(
        F.col("key").alias("doc_id"), "rank", "n_pieces", "log_prob", "gumbel", "log_inclusion", "round_trip", "ids")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text").withColumnRenamed("key", "doc_id")


def op4_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    folder = warc.archive_folder(spark)
    warc.write_monolithic(warc.mark_duplicates(pages, "page_id", "url", "html"), folder)
    rec = warc.read_records(warc.normalise(spark, folder))
    h, revisit = (lambda k: F.col("headers")[k]), F.col("headers")["WARC-Type"] == "revisit"
    # a response's size and digest come from the payload read back, a revisit's from its header
    return rec.select(
        h("X-Page-ID").cast("long").alias("page_id"),
        F.when(revisit, h("X-Payload-Length").cast("long")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.substring_index(h("WARC-Payload-Digest"), ":", -1)).otherwise(warc.sha1_base32(F.col("payload"))).alias("payload_digest"),
        h("WARC-Type").alias("record_type"), h("X-Refers-To-Page").cast("long").alias("refers_to"))


def _warc_sql() -> str:
    five = [f"('0x' || substr(h, {1 + 5 * k}, 5))::INTEGER" for k in range(8)]
    digest = " || ".join(f"substr('{warc.BASE32}', (({v} >> {s}) & 31) + 1, 1)" for v in five for s in (15, 10, 5, 0))
    return f"""WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS keeper FROM p)
SELECT page_id, n AS payload_bytes, {digest} AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to FROM g"""


def op5_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = materialize(ppm.score_documents(docs, "doc_id", "text", id_remainder("doc_id", 10) == 0), "ppm")
    t = scored.agg(F.sum("new_words").alias("v"), F.sum(F.when(~F.col("held_out"), F.col("n_words") + 1)).alias("n"),
                   F.count(F.when(~F.col("held_out"), 1)).alias("ends")).first()
    n, ends, v = t["n"] or 0, t["ends"] or 0, (t["v"] or 0) + (1 if t["ends"] else 0)
    n_tokens = F.col("n_words") + 1
    return scored.select(
        F.col("key").alias("doc_id"), "held_out", n_tokens.alias("n_tokens"),
        (F.col("n_known_words") + F.lit(1 if ends else 0)).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log10_counts") + F.log10(F.lit(ends + 0.1)) - n_tokens * F.log10(F.lit(n + 0.1 * (v + 1)))).alias("base_score"),
        F.col("log10_p").alias("score"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return (token_counts.count_tokens(docs, "doc_id", "text", public_tokenizers.path(token_counts.VOCABULARY))
            .withColumnRenamed("key", "doc_id"))


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    mixed = curriculum.mix(docs, "doc_id", "text", "source")
    return (mixed.select("doc_id", "size", "source_size", "target", "taken", "first_position",
                         F.get(F.col("passes"), F.lit(1))["position"].alias("second_position"))
            .orderBy("first_position", "doc_id"))


TOXIC_AT = 0.3


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    held_out = id_remainder("doc_id", 4) == 2
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic", ~held_out)
    return toxicity.score(docs, "text", model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return (ngram_join.similar_groups(docs, "doc_id", "text")
            .select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")))


def op9_onebit_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onebit.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", F.col("id") % 50 == 0).drop("examined")


def op11_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(F.col("key").alias("doc_id"), *weak_rules.COUNTS, failed.alias("base_failed"),
                         (~failed & (F.col("quality") >= weak_rules.KEEP_AT)).alias("kept"), F.round("quality", 4).alias("quality"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return spelling.variants(docs, "doc_id", "text").select("word", "form", "root", "n", "n_near", "form_n")


def op13_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    drawn = resampling.resample(docs, table(spark, sf_dir, "benchmark", "text"), "doc_id", "text", "text")
    return drawn.select(F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank")


def curriculum_sql(docs: str) -> str:
    """DuckDB SQL for `curriculum.mix` over a table or subquery."""
    values = ", ".join(f"({i}, {w!r}::DOUBLE, {b!r}::DOUBLE, {e!r}::DOUBLE)" for i, (w, (b, e)) in
                       enumerate(zip(curriculum.WEIGHTS, curriculum.SCHEDULES)))
    pos = """coalesce(2 * area{k} / nullif(b + sqrt(greatest(0.0, b * b + 2 * (e - b) * area{k})), 0), 0.0)"""
    return f"""
WITH rates(i, w, b, e) AS (VALUES {values}),
d AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size_,
        md5(concat('17|', coalesce(doc_id::VARCHAR, ''), '|', coalesce(source, ''), '|', coalesce(text, ''))) AS h FROM {docs}),
s AS (SELECT source AS src, sum(size_)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM d GROUP BY source),
c AS (SELECT s.*, w, b, e, source_size * {curriculum.CAP!r}::DOUBLE AS lim, sum(source_size) OVER () * {curriculum.TOTAL_RATIO!r}::DOUBLE AS demand
      FROM s JOIN rates ON n % {len(curriculum.WEIGHTS)} = i),
l AS (SELECT *, (demand - coalesce(sum(lim) OVER (ORDER BY lim / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
               / sum(w) OVER (ORDER BY lim / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM c),
t AS (SELECT *, least(lim, coalesce(max(CASE WHEN lvl * w <= lim THEN lvl END) OVER () * w, lim)) AS target FROM l),
a AS (SELECT d.*, t.source_size, t.target, t.b, t.e, floor(t.target)::BIGINT AS goal,
        coalesce(sum(size_) OVER (PARTITION BY d.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a1
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.src),
q AS (SELECT *, greatest(0, least(goal - a1, size_)) AS t1, greatest(0, least(goal - a1 - source_size, size_)) AS t2,
        ((b + e) / 2 * a1::DOUBLE) / nullif(target, 0) AS area1, ((b + e) / 2 * (a1 + source_size)::DOUBLE) / nullif(target, 0) AS area2 FROM a)
SELECT *, (t1 + t2)::BIGINT AS taken_,
  CASE WHEN t1 > 0 THEN {pos.format(k=1)} END AS p1, CASE WHEN t2 > 0 THEN {pos.format(k=2)} END AS p2 FROM q"""


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a
    cluster installs it there or gets it by --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, env.get("PYTHONPATH")) if p)


ARROW_BYTES = 8 << 20
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts go to and from Python workers in Arrow batches of about ``ARROW_BYTES`` (Spark's
    default of 10,000 rows and 64 MB is held several times over, in the JVM and in
    the worker).  A limit that the application was configured with stays."""
    if not spark.sparkContext.getConf().contains(_ARROW_LIMIT):
        spark.conf.set(_ARROW_LIMIT, str(ARROW_BYTES))


def registered(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        share_code(spark)
        return fn(spark, sf_dir)

    return run


QUERIES = {f.__name__: registered(f) for f in (op1_mtree_topk, op2_gumbel_pieces, op3_license_scan, op4_warc_normalise, op5_ppm_score, op6_token_counts, op7_curriculum_mix, op8_toxicity, op9_onebit_ann, op10_ngram_jaccard, op11_weak_rules,
                                                   op12_spelling_variants, op13_importance_draw)}
ORACLE: dict[str, str] = {
    "op1_mtree_topk": _MTREE_SQL,
    "op4_warc_normalise": _warc_sql(),
    "op11_weak_rules": weak_rules_sql(),
    "op12_spelling_variants": spelling_sql(),
    "op13_importance_draw": resampling_sql(),
    "op7_curriculum_mix": "SELECT doc_id, size_ AS size, source_size, target, taken_ AS taken, p1 AS first_position, p2 AS second_position "
                          f"FROM ({curriculum_sql('documents')})",
}
