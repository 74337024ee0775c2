"""One query per operator over the given tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelens.llm.byte_bpe import ByteBpe
from gripelens.llm import decontaminate, edit_fingerprint, html_text, merkle, secrets, toxicity
from gripelens.llm.line_dedup import LineDedup
from gripelens.llm.merkle_sql import merkle_sql
from gripelens.llm.metric_tree import MetricIndex, whole
from gripelens.llm.near_dedup import NearDedup
from gripelens.llm.periodic_runs import periodic_runs
from gripelens.llm.token_counts import length_histogram, length_table
from gripelens.llm.training_order import TrainingOrder
from gripelens.runtime import lookup_join, materialise


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one (Jaccard 0.9)."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return LineDedup(percent=90).run(docs)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: 3-word shingles, Jaccard 0.85."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return NearDedup(width=3, percent=85).run(docs)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the passage."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, _table(spark, sf_dir, "benchmark"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "html")
    return html_text.extract(pages).select("page_id", F.length("text").cast("bigint").alias("n_chars"), "text")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labelled rows that are not held out."""
    docs, labels = toxicity.read_tables(spark, sf_dir)
    model = toxicity.train(docs, labels)
    held_out = F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False))
    return model.score(docs.select("doc_id", "text")).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        "log_ratio",
    )


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as shards of 512 sequences of 2,048 token ids in training order."""
    docs = _table(spark, sf_dir, "documents").select("text")
    return TrainingOrder(ByteBpe.load(vocabulary()), end_id=50256).shards(docs)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes the ids, and digests both."""
    bpe = ByteBpe.load(vocabulary())
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.encode(docs, decoded_col="decoded")
    listed = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector with all others."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", whole(F.col("embedding")).alias("vector"))
    index = MetricIndex.build(vectors)
    return index.search(vectors.where(F.col("vec_id") % 20 == 0), 20)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of encoded lengths of all documents, with the totals of every limit."""
    bpe = ByteBpe.load(vocabulary())
    docs = _table(spark, sf_dir, "documents").select("text")
    histogram = length_histogram(bpe.encode(docs, ids_col=None))
    return length_table(materialise(histogram, "lengths"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base finds, and runs that look random."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = secrets.train(secrets.samples(docs))
    return secrets.scan(docs, ratios).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.array_join("base_spans", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"),
        "n_random",
    )


def _checksum(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents by source; every fifth text is tampered with and its proof folded."""
    docs = _table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = _checksum(F.col("doc_id")) % 5 == 0
    leaves = docs.select(
        "doc_id",
        "source",
        merkle.row_digest(*fields, F.col("text")).alias("leaf"),
        F.when(hit, merkle.row_digest(*fields, lowered)).alias("altered"),
    )
    proved = merkle.prove(leaves, group="source", key="doc_id", carry=("altered",))
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("proof"))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def repeated_in_part(doc_id: Column, text: Column) -> Column:
    """The text; of every tenth document (by checksum) with its end made periodic."""
    h = _checksum(doc_id)
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = F.lit(1) + F.floor((n - a) / (g % 8 + 3)).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    body = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    altered = F.array_join(F.concat(F.slice(words, F.lit(1), a), body), " ")
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), altered).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of which are made periodic in part."""
    docs = _table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", repeated_in_part(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(texts).drop("text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("fine"))))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best")["before"]).alias("start"),
        F.col("best")["length"].alias("length"),
        (-F.col("best")["fine"]).alias("period"),
        F.floor(F.lit(1000) * F.col("best")["length"] / -F.col("best")["fine"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, their likeness, and the first of all
    documents whose fingerprint is near its own."""
    beside = edit_fingerprint.beside_next(_table(spark, sf_dir, "documents"))
    near = edit_fingerprint.near_first(beside.select("doc_id", "fingerprint"))
    near = materialise(near.where("n_docs > 1 OR near_id < doc_id").select("fingerprint", "near_id"), "near-first")
    return lookup_join(beside, near, "fingerprint", "left", spread_by="doc_id").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        edit_fingerprint.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        edit_fingerprint.likeness("fingerprint", "next_fingerprint").alias("near_next"),
        F.coalesce("near_id", "doc_id").alias("near_id"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_html_text": op4_html_text,
    "op5_toxicity": op5_toxicity,
    "op6_training_order": op6_training_order,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_exact_topk": op8_exact_topk,
    "op9_token_counts": op9_token_counts,
    "op10_secrets": op10_secrets,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_edit_fingerprints": op13_edit_fingerprints,
}

# Brute force over all pairs of distinct word sets whose sizes allow a match.
LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS value,
         unnest(range(len(string_split(text, chr(10))))) AS line
  FROM documents),
sets AS (
  SELECT doc_id, line, value,
         list_sort(list_filter(list_distinct(regexp_split_to_array(lower(value), '\s+')), lambda w: w <> '')) AS words
  FROM lines),
classes AS (
  SELECT words, len(words) AS n, min((doc_id, line)) AS first FROM sets WHERE len(words) > 0 GROUP BY words),
near AS (
  SELECT DISTINCT a.words FROM classes a JOIN classes b
    ON b.n BETWEEN (a.n * 90 + 99) // 100 AND a.n * 100 // 90 AND b.first < a.first
  WHERE a.n >= 9 AND 100 * len(list_intersect(a.words, b.words)) >= 90 * (a.n + b.n - len(list_intersect(a.words, b.words)))),
marked AS (
  SELECT s.doc_id, s.line, s.value,
         c.words IS NOT NULL AND (n.words IS NOT NULL OR c.first <> (s.doc_id, s.line)) AS gone
  FROM sets s LEFT JOIN classes c ON s.words = c.words LEFT JOIN near n ON s.words = n.words)
SELECT doc_id, coalesce(string_agg(value, chr(10) ORDER BY line) FILTER (NOT gone), '') AS text,
       CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed
FROM marked GROUP BY doc_id
"""

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vector, c.vector) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP_SQL,
    "op8_exact_topk": TOP_K_SQL,
    "op11_merkle_manifest": merkle_sql(),
}
