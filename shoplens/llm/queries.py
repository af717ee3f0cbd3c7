"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import (bpe, decontaminate, fingerprint, html_text, language_model, license, minhash, negatives, periodic, pieces,
                          quality, suffix, toxicity)
from shoplens.llm.common import ensure_checkpoint_dir, read

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document, learnt from those of remainder 0, 2, 3 and 4."""
    ensure_checkpoint_dir(spark)
    return language_model.score(read(spark, sf_dir, "documents").select("doc_id", "text"), toxicity.fold("doc_id") != 1)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    ensure_checkpoint_dir(spark)
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that start more than once, over all documents."""
    ensure_checkpoint_dir(spark)
    done = suffix.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return done.select("doc_id", F.col("repeat_bytes").alias("n_bytes"), F.col("repeat_removed").alias("n_removed"),
                       F.col("repeat_spans").alias("n_spans"), F.col("repeat_sha256").alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or its directory's.

    The table has no paths, so a document's path is source/lang/doc_id, and the first
    document (by id) of a directory that states a licence stands for its licence file.
    """
    ensure_checkpoint_dir(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"))
    done = license.scan(docs, is_license_file=F.lit(True), first_by="doc_id")
    return done.select("doc_id", "path", "own_license", F.round("own_score", 6).alias("own_score"), "license", "license_dir")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled rows of remainder 1 to 4."""
    ensure_checkpoint_dir(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    done = toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))
    return done.select("doc_id", (toxicity.fold("doc_id") == 0).alias("held_out"), F.col("toxicity").alias("score"),
                       (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    ensure_checkpoint_dir(spark)
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages, html_text.learn(pages), out="text").withColumn("n_chars", F.length("text").cast("long"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labelled rows of remainder 1 to 4."""
    ensure_checkpoint_dir(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    done = quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")))
    return done.select("doc_id", (toxicity.fold("doc_id") == 0).alias("held_out"), F.col("quality_score").alias("score"),
                       (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited form, and their likeness."""
    ensure_checkpoint_dir(spark)
    done = fingerprint.edited_fingerprints(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_chars", "edited_sha256", fingerprint.as_string(F.col("sketch")).alias("fingerprint"),
                       fingerprint.as_string(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    ensure_checkpoint_dir(spark)
    done = decontaminate.contaminated(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return done.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       "contaminated")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, as digests."""
    ensure_checkpoint_dir(spark)
    done = bpe.tokenize(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), digest_only=True)
    return done.select("doc_id", F.col("bpe_n").alias("n_tokens"), F.col("bpe_ids_sha256").alias("ids_sha256"),
                       F.col("bpe_text_sha256").alias("decoded_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, every seventh of which has the next label."""
    ensure_checkpoint_dir(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where of every tenth id (by hash) the words from some place on repeat a stretch.

    With n words, h the CRC of the id and g = h / 10: from word a = g % n on, the
    1 + (n - a) / (3 + g % 8) words from there repeat to the end.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    trimmed = F.regexp_replace("text", r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$", "")
    w = (docs.select("doc_id", "text", h.alias("h"))
         .withColumn("w", F.when((F.col("h") % 10 == 0) & (trimmed != ""), F.split(trimmed, r"[\x09-\x0D\x20]+")))
         .withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
         .withColumn("a", (F.col("g") % F.col("n")).cast("int"))
         .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")))
    rest = F.col("n") - F.col("a")
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    planted = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), rest))
    return w.select("doc_id", F.when(F.col("w").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some of which get one planted."""
    ensure_checkpoint_dir(spark)
    done = periodic.collapse_runs(with_planted_periods(read(spark, sf_dir, "documents")), digest=True)
    return done.select("doc_id", F.col("run_count").alias("n_runs"), F.col("run_start").alias("start"), F.col("run_length").alias("length"),
                       F.col("run_period").alias("period"), F.floor(1000 * F.col("run_length") / F.col("run_period")).alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text decoded from them, as digests."""
    ensure_checkpoint_dir(spark)
    done = pieces.tokenize(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model"),
                           digest_only=True)
    return done.select("doc_id", F.col("piece_n").alias("n_tokens"), F.col("piece_ids_sha256").alias("ids_sha256"),
                       F.col("piece_text_sha256").alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_score, op2_minhash_dedup, op3_suffix_dedup, op4_license_scan, op5_toxicity, op6_html_text,
                            op7_quality, op8_fingerprint, op9_bpe, op10_decontaminate,
                            op11_hard_negatives, op12_periodic_runs, op13_pieces)
}

ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL["op10_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bl AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bi AS (SELECT item, w, n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM bl),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM bi),
ns AS (SELECT DISTINCT n FROM bw),
di AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, ns WHERE len(w) >= n),
hits AS (SELECT doc_id, i, di.n, item FROM di JOIN bw ON bw.n = di.n AND bw.win = array_to_string(w[i:i + di.n - 1], ' ')),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLE_SQL["op11_hard_negatives"] = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS aid, a.label = r.label AS same, r.vec_id AS id, CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
  FROM r a, r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT aid, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY aid ORDER BY score DESC, id) <= 5)
SELECT p.aid AS anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.aid, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.aid = p.aid AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5"""
