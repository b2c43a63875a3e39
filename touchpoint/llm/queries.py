"""Registered queries of the numbered operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpoint.llm import decontaminate, html, importance, jaccard, licenses, lm, negatives, neighbours, packing, quality, substrings, suffixes, tokens
from touchpoint.session import bound_batches, ship_package, use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL that checks it where SQL can express it."""

    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(use_utc(ship_package(spark)), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sets of 4-word shingles share 85 %, as components."""
    rows, _ = jaccard.similar_classes(table(bound_batches(spark), sf_dir, "documents"), percent=85, k=4)
    return rows.select("doc_id", "n_shingles", "component_id")


@query("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of documents covered by a 200-byte string that starts at several places."""
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=200)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality.train(docs, table(spark, sf_dir, "labels").where(~quality.held_out()))
    scored = quality.score(docs, trees).withColumn("held_out", quality.held_out())
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op6_decontaminate")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items of which a document has 80 % of the 5-word shingles."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_pack")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context_size", "step_id")


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query("op9_licenses")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return licenses.summarize(licenses.scan(table(spark, sf_dir, "documents")))


@query("op10_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors by cosine of every vector whose id is divisible by 50."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op4_html_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html.main_text(pages, html.train(pages))


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the unigram vocabulary of the public 32k pieces."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query("op2_near_passages")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that occur in another document with 80 % of their 5-word shingles."""
    return substrings.near_passages(table(bound_batches(spark), sf_dir, "documents"))


#: Words as letters, digits and everything outside ASCII, of a lower-cased text.
WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
WITH RECURSIVE crc_steps AS (
    SELECT range AS byte, range::BIGINT AS value, 0 AS step FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN value % 2 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1 FROM crc_steps WHERE step < 8
), crc_table AS (
    SELECT list(value ORDER BY byte) AS crc FROM crc_steps WHERE step = 8
), doc_words AS (
    SELECT doc_id, {WORDS_SQL} AS words FROM documents
), doc_features AS (
    SELECT doc_id, unnest(words) AS word FROM doc_words
), target_features AS (
    SELECT unnest({WORDS_SQL}) AS word FROM benchmark
), hashed AS (
    SELECT word, hex(encode(word)) AS digits FROM (SELECT word FROM doc_features UNION SELECT word FROM target_features)
), bucketed AS (
    SELECT word, xor(list_reduce(
        list_prepend(4294967295::BIGINT, [('0x' || substr(digits, 2 * i - 1, 2))::BIGINT for i in range(1, length(digits) // 2 + 1)]),
        lambda state, byte: xor(crc[(xor(state, byte) & 255) + 1], state >> 8)
    ), 4294967295) % 10000 AS bucket FROM hashed, crc_table
), source_counts AS (
    SELECT bucket, count(*) AS s FROM doc_features JOIN bucketed USING (word) GROUP BY bucket
), target_counts AS (
    SELECT bucket, count(*) AS t FROM target_features JOIN bucketed USING (word) GROUP BY bucket
), totals AS (
    SELECT (SELECT count(*) FROM doc_features)::DOUBLE AS all_s, (SELECT count(*) FROM target_features)::DOUBLE AS all_t
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
    FROM source_counts LEFT JOIN target_counts USING (bucket), totals
), weights AS (
    SELECT doc_id, sum(gain)::BIGINT AS weight FROM doc_features JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT
        + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM doc_words LEFT JOIN weights USING (doc_id)
), placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END::BIGINT AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


@query("op11_resample", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by the importance of their words for the benchmark texts."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = """
WITH entries AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.vector, b.vector)::BIGINT AS score
    FROM entries a JOIN entries b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of the five best positives of every vector whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("id") % 100 == 0)


@query("op13_lm_score")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and base scores of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    scored = lm.score_documents(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
