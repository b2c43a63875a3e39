"""Training-corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table; all but the last return the columns of ``docs``.
``run`` writes each stage's table to the shared folder and reads it again for the next.

Defined results: null texts count as empty. Empty documents are scored by the classifier like others, resemble
nothing, lose nothing, leak nothing and pack to the end token. Rows without a doc_id pass every filter but the
classifier. Repeated rows (one doc_id more than once) are reduced to one by the second stage. Columns beyond those
of ``documents`` are carried through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpoint.llm import decontaminate, jaccard, packing, quality, suffixes
from touchpoint.llm.queries import table, tokenizer_file
from touchpoint.llm.scratch import broadcast_if_few, written
from touchpoint.session import bound_batches, ship_package, use_utc

#: Score from which a document is kept.
GOOD = 0.3


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"{name}_"
    return name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled rows that are not held out."""
    bound_batches(use_utc(ship_package(spark)))
    trees = quality.train(docs, table(spark, sf_dir, "labels").where(~quality.held_out()))
    score = free_name(docs, "score")
    return quality.score(docs, trees, score).where(F.col(score) >= GOOD).select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group linked by 80 % of their 5-word shingles."""
    bound_batches(use_utc(ship_package(spark)))
    rows, _ = jaccard.similar_classes(docs, percent=80, k=5)
    rows = written(rows.select("doc_id", "component_id"), "groups")
    gone = written(rows.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    kept = docs.join(broadcast_if_few(gone), "doc_id", "left_anti").select(*docs.columns)
    again = written(rows.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "again")
    if again.isEmpty():
        return kept
    again = broadcast_if_few(again)
    single = kept.join(again, "doc_id", "left_anti").select(*docs.columns)
    return single.unionByName(kept.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"]))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of any 200-byte string that starts at several places of the corpus."""
    bound_batches(use_utc(ship_package(spark)))
    # The operator adds columns of its own; all but the two it reads travel in a struct, where no name can clash.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", *([F.struct(*others).alias("others")] if others else []))
    cut = suffixes.remove_repeats(packed)
    changed = F.col("n_removed") > 0
    columns = {c: F.col("others").getField(c) if c in others else F.col(c) for c in docs.columns}
    columns["text"] = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(changed, F.char_length("kept_text").cast("bigint")).otherwise(columns["n_chars"])
    return cut.select(*[column.alias(c) for c, column in columns.items()])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (80 % of its 5-word shingles)."""
    bound_batches(use_utc(ship_package(spark)))
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    bound_batches(use_utc(ship_package(spark)))
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", keep_distinct),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack),
]

#: The stages are no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i}")
    return docs
