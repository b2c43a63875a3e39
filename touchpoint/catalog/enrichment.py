"""Embeddings, generated text, remote lookups, vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query
from touchpoint.catalog.roles import table
from touchpoint.operators.enrich import (
    RECEIPT_FALLBACK, HashingEmbedder, RefusedText, embed_rows, generate_text, lookup_status, template_text,
)
from touchpoint.operators.similarity import cosine_topk
from touchpoint.operators.validate import status_split
from touchpoint.operators.vector_cells import CellIndex
from touchpoint.sources.tables import spread

REFUSED = "worthless"


class _ChoosyEmbedder(HashingEmbedder):
    """Refuses texts with a certain word, as a service refuses some texts."""

    def __call__(self, texts):
        if any(REFUSED in t for t in texts):
            raise RefusedText("the input token count exceeds the limit")
        return super().__call__(texts)


@query(
    "e01_embed",
    f"""WITH t AS (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS token FROM documents WHERE NOT contains(text, '{REFUSED}')),
    c AS (SELECT doc_id, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % 64 AS slot, count(*) AS n FROM t WHERE token <> '' GROUP BY ALL)
    SELECT doc_id, CAST(slot AS BIGINT) AS slot, n, CAST(64 AS BIGINT) AS dim FROM c
    UNION ALL SELECT doc_id, NULL, NULL, NULL FROM documents WHERE contains(text, '{REFUSED}')""",
)
def e01(spark, sf):
    """Vectors of all documents as (slot, count); a document the service refuses is one row of nulls."""
    rows = table(spark, sf, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("body"))
    vectors = embed_rows(spread(rows), "body", _ChoosyEmbedder(64))
    tokens = F.size(F.filter(F.split("body", " "), lambda t: t != ""))
    summed = F.aggregate("embedding", F.lit(0.0), lambda total, value: total + value)
    dim = F.when(F.col("embedding").isNotNull(), F.size("embedding").cast("bigint"))
    measured = vectors.select("doc_id", "embedding", dim.alias("dim"), (tokens / summed).alias("norm"))
    listed = measured.select("doc_id", "dim", "norm", F.posexplode_outer("embedding").alias("slot", "value"))
    count = F.round(F.col("value") * F.col("norm")).cast("bigint")
    return listed.where(F.col("value").isNull() | (F.col("value") != 0)).select("doc_id", F.col("slot").cast("bigint").alias("slot"), count.alias("n"), "dim")


@query(
    "e02_text_generate",
    """SELECT event_id AS id, CASE event_type WHEN 'click' THEN 'Bought by ' || user_id ELSE 'Transaction: ' || event_type END AS body, 'client' AS kind FROM events
    UNION ALL SELECT event_id, 'Transaction: ' || event_type, 'template' FROM events""",
)
def e02(spark, sf):
    def client(row: dict) -> str | None:
        if row["description"] == "error":
            raise ValueError("service unavailable")
        return f" Bought by {row['user_id']} " if row["description"] == "click" else "  "

    rows = roles.transactions(spark, sf).select("id", "description", "user_id")
    made = generate_text(rows, client, RECEIPT_FALLBACK)
    plain = template_text(rows, RECEIPT_FALLBACK)
    return made.select("id", "body", F.lit("client").alias("kind")).union(plain.select("id", "body", F.lit("template")))


@query(
    "e03_remote_lookup",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_id % 7 NOT IN (3, 5) AS ok,
      CASE WHEN event_id % 7 IN (3, 5) THEN 'failed' ELSE 'successful' END AS outcome FROM events""",
)
def e03(spark, sf):
    def client(key: str) -> int | None:
        if int(key) % 7 == 3:
            raise OSError("connection reset")
        return None if int(key) % 7 == 5 else 200

    answers = lookup_status(table(spark, sf, "events").select("event_id"), "event_id", client)
    return answers.select("event_id", "ok", status_split(F.col("status")).alias("outcome"))


_NEAREST = """SELECT query_id, neighbor_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS r FROM (
        SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id,
          round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) AS score
        FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id)) WHERE r <= 3"""


@query("e04_cosine_topk", _NEAREST)
def e04(spark, sf):
    return cosine_topk(_vectors(spark, sf), _vectors(spark, sf), 3, 64)


@query("e04_cells_topk", _NEAREST)
def e04_cells(spark, sf):
    """The same rows from the cell index, by its bound."""
    return CellIndex.build(_vectors(spark, sf)).search(_vectors(spark, sf), 3)


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
