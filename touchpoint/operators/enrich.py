"""Enrichment through remote services: embeddings, generated text, id lookups.

Clients are injected. Spark decides which rows a task sends; a client only answers one batch.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, FloatType, IntegerType, StringType, StructField, StructType

from touchpoint.operators.inflight import bounded, in_order
from touchpoint.operators.reports import batch_size
from touchpoint.schemas import EMBEDDING_DIM

# Texts in a service's answer that mean "this text cannot be embedded".
UNUSABLE_TEXTS_ANY_CASE = ("token count", "input token", "empty")

RECEIPT_FALLBACK = "Transaction: {description}"
PROFILE_FALLBACK = "Hi, I'm {name}. I enjoy exploring new experiences and connecting with others."

Embedder = Callable[[list[str]], list[list[float]]]
TextClient = Callable[[dict], str | None]
StatusClient = Callable[[str], int | None]


class RefusedText(Exception):
    """A service refused a request because of its text."""


@lru_cache(maxsize=1 << 18)
def _slot(token: str, dim: int) -> int:
    return int.from_bytes(hashlib.md5(token.encode()).digest()[:4], "big") % dim


class HashingEmbedder:
    """Offline stand-in for an embedding service: hashed token counts, scaled to length one."""

    def __init__(self, dim: int = EMBEDDING_DIM):
        self.dim = dim

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        vectors = []
        for text in texts:
            tokens = Counter(text.split(" "))
            tokens.pop("", None)
            if not tokens:
                raise RefusedText("text content is empty")
            slots = [_slot(token, self.dim) for token in tokens]
            counts = np.bincount(slots, weights=list(tokens.values()), minlength=self.dim)
            vectors.append((counts / np.linalg.norm(counts)).astype("float32"))
        return vectors


def _refused(error: Exception) -> bool:
    return isinstance(error, RefusedText) and any(t in str(error).lower() for t in UNUSABLE_TEXTS_ANY_CASE)


def _embed_batch(texts: list[str], client: Embedder) -> list[list[float] | None]:
    """Vectors of a batch; when the service refuses it, text by text, None for the refused ones."""
    try:
        return list(client(texts))
    except RefusedText as error:
        if not _refused(error):
            raise
    answers: list[list[float] | None] = []
    for text in texts:
        try:
            answers.append(client([text])[0])
        except RefusedText as error:
            if not _refused(error):
                raise
            answers.append(None)
    return answers


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Re-cut the Arrow batches of a task into service batches; only the last one is short."""
    pending: list[pa.RecordBatch] = []
    held = 0

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(pending).combine_chunks().to_batches()[0]

    for batch in batches:
        start = 0
        while held + batch.num_rows - start >= size:
            stop = start + size - held
            pending.append(batch.slice(start, stop - start))
            yield whole()
            pending, held, start = [], 0, stop
        if start < batch.num_rows:
            pending.append(batch.slice(start))
            held += batch.num_rows - start
    if pending:
        yield whole()


def _with_column(batch: pa.RecordBatch, name: str, values: list, kind: pa.DataType) -> pa.RecordBatch:
    """The batch with one more column; the others are passed on as they came."""
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, kind)], [*batch.schema.names, name])


def embed_rows(
    df: DataFrame, text: str, client: Embedder, size: int = 35, parallelism: int | None = None, window: int = 1
) -> DataFrame:
    """Add ``embedding``; it is null for texts the service refused, so that they can be reported.

    ``parallelism`` bounds the calls in flight in all, ``window`` those of a task; without ``parallelism`` the input's
    partitioning is kept. With a window above 1 the client must be safe to call from several threads.

    Blank texts and known keys should be filtered out before: Spark does not move filters below
    this step. Any other failure of the service fails the task, which Spark retries.
    """
    size = batch_size(size)
    schema = StructType(df.schema.fields + [StructField("embedding", ArrayType(FloatType()), True)])

    df, window = bounded(df, parallelism, window)

    def embedded(chunk: pa.RecordBatch) -> pa.RecordBatch:
        texts = chunk.column(chunk.schema.get_field_index(text)).to_pylist()
        return _with_column(chunk, "embedding", _embed_batch(texts, client), pa.list_(pa.float32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_order(embedded, _chunks(batches, size), window)

    return df.mapInArrow(run, schema)


def embedded_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("embedding").isNotNull())


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so small that answers are passed on while others are still asked for."""
    rows = max(64, 4 * window)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def generate_text(
    df: DataFrame, client: TextClient, fallback: str, out: str = "body", parallelism: int | None = None, window: int = 1
) -> DataFrame:
    """Add a text per row from a client; a blank answer or a failed call gives the fallback text.

    ``fallback`` is a format string over the row's columns. ``parallelism`` bounds the calls in
    flight in all, ``window`` those of a task; without ``parallelism`` the partitioning of the input is kept. With a window
    above 1 the client must be safe to call from several threads.
    """
    df, window = bounded(df, parallelism, window)
    schema = StructType(df.schema.fields + [StructField(out, StringType(), True)])

    def one(row: dict) -> str:
        try:
            answer = client(row)
        except (OSError, ValueError, KeyError):
            answer = None
        return answer.strip() if answer and answer.strip() else fallback.format(**row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, window):
            yield _with_column(piece, out, list(in_order(one, piece.to_pylist(), window)), pa.string())

    return df.mapInArrow(run, schema)


def template_text(df: DataFrame, fallback: str, out: str = "body") -> DataFrame:
    """The fallback text for every row, as a plain expression; null when a named column is null."""
    pieces = []
    for literal, field in _format_parts(fallback):
        pieces += [F.lit(literal)] if literal else []
        pieces += [F.col(field).cast("string")] if field else []
    return df.withColumn(out, F.concat(*pieces))


def _format_parts(template: str) -> list[tuple[str, str | None]]:
    from string import Formatter

    return [(literal, field) for literal, field, _, _ in Formatter().parse(template)]


def lookup_status(df: DataFrame, key: str, client: StatusClient, parallelism: int | None = None, window: int = 1) -> DataFrame:
    """Ask a service about every key: (key, status, ok). No status, or a failed call, is not ok.

    ``parallelism`` bounds the calls in flight in all, ``window`` those of a task; without ``parallelism`` the partitioning of the
    input is kept. With a window above 1 the client must be safe to call from several threads.
    """
    keys, window = bounded(df.select(F.col(key).cast("string").alias(key)), parallelism, window)
    schema = StructType(
        [
            StructField(key, StringType(), True),
            StructField("status", IntegerType(), True),
            StructField("ok", BooleanType(), False),
        ]
    )

    def one(value: str) -> int | None:
        try:
            return client(value)
        except (OSError, ValueError, KeyError, TypeError):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, window):
            status = pa.array(list(in_order(one, piece.column(0).to_pylist(), window)), pa.int32())
            yield pa.RecordBatch.from_arrays([piece.column(0), status, status.is_valid()], [key, "status", "ok"])

    return keys.mapInArrow(run, schema)
