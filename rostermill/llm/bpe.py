"""Encode texts to token ids and decode them, whole and byte for byte.

The merges are found by the segment tree of :mod:`.word_bpe`; Spark only
spreads the rows. There is no shuffle: a row's ids depend on its text alone.
"""

from __future__ import annotations

import ctypes
import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermill.llm import word_bpe

#: texts encoded at once in a task
ROWS = 400


def slices(batch: pa.RecordBatch, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that few texts are Python objects at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
    give_back()


def give_back() -> None:
    """Return free memory to the system. Worker processes outlive their task, and
    several stages' workers share an executor's memory."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: ``key``, ``n_tokens`` and ``ids`` (little-endian 16-bit numbers).

    Null and empty texts have no ids. Rows are independent: repeated keys,
    null keys and repeated texts give one row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.loaded(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids = bpe.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["key", "n_tokens", "ids"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n_tokens long, ids binary"
    ).withColumnRenamed("key", key)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """Per row: ``key`` and ``text``, the tokens of ``ids`` joined by spaces.

    The tokenizer file has no decoder, so this is what its library returns.
    Null ids give a null text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.loaded(tokenizer)
        for batch in batches:
            for part in slices(batch):
                texts = [None if x is None else bpe.decode(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(
        run, f"key {kind}, text string"
    ).withColumnRenamed("key", key)


def round_trip_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document.

    ``ids_sha256`` is taken over little-endian 32-bit ids, ``decoded_sha256``
    over the UTF-8 of the decoded text. Encoding and decoding run in the same
    pass, so ids never leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.loaded(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids = bpe.encode(part.column(1).to_pylist())
                wide = [word_bpe.wide(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) // 2 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in wide]),
                        pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
