"""Packing without padding or foreign context: documents in pieces of power-of-two lengths.

A document's length is a sum of powers of two, its binary digits; longest first, they cut it into
pieces. Each piece is a sequence of its own, in the bucket of its length, so that a batch drawn
from one bucket has no padding and no sequence shows a model two documents. Everything happens
where a document is read: nothing is shuffled, stored or sent to the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.bpe import ByteEncoder

CAPACITY = 1024
END_ID = 0
#: A sequence's number: the logarithm of its length above the task above the count within the task.
TASK_BITS, COUNT_BITS = 22, 36


@lru_cache(maxsize=1)
def encoder(path: str) -> ByteEncoder:
    """One encoder for each worker process, which serves one task after another."""
    return ByteEncoder(path)


def lengths(total: int, capacity: int) -> list[int]:
    """``total`` as a sum of powers of two of at most ``capacity``, longest first."""
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def sequence_number(length: int, task: int, count: int) -> int:
    """Distinct for each sequence; those of a bucket follow one another."""
    if task >> TASK_BITS or count >> COUNT_BITS:
        raise OverflowError("more tasks, or sequences of a task, than numbers")
    return (length.bit_length() - 1 << TASK_BITS | task) << COUNT_BITS | count


def bucketed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: the id column, start, length, doc_tokens, ids, sequence_id, offset.

    A document is the ids of its text and ``end_id``; null and empty texts are one id. ``start`` is
    the number of the document's ids before the piece, ``doc_tokens`` that of all its ids, ``ids``
    the piece itself as little-endian unsigned 32-bit numbers. A piece fills its sequence, so
    ``offset`` is 0 and ``length`` names the bucket. ``sequence_id`` orders by bucket. Ids may be
    null or repeat. Of ``docs`` only the id and the text are read. No rows: no rows.
    """
    if not 1 <= capacity < 1 << 31 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    end = int(end_id).to_bytes(4, "little")
    names = ("id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, task, seen = encoder(tokenizer_path), TaskContext.get().partitionId(), Counter()
        for frame in frames:
            out = []
            for key, text in zip(frame["id"].array, frame["text"]):
                ids, start = own.encode(text) + end, 0
                total = len(ids) // 4
                for n in lengths(total, capacity):
                    out.append((key, start, n, total, ids[4 * start:4 * (start + n)], sequence_number(n, task, seen[n]), 0))
                    seen[n] += 1
                    start += n
            if out:
                columns = dict(zip(names, zip(*out)))
                yield pd.DataFrame(columns | {"id": pd.Series(columns["id"], dtype=frame["id"].dtype)})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(cut, f"id {kind}, start long, length long, doc_tokens long, ids binary, sequence_id long, "
                                 "offset long").withColumnRenamed("id", id_col)


def write_buckets(sequences: DataFrame, path: str) -> None:
    """A folder for each length below ``path``, with the ids of its sequences in Parquet files."""
    sequences.write.partitionBy("length").parquet(path)
