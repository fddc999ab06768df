"""Suffix-array deduplication of bytes by prefix-free parsing.

A rolling hash triggers phrase ends: in every string of ``LENGTH`` bytes the run of ``TRIGGER``
bytes with the smallest hash ends one phrase and starts the next. The dictionary holds each distinct
phrase end with what follows it once, however often it occurs, with the smallest document that has
it. Strings are ordered by two ranks, that of the phrase suffix before the trigger in the
dictionary and that of what follows in the parse; equal pairs of ranks are equal strings.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from logweir.llm.sampled import Kind, repeats

LENGTH, TRIGGER = 50, 16


def _symbols(texts: list[str]):
    parts = [text.encode("utf-8", "surrogatepass") for text in texts]
    raw = b"".join(parts)
    return raw, _numbers(raw), np.fromiter(map(len, parts), np.int64, len(parts)), None


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8)


def _finish(doc_id, raw: bytes, removed: np.ndarray):
    if not removed.any():
        return doc_id, len(raw), 0, 0, raw
    runs = int(removed[:1].sum() + (removed[1:] & ~removed[:-1]).sum())
    return doc_id, len(raw), int(removed.sum()), runs, _numbers(raw)[~removed].tobytes()


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    trigger: int = TRIGGER) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept (binary): each text, as UTF-8, without the bytes of
    strings of ``length`` bytes that also start in a document with a smaller id.

    Ids are whole numbers. A text with a null id is neither changed nor compared; rows with the
    same id are one document. Null texts are empty. One row for each row of ``docs``.
    """
    if not 0 < trigger <= length <= trigger + 62:
        raise ValueError("the trigger must be shorter than the string, by 62 bytes at most")
    kind = Kind(length, trigger, _symbols, _numbers, b"", ordered=True)
    id_type = docs.schema[id_col].dataType.simpleString()
    return repeats(docs, kind, id_col, text_col, _finish,
                   f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")
