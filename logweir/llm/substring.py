"""Substring deduplication by prefix-partitioned suffix trees over words.

Suffixes start at sampled words. Their prefixes of ``PREFIX`` words split them into groups: a
prefix that occurs once is a leaf and is dropped; a group that fits into memory becomes a subtree,
grown word by word; a crowded prefix is lengthened to the whole window, so that its suffixes fall
into groups of their own. Nodes at least a window deep, counting what agrees in front of the
sample, with more than one suffix below them are the repeats.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from logweir.llm.common import ascii_words
from logweir.llm.sampled import Kind, repeats

WINDOW, PREFIX = 35, 12


def _symbols(texts: list[str]):
    parts = [ascii_words(text) for text in texts]
    words = [word for part in parts for word in part]
    symbols = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    offset = np.r_[0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]
    return b" ".join(words), symbols, np.fromiter(map(len, parts), np.int64, len(parts)), offset


def _numbers(raw: bytes) -> np.ndarray:
    vocabulary: dict[bytes, int] = {}
    return np.array([vocabulary.setdefault(w, len(vocabulary)) for w in raw.split(b" ")], np.uint32)


def _finish(doc_id, raw: bytes, removed: np.ndarray):
    kept = b" ".join(compress(raw.split(b" "), (~removed).tolist())) if removed.any() else raw
    return doc_id, len(removed), int(removed.sum()), kept.decode("utf-8", "surrogatepass")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    prefix: int = PREFIX) -> DataFrame:
    """id, n_words, n_removed, kept: each text without the words of repeated windows.

    A window is ``window`` words in a row of one text; it is repeated if its words also start at
    any other place of any text, the same included. Kept words are joined by one space. One row
    for each row of ``docs``; ids may be null or repeat. Null and empty texts have no words, texts
    shorter than a window keep all. Equal rows are places of their own, so they repeat each other.
    """
    if not 0 < prefix <= window <= prefix + 62:
        raise ValueError("the prefix must be shorter than the window, by 62 words at most")
    kind = Kind(window, prefix, _symbols, _numbers, b" ", ordered=False)
    id_type = docs.schema[id_col].dataType.simpleString()
    return repeats(docs, kind, id_col, text_col, _finish, f"id {id_type}, n_words long, n_removed long, kept string")
