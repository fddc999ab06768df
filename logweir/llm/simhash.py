"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, a check of the distance."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import ascii_words, stored
from logweir.llm.components import connected_components

BITS = 64
SEED = 42
#: Members up to which a bucket's pairs are compared one by one.
PAIRWISE = 64
_AT_ONCE = 1 << 16


def text_fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of one text, as a signed 64-bit number; 0 if it has no word."""
    words = ascii_words(None if text is None else text)
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words).lower()  # on bytes, lower() changes A-Z only
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), _AT_ONCE):
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED)
                           for a, b in zip(starts[i:i + _AT_ONCE], ends[i:i + _AT_ONCE])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash of the lower-cased word shingles of ``text``, repeats included."""
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return prints(text)


def block_masks(max_bits: int, blocks: int) -> list[int]:
    """Masks such that two fingerprints within ``max_bits`` agree under one at least.

    The bits are cut into ``blocks`` blocks; ``max_bits`` differing bits spoil as many at most, so
    the others agree. One mask for each choice of the blocks that stay.
    """
    if not 0 <= max_bits < blocks <= BITS:
        raise ValueError("there must be more blocks than differing bits")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _pairwise(members: DataFrame, max_bits: int) -> DataFrame:
    other = members.select("mask", "key", F.col("fp").alias("other"))
    return (members.select("mask", "key", "fp").join(other, ["mask", "key"])
            .filter((F.col("fp") < F.col("other")) & (_distance("fp", "other") <= max_bits))
            .select("fp", "other"))


def _crowded(members: DataFrame, masks: list[int], max_bits: int) -> DataFrame:
    """Links within crowded buckets that give the same components as all close pairs do.

    A fingerprint reaches every value within half of ``max_bits`` of it. Fingerprints that reach
    the same value are at most ``max_bits`` apart, and any pair so close meets in one value; so
    each value links its smallest fingerprint to the others, without comparing pairs. Only bits
    outside the bucket's mask can differ, which bounds the values of a fingerprint and the
    fingerprints of a value alike.
    """
    def reach(mask: int) -> list[int]:
        free = [1 << bit for bit in range(BITS) if not mask >> bit & 1]
        return [0] + [_signed(sum(c)) for r in range(1, max_bits // 2 + 1) for c in combinations(free, r)]

    flips = members.sparkSession.createDataFrame([(i, reach(mask)) for i, mask in enumerate(masks)], "mask int, flips array<long>")
    met = (members.join(F.broadcast(flips), "mask").select("fp", F.explode("flips").alias("flip"))
           .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
           .groupBy("value").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1))
    return (met.select(F.array_min("fps").alias("fp"), F.explode("fps").alias("other"))
            .filter("fp < other"))


def close_links(prints: DataFrame, max_bits: int = 2, blocks: int = 5) -> DataFrame:
    """fp, other: links whose components are those of all fingerprints within ``max_bits``.

    ``prints`` has one column of distinct fingerprints. Buckets of up to ``PAIRWISE`` members are
    compared pair by pair; beyond that ``max_bits`` must be even, and members meet in the values
    between them (see ``_crowded``), which is exact and linear. More blocks make smaller buckets
    and more of them: the number of keys is the binomial of ``blocks`` over ``max_bits``.
    """
    if max_bits % 2:
        raise ValueError("an even number of bits is needed")
    masks = block_masks(max_bits, blocks)
    fp = prints.columns[0]
    keys = F.array(*(F.struct(F.lit(i).alias("mask"),
                              F.col(fp).bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
                     for i, m in enumerate(masks)))
    keyed = prints.select(F.col(fp).alias("fp"), F.explode(keys).alias("at")).select("fp", "at.*")
    shared = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(keyed.join(shared, ["mask", "key"]))
    return (_pairwise(members.filter(F.col("n") <= PAIRWISE), max_bits)
            .unionByName(_crowded(members.filter(F.col("n") > PAIRWISE), masks, max_bits)))


def classes(prints: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """fp, label: every distinct fingerprint with the smallest one it can reach."""
    distinct = prints.select("fp").distinct()
    labels = connected_components(close_links(distinct, max_bits, blocks))
    return distinct.join(labels, distinct.fp == labels.node, "left").select(
        "fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2, blocks: int = 5) -> DataFrame:
    """The id column, ``fp`` (long) and ``component_id``: the smallest id that can be reached.

    One row for each row of ``docs``. Texts without words, and null texts, have fingerprint 0 and
    are linked like others. A null id takes no part in the minimum; a component without any id
    has a null one. Ids may repeat. Other columns of ``docs`` are neither read nor returned.
    Exact copies meet in one fingerprint before anything is joined.
    """
    prints = stored(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")))
    member = stored(classes(prints, max_bits, blocks))
    lowest = prints.groupBy("fp").agg(F.min("id").alias("low")).join(member, "fp")
    named = member.join(lowest.groupBy("label").agg(F.min("low").alias("component_id")), "label")
    return prints.join(named.select("fp", "component_id"), "fp").select(
        F.col("id").alias(id_col), "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 3, max_bits: int = 2, blocks: int = 5) -> DataFrame:
    """``docs`` with one document of each group of ``near_duplicates``: the one with the smallest id.

    Null and wordless texts have fingerprint zero, so one of them stays. Ids that are null come
    last; rows without an id, or with the same one, are told apart by their texts. Rows that share
    id and text are one document, of which one row stays. Columns are those of ``docs``.
    """
    ident = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"),
                     F.coalesce(F.unhex(F.md5(F.col(f"`{text_col}`").cast("binary"))), F.lit(b"")).alias("digest"))
    keyed = docs.select(ident.alias("ident"), F.col(f"`{text_col}`").alias("text"))
    found = near_duplicates(keyed, "ident", "text", shingle, max_bits, blocks)
    mark = "_" + "_".join(docs.columns)
    first = found.filter(F.col("ident") == F.col("component_id")).select(F.col("ident").alias(mark)).distinct()
    return docs.withColumn(mark, ident).join(first, mark, "left_semi").dropDuplicates([mark]).drop(mark)


def hex_of(fp: Column) -> Column:
    """16 lower-case hexadecimal digits of a signed 64-bit number."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
