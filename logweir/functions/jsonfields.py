"""Strict JSON access on top of VARIANT, without Python UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sealed_parse(text: Column) -> Column:
    """Parse ``text`` together with its own hash, as ``{"v": <text>, "h": <hash>}``.

    ``try_parse_json`` stops at the end of the first value and ignores whatever follows it.
    The hash behind the text makes trailing content visible: see ``intact``. Invalid JSON and
    duplicate object keys give NULL.
    """
    return F.try_parse_json(F.concat(
        F.lit('{"v":'), text, F.lit(',"h":'), F.xxhash64(text).cast("string"), F.lit("}")))


def sealed_shape(shape: str) -> str:
    """The shape of a sealed value whose content has the given shape."""
    return f"OBJECT<h: BIGINT, v: {shape}>"


def sealed_hash(sealed: Column) -> Column:
    return F.try_variant_get(sealed, "$.h", "bigint")


def text_of(sealed: Column, field: str) -> Column:
    """A field of the content as text: strings as they are, other values as JSON, else NULL."""
    return F.try_variant_get(sealed, f"$.v.{field}", "string")


def kind(sealed: Column, field: str | None = None) -> Column:
    """Type name of the content or of one field of it.

    NULL if absent, VOID for JSON null, else STRING, BIGINT, OBJECT<..> and so on.
    """
    path = "$.v" if field is None else f"$.v.{field}"
    return F.schema_of_variant(F.try_variant_get(sealed, path, "variant"))


def intact(digest: Column, shape: Column, content: Column, text: Column) -> Column:
    """Whether ``text`` is exactly one JSON value, with nothing before or behind it.

    ``digest``, ``shape`` and ``content`` are the sealed value's hash, its type name and that of
    its content.
    """
    sealed_content = F.concat(F.lit("OBJECT<h: BIGINT, v: "), content, F.lit(">"))
    return F.coalesce((digest == F.xxhash64(text)) & (shape == sealed_content), F.lit(False))


# RFC 3339 date-time with a mandatory zone. try_to_timestamp alone accepts '2025'.
_RFC3339 = r"\A\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})\z"


def rfc3339(text: Column) -> Column:
    """Instant of an RFC 3339 text, NULL if it is not one or not a real date."""
    return F.when(text.rlike(_RFC3339), F.try_to_timestamp(F.upper(text)))


def computed_once(df: DataFrame, kept: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    """``kept`` columns of ``df`` plus ``columns``, which later filters will not recompute.

    Catalyst pushes a filter through projections by repeating the projected expressions below
    it, so a filter on a parsed field would parse every message again. It does not push through
    a generator, hence the ``inline`` of a one-element array.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))


def with_fields(df: DataFrame, source: str, fields: Sequence[str]) -> DataFrame:
    """Add top-level fields of the JSON in ``source`` as text columns, NULL if there are none."""
    text = F.col(source).cast("string")
    parsed = df.withColumn("_sealed", sealed_parse(text)).withColumn(
        "_content", F.when(
            intact(sealed_hash(F.col("_sealed")), F.schema_of_variant("_sealed"),
                   kind(F.col("_sealed")), text),
            F.col("_sealed")))
    return computed_once(parsed, df.columns, [text_of(F.col("_content"), f).alias(f) for f in fields])
