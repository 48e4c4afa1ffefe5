"""Strict decoding of JSON object metadata, entirely in built-in expressions.

``from_json`` coerces (``{"bucket": 5}`` reads as ``"5"``, ``"1"`` as 1), so the
payload is parsed to a VARIANT and every field is type-tested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.functions.records import object_location
from ackline.params import MAX_OBJECT_SIZE, U64_MAX, positive

# Error texts by code. {field}, {actual} and {maximum} are filled in.
MESSAGES = {
    "missing_payload": "record payload is missing",
    "invalid_json": "object metadata is not valid JSON",
    "empty_field": "object metadata field `{field}` must not be empty",
    "null_character": "object metadata field `{field}` contains a null character",
    "empty_object": "object metadata field `size` must be greater than zero",
    "object_too_large": "object metadata size {actual} exceeds configured maximum {maximum}",
}

# The Unicode White_Space class, whole text.
BLANK = r"^\p{IsWhite_Space}*\z"

# How an unsigned number is written without fraction or exponent. A parsed number
# no longer shows that, the text of the top-level member does.
_PLAIN_DIGITS = r"^(0|[1-9][0-9]{0,19})\z"
# Parsing makes 0 of -0. With -1 in place of every -0 (inside texts it does no
# harm, they are not looked at) only a size of -0 becomes -1.
_NEGATIVE_ZERO = r"-0(?![0-9.eE])"


def is_empty_text(value: Column, reject_blank: bool) -> Column:
    """True for empty text and, if asked, for text of white space only."""
    empty = value == ""
    return (empty | value.rlike(BLANK)) if reject_blank else empty


def has_nul(value: Column) -> Column:
    """True if the text contains U+0000."""
    return F.contains(value, F.lit("\0"))


def _u64(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def _member(name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(F.col("_object"), f"$.{name}", kind)


def parse_metadata(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``bucket, object_key, size, etag`` and ``json_ok``.

    The four fields are null unless ``json_ok``: the payload is valid UTF-8, one
    JSON object and nothing else, with the required members of the right type.
    Unknown members are ignored; ``etag`` may be absent or null.
    """
    text = F.col(payload).cast("string")
    # Two wraps: try_parse_json alone accepts text after the first value, and
    # `{..}] x` still passes the array wrap while `{..}} x` passes the object one.
    parsed = (
        df.withColumn("_text", F.when(F.is_valid_utf8(text), text))
        .withColumn("_listed", F.try_parse_json(F.concat(F.lit("["), "_text", F.lit("]"))))
        .withColumn("_boxed", F.try_parse_json(F.concat(F.lit('{"v":'), "_text", F.lit("}"))))
        .withColumn("_object", F.try_variant_get("_listed", "$[0]", "variant"))
        .withColumn("_more", F.try_variant_get("_listed", "$[1]", "variant"))
        .withColumn("_size_type", F.schema_of_variant(_member("size")))
        .withColumn("_size", _member("size", "decimal(20,0)"))
        .withColumn("_size_text", F.from_json("_text", "size string")["size"])
        .withColumn("_etag_type", F.schema_of_variant(_member("etag")))
    )
    plain = F.col("_size_type") == "BIGINT"
    wide = F.col("_size_type").isin("DECIMAL(19,0)", "DECIMAL(20,0)")
    marked = F.try_parse_json(F.regexp_replace("_text", _NEGATIVE_ZERO, "-1"))
    negative_zero = F.when(
        F.contains("_text", F.lit("-0")) & (F.col("_size") == 0),
        F.coalesce(F.try_variant_get(marked, "$.size", "decimal(20,0)") == -1, F.lit(False)),
    ).otherwise(False)
    size_ok = (plain | wide) & ~negative_zero & F.col("_size_text").rlike(_PLAIN_DIGITS) & F.col("_size").between(_u64(0), _u64(U64_MAX))
    ok = (
        F.schema_of_variant("_object").startswith("OBJECT")
        & F.col("_more").isNull()
        & F.col("_boxed").isNotNull()
        & (F.schema_of_variant(_member("bucket")) == "STRING")
        & (F.schema_of_variant(_member("key")) == "STRING")
        & (F.col("_etag_type").isNull() | F.col("_etag_type").isin("VOID", "STRING"))
        & size_ok
    )
    checked = parsed.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    good = F.col("_ok")
    return _sealed(
        checked,
        df.columns,
        {
            "json_ok": good,
            "bucket": F.when(good, _member("bucket", "string")),
            "object_key": F.when(good, _member("key", "string")),
            "size": F.when(good, F.col("_size")),
            "etag": F.when(good, _member("etag", "string")),
        },
    )


def _sealed(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """Select ``keep`` and ``columns``, the latter through a one-row generator.

    The optimizer pushes filters below projections by repeating the projected
    expressions in them, and these are nested deeply. It does not push filters
    below a generator that makes their columns.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def rule_hits(max_object_size: int) -> list[tuple[str, str | None, Column]]:
    """The value rules in the order they are applied: (code, field, broken)."""
    bucket, key, etag, size = (F.col(c) for c in ("bucket", "object_key", "etag", "size"))
    return [
        ("empty_field", "bucket", is_empty_text(bucket, True)),
        ("null_character", "bucket", has_nul(bucket)),
        ("empty_field", "key", is_empty_text(key, False)),
        ("null_character", "key", has_nul(key)),
        ("empty_object", None, size == 0),
        ("object_too_large", None, size > _u64(max_object_size)),
        ("empty_field", "etag", is_empty_text(etag, True)),
        ("null_character", "etag", has_nul(etag)),
    ]


def decode_metadata(
    df: DataFrame, payload: str = "payload", *, max_object_size: int = MAX_OBJECT_SIZE
) -> DataFrame:
    """Decode ``payload`` and add the verdict of the first broken rule.

    Adds ``bucket, object_key, size, etag, location`` (null for rejects) and
    ``error_code, error_field, error_message`` (null for accepted rows).
    """
    positive("max_object_size", max_object_size, U64_MAX)
    parsed = parse_metadata(df, payload)
    none = F.lit(None).cast("string")
    rules = [
        ("missing_payload", None, F.col(payload).isNull()),
        ("invalid_json", None, ~F.col("json_ok")),
        *rule_hits(max_object_size),
    ]
    verdict = F.coalesce(
        *[
            F.when(
                broken,
                F.struct(
                    F.lit(code).alias("code"),
                    (F.lit(field) if field else none).alias("field"),
                    _message(code, field, max_object_size).alias("message"),
                ),
            )
            for code, field, broken in rules
        ]
    )
    judged = parsed.withColumn("_verdict", verdict)
    code = F.col("_verdict.code")
    fields = {c: F.when(code.isNull(), F.col(c)) for c in ("bucket", "object_key", "size", "etag")}
    return _sealed(
        judged,
        df.columns,
        {
            **fields,
            "location": object_location(fields["bucket"], fields["object_key"]),
            "error_code": code,
            "error_field": F.col("_verdict.field"),
            "error_message": F.col("_verdict.message"),
        },
    )


def _message(code: str, field: str | None, maximum: int) -> Column:
    text = MESSAGES[code].replace("{field}", field or "").replace("{maximum}", str(maximum))
    if "{actual}" not in text:
        return F.lit(text)
    before, after = text.split("{actual}")
    return F.concat(F.lit(before), F.col("size").cast("string"), F.lit(after))


def metadata_rule_hits(
    df: DataFrame, payload: str = "payload", *, max_object_size: int = MAX_OBJECT_SIZE
) -> DataFrame:
    """All value rules a parsed payload breaks, one row each; not just the first."""
    positive("max_object_size", max_object_size, U64_MAX)
    none = F.lit(None).cast("string")
    hits = F.array(
        *[
            F.when(
                broken,
                F.struct(F.lit(code).alias("code"), (F.lit(field) if field else none).alias("field")),
            )
            for code, field, broken in rule_hits(max_object_size)
        ]
    )
    parsed = parse_metadata(df, payload).filter("json_ok")
    exploded = parsed.withColumn("_hit", F.explode(F.filter(hits, lambda h: h.isNotNull())))
    return exploded.select(
        *df.columns, F.col("_hit.code").alias("error_code"), F.col("_hit.field").alias("error_field")
    )
