"""Stored document ids back to text, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardlift.fixed import ID_BASE64_ESCAPE, ID_NUMERIC, ID_UTF8


def _tail(raw: Column) -> Column:
    return F.substring(raw, F.lit(2), F.length(raw))


def numeric_id(raw: Column) -> Column:
    """Two digits per byte; a low nibble of F in the last byte ends an odd-length id.

    Nibbles above 9 are not digits and become the characters after '9'.
    """
    digits = F.regexp_replace(F.hex(_tail(raw)), "F$", "")
    return F.translate(digits, "ABCDEF", ":;<=>?")


def utf8_id(raw: Column) -> Column:
    """Bytes that are no UTF-8 become the replacement character."""
    return F.make_valid_utf8(_tail(raw).cast("string"))


def base64_id(raw: Column) -> Column:
    """URL alphabet, no padding, no line breaks (Spark's encoder adds them after 76 characters)."""
    escaped = F.hex(F.substring(raw, 1, 1)) == ID_BASE64_ESCAPE
    body = F.when(escaped, _tail(raw)).otherwise(raw)
    return F.rtrim(F.translate(F.base64(body), "+/\r\n", "-_"), F.lit("="))


def decode_id(raw: Column) -> Column:
    """Id text; an empty id raises and a null one stays null."""
    marker = F.hex(F.substring(raw, 1, 1))
    return (
        F.when(F.length(raw) == 0, F.raise_error(F.lit("ids cannot be empty")).cast("string"))
        .when(marker == ID_NUMERIC, numeric_id(raw))
        .when(marker == ID_UTF8, utf8_id(raw))
        .when(raw.isNotNull(), base64_id(raw))
    )


def id_problem(raw: Column) -> Column:
    """Why an id cannot be decoded, or null."""
    text = _tail(raw).cast("string")
    return (
        F.when(raw.isNull(), F.lit("id is missing"))
        .when(F.length(raw) == 0, F.lit("id is empty"))
        .when(
            (F.hex(F.substring(raw, 1, 1)) == ID_UTF8) & ~F.is_valid_utf8(text),
            F.lit("id is not valid UTF-8"),
        )
    )


def raised_if_undecodable(raw: Column) -> Column:
    """The id, unless it is missing or empty: then the job stops."""
    gone = raw.isNull() | (F.length(raw) == 0)
    return F.when(gone, F.raise_error(id_problem(raw)).cast("binary")).otherwise(raw)


def source_text(raw: Column) -> Column:
    """Document payload as text, byte for byte."""
    return raw.cast("string")
