"""Timestamp text parsing. Results are ``timestamp_ntz`` wall clock."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The zone suffix pattern stripped before parsing, the ISO-8601 shape
# accepted by the strict parser, and the default extra patterns tried after the ISO forms
# (month first, as pandas guesses for ambiguous day/month text).
ZONE_SUFFIX = r"(Z|[+-]\d{2}:?\d{2})$"
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2})?$"
DEFAULT_FORMATS = ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy", "yyyy/MM/dd HH:mm:ss",
                   "dd-MM-yyyy HH:mm:ss")


def strip_timezone(c: Column) -> Column:
    """Drop a trailing zone designator and keep the wall-clock text
    (``10:00:00+02:00`` stays 10:00)."""
    return F.regexp_replace(F.trim(c), ZONE_SUFFIX, "")


def _parse(text: Column, formats: Sequence[str]) -> Column:
    cands = [text.try_cast("timestamp_ntz")]
    for f in formats:
        cands.append(F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz"))
    return F.coalesce(*cands)


def _checked(raw: Column, parsed: Column, what: str) -> Column:
    bad = raw.isNotNull() & (F.trim(raw) != "") & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"unparseable {what} timestamp: "), raw))) \
        .otherwise(parsed)


def parse_timestamp(df: DataFrame, col: str = "timestamp", formats: Sequence[str] = DEFAULT_FORMATS,
                    out: str | None = None) -> DataFrame:
    """S3: per-row format detection (ISO forms with or without ``T``/zone/fraction,
    date-only, then ``formats`` in order); nulls stay null, anything else that does not
    parse raises. Zones are stripped (S5), as the reference does after parsing."""
    raw = F.col(col).cast("string")
    parsed = _parse(strip_timezone(raw), formats)
    return df.withColumn(out or col, _checked(raw, parsed, "mixed-format"))


def parse_timestamp_iso(df: DataFrame, col: str = "timestamp", out: str | None = None) -> DataFrame:
    """Strict ISO-8601; any other shape raises."""
    raw = F.col(col).cast("string")
    ok = F.trim(raw).rlike(ISO_SHAPE)
    parsed = F.when(ok, strip_timezone(raw).try_cast("timestamp_ntz"))
    return df.withColumn(out or col, _checked(raw, parsed, "ISO-8601"))
