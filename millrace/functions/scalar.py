"""Scalar expressions used by the analytics, all evaluated on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.durations import micros


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def split_literal(value: Column | str, separator: str) -> Column:
    """Split at a separator that is taken literally, not as a pattern."""
    return F.split(_col(value), "\\Q" + separator + "\\E")


def field(value: Column | str, separator: str, index: int) -> Column:
    """Field ``index`` (from 0) of a delimited text; null if there are fewer."""
    return F.get(split_literal(value, separator), F.lit(index))


def joined(*values: Column | str, separator: str = "_") -> Column:
    return F.concat_ws(separator, *[_col(v).cast("string") for v in values])


def as_long(value: Column | str) -> Column:
    """Integer of a text, null when it is not one."""
    return _col(value).try_cast("bigint")


def as_int(value: Column | str) -> Column:
    return _col(value).try_cast("int")


def epoch_seconds_to_time(value: Column | str) -> Column:
    return F.timestamp_seconds(_col(value))


def epoch_text_to_time(value: Column | str) -> Column:
    """The SQL spelling of the same: format the seconds, then parse the text."""
    return F.to_timestamp(F.from_unixtime(_col(value), "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss")


def parse_time(value: Column | str, pattern: str) -> Column:
    return F.try_to_timestamp(_col(value), F.lit(pattern))


def format_time(value: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_col(value), pattern)


def next_midnight(seconds: Column | str, utc_offset: str = "0 hours") -> Column:
    """Epoch seconds of the next local midnight; a time at midnight gives the following one."""
    offset = micros(utc_offset) // 1_000_000
    day = F.floor((_col(seconds) + F.lit(offset)) / F.lit(86_400))
    return ((day + 1) * F.lit(86_400) - F.lit(offset)).cast("bigint")


def processing_time() -> Column:
    return F.current_timestamp()


def bit_offset(value: Column | str, bits: int = 30) -> Column:
    """Position of a text in a bitmap of 2**bits: polynomial hash with base 32, masked.

    With base 2**5 every character is shifted past the mask after
    ceil(bits / 5) more, so only that many last characters count and the sum
    cannot overflow.
    """
    characters = F.split(F.right(_col(value).cast("string"), F.lit(-(-bits // 5))), "")
    folded = F.aggregate(
        characters, F.lit(0).cast("bigint"), lambda acc, c: acc * 32 + F.ascii(c).cast("bigint")
    )
    return folded.bitwiseAND(F.lit((1 << bits) - 1))


def to_json_text(*columns: str) -> Column:
    return F.to_json(F.struct(*columns) if columns else F.struct("*"))


def to_csv_text(*columns: str) -> Column:
    return F.to_csv(F.struct(*columns) if columns else F.struct("*"))
