"""Scalar rules: names, error codes, progress and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Storage prefixes, SQLSTATE patterns that no retry can cure, the code of a
# full sync, the largest op id and the default priority of a bucket.
LOCAL_PREFIX = "ps_data_local__"
SYNCED_PREFIX = "ps_data__"
FATAL_CODES = "^(22...|23...|42501)$"
FULL_SYNC = 2147483647
MAX_OP_ID = 9223372036854775807
DEFAULT_PRIORITY = 3
CHECKSUM_MODULUS = 4294967296


def friendly_table_name(name: Column) -> Column:
    """The declared name of a storage table; other names are left as they are."""
    return F.regexp_replace(name, "^ps_data(_local)?__(?=.)", "")


def internal_table_name(name: Column, local_only: Column) -> Column:
    return F.concat(F.when(local_only, LOCAL_PREFIX).otherwise(SYNCED_PREFIX), name)


def attachment_filename(filename: Column, id_: Column, extension: Column) -> Column:
    """The given file name, else ``<id>.<extension>``; one of the two must be there."""
    return F.coalesce(
        filename,
        F.concat(id_, F.lit("."), extension),
        F.raise_error(F.lit("a watched attachment needs a filename or a file extension")).cast("string"),
    )


def is_fatal_error(code: Column) -> Column:
    """Whether a SQLSTATE stands for a data, integrity or privilege error. NULL is not fatal."""
    return F.coalesce(code.rlike(FATAL_CODES), F.lit(False))


def progress_fraction(downloaded: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(downloaded / total)


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def timestamp_to_epoch(instant: Column) -> Column:
    return F.unix_timestamp(instant)


def now_text(now: Column | None = None) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` of the given instant, by default the current one."""
    return F.date_format(now if now is not None else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def now_epoch(now: Column | None = None) -> Column:
    return F.unix_timestamp(now if now is not None else F.current_timestamp())


def sum_modulo_32_bits(value: Column) -> Column:
    """Aggregate: the sum of 32-bit values modulo 2**32, by 16-bit halves.

    A plain sum of bigints would overflow after 2**31 rows of one bucket; each half
    overflows only after 2**47 rows.
    """
    low = F.sum(value.bitwiseAND(F.lit(0xFFFF).cast("bigint")))
    high = F.sum(F.shiftright(value, 16))
    return F.pmod(
        F.pmod(high, F.lit(65536)) * F.lit(65536) + F.pmod(low, F.lit(CHECKSUM_MODULUS)),
        F.lit(CHECKSUM_MODULUS),
    )
