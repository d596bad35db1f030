"""Epoch integers back to timestamps and dates.

Results are ``timestamp_ntz`` counted from 1970-01-01 in UTC, so they do not move
with the session time zone. Text that is not a decodable value gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: the last second of the range rule, 3000-01-01 00:00:00 UTC.
RANGE_END_SECONDS = 32503680000

_WHOLE_NUMBER = "^[0-9]+$"
_ISO_START = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_ZONED_TIME = "[0-9]:[0-9]{2}.*(Z|UTC|[+-][0-9]{1,2}(:?[0-9]{2})?)$"


def _at(micros: str) -> str:
    return f"timestampadd(MICROSECOND, {micros}, timestamp_ntz'1970-01-01 00:00:00')"


def _by_digits(text: str) -> str:
    """10 digits are seconds, 13 milli-, 16 micro-, 19 nanoseconds; NULL otherwise."""
    number = f"try_cast({text} as bigint)"
    # Nanoseconds are rounded, in decimals: a double cannot hold 19 digits.
    from_nanos = f"cast(round(cast({number} as decimal(20,0)) / 1000) as bigint)"
    return f"""case length({text})
        when 10 then {_at(f"{number} * 1000000")}
        when 13 then {_at(f"{number} * 1000")}
        when 16 then {_at(number)}
        when 19 then {_at(from_nanos)} end"""


def _ts_sql(value: str) -> str:
    text = f"cast({value} as string)"
    instant = f"cast(try_cast({text} as timestamp) as timestamp_ntz)"
    return f"""case
        when {text} rlike '{_WHOLE_NUMBER}' then {_by_digits(text)}
        when not {text} rlike '{_ISO_START}' then null
        when {text} rlike '{_ZONED_TIME}' then convert_timezone(current_timezone(), 'UTC', {instant})
        else try_cast({text} as timestamp_ntz) end"""


def _date_sql(value: str) -> str:
    text = f"cast({value} as string)"
    return f"""case
        when {text} rlike '^[0-9]{{1,5}}$' then date_from_unix_date(cast({text} as int))
        when {text} rlike '{_WHOLE_NUMBER}' then cast({_by_digits(text)} as date)
        when {text} rlike '{_ISO_START}$' then try_cast({text} as date) end"""


def _range_sql(value: str) -> str:
    number = f"cast({value} as bigint)"
    return f"""case
        when {number} between 0 and {RANGE_END_SECONDS} then {_at(f"{number} * 1000000")}
        when {number} between 0 and {RANGE_END_SECONDS * 1000} then {_at(f"{number} * 1000")} end"""


def decode_epoch_ts(value: str) -> Column:
    """Timestamp of an epoch integer by digit count, or of ISO date/time text."""
    return F.expr(_ts_sql(value))


def decode_epoch_date(value: str) -> Column:
    """Date of a day number (1-5 digits), an epoch integer by digit count, or ISO date text."""
    return F.expr(_date_sql(value))


def decode_epoch_range(value: str) -> Column:
    """Timestamp of a bigint by magnitude: seconds, then milliseconds, NULL beyond both."""
    return F.expr(_range_sql(value))


def register_functions(spark: SparkSession) -> None:
    """Offer the decoders to the session's SQL queries under the names used here."""
    for name, argument, result, sql in (
        ("decode_epoch_ts", "string", "timestamp_ntz", _ts_sql("v")),
        ("decode_epoch_date", "string", "date", _date_sql("v")),
        ("decode_epoch_range", "bigint", "timestamp_ntz", _range_sql("v")),
    ):
        spark.sql(
            f"create or replace temporary function {name}(v {argument}) returns {result} return {sql}"
        )
