"""Column functions: flags, durations, epoch decoding, scores.

Arguments are SQL expressions, usually column names. Each ``*_sql`` function gives the SQL text,
for use inside rules; its namesake gives the Column; ``register_functions`` offers the decoders
to SQL queries.
"""

from lamina.functions.epoch import (
    decode_epoch_date,
    decode_epoch_range,
    decode_epoch_ts,
    register_functions,
)
from lamina.functions.flags import is_positive, is_yes, positive_sql, yes_sql
from lamina.functions.scoring import band, score
from lamina.functions.timing import hours_between, hours_sql, whole_second_hours

__all__ = [
    "band",
    "decode_epoch_date",
    "decode_epoch_range",
    "decode_epoch_ts",
    "hours_between",
    "hours_sql",
    "is_positive",
    "is_yes",
    "positive_sql",
    "register_functions",
    "score",
    "whole_second_hours",
    "yes_sql",
]
