"""Column expressions: keys, safe conversions, type names."""

from tidestar.functions.convert import (
    date_to_epoch_day,
    epoch_micros,
    to_date_safe,
    to_decimal_safe,
    to_int_safe,
    to_string_safe,
    to_timestamp_safe,
    ts_to_epoch_micros,
)
from tidestar.functions.keys import md5_hex, op_priority, surrogate_key
from tidestar.functions.typing import column_profile, infer_column_types, type_name

__all__ = [
    "column_profile", "date_to_epoch_day", "epoch_micros", "infer_column_types", "md5_hex",
    "op_priority", "surrogate_key", "to_date_safe", "to_decimal_safe", "to_int_safe",
    "to_string_safe", "to_timestamp_safe", "ts_to_epoch_micros", "type_name",
]
