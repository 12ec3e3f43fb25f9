"""Column builders. Everything here is a composition of built-in functions."""

from .business import calculate_ltv, calculate_sla_status, clean_email, format_currency
from .casts import (NUMERIC, average_of, parse_date, parse_timestamp, plain_number_text, ratio,
                    safe_integer, safe_numeric, subtract, times, to_numeric, utc_instant)
from .display import (cache_rate, coverage_bucket, distinct_bucket, email_local_part, human_bytes,
                      human_date, human_datetime, human_duration, iso_text, label_value,
                      last_two_parts, layer_label, layer_of, millis_to_days, null_bucket, preview,
                      size_mb, table_kind, truncated)
from .text import initcap_delimited

__all__ = [n for n in dir() if not n.startswith("_")]
