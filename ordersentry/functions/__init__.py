"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from .ids import strip_prefix_id, user_number, with_prefix
from .money import line_amount, rupiah
from .text import digits_only, title_words, trim_text
from .timefn import event_date, hour_in, hour_of_iso_text, micros, on_day, previous_day

__all__ = [
    "digits_only", "event_date", "hour_in", "hour_of_iso_text", "line_amount",
    "micros", "on_day", "previous_day", "rupiah", "strip_prefix_id", "title_words", "trim_text",
    "user_number", "with_prefix",
]
