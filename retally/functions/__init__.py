"""Column expressions used by the jobs; all built-in Spark functions (JVM side)."""

from retally.functions.casts import to_int
from retally.functions.dates import deadline, format_day, parse_day
from retally.functions.notes import note_field, note_fields, payment_notes
from retally.functions.tokens import token

__all__ = ["deadline", "format_day", "note_field", "note_fields", "parse_day", "payment_notes", "to_int", "token"]
