"""Payment notes are JSON text with the keys ``sem``, ``course`` and ``pay_for``.

A missing key, a JSON null or malformed text all give NULL, which never
matches.  Fields are extracted once into columns before any reuse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOTE_KEYS = ("pay_for", "course", "sem")


def note_field(notes: Column | str, key: str) -> Column:
    c = F.col(notes) if isinstance(notes, str) else notes
    return F.get_json_object(c, f"$.{key}")


def note_fields(notes: Column | str, keys: tuple[str, ...]) -> list[Column]:
    """Several top-level fields as text columns named like the keys, from one parse per row."""
    c = F.col(notes) if isinstance(notes, str) else notes
    return [F.json_tuple(c, *keys).alias(*keys)]


def payment_notes(sem: Column, course: Column, pay_for: Column) -> Column:
    """Build the notes text the way payment drops carry it."""
    return F.to_json(F.struct(sem.alias("sem"), course.alias("course"), pay_for.alias("pay_for")))
