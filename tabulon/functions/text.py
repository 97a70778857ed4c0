"""Labels, reasons, notes and display text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Shown wherever a number is missing.
DASH = "—"


def map_labels(value: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Replace each listed value; unlisted ones become ``default`` (null if none)."""
    pairs = iter(mapping.items())
    first, label = next(pairs)
    out = F.when(value == first, F.lit(label))
    for key, label in pairs:
        out = out.when(value == key, F.lit(label))
    return out if default is None else out.otherwise(default)


def join_reasons(rules: Iterable[tuple[Column, str]]) -> Column:
    """``a;b;c`` of every rule that holds, in rule order; '' when none does."""
    return F.concat_ws(";", *[F.when(condition, F.lit(reason)) for condition, reason in rules])


def join_notes(notes: Column) -> Column:
    return F.array_join(notes, ";")


def has_note(notes: Column, note: str, is_array: bool = True) -> Column:
    """Whether the notes mention ``note`` as a substring; null notes never do."""
    found = F.exists(notes, lambda n: n.contains(note)) if is_array else notes.contains(note)
    return F.coalesce(found, F.lit(False))


def money(amount: Column, symbol: str = "Q") -> Column:
    """``Q1,234.50``"""
    return F.concat(F.lit(symbol), F.format_number(amount, 2))


def number_or_dash(value: Column, decimals: int) -> Column:
    """Fixed decimals without separators, or a dash when missing."""
    return F.coalesce(F.replace(F.format_number(value, decimals), F.lit(","), F.lit("")), F.lit(DASH))


def address(*parts: Column) -> Column:
    """Non-empty parts joined by a comma."""
    return F.concat_ws(", ", *[F.nullif(p, F.lit("")) for p in parts])


def badge(source: Column, labels: Mapping[str, str], default: str) -> Column:
    return map_labels(source, labels, F.lit(default))


def pending_label(title: Column, pending: Iterable[tuple[Column, str]], lead: str) -> Column:
    """Title followed by ``lead`` and the pending parts joined by '/', if any are pending."""
    parts = F.concat_ws("/", *[F.when(condition, F.lit(text)) for condition, text in pending])
    return F.concat(title, F.when(parts != "", F.concat(F.lit(lead), parts)).otherwise(F.lit("")))
