"""Names, labels and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from limnia.functions.cleaning import as_col


def basename(path: Column | str) -> Column:
    return F.substring_index(as_col(path), "/", -1)


def url_basename(url: Column | str) -> Column:
    """Last path part of a URL, without its query string."""
    return F.substring_index(basename(url), "?", 1)


def contains_text(c: Column | str, needle: str) -> Column:
    """Case-insensitive literal substring; missing text never matches."""
    return F.contains(F.lower(F.coalesce(as_col(c), F.lit(""))), F.lit(needle.lower()))


def _alternatives(names) -> str:
    return "|".join(re.escape(n) for n in names)


def mentions_any(c: Column | str, names) -> Column:
    """Case-insensitive: any of the names anywhere in the text."""
    return F.coalesce(as_col(c), F.lit("")).rlike(f"(?i)(?:{_alternatives(names)})")


def is_any(c: Column | str, names) -> Column:
    """Case-insensitive: the whole text is one of the names."""
    return F.coalesce(as_col(c), F.lit("")).rlike(rf"(?i)\A(?:{_alternatives(names)})\z")


def list_rank(c: Column | str, names) -> Column:
    """0-based place of a value in an explicit list; NULL when absent."""
    place = F.array_position(F.array(*[F.lit(n) for n in names]), as_col(c))
    return F.when(place > 0, (place - 1).cast("int"))


def display_label(lake_id: Column | str, name: Column | str) -> Column:
    return F.concat_ws(" - ", as_col(lake_id).cast("string"), F.coalesce(as_col(name), F.lit("")))
