"""Fill-in-the-middle: a text is cut at two unit bounds and its middle moved to the end.

A unit is a run of white space with the word after it, or white space alone. One full match of
``(unit)*`` over a text keeps every repetition of the group, so the ends of its captures are all
places where the text can be cut: their number is n, and two of them are the cuts. A text of more
than WINDOW code points is matched window by window; a window ends where a unit ends, so the ends
are the same, and a worker holds one window's captures at a time. Cuts and choices follow from
the hash of seed and doc_id alone, never from other rows or the order of rows.

Rearranging, and ``restore``, which undoes it, are column expressions. A text that holds a
sentinel stays plain, so that the three sentinels of an output are the only ones in it: no
sentinel overlaps itself or another, hence none can arise where two parts meet.

Cases: null and empty texts have no unit, stay plain and give an empty output (``restore`` gives
the empty text for both); a null doc_id counts as empty text in the hash; rows of equal doc_id
are cut at the same shares of their own units; very long texts need memory for their bytes, one
window's captures and four bytes a unit; an empty table gives no rows; other columns come through
unchanged, but those named ``_n``, ``_form``, ``_prefix_chars``, ``_middle_chars``, ``_output``
are replaced, and names that begin with ``_fim_`` are this module's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnia.llm.common import ready, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WINDOW = 1 << 20
# A unit always ends where a word does, so no repetition is ever given back.
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")
WORD_END = regex.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
NEW = ("_n", "_form", "_prefix_chars", "_middle_chars", "_output")


def windows(text: str, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of about ``size`` code points that end where a unit ends."""
    start = 0
    while start < len(text):
        found = WORD_END.search(text, start + size) if len(text) - start > size else None
        end = found.end() if found else len(text)
        yield start, end
        start = end


def unit_ends(text: str, size: int = WINDOW) -> np.ndarray:
    """Where each unit of the text ends, in code points."""
    parts = [np.array(UNITS.fullmatch(text, a, b).ends(1), np.int32) for a, b in windows(text, size)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def cuts(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with n and the code points before each of the two cuts, as ``_n``, ``_fim_a`` and ``_fim_b``."""
    kept = [c for c in docs.columns if c not in NEW]
    h1, h2, _, _ = draws(F.col("doc_id"), seed)
    asked = docs.select(*kept, h1.alias("_fim_h1"), h2.alias("_fim_h2"))
    new = [T.StructField(c, T.LongType()) for c in ("_n", "_fim_a", "_fim_b")]
    schema = T.StructType([*(docs.schema[c] for c in kept), *new])

    def run(batches):
        for batch in slices(batches):
            found = np.zeros((3, batch.num_rows), np.int64)
            wanted = zip(batch.column("text"), batch.column("_fim_h1").to_numpy(), batch.column("_fim_h2").to_numpy(), strict=True)
            for i, (text, x, y) in enumerate(wanted):
                ends = unit_ends(text.as_py() or "")
                n = len(ends)
                places = [int(ends[k - 1]) if k else 0 for k in (int(x) % (n + 1), int(y) % (n + 1))]
                found[:, i] = n, min(places), max(places)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(f) for f in found)], names=[*kept, "_n", "_fim_a", "_fim_b"]
            )

    ready(docs.sparkSession)
    return asked.mapInArrow(run, schema)


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """``docs`` with n, form, lengths of prefix and middle (null if plain), and the rearranged text.

    ``rate`` of 100 documents are rearranged, of these ``spm`` of 100 with the suffix first.
    """
    _, _, h3, h4 = draws(F.col("doc_id"), seed)
    text = F.coalesce("text", F.lit(""))
    plain = (text == "") | (h3 % 100 >= rate)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain |= F.contains(text, F.lit(mark))
    form = F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    moved = F.col("_form") != "plain"
    length = lambda a, b: (F.col(b) - F.col(a)).cast("int")
    prefix = F.substring(text, F.lit(1), F.col("_fim_a").cast("int"))
    middle = F.substring(text, (F.col("_fim_a") + 1).cast("int"), length("_fim_a", "_fim_b"))
    suffix = F.substring(text, (F.col("_fim_b") + 1).cast("int"), F.char_length(text))
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    output = (
        F.when(F.col("_form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("_form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(text)
    )
    out = cuts(docs, seed).withColumn("_form", form).withColumns({
        "_output": output,
        "_prefix_chars": F.when(moved, F.col("_fim_a")),
        "_middle_chars": F.when(moved, F.col("_fim_b") - F.col("_fim_a")),
    })
    return out.select(*(c for c in docs.columns if c not in NEW), *NEW)


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")  # nothing stands before the first sentinel
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
