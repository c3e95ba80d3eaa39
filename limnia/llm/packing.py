"""Packing token ids into fixed-length training sequences.

Method: first-fit decreasing with a tournament tree of bin capacities, run by itself in each
randomised group of pieces. Every document is cut into pieces of at most ``length`` ids; a
piece falls into a group by a hash of its row and place, so that groups have even sizes
whatever the lengths and sources of documents. Bins that stay emptier than ``loose`` ids are
poured together and cut anew; the last rest becomes sequences of power-of-two lengths, which
need no padding.

Cases: null text is packed like an empty one (its end id alone); rows with equal or null
``doc_id`` are separate documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnia.llm.common import ready, slices, text_bytes
from limnia.llm.tokens import DEFAULT, Encoder

LENGTH = 2048
GROUP_BYTES = 4 << 20
LOOSE = 48


class Tournament:
    """A complete binary tree over bins; every node holds the largest free capacity below it."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.tree = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Take ``size`` from the first bin with that much room and return its number."""
        tree, node = self.tree, 1
        while node < self.leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        chosen = node - self.leaves
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
        return chosen


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each size (at most ``capacity``), largest sizes first, ties in the given order."""
    tree = Tournament(len(sizes), capacity)
    bins = np.zeros(len(sizes), dtype=np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        bins[i] = tree.first_fit(int(sizes[i]))
    return bins


def lay_out(sizes: np.ndarray, capacity: int, loose: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (piece, from, to): each id of each piece is in exactly one place."""
    bins = first_fit_decreasing(sizes, capacity)
    fill = np.bincount(bins, weights=sizes).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    sequences: list[list[tuple[int, int, int]]] = [[] for _ in fill]
    for i, b in enumerate(bins):
        sequences[b].append((i, 0, int(sizes[i])))
    is_loose = fill < capacity - loose
    done = [s for s, x in zip(sequences, is_loose, strict=True) if not x]
    poured = [piece for s, x in zip(sequences, is_loose, strict=True) if x for piece in s]
    left = int(fill[is_loose].sum())
    room = 0
    for piece, at, end in poured:
        while at < end:
            if not room:
                room = capacity if left >= capacity else 1 << (left.bit_length() - 1)
                done.append([])
            n = min(room, end - at)
            done[-1].append((piece, at, at + n))
            at, room, left = at + n, room - n, left - n
    return done


def token_pieces(docs: DataFrame, tokenizer: str, length: int) -> DataFrame:
    """_row, doc_id, start, length, doc_tokens, ids (two bytes an id, little end first)."""

    def cut(batches):
        encoder = Encoder.of(tokenizer)
        for batch in slices(batches):
            ids, bounds = encoder.encode(batch.column("text"))
            sizes = np.diff(bounds)
            n_pieces = -(-sizes // length)
            doc = np.repeat(np.arange(len(sizes)), n_pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)) * length
            size = np.minimum(length, sizes[doc] - start)
            where = np.append(bounds[doc] + start, len(ids)).astype(np.int64) * 2
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row").take(pa.array(doc)),
                    batch.column("doc_id").take(pa.array(doc)),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(sizes[doc], pa.int64()),
                    pa.Array.from_buffers(
                        pa.binary(), len(doc), [None, pa.py_buffer(where.astype(np.int32)), pa.py_buffer(ids.astype("<u2"))]
                    ),
                ],
                names=["_row", "doc_id", "start", "length", "doc_tokens", "ids"],
            )

    ready(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row")).mapInArrow(
        cut, f"_row long, doc_id {kind}, start long, length long, doc_tokens long, ids binary"
    )


def pack(docs: DataFrame, tokenizer: str = DEFAULT, length: int = LENGTH, loose: int = LOOSE, seed: int = 17) -> DataFrame:
    """doc_id, start, length, doc_tokens, sequence_id, offset, ids (four bytes an id, little end first): a row per piece."""
    n_groups = 1 + text_bytes(docs) // GROUP_BYTES
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack_group(key, t):
        order = np.lexsort((t.column("start").to_numpy(), t.column("_row").to_numpy()))
        sizes = t.column("length").to_numpy()[order]
        start = t.column("start").to_numpy()[order]
        blobs = t.column("ids").combine_chunks()
        piece, at, end, seq, offset = [], [], [], [], []
        for k, s in enumerate(lay_out(sizes, length, loose)):
            o = 0
            for i, a, b in s:
                piece.append(i)
                at.append(a)
                end.append(b)
                seq.append(k)
                offset.append(o)
                o += b - a
        piece, at, end = (np.array(x, dtype=np.int64) for x in (piece, at, end))
        rows = pa.array(order[piece])
        ids = [
            np.frombuffer(blobs[r].as_buffer(), "<u2")[a:b].astype("<u4").tobytes()
            for r, a, b in zip(order[piece].tolist(), at.tolist(), end.tolist(), strict=True)
        ]
        return pa.table(
            {
                "doc_id": t.column("doc_id").take(rows),
                "start": pa.array(start[piece] + at),
                "length": pa.array(end - at),
                "doc_tokens": t.column("doc_tokens").take(rows),
                "sequence_id": pa.array((key[0].as_py() << 32) + np.array(seq, dtype=np.int64)),
                "offset": pa.array(offset, pa.int64()),
                "ids": pa.array(ids, pa.binary()),
            }
        )

    pieces = token_pieces(docs, tokenizer, length)
    group = F.pmod(F.xxhash64("_row", "start", F.lit(seed)), F.lit(n_groups))
    return (
        pieces.withColumn("_group", group)
        .groupBy("_group")
        .applyInArrow(
            pack_group,
            f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
        )
    )


def padding_share(packed: DataFrame, length: int = LENGTH) -> float:
    """Share of padding ids, a sequence of power-of-two length having none."""
    n = F.sum("length")
    fill = packed.groupBy("sequence_id").agg(n.alias("n"))
    short = F.when(F.col("n").bitwiseAND(F.col("n") - 1) == 0, 0).otherwise(F.lit(length) - F.col("n"))
    row = fill.agg(F.sum(short).alias("pad"), F.sum("n").alias("ids")).first()
    return (row["pad"] or 0) / max(1, (row["pad"] or 0) + (row["ids"] or 0))
