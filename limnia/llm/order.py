"""Training-order materialisation: every sequence at its own slot of a keyed permutation.

Token ids are joined to a stream in each input split and cut into sequences of ``length`` ids.
Sequences get dense numbers (splits' counts summed up in two levels); a Feistel network keyed
by ``key`` permutes them, walking its cycles until a number below the total comes up. Shard k
holds the slots from k * shard_size on, in order and with a fixed stride, so that a reader
finds slot s at byte (s % shard_size) * stride of shard s // shard_size, reads on from there,
and takes up again at any slot.

Cases: null text counts as empty (its end id alone); rows with equal or null doc_id are
separate documents; the last sequence of a split is filled up with PAD; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from limnia.llm.bytewords import mix
from limnia.llm.common import ready, slices, stored
from limnia.llm.tokens import DEFAULT, Encoder

LENGTH = 2048
PAD = 0
SHARD_SIZE = 16_384  # sequences; 64 MB at two bytes an id
ROUNDS = 6
PARTS_AT_ONCE = 1000
RECORDS_AT_ONCE = 512


def stride(length: int) -> int:
    """Bytes from one record of a shard to the next: two an id, and a line feed."""
    return 2 * length + 1


class Permutation:
    """A keyed bijection of 0 .. n-1."""

    def __init__(self, n: int, key: int) -> None:
        self.n = n
        self.half = np.uint64(max(1, -(-max(1, n - 1).bit_length() // 2)))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        base = np.arange(ROUNDS, dtype=np.uint64) + np.uint64(key % (1 << 64))
        self.keys = mix(base * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))

    def _round(self, x: np.ndarray, back: bool) -> np.ndarray:
        a, b = x >> self.half, x & self.mask
        for k in self.keys[::-1] if back else self.keys:
            if back:
                a, b = b ^ (mix(a ^ k) & self.mask), a
            else:
                a, b = b, a ^ (mix(b ^ k) & self.mask)
        return a << self.half | b

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = x.astype(np.uint64)
        at = np.arange(len(x))
        while len(at):
            x[at] = self._round(x[at], back)
            at = at[x[at] >= self.n]
        return x.astype(np.int64)

    def slot(self, number: np.ndarray) -> np.ndarray:
        return self._walk(number, False)

    def number(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, True)


def sequences(docs: DataFrame, tokenizer: str = DEFAULT, length: int = LENGTH) -> DataFrame:
    """part, place, n_tokens, ids: the stream of each input split, cut and filled up; two bytes an id."""

    def cut(batches):
        encoder, part, place = Encoder.of(tokenizer), TaskContext.get().partitionId(), 0
        rest = np.zeros(0, np.uint16)

        def rows(ids: np.ndarray, sizes: list[int]) -> pa.RecordBatch:
            nonlocal place
            n = len(sizes)
            at = pa.py_buffer(np.arange(0, (n + 1) * 2 * length, 2 * length, dtype=np.int32))
            blob = pa.Array.from_buffers(pa.binary(), n, [None, at, pa.py_buffer(ids.astype("<u2"))])
            place += n
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int64()), pa.array(range(place - n, place), pa.int64()), pa.array(sizes, pa.int32()), blob],
                names=["part", "place", "n_tokens", "ids"],
            )

        for batch in slices(batches):
            rest = np.concatenate([rest, encoder.encode(batch.column("text"))[0]])
            full = len(rest) // length
            if full:
                yield rows(rest[: full * length], [length] * full)
                rest = rest[full * length :]
        if len(rest):
            yield rows(np.pad(rest, (0, length - len(rest)), constant_values=PAD), [len(rest)])

    ready(docs.sparkSession)
    return docs.select("text").mapInArrow(cut, "part long, place long, n_tokens int, ids binary")


def numbered(parts: DataFrame) -> tuple[DataFrame, int]:
    """For the stored sequences: part, first (the number of its first sequence), and the total."""
    counts = parts.groupBy("part").count().withColumn("block", F.floor(F.col("part") / PARTS_AT_ONCE))
    counts = stored(counts)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("block").agg(F.sum("count").alias("size"))
    blocks = blocks.select("block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("above"))
    first = F.coalesce(F.sum("count").over(inside), F.lit(0)) + F.col("above")
    table = counts.join(blocks, "block").select("part", first.alias("first"))
    return stored(table), counts.agg(F.sum("count")).first()[0] or 0


def _place(parts: DataFrame, first: DataFrame, n: int, key: int, shard_size: int) -> DataFrame:
    held = Permutation(n, key)

    def place(batches):
        for b in batches:
            number = b.column("number").to_numpy()
            slot = held.slot(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot // shard_size), pa.array(slot), *(b.column(c) for c in ("number", "n_tokens", "ids"))],
                names=["shard", "slot", "number", "n_tokens", "ids"],
            )

    # the table of splits is stored: the planner knows its size and broadcasts it or not
    rows = parts.join(first, "part").select((F.col("first") + F.col("place")).alias("number"), "n_tokens", "ids")
    placed = rows.mapInArrow(place, "shard long, slot long, number long, n_tokens int, ids binary")
    # by shard first, as the writer of shards asks for and would else sort anew
    return placed.repartitionById(max(1, -(-n // shard_size)), F.col("shard").cast("int")).sortWithinPartitions("shard", "slot")


def materialise(
    docs: DataFrame, key: int = 20240229, tokenizer: str = DEFAULT, length: int = LENGTH, shard_size: int = SHARD_SIZE
) -> DataFrame:
    """shard, slot, number, n_tokens, ids, a shard in one partition and in order of slots.

    ``ids`` has ``length`` ids of two bytes each, little end first.
    """
    parts = stored(sequences(docs, tokenizer, length))
    return _place(parts, *numbered(parts), key, shard_size)


def written(
    docs: DataFrame, path: str, key: int = 20240229, tokenizer: str = DEFAULT, length: int = LENGTH, shard_size: int = SHARD_SIZE
) -> DataFrame:
    """Write all shards under ``path``; shard, slot, byte_offset, number, n_tokens, ids as read back from them."""
    spark = docs.sparkSession
    parts = stored(sequences(docs, tokenizer, length))
    first, n = numbered(parts)
    if not n:
        return spark.createDataFrame([], "shard long, slot long, byte_offset long, number long, n_tokens int, ids binary")
    write_shards(_place(parts, first, n, key, shard_size), path)
    # files have no sizes: the sequences that were filled up, one of a split at most
    short = parts.filter(F.col("n_tokens") < length).join(first, "part")
    short = stored(short.select((F.col("first") + F.col("place")).alias("number"), "n_tokens"))
    back = records(spark, path, 0, n, length, shard_size, Permutation(n, key))
    return back.join(short, "number", "left").select(
        F.floor(F.col("slot") / shard_size).alias("shard"),
        "slot",
        (F.col("slot") % shard_size * stride(length)).alias("byte_offset"),
        "number",
        F.coalesce("n_tokens", F.lit(length)).alias("n_tokens"),
        "ids",
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Write each shard as one file of raw records under ``path``/shard=k/.

    Spark's text writer puts bytes out as they are and ends each record with a line feed, so
    the stride is two bytes an id and one more.
    """
    placed.select("shard", F.col("ids").cast("string").alias("value")).write.partitionBy("shard").text(path)


def records(
    spark: SparkSession, path: str, first: int, end: int, length: int, shard_size: int, permutation: Permutation | None = None
) -> DataFrame:
    """slot, ids of the slots from ``first`` up to ``end``, read from the shards that hold them; each file's in order.

    With the permutation, also the sequences' numbers: slot, number, ids.
    """
    names = ["slot", "ids"] if permutation is None else ["slot", "number", "ids"]
    step = stride(length)

    def cut(batches):
        for batch in slices(batches, "content"):
            for name, blob in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                start = int(name.rsplit("/shard=", 1)[1].split("/")[0]) * shard_size
                data = np.frombuffer(blob.as_buffer(), np.uint8)
                data = data[: len(data) // step * step].reshape(-1, step)
                low, high = max(first - start, 0), min(end - start, len(data))
                for a in range(low, high, RECORDS_AT_ONCE):
                    b = min(high, a + RECORDS_AT_ONCE)
                    at = pa.py_buffer(np.arange(b - a + 1, dtype=np.int32) * np.int32(2 * length))
                    ids = pa.Array.from_buffers(pa.binary(), b - a, [None, at, pa.py_buffer(data[a:b, :-1].tobytes())])
                    slots = np.arange(start + a, start + b)
                    numbers = [] if permutation is None else [pa.array(permutation.number(slots))]
                    yield pa.RecordBatch.from_arrays([pa.array(slots), *numbers, ids], names=names)

    files = spark.read.format("binaryFile").load(path)
    shard = F.col("shard").between(first // shard_size, (end - 1) // shard_size)
    return files.filter(shard).select("path", "content").mapInArrow(cut, ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in names))


def read_slots(spark: SparkSession, path: str, first: int, end: int, length: int = LENGTH, shard_size: int = SHARD_SIZE) -> DataFrame:
    """slot, ids of the slots from ``first`` up to ``end``, in order."""
    return records(spark, path, first, end, length, shard_size).orderBy("slot")
