"""Line dedup that can be taken back: sharded cuckoo filters in front of exact reference counts.

A line's key is the line without white space at both ends, A-Z lower-cased. The exact table
has a row for every (key, document) reference; counts and the largest document follow from
it, so inserting and deleting documents are the same step with the sign turned. Each shard of
the key space has a cuckoo filter over the keys that lie in enough documents. A filter answers
"not repeated" for nearly every line; only lines that pass it are looked up in the exact table.

No key is a hot spot: references are counted with partial sums, and documents ask for their
lines by block, so that a line is asked for once a block and not once a document.

Cases: null text is one empty line; a repeated ``doc_id`` is one document whose rows are each
cut in the same way; rows with null ``doc_id`` are one document that counts as the smallest;
an empty table gives no rows; other columns come through unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limnia.llm.bytewords import LOWER, NOT_SPACE, raw, span_hashes
from limnia.llm.common import ready, shared_folder, slices, text_bytes

MIN_CHARS = 40
MIN_DOCS = 5
BLOCK_BYTES = 8 << 20
SHARD_REFERENCES = 200_000
SLOTS = 4


class CuckooFilter:
    """Fingerprints of 64-bit keys in buckets of four; supports insert, membership and delete.

    A key has two buckets, each found from the other and the fingerprint. The table doubles
    when an insertion finds no place, which needs the keys again: ``build`` does that.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None) -> None:
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @staticmethod
    def _hash(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(33))

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = self._hash(keys.astype(np.uint64))
        print_ = ((h >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        first = (h & np.uint64(self.buckets - 1)).astype(np.int64)
        return print_, first, self._other(first, print_)

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        step = self._hash(print_.astype(np.uint64)) & np.uint64(self.buckets - 1)
        return bucket ^ step.astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter that holds each of the distinct keys once."""
        buckets = 1 << max(1, int(np.ceil(len(keys) / (SLOTS * 0.85)))).bit_length()
        while True:
            made = cls(buckets)
            if made.insert(keys):
                return made
            buckets *= 2

    def insert(self, keys: np.ndarray) -> bool:
        """False if some key found no place; the filter is then unusable and must be built anew."""
        prints, first, second = self._places(keys)
        table, rng = self.table, np.random.default_rng(1)
        for p, a, b in zip(prints.tolist(), first.tolist(), second.tolist(), strict=True):
            for bucket in (a, b):
                free = np.flatnonzero(table[bucket] == 0)
                if len(free):
                    table[bucket, free[0]] = p
                    break
            else:
                bucket = b
                for _ in range(500):
                    slot = int(rng.integers(SLOTS))
                    p, table[bucket, slot] = int(table[bucket, slot]), p
                    bucket = int(self._other(np.array([bucket]), np.array([p], np.uint16))[0])
                    free = np.flatnonzero(table[bucket] == 0)
                    if len(free):
                        table[bucket, free[0]] = p
                        break
                else:
                    return False
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        return ((self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])).any(axis=1)

    def delete(self, keys: np.ndarray) -> None:
        """Remove one fingerprint for each key; only keys that were inserted may be deleted."""
        for p, a, b in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            for bucket in (a, b):
                at = np.flatnonzero(self.table[bucket] == p)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, "<u2").reshape(-1, SLOTS).copy()
        return cls(len(table), table)


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, row, pos, k1, k2 of every line whose key has ``min_chars`` code points or more.

    ``row`` is a hash of the text, which with doc_id names a row; k1 and k2 are independent
    64-bit hashes that stand for the key.
    """

    def find(batches):
        for batch in slices(batches):
            data, offsets = raw(batch.column("text"))
            low = LOWER[data]
            starts, ends = line_bounds(low, offsets)
            pos = np.arange(len(starts)) - np.repeat(np.searchsorted(starts, offsets[:-1]), np.diff(np.searchsorted(starts, offsets)))
            owner = np.searchsorted(offsets, starts, "right") - 1
            # first and last byte of a line that are not white space
            solid = np.flatnonzero(NOT_SPACE[low])
            a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
            some = np.flatnonzero(b > a)
            key_start, key_end = solid[a[some]], solid[b[some] - 1] + 1
            chars = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
            enough = chars[key_end] - chars[key_start] >= min_chars
            some, key_start, key_end = some[enough], key_start[enough], key_end[enough]
            rows = pa.array(owner[some])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("row").take(rows),
                    pa.array(pos[some].astype(np.int32)),
                    pa.array(span_hashes(low, key_start, key_end).view(np.int64)),
                    pa.array(span_hashes(low, key_start, key_end, second=True).view(np.int64)),
                ],
                names=["doc_id", "row", "pos", "k1", "k2"],
            )

    ready(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("row")).mapInArrow(
        find, f"doc_id {kind}, row long, pos int, k1 long, k2 long"
    )


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines of all texts; texts without a byte are left out."""
    full = np.flatnonzero(np.diff(offsets))
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[full], breaks + 1)
    # the empty line after a line break that ends a text has no bytes and so no key
    starts = starts[starts < len(data)]
    ends = np.minimum(
        np.append(breaks, len(data))[np.searchsorted(breaks, starts)], offsets[np.searchsorted(offsets, starts, "right")]
    )
    return starts, ends


class LineIndex:
    """Exact references and per-shard filters, kept as tables in one folder.

    ``insert`` and ``delete`` append signed references and refresh the filters of the shards
    whose set of repeated keys changed. A document's text may be inserted again after it was
    deleted; inserting the same (key, document) twice without deleting counts once.
    """

    def __init__(
        self, spark: SparkSession, path: str | None = None, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shards: int | None = None
    ) -> None:
        self.spark, self.path = spark, path or shared_folder(spark)
        self.min_docs, self.min_chars, self.shards, self.given = min_docs, min_chars, shards, shards is not None
        self.version = 0

    def insert(self, docs: DataFrame) -> None:
        self._add(docs, 1)

    def delete(self, docs: DataFrame) -> None:
        """Take back the references of documents given with the text they were inserted with."""
        self._add(docs, -1)

    def _add(self, docs: DataFrame, sign: int) -> None:
        refs = long_lines(docs, self.min_chars).select("k1", "k2", "doc_id", F.lit(sign).alias("n"))
        refs.write.mode("append").option("compression", "zstd").parquet(f"{self.path}/refs/batch={self.version}")
        old = self.filters() if self.version else None
        self.version += 1
        if not self.given:
            # a shard is asked for all its keys, repeated or not: their number follows the references
            shards = 1 + self._references().count() // SHARD_REFERENCES
            old = old if shards == self.shards else None
            self.shards = shards
        self._refresh(self._count().withColumn("shard", self._shard()), old)

    def _references(self) -> DataFrame:
        return self.spark.read.schema("k1 long, k2 long, doc_id long, n int").parquet(f"{self.path}/refs/batch=*")

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("k1", "k2"), F.lit(self.shards))

    def _count(self) -> DataFrame:
        """k1, k2, n_docs, keep: keys in ``min_docs`` documents or more and the largest of these."""
        live = self._references()
        if self.version > 1:
            live = live.groupBy("k1", "k2", "doc_id").agg(F.sum("n").alias("n")).filter("n > 0")
            counted = live.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep"))
        else:
            distinct = F.count_distinct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
            counted = live.groupBy("k1", "k2").agg(distinct.alias("n_docs"), F.max("doc_id").alias("keep"))
        path = f"{self.path}/repeated/version={self.version}"
        counted.filter(F.col("n_docs") >= self.min_docs).write.option("compression", "zstd").parquet(path)
        return self.repeated()

    def repeated(self) -> DataFrame:
        """The exact table of repeated keys: k1, k2, n_docs, keep."""
        return self.spark.read.schema("k1 long, k2 long, n_docs long, keep long").parquet(
            f"{self.path}/repeated/version={self.version}"
        )

    def filters(self) -> DataFrame:
        """shard, keys, filter: the cuckoo filter of each shard, and the keys it holds."""
        return self.spark.read.schema("shard long, keys binary, filter binary").parquet(f"{self.path}/filters/version={self.version}")

    def _refresh(self, keys: DataFrame, old: DataFrame | None) -> None:
        """Bring the filters to the present set of keys: delete what left, insert what came."""

        def update(t):
            is_filter = pc.is_valid(t.column("filter"))
            held, new = t.filter(is_filter), t.filter(pc.invert(is_filter))
            now = np.unique(new.column("k1").to_numpy())
            made = None
            if held.num_rows:
                before = np.frombuffer(held.column("keys")[0].as_py(), "<i8")
                made = CuckooFilter.from_bytes(held.column("filter")[0].as_py())
                made.delete(np.setdiff1d(before, now))
                if not made.insert(np.setdiff1d(now, before)):
                    made = None
            made = made or CuckooFilter.build(now)
            row = {"shard": [t.column("shard")[0].as_py()], "keys": [now.astype("<i8").tobytes()], "filter": [made.to_bytes()]}
            return pa.table(row, schema=pa.schema([("shard", pa.int64()), ("keys", pa.binary()), ("filter", pa.binary())]))

        none = F.lit(None).cast("binary")
        rows = keys.select("shard", "k1", none.alias("keys"), none.alias("filter"))
        if old is not None:
            rows = rows.unionByName(old, allowMissingColumns=True)
        fresh = rows.groupBy("shard").applyInArrow(update, "shard long, keys binary, filter binary")
        fresh.write.option("compression", "zstd").parquet(f"{self.path}/filters/version={self.version}")

    def look_up(self, asked: DataFrame) -> DataFrame:
        """Of the asked keys (k1, k2 and other columns), those that are repeated, with ``keep``.

        Each shard's filter screens what is asked of the shard; what passes joins the exact table.
        """
        names = [*asked.columns, "shard"]

        def screen(t):
            is_filter = pc.is_valid(t.column("filter"))
            wanted, blobs = t.filter(pc.invert(is_filter)).select(names), t.column("filter").filter(is_filter)
            if not len(blobs) or not wanted.num_rows:
                return wanted.slice(0, 0)
            made = CuckooFilter.from_bytes(blobs[0].as_py())
            return wanted.filter(pa.array(made.contains(wanted.column("k1").to_numpy())))

        asked = asked.withColumn("shard", self._shard())
        both = asked.unionByName(self.filters().select("shard", "filter"), allowMissingColumns=True)
        passed = both.groupBy("shard").applyInArrow(screen, asked.schema)
        return passed.drop("shard").join(self.repeated().drop("n_docs"), ["k1", "k2"])

    def clean(self, docs: DataFrame) -> DataFrame:
        """``docs`` with repeated lines cut from ``text``; ``_n_lines`` and ``_dropped`` (line positions) are added.

        A repeated line stays only in the largest document that holds it.
        """
        n_blocks = 1 + text_bytes(docs) // BLOCK_BYTES
        block = F.pmod(F.xxhash64("doc_id", "row"), F.lit(n_blocks)).alias("block")
        lines = long_lines(docs, self.min_chars).select("*", block)
        answers = self.look_up(lines.select("block", "k1", "k2").distinct())
        drop = (
            lines.join(answers, ["block", "k1", "k2"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("keep")))
            .groupBy(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"))
            .agg(F.collect_set("pos").alias("_dropped"))
        )
        same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_row"))
        # names that the caller's own columns may have are kept apart in a struct
        joined = docs.select(F.struct(*docs.columns).alias("_in"), "doc_id", "text").join(drop, same, "left")
        parts = F.split(F.coalesce("text", F.lit("")), "\n")
        none = F.array().cast("array<int>")
        kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("_dropped"), i)), "\n")
        text = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(kept)
        columns = [(text if c == "text" else F.col("_in")[c]).alias(c) for c in docs.columns]
        return joined.select(
            *columns, F.size(parts).cast("long").alias("_n_lines"), F.coalesce("_dropped", none).alias("_dropped")
        )
