"""Quality as a logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

Tokens are runs of letters and digits (case counts) and runs of other marks; unigrams and bigrams
are hashed into BUCKETS. A text's features are the logarithms of their counts, scaled to length 1,
and a constant. Labelled documents are dealt by hash to SHARDS. In each of ROUNDS every shard's
learner starts from the common state and goes through its documents once, one update each, in an
order by hash; the common state (for each bucket the leader's sum and its squared gradients) is
the mean of the learners that met the bucket. A score is the logistic of a sparse dot product.

Labels come from about MAX_LABELLED documents, all if there are no more, chosen by a hash of the
id: what the driver gathers are sums for BUCKETS buckets. Scoring runs over whole texts of all
rows; a text beyond WINDOW bytes is counted window by window, cut at white space.

Cases: null and empty texts have the constant only; a document with several labels counts as good
if one of them says so; rows with null id or label don't train; of rows with equal id one trains,
that of the smallest text hash; without a label every score is 0.5; rows are scored one by one,
equal texts equally; an empty table gives no rows; other columns come through unchanged but for
``_score``, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnia.llm.bytewords import SPACE, mix, raw, runs, span_hashes
from limnia.llm.common import broadcast, ready, slices, stored

BITS = 18
BUCKETS = 1 << BITS  # the constant's place is the one after the last
ORDERS = 2
WINDOW = 1 << 20
MAX_LABELLED = 50_000
SHARDS = 8
ROUNDS = 4
STEP, SMOOTH, L1, L2 = 6.0, 1.0, 0.0, 0.1

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
MARK = ~WORD & ~SPACE


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens in order, and which text each is of."""
    (a, b), (c, d) = runs(WORD[data], offsets), runs(MARK[data], offsets)
    starts, ends = np.concatenate([a, c]), np.concatenate([b, d])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    owner = np.searchsorted(offsets, starts, "right") - 1
    return span_hashes(data, starts, ends), owner


def grams(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams that lie in one text, and the texts."""
    buckets, owners, h = [hashes >> np.uint64(64 - BITS)], [owner], hashes
    for n in range(1, ORDERS):
        if len(hashes) <= n:
            break
        h = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[n:])
        same = owner[n:] == owner[:-n]
        buckets.append(h[same] >> np.uint64(64 - BITS))
        owners.append(owner[n:][same])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def windows(data: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Pieces of about ``size`` bytes that begin at white space."""
    start = 0
    while start < len(data):
        space = np.flatnonzero(SPACE[data[start + size : start + 2 * size]])
        end = start + size + int(space[0]) if len(space) else start + 2 * size
        # a word longer than a window stays whole
        while not len(space) and end < len(data) and not SPACE[data[end]]:
            end += 1
        yield data[start:end]
        start = end


class Features(NamedTuple):
    first: np.ndarray  # text i has the features first[i] to first[i + 1]
    buckets: np.ndarray
    values: np.ndarray

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.first[i], self.first[i + 1])
        return self.buckets[at], self.values[at]


def features(texts: pa.Array, window: int = WINDOW) -> Features:
    """Distinct buckets of each text and their scaled values; the constant comes last."""
    data, offsets = raw(texts)
    n = len(offsets) - 1
    if n == 1 and len(data) > window:
        counts, last = np.zeros(BUCKETS, np.int64), np.zeros(0, np.uint64)
        for piece in windows(data, window):
            h, _ = token_hashes(piece, np.array([0, len(piece)]))
            counts += np.bincount(grams(np.append(last, h), np.zeros(len(last) + len(h), np.int64))[0], minlength=BUCKETS)
            if len(last):  # its own n-grams were counted before
                counts -= np.bincount(grams(last, np.zeros(len(last), np.int64))[0], minlength=BUCKETS)
            last = np.append(last, h)[-(ORDERS - 1) :]
        keys = np.flatnonzero(counts)
        counts = counts[keys]
    else:
        b, owner = grams(*token_hashes(data, offsets))
        keys, counts = np.unique(owner << BITS | b, return_counts=True)
    owner = np.append(keys >> BITS, np.arange(n))
    values = np.append(np.log1p(counts), np.zeros(n))
    norms = np.sqrt(np.bincount(owner, weights=values**2, minlength=n))
    values[: len(keys)] /= norms[owner[: len(keys)]]
    values[len(keys) :] = 1.0
    order = np.argsort(owner, kind="stable")
    buckets = np.append(keys & (BUCKETS - 1), np.full(n, BUCKETS))
    return Features(np.searchsorted(owner[order], np.arange(n + 1)), buckets[order], values[order])


class Leader:
    """Follow the regularised leader: weights are read off each bucket's sum ``z`` and squared gradients ``n``."""

    def __init__(self, z: np.ndarray, n: np.ndarray) -> None:
        self.z, self.n = z, n

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(0, np.abs(z) - L1)
        return -shrunk / ((SMOOTH + np.sqrt(n)) / STEP + L2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (logistic(w @ x) - label) * x
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / STEP * w
        self.n[at] = grown


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def labelled(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """shard, place in its order, label and text of about ``limit`` labelled documents, one row each."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("label"))
    share = limit / max(limit, known.count())
    some = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # the chosen ids are about ``limit`` rows of two numbers; many rows of one id are combined before the shuffle
    texts = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id")
    one = texts.agg(F.min_by(F.struct("label", "text"), F.xxhash64("text")).alias("row"))
    return one.select(
        F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(SHARDS)).alias("shard"), F.xxhash64("doc_id", F.lit(3)).alias("place"), "row.*"
    )


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> np.ndarray:
    """Weights of all buckets and the constant."""
    spark = ready(docs.sparkSession)
    rows = stored(labelled(docs, labels, limit))
    common = Leader(np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1))
    for _ in range(ROUNDS):
        moved = one_round(spark, rows, common).toArrow()  # BUCKETS rows at most
        at = moved["bucket"].to_numpy()
        common.z[at] += moved["z"].to_numpy()
        common.n[at] += moved["n"].to_numpy()
    return common.weights().astype(np.float32)


def one_round(spark, rows: DataFrame, common: Leader) -> DataFrame:
    """bucket, z, n: how far the learners of all shards moved the common state, in the mean."""
    held = broadcast(spark, (common.z, common.n))

    def run(batches):
        shard, leader = None, None
        for batch in slices(batches):
            f = features(batch.column("text"))
            for i, (s, label) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("label").to_pylist(), strict=True)):
                if s != shard:
                    yield from moves(leader)
                    shard, leader = s, Leader(*(v.copy() for v in held()))
                leader.learn(*f.of(i), label)
        yield from moves(leader)

    def moves(leader):
        if leader:
            z, n = held()
            at = np.flatnonzero(leader.n > n)
            shifts = ((a[at] - b[at]).astype(np.float32) for a, b in ((leader.z, z), (leader.n, n)))
            arrays = [pa.array(at.astype(np.int32)), *map(pa.array, shifts)]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "z", "n"])

    dealt = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "place")
    moved = dealt.mapInArrow(run, "bucket int, z float, n float")
    return moved.groupBy("bucket").agg(F.avg("z").alias("z"), F.avg("n").alias("n"))


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with ``_score``, the chance that a text is good."""
    kept = [c for c in docs.columns if c != "_score"]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("_score", T.DoubleType())])
    held = broadcast(ready(docs.sparkSession), weights)

    def run(batches):
        w = held()
        for batch in slices(batches):
            f = features(batch.column("text"))
            sums = np.add.reduceat(w[f.buckets] * f.values, f.first[:-1]) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(logistic(sums))], names=[*kept, "_score"])

    return docs.select(*kept).mapInArrow(run, schema)
