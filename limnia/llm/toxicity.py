"""Toxic passages as maximum-scoring segments of token log-odds.

Each token's log-odds between toxic and other labelled documents comes from a Dirichlet prior
that holds the tokens' usual frequencies, and is shrunk by its standard error; a small drift is
taken off, so that a clean text's running sum falls. One linear scan finds all maximal
segments of a text. Under extreme-value theory the best segment of a clean text of n tokens
exceeds S with probability 1 - exp(-K n exp(-lambda S)); segments beyond that are significant,
and their summed surprise, put through a monotone calibration on labelled documents that the
weights haven't seen, is the document's score.

The labelled documents are at most MAX_LABELLED, chosen by a hash of the id; the table of
weights has BUCKETS numbers. Everything else runs over whole texts of all rows: the tokens' usual
frequencies come from every document, by documents for the prior (as labelled ones are counted),
by occurrences for the extreme-value law.

Cases: null and empty texts have no token and get the calibration's lowest score; a document
with several labels counts as toxic if one of them says so, rows with null labels don't train, and
of rows with equal id one trains, that of the smallest text hash;
without labels of both kinds every score is 0; rows with null or repeated doc_id are scored one
by one; an empty table gives no rows; other columns come through unchanged.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnia.llm.bytewords import ALNUM, split
from limnia.llm.common import broadcast, ready, slices, stored

BUCKETS = 1 << 18
MAX_LABELLED = 50_000
CALIBRATION_FOLDS = 4  # one of so many labelled documents calibrates, the others give weights
DRIFT = 0.1
PASSAGES = "array<struct<start:int,end:int,score:double,p:double>>"


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


def log_odds(toxic: np.ndarray, other: np.ndarray, usual: np.ndarray, strength: float = 500.0, errors: float = 2.0) -> np.ndarray:
    """Log-odds of tokens between two sets of counts, each shrunk towards 0 by ``errors`` standard errors.

    The prior adds ``strength`` tokens spread as in ``usual`` to both sets.
    """
    prior = strength * (usual + 0.01) / (usual + 0.01).sum()
    a, b = toxic + prior, other + prior
    delta = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    return np.sign(delta) * np.maximum(0, np.abs(delta) - errors * np.sqrt(1 / a + 1 / b))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), found in one pass over the positive scores.

    A segment is maximal if no part of it scores as much and no longer segment that holds it
    has this property; they are disjoint. Scores between two positive ones enter as one sum.
    """
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    held: list[tuple[int, int, float, float]] = []  # start, end, sum before it, sum at its end
    for i, before, after in zip(up.tolist(), sums[up].tolist(), sums[up + 1].tolist(), strict=True):
        start, end, left, right = i, i + 1, before, after
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j -= 1
            if j < 0 or held[j][3] >= right:
                break
            start, left = held[j][0], held[j][2]
            del held[j:]
        held.append((start, end, left, right))
    return [(a, b, r - x) for a, b, x, r in held]


class Model(NamedTuple):
    weights: np.ndarray  # score of each token bucket, drift taken off
    lam: float
    log_k: float
    steps: np.ndarray  # evidence at which the calibrated probability changes
    chances: np.ndarray

    def passages(self, scores: np.ndarray, level: float = 0.05) -> list[tuple[int, int, float, float]]:
        """Significant segments: start, end, score, chance of one as good in a clean text as long."""
        out = []
        size = np.log(max(1, len(scores))) + self.log_k
        for a, b, s in maximal_segments(scores):
            p = -np.expm1(-np.exp(min(50.0, size - self.lam * s)))
            if p <= level:
                out.append((a, b, s, float(p)))
        return out

    def evidence(self, scores: np.ndarray) -> float:
        """Summed surprise of the text's segments beyond what chance gives in its length."""
        size = np.log(max(1, len(scores))) + self.log_k
        return float(sum(max(0.0, self.lam * s - size) for _, _, s in maximal_segments(scores)))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if not len(self.steps):
            return np.zeros(len(evidence))
        return self.chances[np.maximum(0, np.searchsorted(self.steps, evidence, "right") - 1)]


def tail(weights: np.ndarray, usual: np.ndarray) -> tuple[float, float]:
    """lambda and log K of the extreme-value law, for tokens drawn as in ``usual``."""
    p = usual / max(1.0, usual.sum())
    if not (weights > 0).any() or not (p[weights > 0] > 0).any():
        return 1.0, 0.0
    low, high = 1e-6, 1.0
    moment = lambda x: float((p * np.exp(np.minimum(700, x * weights))).sum())
    while moment(high) < 1 and high < 1e3:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if moment(mid) < 1 else (low, mid)
    # an upper bound of K: the chance that a positive token begins a segment
    return low, float(np.log(max(1e-12, p[weights > 0].sum())))


def monotone(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function closest to y over x: starts of steps and their values."""
    values, first = np.unique(x, return_index=True)
    order = np.argsort(x, kind="stable")
    sums = np.add.reduceat(y[order], np.searchsorted(x[order], values)) if len(values) else np.zeros(0)
    counts = np.diff(np.append(np.searchsorted(x[order], values), len(x)))
    blocks: list[list[float]] = []
    for v, s, n in zip(values.tolist(), sums.tolist(), counts.tolist(), strict=True):
        blocks.append([v, s, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, s2, n2 = blocks.pop()
            blocks[-1][1] += s2
            blocks[-1][2] += n2
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def labelled(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """text, toxic, fold of at most ``limit`` labelled documents, chosen by a hash of their id."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(CALIBRATION_FOLDS)).alias("fold")
    texts = docs.select("doc_id", "text")
    # the labelled ids are no more than ``limit`` rows of two numbers; many rows of one id are combined before the shuffle
    found = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id")
    one = found.agg(F.min_by(F.struct("text", "toxic"), F.xxhash64("text")).alias("row"))
    return one.select("row.text", (F.col("row.toxic") == 1).cast("int").alias("toxic"), fold)


def usual_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Over all documents, in how many each bucket's tokens occur, and how often."""

    def count(batches):
        n = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches):
            words = split(batch.column("text"), ALNUM)
            b = buckets(words.hashes())
            n[0] += np.bincount(np.unique(words.owner() * BUCKETS + b) % BUCKETS, minlength=BUCKETS)
            n[1] += np.bincount(b, minlength=BUCKETS)
        at = np.flatnonzero(n[1])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[0][at]), pa.array(n[1][at])], names=["bucket", "docs", "times"])

    counted = docs.select("text").mapInArrow(count, "bucket int, docs long, times long")
    table = counted.groupBy("bucket").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times")).toArrow()  # BUCKETS rows at most
    out = np.zeros((2, BUCKETS))
    for into, name in zip(out, ("docs", "times"), strict=True):
        into[table["bucket"].to_numpy()] = table[name].to_numpy()
    return out[0], out[1]


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    ready(docs.sparkSession)
    rows = stored(labelled(docs, labels, limit))

    def count(batches):
        n = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches):
            words = split(batch.column("text"), ALNUM)
            b, owner = buckets(words.hashes()), words.owner()
            held = np.unique(owner * BUCKETS + b)  # a document counts once for each token
            toxic = np.asarray(batch.column("toxic"))[held // BUCKETS]
            for k in (0, 1):
                n[k] += np.bincount(held[toxic == k] % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(n[1][at]), pa.array(n[0][at])], names=["bucket", "toxic", "other"]
        )

    counted = rows.filter("fold <> 0").select("text", "toxic").mapInArrow(count, "bucket int, toxic long, other long")
    table = counted.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("toxic", "other"))).toArrow()  # BUCKETS rows at most
    toxic, other = (np.zeros(BUCKETS) for _ in range(2))
    for name, into in (("toxic", toxic), ("other", other)):
        into[table["bucket"].to_numpy()] = table[name].to_numpy()
    if not toxic.any() or not other.any():
        return Model(np.zeros(BUCKETS, np.float32), 1.0, 0.0, np.zeros(0), np.zeros(0))
    in_docs, usual = usual_counts(docs)
    weights = (log_odds(toxic, other, in_docs) - DRIFT).astype(np.float32)
    lam, log_k = tail(weights, usual)
    model = Model(weights, lam, log_k, np.zeros(0), np.zeros(0))
    seen = evidence(rows.filter("fold = 0").select("text", "toxic"), model).select("_evidence", "toxic").toArrow()  # of ``limit`` rows
    steps, chances = monotone(seen["_evidence"].to_numpy(), seen["toxic"].to_numpy().astype(float))
    return model._replace(steps=steps, chances=chances)


def evidence(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_evidence``, ``_score`` and ``_passages`` (ranges of words, significant ones only)."""
    spark, columns = ready(docs.sparkSession), docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("_evidence", T.DoubleType()), T.StructField("_score", T.DoubleType())])
    schema = schema.add("_passages", T.DataType.fromDDL(PASSAGES))
    held = broadcast(spark, tuple(model))

    def run(batches):
        m = Model(*held())
        for batch in slices(batches):
            words = split(batch.column("text"), ALNUM)
            scores = m.weights[buckets(words.hashes())]
            found, passages = np.zeros(batch.num_rows), []
            for i in range(batch.num_rows):
                own = scores[words.first[i] : words.first[i + 1]]
                found[i] = m.evidence(own)
                passages.append([dict(zip(("start", "end", "score", "p"), x, strict=True)) for x in m.passages(own)])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("p", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(found), pa.array(m.score(found)), pa.array(passages, kind)],
                names=[*columns, "_evidence", "_score", "_passages"],
            )

    return docs.mapInArrow(run, schema)
