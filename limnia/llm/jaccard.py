"""Jaccard self-join of word-shingle sets by universe partition and pigeonholes.

Sets are banded by size; two sets that reach the threshold lie in one band or in neighbours, so
a set takes part in the scheme of its own band and in that of the band below. A scheme bounds
how many shingles two of its sets may differ in (d), and hashes the universe into d + 1 + spare
segments: two linked sets then agree on ``spare`` + 1 segments at least.

What a segment may cost is decided by what it costs. A segment's subset is its signature; budget
1. Empty segments, and signatures that prove to lie in more than LARGE sets, get budget 0 as
long as a set has no more than ``spare`` of them: one agreeing segment is left. With LARGE at 1
that means that a set must share more signatures than it can spare to be a candidate at all. A
set with more empty segments adds one-deletion neighbourhoods of all its segments, budget 2, or,
when even that leaves a gap, keeps its empty segments. So no link is lost.

Sets that share a signature form candidate clusters. Each is verified exactly, band by band and
large ones in pairs of blocks of bounded size; the links' connected components are the groups. Equal sets
are one node all along; hashes of words, shingles and sets have 64 bits.

Cases: a text with fewer words than a shingle is one shingle; a text without words has an empty
set and links with nothing; rows with equal or null doc_id are judged one by one, and a group of
rows without ids has a null component; an empty table gives no rows; other columns are ignored
by ``groups`` and come through unchanged in ``keep_one``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnia.llm.bytewords import NOT_SPACE, mix, split
from limnia.llm.common import ready, slices, stored
from limnia.llm.graph import components

SHINGLE = 4
THRESHOLD = 85  # per cent
LARGE = 1
BLOCK = 1024
COLUMNS = 4096
BLOCK_SHINGLES = 1 << 20
DELETIONS, MAY_LEAVE = 255, 254  # in place of a scheme's number: one-deletion neighbourhoods; how many segments a set can spare
_FACTORS = np.random.default_rng(7).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = split(texts, NOT_SPACE)
    h = words.hashes()
    n = max(0, len(h) - size + 1)
    grams = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        grams += h[k : k + n] * _FACTORS[k]
    grams = mix(grams)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(mix((h[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64)[None] + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(s: np.ndarray) -> int:
    return int(mix(mix(s).sum(dtype=np.uint64)[None] + np.uint64(len(s))).view(np.int64)[0])


class Schemes:
    """Size bands and, for each, the number of segments and how many may go without budget."""

    def __init__(self, threshold: int) -> None:
        self.t = threshold
        # the smallest set that can be linked with an unequal one
        low = 1
        while 100 * low < threshold * (low + 1):
            low += 1
        self.low = [low]

    def _reach(self, band: int) -> None:
        while len(self.low) <= band + 1:
            self.low.append(100 * self.low[-1] // self.t + 1)

    def band(self, n: int) -> int:
        """The band of a size, -1 if such sets link with equal ones only."""
        if n < self.low[0]:
            return -1
        while self.low[-1] <= n:
            self._reach(len(self.low))
        return int(np.searchsorted(self.low, n, "right")) - 1

    def of(self, n: int) -> list[int]:
        """The schemes that a set of this size takes part in."""
        b = self.band(n)
        if b < 0:
            return []
        below = b > 0 and 100 * (self.low[b] - 1) >= self.t * n
        return [b - 1, b] if below else [b]

    def columns(self, n: Column, largest: int) -> Column:
        """``of`` as a column expression, for sizes up to ``largest``."""
        self.band(max(largest, self.low[0]))
        low = F.array(*(F.lit(x).cast("long") for x in self.low))
        band = F.size(F.filter(low, lambda x: x <= n)) - 1
        below = (band > 0) & ((F.element_at(low, F.greatest(band, F.lit(0)) + 1) - 1) * 100 >= n * self.t)
        return F.when(below, F.array(band - 1, band)).when(band >= 0, F.array(band)).otherwise(F.array().cast("array<int>"))

    def shape(self, band: int) -> tuple[int, int, int]:
        """Largest difference, spare segments, segments."""
        self._reach(band)
        x = self.low[band + 1] - 1
        d = (100 - self.t) * (x + 100 * x // self.t) // (100 + self.t)
        spare = 1 + d // 16
        # room for twice the segments that the band's smallest sets can be expected to leave empty
        while 1 + 2 * (d + 1 + spare) * math.exp(-self.low[band] / (d + 1 + spare)) > spare and spare <= d:
            spare += 1
        return d, spare, d + 1 + spare


def signatures(s: np.ndarray, schemes: Schemes) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """All signatures of a set, the scheme's number in the low byte; and (scheme, what it may still leave out)."""
    out, left = [], []
    for band in schemes.of(len(s)):
        d, spare, k = schemes.shape(band)
        segment = ((mix(s + np.uint64(band)) >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        value = mix(s ^ np.uint64(0xA5A5))
        sums = np.zeros(k, np.uint64)
        np.add.at(sums, segment, value)
        filled = np.bincount(segment, minlength=k) > 0
        place = np.arange(k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band)
        empty = int(k - filled.sum())
        left.append((band, spare - empty))
        take = filled
        if empty > spare:
            whole = mix(sums + mix(place + np.uint64(1 << 40)))
            deleted = mix(sums[segment] - value + mix(place[segment] + np.uint64(1 << 40)))
            out.append(np.concatenate([whole, deleted]) & ~np.uint64(255) | np.uint64(DELETIONS))
            if d + 2 - 2 * (empty - spare) < 1:
                take = np.ones(k, bool)
        out.append(mix(sums[take] + mix(place[take])) & ~np.uint64(255) | np.uint64(band))
    return (np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)), left


def linked_blocks(sets: list[np.ndarray], split_at: int, threshold: int) -> np.ndarray:
    """Labels of the sets, equal for those connected by links.

    ``split_at``: 0 to compare all sets with each other, else those before it with those after.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    uniq, column = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.flatnonzero(np.bincount(column, minlength=len(uniq)) > 1)
    rank = np.full(len(uniq), -1)
    rank[often] = np.arange(len(often))
    column = rank[column]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    rows, cols = (slice(0, split_at), slice(split_at, n)) if split_at else (slice(0, n), slice(0, n))
    common = np.zeros((rows.stop, n - cols.start), np.float32)
    for start in range(0, len(often), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        dense = np.zeros((n, min(COLUMNS, len(often) - start)), np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        common += dense[rows] @ dense[cols].T
    union = size[rows][:, None] + size[cols][None, :] - common
    link = 100 * common.astype(np.float64) >= threshold * union
    full = np.zeros((n, n), bool)
    full[rows, cols] = link
    full |= full.T
    labels = np.full(n, -1)
    for i in range(n):
        if labels[i] < 0:
            labels[i] = i
            front = np.array([i])
            while len(front):
                front = np.flatnonzero(full[front].any(axis=0) & (labels < 0))
                labels[front] = i
    return labels


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and the row's number; documents must be read from a table, whose rows keep their places."""
    ready(docs.sparkSession)
    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid"))


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """rid, doc_id, n, id: each row's set size and the hash that stands for its set."""

    def run(batches):
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), size)
            ids = pa.array([set_id(s) for s in sets], pa.int64())
            n = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), n, ids], names=["rid", "doc_id", "n", "id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _rows(docs).mapInArrow(run, f"rid long, doc_id {kind}, n long, id long")


def candidate_edges(docs: DataFrame, size: int, threshold: int, large: int) -> DataFrame:
    """u, v: sets (by id) that share a signature, each with the smallest one in its bucket."""

    def run(batches):
        schemes, done = Schemes(threshold), set()
        for batch in slices(batches):
            sigs, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for s in shingle_sets(batch.column("text"), size):
                i = set_id(s)
                if i in done:  # a copy; a split has one row for each signature of a set
                    continue
                done.add(i)
                found, left = signatures(s, schemes)
                own = int(mix(np.array([i], np.int64).view(np.uint64))[0]) & ~0xFFFFFF
                may = [own | min(255, max(0, n)) << 16 | band << 8 | MAY_LEAVE for band, n in left]
                sigs += [found, np.array(may, np.uint64)]
                ids.append(np.full(len(found) + len(may), i, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(ids))], names=["sig", "id"]
            )

    rows = _rows(docs).select("text").mapInArrow(run, "sig long, id long")
    bucket = Window.partitionBy("sig")
    rows = rows.select("sig", "id", F.min("id").over(bucket).alias("m"), F.max("id").over(bucket).alias("x"), F.count("id").over(bucket).alias("c"))
    kind = F.col("sig").bitwiseAND(F.lit(255))
    shared = stored(rows.select(kind.alias("kind"), "sig", "id", "m", "x", "c").filter("m <> x OR kind = %d" % MAY_LEAVE))
    met = shared.filter(F.col("kind") != MAY_LEAVE)
    is_large = (F.col("c") > large) & (F.col("kind") != DELETIONS)
    small = met.filter(~is_large).select("id", "m")
    # a set may leave its large buckets in a scheme if they are no more than it has segments to spare
    band = F.shiftright("sig", 8).bitwiseAND(F.lit(255)).alias("kind")
    may = shared.filter(F.col("kind") == MAY_LEAVE).select("id", band, F.shiftright("sig", 16).bitwiseAND(F.lit(255)).alias("may")).distinct()
    many = met.filter(is_large)
    stay = many.groupBy("id", "kind").agg(F.count_distinct("sig").alias("n")).join(may, ["id", "kind"]).filter("n > may")
    kept = many.join(stay.select("id", "kind"), ["id", "kind"], "left_semi").select("id", "m")
    return small.unionAll(kept).filter("id <> m").select(F.col("id").alias("u"), F.col("m").alias("v")).distinct()


def verified_links(docs: DataFrame, classes: DataFrame, clusters: DataFrame, size: int, threshold: int) -> DataFrame:
    """u, v: for the sets of each cluster, links enough to connect what is connected.

    ``classes``: id, rep (a row that has the set), n. ``clusters``: node, root.
    """
    members = stored(clusters.join(classes, clusters["node"] == classes["id"]).select("id", "rep", "n", "root"))
    largest = members.agg(F.max("n")).first()[0] or 0
    # sets of a cluster meet within a size band and its neighbour only
    banded = members.withColumn("band", F.explode(Schemes(threshold).columns(F.col("n"), largest)))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = banded.groupBy("root", "band").agg(blocks.alias("blocks"), F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("sets"))
    sizes = stored(sizes.filter("sets > 1"))
    work = sizes.agg(F.sum(F.col("shingles") * F.col("blocks"))).first()[0] or 0
    n_bins = 1 + work // (2 * BLOCK_SHINGLES)

    def run(batches):
        for batch in slices(batches):
            data = [x.tobytes() for x in shingle_sets(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("root"), batch.column("at"), pa.array(data, pa.binary())], names=["id", "root", "at", "data"]
            )

    def verify(key, t):
        ids = t.column("id").to_numpy()
        parts = np.stack([t.column(c).to_numpy() for c in ("root", "band", "i", "j", "b")])
        order = np.lexsort((ids, *parts[::-1]))
        ids, parts = ids[order], parts[:, order]
        cuts = np.flatnonzero((np.diff(parts[:4], axis=1) != 0).any(axis=0)) + 1
        data = t.column("data").combine_chunks()
        u, v = [], []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
            sets = [np.frombuffer(data[int(r)].as_buffer(), np.uint64) for r in order[a:b]]
            split_at = int((parts[4, a:b] == parts[2, a]).sum()) if parts[2, a] != parts[3, a] else 0
            if len(sets) > 1 and split_at < len(sets):
                labels = linked_blocks(sets, split_at, threshold)
                other = np.flatnonzero(labels != np.arange(b - a))
                u.append(ids[a:b][other])
                v.append(ids[a:b][labels[other]])
        none = [np.zeros(0, np.int64)]
        return pa.table({"u": pa.array(np.concatenate(u or none)), "v": pa.array(np.concatenate(v or none))})

    held = banded.join(sizes, ["root", "band"]).groupBy("rep", "id", "root").agg(F.collect_list(F.struct("band", "blocks")).alias("at"))
    texts = _rows(docs).join(held, F.col("rid") == F.col("rep")).select("text", "id", "root", "at")
    sets = texts.mapInArrow(run, "id long, root long, at array<struct<band:int,blocks:int>>, data binary")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("b")
    each = sets.select("id", "root", "data", F.explode("at").alias("at")).select("id", "root", "data", "at.band", "at.blocks")
    each = each.select("*", own).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    pairs = each.select("id", "root", "band", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "data")
    binned = pairs.withColumn("bin", F.pmod(F.xxhash64("root", "band", "i", "j"), F.lit(n_bins)))
    return binned.groupBy("bin").applyInArrow(verify, "u long, v long")


def _groups(docs: DataFrame, size: int, threshold: int, large: int) -> tuple[DataFrame, DataFrame]:
    """rid, doc_id, n, id of each row; id, root of each set that has a group."""
    rows = stored(sets_of(docs, size))
    classes = rows.filter("n > 0").groupBy("id").agg(F.min("rid").alias("rep"), F.max("n").alias("n"))
    clusters = components(candidate_edges(docs, size, threshold, large))
    links = verified_links(docs, classes, clusters, size, threshold)
    linked = components(links)
    roots = rows.filter("n > 0").select("id").distinct().join(linked, F.col("id") == F.col("node"), "left")
    return rows, roots.select("id", F.coalesce("root", "id").alias("root"))


def groups(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD, large: int = LARGE) -> DataFrame:
    """doc_id, n_shingles, component_id of each row: the smallest doc_id reachable by links, its own included."""
    rows, roots = _groups(docs, size, threshold, large)
    least = rows.filter("n > 0").groupBy("id").agg(F.min("doc_id").alias("doc"))
    labels = roots.join(least, "id")
    labels = labels.join(labels.groupBy("root").agg(F.min("doc").alias("component_id")), "root").select("id", "component_id")
    out = rows.join(labels, "id", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD, large: int = LARGE) -> DataFrame:
    """``docs`` with one row of each group, that of the smallest doc_id; rows without words all stay."""
    rows, roots = _groups(docs, size, threshold, large)
    least = rows.filter("n > 0").groupBy("id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("s"))
    best = least.join(roots, "id").groupBy("root").agg(F.min("s").getField("rid").alias("_rid")).select("_rid")
    kept = best.unionAll(rows.filter("n = 0").select(F.col("rid").alias("_rid")))
    numbered = docs.withColumn("_rid", F.monotonically_increasing_id())
    return numbered.join(stored(kept), "_rid", "left_semi").drop("_rid")
