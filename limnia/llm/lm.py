"""Language-model scores from a log-frequency Bloom filter.

Counts of all training tokens, and of all pairs of a token and the one before it, are gathered
exactly. A pair has evidence from FLOOR occurrences on, at any size of corpus; its count is
quantised to FLOOR times a power of STEP. The probability of a token mixes the pair's share of
its context with the smoothed token share; the weight of the former is chosen for each class of
contexts (by powers of two of their counts) by the training pairs' likelihood when an occurrence
doesn't count itself.

How often something occurs only decides where it is kept. Tokens of relative frequency COMMON or
more, and pairs of PAIR_COMMON or more, are broadcast: no more than 1/COMMON tokens and
1/PAIR_COMMON pairs can be that frequent, so a broadcast has a bound at any size of corpus. These
pairs are in a Bloom filter as one entry for each level from the filter's lowest up to the
count's; a probe asks level after level until one is missing. Between tokens of VOCABULARY or
more, and SERVED occurrences or more, its answer is the pair's count. All other tokens and pairs are looked up by a join: those of
each text meet the table of counts and of what each pair adds to a text's score. Most pairs of a
text occur nowhere else and are not looked up at all: while the filter's lowest level is FLOOR it
has every pair with evidence; in larger corpora a second filter, the screen, has those that are
left to the join. It takes SCREEN_BLOCKS at most and asks fewer bits of a pair where they get scarce.

Cases: null text is empty and has the end token alone; without training documents N and V are
0 and every probability is 1; rows with equal or null doc_id are scored one by one; an empty
table gives no rows; other columns come through unchanged.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnia.llm.bytewords import NOT_SPACE, mix, split
from limnia.llm.common import broadcast, ready, slices, stored

COMMON = 2.0**-21
VOCABULARY = COMMON
SERVED = 32  # occurrences of a token below which a false hit would weigh too much
PAIR_COMMON = 2.0**-26
FLOOR = 2.0
STEP = 1.5
PROBES = 8
WORD_PROBES = 4  # so many of them lie in one word
BLOCK_BITS = 1 << 19
BLOCK_WORDS = BLOCK_BITS // 64
END = np.uint64(0x656E64)  # stands for the end token's hash
RARE = np.uint64(1 << 63)  # set in the numbers of rare tokens and of their pairs
SCREEN_BLOCKS = 2048
HOLD_ENTRIES = 1_000_000
GRID = np.arange(0.0, 0.96, 0.05)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens with the end token after each, and where each text begins."""
    words = split(texts, NOT_SPACE)
    n = len(words.first) - 1
    return np.insert(words.hashes(), words.first[1:], END), words.first + np.arange(n + 1)


def pair_keys(before: np.ndarray, own: np.ndarray) -> np.ndarray:
    """A key of 64 bits for each pair of token numbers; those of common tokens sort by the first token."""
    mixed = mix(mix(before) * np.uint64(0x9E3779B97F4A7C15) + own) | RARE
    return np.where((before | own) & RARE > 0, mixed, before << np.uint64(32) | own)


def contexts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The hash before each token, the end token's before a text."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[first[:-1]] = END
    return before


class Tally:
    """Sums of counts by key, handed out with the key's columns when there are many."""

    def __init__(self, names: tuple[str, ...]) -> None:
        self.names = [*names, "n"]
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, keys: np.ndarray, *columns: np.ndarray) -> None:
        uniq, at, n = np.unique(keys, return_index=True, return_counts=True)
        self.parts.append((uniq, n, *(c[at] for c in columns)))
        self.size += len(uniq)
        if self.size > 2 * HOLD_ENTRIES:
            self.merge()

    def merge(self) -> None:
        keys, counts, *columns = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        uniq, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
        n = np.bincount(inverse, weights=counts, minlength=len(uniq)).astype(np.int64)
        self.parts, self.size = [(uniq, n, *(c[at] for c in columns))], len(uniq)

    def full(self) -> bool:
        return self.size > HOLD_ENTRIES

    def take(self):
        if self.parts:
            self.merge()
            _, n, *columns = self.parts[0]
            self.parts, self.size = [], 0
            for a in range(0, len(n), 100_000):
                b = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([*(pa.array(c[b].view(np.int64)) for c in columns), pa.array(n[b])], names=self.names)


def tallied(docs: DataFrame, keys_of, names: tuple[str, ...]) -> DataFrame:
    """``names`` and n: how often each key of the texts occurs.

    ``keys_of``: a 64-bit key for each occurrence, and the columns of hashes it stands for.
    """

    def count(batches):
        tally = Tally(names)
        for batch in slices(batches):
            tally.add(*keys_of(batch.column("text")))
            if tally.full():
                yield from tally.take()
        yield from tally.take()

    ready(docs.sparkSession)
    schema = ", ".join(f"{c} long" for c in (*names, "n"))
    return docs.select("text").mapInArrow(count, schema).groupBy(*names).agg(F.sum("n").alias("n"))


class LogFrequencyFilter:
    """Quantised counts of 64-bit keys in a Bloom filter made of blocks."""

    def __init__(self, blocks: np.ndarray, unit: float, probes: int | None = None) -> None:
        """``blocks``: a row of bytes each; ``unit``: the count that level 1 stands for."""
        self.blocks, self.unit, self.probes = blocks, unit, probes or PROBES

    @staticmethod
    def block_of(keys: np.ndarray, n_blocks: int) -> np.ndarray:
        return (mix(keys.view(np.uint64) + np.uint64(0xB10C)) % np.uint64(n_blocks)).astype(np.int64)

    @staticmethod
    def level(counts: np.ndarray, unit: float) -> np.ndarray:
        """0 below the unit; else the number of entries that stand for the count."""
        safe = np.maximum(counts / unit, 1e-300)
        return np.where(counts >= unit, 1 + np.floor(np.log(safe) / np.log(STEP) + 1e-9), 0).astype(np.int64)

    @staticmethod
    def value(level: np.ndarray, unit: float) -> np.ndarray:
        return np.where(level > 0, unit * STEP ** (level - 1.0), 0.0)

    @staticmethod
    def entry(keys: np.ndarray, level: int) -> np.ndarray:
        return keys.view(np.uint64) ^ np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)

    @staticmethod
    def probe(entry: np.ndarray, i: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """The entries' probes from ``i`` on, as many as a word takes: a word of 64 bits in the block, and the bits asked for there."""
        h = mix(entry + np.uint64(i * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
        word, bits = (h & np.uint64(BLOCK_WORDS - 1)).astype(np.int64), np.zeros_like(h)
        for j in range(min(WORD_PROBES, probes - i)):
            bits |= np.uint64(1) << (h >> np.uint64(16 + 6 * j) & np.uint64(63))
        return word, bits

    @classmethod
    def fill(cls, keys: np.ndarray, counts: np.ndarray, unit: float, probes: int | None = None) -> np.ndarray:
        """One block's bytes with all levels of the keys' counts."""
        probes = probes or PROBES
        out = np.zeros(BLOCK_WORDS, "<u8")
        level = cls.level(counts, unit)
        for j in range(1, int(level.max(initial=0)) + 1):
            entry = cls.entry(keys[level >= j], j)
            for i in range(0, probes, WORD_PROBES):
                np.bitwise_or.at(out, *cls.probe(entry, i, probes))
        return out.view(np.uint8)

    def count(self, keys: np.ndarray) -> np.ndarray:
        """The quantised count of each key, found by probing level after level."""
        level = np.zeros(len(keys), np.int64)
        if not len(self.blocks):
            return level.astype(float)
        words = self.blocks.reshape(-1).view("<u8")
        live, base = np.arange(len(keys)), self.block_of(keys, len(self.blocks)) * BLOCK_WORDS
        while len(live):
            has = self.has(words, base, self.entry(keys, int(level[live[0]]) + 1))
            live, base, keys = live[has], base[has], keys[has]
            level[live] += 1
        return self.value(level, self.unit)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key is there at all, if it isn't a false hit."""
        out = np.zeros(len(keys), bool)
        if len(self.blocks):
            base = self.block_of(keys, len(self.blocks)) * BLOCK_WORDS
            out[self.has(self.blocks.reshape(-1).view("<u8"), base, self.entry(keys, 1))] = True
        return out

    def has(self, words: np.ndarray, base: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """The numbers of the entries whose bits are all set; a missing word ends an entry's probes."""
        inside = np.arange(len(entry))
        for i in range(0, self.probes, WORD_PROBES):
            word, bits = self.probe(entry[inside], i, self.probes)
            inside = inside[words[base[inside] + word] & bits == bits]
        return inside


def classes_of(counts: np.ndarray) -> np.ndarray:
    """The class of contexts that occur so often."""
    return np.log2(np.maximum(1, counts)).astype(np.int64)


def quantised(counts: np.ndarray) -> np.ndarray:
    return LogFrequencyFilter.value(LogFrequencyFilter.level(counts, FLOOR), FLOOR)


class Model(NamedTuple):
    keys: np.ndarray  # sorted hashes of the common tokens
    counts: np.ndarray
    n: int  # training tokens
    v: int  # distinct ones
    in_pairs: np.ndarray  # whether the filter's counts serve for a common token's pairs
    weight: np.ndarray  # of the pair's share, for each common token as context
    blocks: np.ndarray
    unit: float  # the filter's lowest count
    starts: np.ndarray  # where the common tokens with these leading bits begin
    probes: int
    screen: np.ndarray  # blocks with the pairs to look up, if the filter lacks some
    screen_probes: int

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.1) / (self.n + 0.1 * (self.v + 1))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes among the common tokens, -1 for others."""
        last = len(self.keys) - 1
        at = np.minimum(self.starts[hashes >> np.uint64(65 - len(self.starts).bit_length())], last)
        behind = np.flatnonzero(self.keys[at] < hashes)
        while len(behind):
            behind = behind[at[behind] < last]
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < hashes[behind]]
        return np.where(self.keys[at] == hashes, at, -1)

    def numbers(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The places of common tokens, and 63 bits of the others' hashes."""
        return np.where(at >= 0, at.astype(np.uint64), hashes | RARE)

    def in_filter(self, context: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether the filter's counts serve for pairs of these places."""
        return (context >= 0) & (at >= 0) & self.in_pairs[context] & self.in_pairs[at]

    def code(self, context: np.ndarray, at: np.ndarray) -> np.ndarray:
        return pair_keys(context.astype(np.uint64), at.astype(np.uint64))


def starts_of(keys: np.ndarray) -> np.ndarray:
    """For each value of some leading bits the place of the first of the sorted keys that has them or more."""
    bits = len(keys).bit_length() + 1
    return np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The broadcast model, and the table k, n, gain of all that is looked up.

    For a token: its exact count, and what it adds to the log10 score as context. For a pair
    whose count the filter doesn't give: n is 0, and gain what it adds to the score of its second token.
    """
    spark = docs.sparkSession
    counts = stored(tallied(docs, lambda texts: (token_hashes(texts)[0],) * 2, ("k",)))
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = total["n"] or 0, total["v"]
    common = counts.filter((F.col("n") >= COMMON * n) | (F.col("k") == int(END))).toArrow()  # 1/COMMON rows at most
    keys = common["k"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, seen = keys[order], common["n"].to_numpy().astype(np.int64)[order]
    none, blocks = np.zeros(len(keys)), np.zeros((0, BLOCK_BITS // 8), np.uint8)
    empty = Model(keys, seen, n, v, none.astype(bool), none, blocks, FLOOR, starts_of(keys), PROBES, blocks, PROBES)
    if not n:
        end, zero = np.array([END]), np.zeros(1)
        none = empty._replace(keys=end, counts=zero.astype(np.int64), in_pairs=zero.astype(bool), weight=zero, starts=starts_of(end))
        return none, counts.withColumn("gain", F.lit(0.0))
    # the lowest level of the one grid of counts that bounds the number of pairs
    unit = FLOOR * STEP ** max(0, int(np.ceil(np.log(PAIR_COMMON * n / FLOOR) / np.log(STEP) - 1e-9)))
    model = empty._replace(in_pairs=(seen >= max(VOCABULARY * n, SERVED)) | (keys == END), unit=unit)
    frequent, pairs = counted_pairs(docs, counts, model)
    weights = context_weights(pairs, counts, model)
    blocks, probes = fill_blocks(frequent, unit)
    model = model._replace(blocks=blocks, probes=probes, weight=weights[classes_of(seen)])
    if unit > FLOOR:
        screen, probes = fill_blocks(pairs.filter("NOT filtered").select("k", F.lit(int(FLOOR)).cast("long").alias("n")), FLOOR, SCREEN_BLOCKS)
        model = model._replace(screen=screen, screen_probes=probes)
    table = looked_up(pairs, counts, model, weights)
    # all tables are stored: Spark's cleaner drops the shuffles behind them once the driver has collected its garbage
    spark.sparkContext._jvm.System.gc()
    return model, table


def counted_pairs(docs: DataFrame, counts: DataFrame, model: Model) -> tuple[DataFrame, DataFrame]:
    """The pairs of the filter, and all pairs of FLOOR occurrences or more: k, n, before, own, filtered.

    ``before`` and ``own`` are the counts of the pair's two tokens; ``filtered`` pairs are not looked up.
    """
    held = broadcast(docs.sparkSession, tuple(model))

    def occurring(texts: pa.Array) -> tuple[np.ndarray, ...]:
        m = Model(*held())
        hashes, first = token_hashes(texts)
        own = m.numbers(hashes, m.find(hashes))
        before = np.insert(own[:-1], 0, 0)
        before[first[:-1]] = np.searchsorted(m.keys, END)
        return pair_keys(before, own), before, own

    def add_common(batches):
        m = Model(*held())
        for b in batches:
            u, w, n = (b.column(c).to_numpy() for c in ("u", "w", "n"))
            added = [np.where(x >= 0, m.counts[np.maximum(x, 0)], 0) for x in (u, w)]
            filtered = m.in_filter(np.maximum(u, -1), np.maximum(w, -1)) & (n >= m.unit)
            columns = [pair_keys(u.view(np.uint64), w.view(np.uint64)).view(np.int64), u, w, n, *added, filtered]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k", "u", "w", "n", "before", "own", "filtered"])

    schema = "k long, u long, w long, n long, before long, own long, filtered boolean"
    pairs = tallied(docs, occurring, ("u", "w")).filter(F.col("n") >= FLOOR)
    pairs = stored(pairs.mapInArrow(add_common, schema))
    whole = (F.col("before") > 0) & (F.col("own") > 0)
    rest = pairs.filter(~whole)
    for token, column in (("u", "before"), ("w", "own")):
        # only rare tokens are looked up, which no more than COMMON of all pairs have; other rows go by their own key
        rare = F.col("k").bitwiseOR(F.lit(-(1 << 63)))
        one = counts.filter(F.col("n") < COMMON * model.n).select(rare.alias("_k"), F.col("n").alias("_n"))
        rest = rest.join(one, F.when(F.col(column) == 0, F.col(token)).otherwise(F.col("k")) == F.col("_k"), "left")
        rest = rest.withColumn(column, F.when(F.col(column) == 0, F.col("_n")).otherwise(F.col(column))).drop("_k", "_n")
    columns = ["k", "n", "before", "own", "filtered"]
    return pairs.filter(F.col("n") >= model.unit), pairs.filter(whole).select(*columns).union(stored(rest.select(*columns)))


def looked_up(pairs: DataFrame, counts: DataFrame, model: Model, weights: np.ndarray) -> DataFrame:
    held = broadcast(pairs.sparkSession, (model.n, model.v, weights))

    def emit(k: pa.Array, n: pa.Array, gain: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([k, n, pa.array(gain)], names=["k", "n", "gain"])

    def of_tokens(batches):
        _, _, weight = held()
        for b in batches:
            yield emit(b.column("k"), b.column("n"), np.log10(1 - weight[classes_of(b.column("n").to_numpy())]))

    def of_pairs(batches):
        n, v, weight = held()
        for b in batches:
            before = b.column("before").to_numpy()
            w = weight[classes_of(before)]
            share = np.minimum(1.0, quantised(b.column("n").to_numpy()) / before)
            base = (b.column("own").to_numpy() + 0.1) / (n + 0.1 * (v + 1))
            yield emit(b.column("k"), pa.array(np.zeros(b.num_rows, np.int64)), np.log10(1 + w * share / ((1 - w) * base)))

    schema = "k long, n long, gain double"
    rare = pairs.filter("NOT filtered").mapInArrow(of_pairs, schema).filter("gain > 0")
    return stored(counts.mapInArrow(of_tokens, schema).union(rare))


def fill_blocks(pairs: DataFrame, unit: float, most: int | None = None) -> tuple[np.ndarray, int]:
    """The filter's blocks, each built in a task of its own, and its probes; both follow from the entries.

    Where the blocks would be more than ``most`` the probes are fewer.
    """
    level = 1 + F.floor(F.log(F.col("n") / unit) / F.log(F.lit(STEP)) + 1e-9)
    entries = pairs.agg(F.sum(level)).first()[0] or 0
    n_blocks, probes = -(-int(entries * PROBES / np.log(2)) // BLOCK_BITS), PROBES
    if not n_blocks:
        return np.zeros((0, BLOCK_BITS // 8), np.uint8), PROBES
    if most and n_blocks > most:
        n_blocks, probes = most, max(1, int(most * BLOCK_BITS / entries * np.log(2)))

    def place(batches):
        for b in batches:
            block = LogFrequencyFilter.block_of(b.column("k").to_numpy().copy(), n_blocks)
            yield pa.RecordBatch.from_arrays([pa.array(block), b.column("k"), b.column("n")], names=["block", "k", "n"])

    def build(key, t):
        data = LogFrequencyFilter.fill(t.column("k").to_numpy().copy(), t.column("n").to_numpy(), unit, probes)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([data.tobytes()], pa.binary())})

    placed = pairs.mapInArrow(place, "block long, k long, n long")
    rows = placed.groupBy("block").applyInArrow(build, "block long, data binary").collect()  # the filter: bounded as said above
    out = np.zeros((n_blocks, BLOCK_BITS // 8), np.uint8)
    for r in rows:
        out[r["block"]] = np.frombuffer(r["data"], np.uint8)
    return out, probes


def context_weights(pairs: DataFrame, counts: DataFrame, model: Model) -> np.ndarray:
    """For each class of contexts, the weight of the pair's share that suits it best.

    Pairs below FLOOR count as not found.
    """
    of_class = counts.groupBy((F.length(F.bin("n")) - 1).alias("c")).agg(F.sum("n").alias("n")).collect()  # 64 rows at most
    n_classes = 1 + max(r["c"] for r in of_class)
    held = broadcast(pairs.sparkSession, (model.n, model.v))

    def gains(batches):
        n, v = held()
        gain, known = np.zeros((n_classes, len(GRID))), np.zeros(n_classes)
        for b in batches:
            times, before, own = (b.column(c).to_numpy() for c in ("n", "before", "own"))
            cls = classes_of(before)
            ratio = quantised(times - 1.0) / np.maximum(1, before - 1) / ((own + 0.1) / (n + 0.1 * (v + 1)))
            known += np.bincount(cls, weights=times, minlength=n_classes)
            for j, g in enumerate(GRID):
                gain[:, j] += np.bincount(cls, weights=times * np.log(g * ratio + 1 - g), minlength=n_classes)
        rows = [(i, j, gain[i, j], known[i]) for i in range(n_classes) for j in range(len(GRID))]
        cols = list(zip(*rows, strict=True))
        types = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["c", "j", "gain", "known"])

    rows = pairs.select("n", "before", "own").mapInArrow(gains, "c int, j int, gain double, known double")
    gain, known = np.zeros((n_classes, len(GRID))), np.zeros(n_classes)
    for c, j, g, k in rows.groupBy("c", "j").agg(F.sum("gain"), F.sum("known")).collect():
        gain[c, j], known[c] = g, k
    followers = np.zeros(n_classes)
    for r in of_class:
        followers[r["c"]] = r["n"]
    gain += np.maximum(0, followers - known)[:, None] * np.log(1 - GRID)[None, :]
    return GRID[gain.argmax(axis=1)]


def score(docs: DataFrame, model: Model, counts: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) with ``_n_tokens``, ``_n_known``, ``_base`` and ``_score``.

    The last two are log10 probabilities of the text, by token shares alone and by the model.
    """
    spark, columns = ready(docs.sparkSession), docs.columns if keep is None else keep
    held = broadcast(spark, tuple(model))
    schema = T.StructType([*(docs.schema[c] for c in columns), T.StructField("_n_tokens", T.LongType()), T.StructField("_n_common", T.LongType())])
    schema = schema.add("_base", T.DoubleType()).add("_score", T.DoubleType())
    schema = schema.add("_rare", T.ArrayType(T.LongType()))
    schema = schema.add("_times", T.ArrayType(T.IntegerType())).add("_gains", T.ArrayType(T.IntegerType()))

    def run(batches):
        m = Model(*held())
        base_log = np.log10(m.base(m.counts))
        found, complete = LogFrequencyFilter(m.blocks, m.unit, m.probes), m.unit <= FLOOR
        screen = LogFrequencyFilter(m.screen, FLOOR, m.screen_probes)
        for batch in slices(batches):
            hashes, first = token_hashes(batch.column("text"))
            at = m.find(hashes)
            common = at >= 0
            base = np.where(common, base_log[at], 0.0)
            before = contexts(hashes, first)
            context = np.insert(at[:-1], 0, -1)
            context[first[:-1]] = np.searchsorted(m.keys, END)
            weight = np.where(context >= 0, m.weight[context], 0.0)
            score = base + np.log10(1 - weight)
            missed = (context < 0) | (weight > 0)
            direct = m.in_filter(context, at)
            numbers = m.numbers(before, context), m.numbers(hashes, at)
            asked = np.flatnonzero(missed & (direct | complete))
            code, back = np.unique(pair_keys(numbers[0][asked], numbers[1][asked]), return_inverse=True)
            answer = found.count(code)[back]
            own = (answer > 0) & direct[asked]
            both, value = asked[own], answer[own]
            missed[both] = False
            if complete:
                missed[asked[answer == 0]] = False
            else:
                left = np.flatnonzero(missed)
                missed[left] = screen.holds(pair_keys(numbers[0][left], numbers[1][left]))
            share = np.minimum(1.0, value / np.maximum(1, m.counts[context[both]]))
            w = weight[both]
            score[both] = np.log10(w * share + (1 - w) * m.base(m.counts[at[both]]))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
            # to look up: rare tokens, rare contexts and pairs that the filter may lack or gives no count for
            places = [np.flatnonzero(~common), np.flatnonzero(context < 0), np.flatnonzero(missed)]
            pairs = pair_keys(numbers[0][places[2]], numbers[1][places[2]])
            sought = np.concatenate([hashes[places[0]], before[places[1]], pairs])
            as_token = np.repeat([1, 0, 0], [len(p) for p in places]).astype(np.int32)
            rare_owner = owner[np.concatenate(places)]
            order = np.lexsort((sought, rare_owner))
            ro, rh, as_token = rare_owner[order], sought[order], as_token[order]
            new = np.ones(len(ro), bool)
            new[1:] = (ro[1:] != ro[:-1]) | (rh[1:] != rh[:-1])
            starts = np.flatnonzero(new)
            times = (np.add.reduceat(as_token, starts) if len(starts) else as_token).astype(np.int32)
            gains = (np.diff(np.append(starts, len(ro))) - times).astype(np.int32)
            at_row = pa.array(np.searchsorted(ro[starts], np.arange(batch.num_rows + 1)).astype(np.int32))
            sums = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  each text has a token at least
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(sums(common & (m.n > 0)).astype(np.int64)),
                    pa.array(sums(base)),
                    pa.array(sums(score)),
                    pa.ListArray.from_arrays(at_row, pa.array(rh[starts].view(np.int64))),
                    pa.ListArray.from_arrays(at_row, pa.array(times)),
                    pa.ListArray.from_arrays(at_row, pa.array(gains)),
                ],
                names=schema.names,
            )

    part = stored(docs.select("*").mapInArrow(run, schema).withColumn("_id", F.monotonically_increasing_id()))
    rare = part.select("_id", F.explode(F.arrays_zip("_rare", "_times", "_gains")).alias("x"))
    rare = rare.select("_id", F.col("x._rare").alias("k"), F.col("x._times").alias("t"), F.col("x._gains").alias("g"))
    c = F.coalesce("n", F.lit(0))
    log = F.log10((c + 0.1) / F.lit(float(model.n + 0.1 * (model.v + 1))))
    sums = rare.join(counts, "k", "left").filter("t > 0 OR gain IS NOT NULL").groupBy("_id").agg(
        F.sum(F.col("t") * log).alias("_more"),
        F.sum(F.col("g") * F.coalesce("gain", F.lit(0.0))).alias("_gain"),
        F.sum(F.when(c > 0, F.col("t")).otherwise(0)).alias("_known"),
    )
    more = F.coalesce("_more", F.lit(0.0))
    return part.drop("_rare", "_times", "_gains").join(sums, "_id", "left").select(
        *columns,
        "_n_tokens",
        (F.col("_n_common") + F.coalesce("_known", F.lit(0))).alias("_n_known"),
        (F.col("_base") + more).alias("_base"),
        (F.col("_score") + more + F.coalesce("_gain", F.lit(0.0))).alias("_score"),
    )
