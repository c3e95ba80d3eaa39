"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. Documents stream through it word by
word; it always knows the longest run of items' words that ends here. A run that reaches
``min_words`` words, or covers a whole shorter item, is a hit. Stretches that cannot reach a
limit are skipped first: every two neighbours of a hit are neighbours in some item.

Items are split by hash into shards of about SHARD_BYTES of text, and documents pass one
shard after the other; a shard's automaton is all that is broadcast.

Words: A-Z lower-cased, then runs of ASCII digits, letters and everything beyond ASCII.

Cases: null text has no words; an item without words has no window; items with equal ids count
once; a null item id reads as empty text; rows with equal or null doc_id are judged one by one;
empty tables give no rows or no hits; other columns come through unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnia.llm.bytewords import ALNUM, raw, split
from limnia.llm.common import broadcast, ready, slices, stored, text_bytes

MIN_WORDS = 10
MAX_COVERAGE = 0.8
SHARD_BYTES = 1 << 20
SPANS = "array<struct<first:int,end:int>>"
MARK = "…"


class SuffixAutomaton:
    """All runs of words of several sequences; state 0 is the empty run."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, word: int) -> int:
        """The state that is exactly the runs of p followed by ``word``; cloned off a longer one if need be."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            new = self._state(self.length[last] + 1, 0, {})
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word)
            last = new

    def walk(self, words):
        """(state, length) of the longest known run that ends at each word."""
        state, n = 0, 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            to = self.next[state].get(w)
            state, n = (to, n + 1) if to is not None else (0, 0)
            yield state, n


class Matcher:
    """Finds items' windows in word hashes of documents."""

    def __init__(self, items: list[tuple[str, np.ndarray]], min_words: int) -> None:
        """``items``: id and word hashes of each test item."""
        items = [(i, w) for i, w in items if len(w)]
        self.min_words = min_words
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(w for _, w in items)]))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        sequences = [np.searchsorted(self.vocabulary, w) for _, w in items]
        v = len(self.vocabulary)
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(s[:-1] * v + s[1:] for s in sequences)]))
        self.shortest = min([min_words, *map(len, sequences)])
        self.automaton = SuffixAutomaton()
        for s in sequences:
            self.automaton.add(s.tolist())
        link, length = self.automaton.link, self.automaton.length
        self.items_at: list[set[str]] = [set() for _ in length]
        self.ends_at: dict[int, set[str]] = {}
        for (name, _), s in zip(items, sequences, strict=True):
            for state, n in self.automaton.walk(s.tolist()):
                while state > 0 and name not in self.items_at[state]:
                    self.items_at[state].add(name)
                    state = link[state]
            if len(s) < min_words:
                state, n = list(self.automaton.walk(s.tolist()))[-1]
                while length[link[state]] >= len(s):
                    state = link[state]
                self.ends_at.setdefault(state, set()).add(name)

    def search(self, hashes: np.ndarray, text_first: np.ndarray) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """Spans of hit words (numbered over all texts) and items, by the number of the text."""
        found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        if not len(self.vocabulary) or not len(hashes):
            return found
        known = np.flatnonzero(self.seen[(hashes >> np.uint64(48)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[known])
        right = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == hashes[known]
        known, at = known[right], at[right]
        if not len(known):
            return found
        text = np.searchsorted(text_first, known, "right") - 1
        joined = (np.diff(known) == 1) & (np.diff(text) == 0)
        code = at[:-1] * len(self.vocabulary) + at[1:]
        if len(self.pairs):
            joined &= self.pairs[np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)] == code
        else:
            joined[:] = False
        cuts = np.flatnonzero(~joined) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(known)]])
        long = ends - starts >= self.shortest
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            spans, items = self._stretch(at[a:b].tolist(), int(known[a]))
            if spans:
                mine = found.setdefault(int(text[a]), ([], set()))
                mine[0].extend(spans)
                mine[1].update(items)
        return found

    def _stretch(self, words: list[int], base: int) -> tuple[list[tuple[int, int]], set[str]]:
        link, length, limit = self.automaton.link, self.automaton.length, self.min_words
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for i, (state, n) in enumerate(self.automaton.walk(words)):
            size = 0
            if n >= limit:
                top = state
                while length[link[top]] >= limit:
                    top = link[top]
                items |= self.items_at[top]
                size = limit
            if self.ends_at:
                u = state
                while u > 0:
                    if u in self.ends_at and length[u] <= n:
                        items |= self.ends_at[u]
                        size = max(size, length[u])
                    u = link[u]
            if size:
                a, b = base + i + 1 - size, base + i + 1
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, b))
        return spans, items


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _shards(benchmark: DataFrame, min_words: int):
    """A broadcast matcher for each shard of the items."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    items = stored(items.distinct())  # repeated rows count once and would all fall into one shard
    n = 1 + text_bytes(items) // SHARD_BYTES
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        rows = part.collect()  # a shard: about SHARD_BYTES of text
        words = split(pa.array([r["text"] for r in rows], pa.string()), ALNUM)
        hashes = words.hashes()
        pairs = [(r["item"], hashes[words.first[i] : words.first[i + 1]]) for i, r in enumerate(rows)]
        yield Matcher(pairs, min_words)


def scan(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``_n_words``, ``_n_hit``, ``_items`` (ids as text) and ``_spans`` (ranges of hit words)."""
    spark = ready(docs.sparkSession)
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("_n_words", T.LongType()), T.StructField("_n_hit", T.LongType())])
    schema = schema.add("_items", T.ArrayType(T.StringType())).add("_spans", T.DataType.fromDDL(SPANS))
    out = docs.select("*", F.lit(0).cast("long").alias("_n_words"), F.lit(0).cast("long").alias("_n_hit"))
    out = out.select("*", F.array().cast("array<string>").alias("_items"), F.array().cast(SPANS).alias("_spans"))

    def search(matcher):
        def run(batches):
            for batch in slices(batches):
                words = split(batch.column("text"), ALNUM)
                found = matcher().search(words.hashes(), words.first)
                items = batch.column("_items").to_pylist()
                spans = [[(s["first"], s["end"]) for s in x] for x in batch.column("_spans").to_pylist()]
                for i, (new, names) in found.items():
                    spans[i] = _merge(spans[i] + [(a - int(words.first[i]), b - int(words.first[i])) for a, b in new])
                    items[i] = sorted({*items[i], *names})
                hit = [sum(b - a for a, b in x) for x in spans]
                spans = [[{"first": a, "end": b} for a, b in x] for x in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in columns),
                        pa.array(np.diff(words.first), pa.int64()),
                        pa.array(hit, pa.int64()),
                        pa.array(items, pa.list_(pa.string())),
                        pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                    ],
                    names=[*columns, "_n_words", "_n_hit", "_items", "_spans"],
                )

        return run

    for matcher in _shards(benchmark, min_words):
        out = out.mapInArrow(search(broadcast(spark, matcher)), schema)
    return out


def remove_spans(scanned: DataFrame, mark: str = MARK) -> DataFrame:
    """Cut the hit words, and what stands between them, out of ``text``.

    A word that no item has takes their place, so that no new window arises across a cut.
    """
    columns = scanned.columns

    def cut(batches):
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            spans = batch.column("_spans").to_pylist()
            hit = [i for i, s in enumerate(spans) if s]
            words = split(pa.array([texts[i] for i in hit], pa.string()), ALNUM)
            data, offsets = raw(pa.array([texts[i] for i in hit], pa.string()))
            for k, i in enumerate(hit):
                first, at, parts = int(words.first[k]), int(offsets[k]), []
                for s in spans[i]:
                    parts += [data[at : words.starts[first + s["first"]]].tobytes(), mark.encode()]
                    at = int(words.ends[first + s["end"] - 1])
                parts.append(data[at : offsets[k + 1]].tobytes())
                texts[i] = b"".join(parts).decode()
            place = columns.index("text")
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if k == place else batch.column(k) for k in range(len(columns))], names=columns
            )

    return scanned.mapInArrow(cut, scanned.schema)


def free_mark(benchmark: DataFrame, mark: str = MARK) -> str:
    """``mark`` repeated until it is no word of any item."""
    while benchmark.filter(F.contains("text", F.lit(mark))).limit(1).count():
        mark += MARK
    return mark


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, max_coverage: float = MAX_COVERAGE, keep_length: str | None = None
) -> DataFrame:
    """``docs`` without hit spans; documents of which more than ``max_coverage`` is hit go.

    ``keep_length``: a column, if there is one, that holds the text's length and follows it.
    """
    scanned = scan(docs, benchmark, min_words).filter(F.col("_n_hit") <= F.col("_n_words") * max_coverage)
    cut = remove_spans(scanned, free_mark(benchmark))
    if keep_length in docs.columns:
        length = F.when(F.col("_n_hit") > 0, F.char_length("text")).otherwise(F.col(keep_length))
        cut = cut.withColumn(keep_length, length.cast(docs.schema[keep_length].dataType))
    return cut.select(*docs.columns)
