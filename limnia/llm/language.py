"""Language identification as inference of a mixture of languages.

Training counts hashed byte n-grams of each language over all training documents. A document
is a mixture: each of its n-grams comes from one language, with the document's own language
proportions. Expectation-maximisation estimates these; the set of languages is chosen by a
likelihood with a penalty for each further language, starting from all and leaving out the
weakest as long as that pays.

The model is a table of languages x BUCKETS numbers, whatever the corpus' size. Letters are
lower-cased (A-Z); n-grams run over letters beyond ASCII byte by byte. A document enters inference as
its distinct buckets with their counts, BUCKETS at most however long it is; texts beyond WINDOW
bytes are counted window by window.

Cases: text that is null or has no letter is ``und`` with score 0; text too short for an n-gram
gets the language with most training text; documents without a language
don't train; with no training document at all everything is ``und``; ties go to the first
language in text order; of more than MAX_LANGUAGES labels the MAX_LANGUAGES with most n-grams (then first in
text order) are learnt; an empty table gives no rows; other columns come through unchanged.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnia.llm.bytewords import LOWER, raw
from limnia.llm.common import broadcast, ready, slices, stored

ORDERS = (3,)
BUCKETS = 1 << 16
MAX_LANGUAGES = 200
WINDOW = 1 << 20
HOLD_ENTRIES = 1_000_000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def _has_letter(text: str | None) -> bool:
    return text is not None and any(x[0].isalpha() for x in _LETTER.finditer(text))


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that n-grams are made of, and the text that each lies in.

    Signs and digits count as blanks, and of several blanks only the one before a word stays.
    """
    low = LOWER[data]
    letter = (low >= 0x61) & (low <= 0x7A) | (low >= 0x80)
    begins = np.zeros(len(low) + 1, bool)
    begins[offsets] = True
    keep = letter.copy()
    keep[:-1] |= ~letter[:-1] & letter[1:] & ~begins[1:-1]
    at = np.flatnonzero(keep)
    x = np.where(letter[at], low[at], 32).astype(np.uint32)
    return x, np.searchsorted(offsets, at, "right") - 1


def grams(x: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams that lie in one text, and the texts, in their order."""
    codes, owners = [], []
    code = np.zeros(len(x), np.uint32)
    for k in range(1, max(ORDERS) + 1):
        n = len(x) - k + 1
        if n <= 0:
            break
        code = code[:n] * np.uint32(0x01000193) ^ x[k - 1 :] + np.uint32(k << 8)
        if k in ORDERS:
            h = code * np.uint32(0x9E3779B1)
            same = text[:n] == text[k - 1 :]
            codes.append((h >> np.uint32(16))[same])
            owners.append(text[:n][same])
    if not codes:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    codes, owners = np.concatenate(codes), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return codes[order], owners[order]


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return grams(*symbols(data, offsets))


def gram_counts(texts: pa.Array, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct buckets and how often they occur in it."""
    data, offsets = raw(texts)
    if len(offsets) == 2 and len(data) > window:
        counts, last = np.zeros(BUCKETS, np.int64), np.zeros(0, np.uint32)
        for a in range(0, len(data), window):
            piece = data[a : a + window + 1]  # whether a blank stays depends on the byte after it
            x, _ = symbols(piece, np.array([0, len(piece)]))
            if len(piece) > window and symbols(piece[-1:], np.array([0, 1]))[0].size:
                x = x[:-1]  # that byte itself belongs to the next window
            x = np.concatenate([last, x])
            counts += np.bincount(grams(x, np.zeros(len(x), np.int64))[0], minlength=BUCKETS)
            if len(last):  # n-grams within what was carried over were counted before
                counts -= np.bincount(grams(last, np.zeros(len(last), np.int64))[0], minlength=BUCKETS)
            last = x[-(max(ORDERS) - 1) :]
        at = np.flatnonzero(counts)
        return [(at, counts[at])]
    codes, owners = gram_buckets(data, offsets)
    keys, n = np.unique(owners << 16 | codes, return_counts=True)
    first = np.searchsorted(keys >> 16, np.arange(len(offsets)))
    return [(keys[p:q] & (BUCKETS - 1), n[p:q]) for p, q in zip(first[:-1], first[1:], strict=True)]


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, bucket, n: n-grams of each language, counted over all rows with a language."""

    def count(batches):
        names: dict[str, int] = {}
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([n for _, n in parts]), minlength=len(keys))
            return keys, n.astype(np.int64)

        def rows(keys, n):
            labels = pa.array(names, pa.string())
            for a in range(0, len(keys), 100_000):
                k = keys[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [labels.take(pa.array(k >> 16)), pa.array((k & (BUCKETS - 1)).astype(np.int32)), pa.array(n[a : a + 100_000])],
                    names=["lang", "bucket", "n"],
                )

        for batch in slices(batches):
            for lang, (at, n) in zip(batch.column("lang").to_pylist(), gram_counts(batch.column("text")), strict=True):
                parts.append((names.setdefault(lang, len(names)) << 16 | at.astype(np.int64), n))
                size += len(at)
            if size > 2 * HOLD_ENTRIES:
                parts = [merged()]
                size = len(parts[0][0])
                if size > HOLD_ENTRIES:  # many labels: hand out what there is
                    yield from rows(*parts[0])
                    names, parts, size = {}, [], 0
        if parts:
            yield from rows(*merged())

    ready(docs.sparkSession)
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    return rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Probability of each n-gram bucket in each language.

    ``penalty``: log-likelihood per n-gram that one more language must bring; ``least``: the
    smallest proportion that is looked at; ``rounds``: of expectation-maximisation.
    """

    def __init__(self, counts: dict[str, np.ndarray], penalty: float = 0.02, rounds: int = 12, prior: float = 0.5, least: float = 0.02) -> None:
        self.languages = sorted(counts)
        table = np.array([counts[x] for x in self.languages], dtype=np.float64).reshape(len(self.languages), BUCKETS)
        smooth = table + prior
        self.usual = table.sum(axis=1) / max(1.0, table.sum())
        self.prob = (smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()
        self.penalty, self.rounds, self.least = penalty, rounds, least

    def fit(self, prob: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions of the languages whose probabilities of buckets met ``n`` times are the columns, and the log-likelihood."""
        share = np.full(prob.shape[1], 1 / prob.shape[1])
        if prob.shape[1] == 1:
            return share, float(n @ np.log(prob[:, 0]))
        for _ in range(self.rounds):
            total = prob @ share.astype(np.float32)
            new = share * ((n / total) @ prob) / n.sum()
            moved = np.abs(new - share).max()
            share = new / new.sum()
            if moved < 1e-3:
                break
        return share, float(n @ np.log(prob @ share.astype(np.float32)))

    def mixture(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The proportion of every language in a document of these buckets, each met ``n`` times."""
        prob = self.prob[at]
        prob /= prob.max(axis=1, keepdims=True)
        chosen = np.arange(len(self.languages))
        share, fit = self.fit(prob, n)
        some = share > self.least  # those that explain next to nothing go at once
        if not some.all():
            chosen, prob = chosen[some], prob[:, some]
            share, fit = self.fit(prob, n)
        cost = self.penalty * n.sum() + 0.5 * np.log(n.sum() + 1)
        while len(chosen) > 1:
            keep = np.arange(len(chosen)) != share.argmin()
            fewer, less = self.fit(prob[:, keep], n)
            if less + cost < fit:
                break
            chosen, prob, share, fit = chosen[keep], prob[:, keep], fewer, less
        out = np.zeros(len(self.languages))
        out[chosen] = share
        return out


def train(docs: DataFrame) -> Model:
    counted = stored(count_grams(docs))
    most = counted.groupBy("lang").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "lang").limit(MAX_LANGUAGES)
    rows = counted.join(F.broadcast(most), "lang").select("lang", "bucket", "n").toArrow()  # MAX_LANGUAGES x BUCKETS numbers at most
    names, which = np.unique(np.array(rows.column("lang").to_pylist(), dtype=str), return_inverse=True)
    counts = {}
    for k, name in enumerate(names.tolist()):
        counts[name] = np.zeros(BUCKETS)
        counts[name][rows.column("bucket").to_numpy()[which == k]] = rows.column("n").to_numpy()[which == k]
    return Model(counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_lang`` and ``_score`` (the proportion of that language)."""
    spark, columns = ready(docs.sparkSession), docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType())])
    held = broadcast(spark, model)

    def run(batches):
        m = held()
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            langs, scores = [], []
            for t, (at, n) in zip(texts, gram_counts(batch.column("text")), strict=True):
                if not m.languages or not _has_letter(t):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                share = m.mixture(at, n) if len(at) else m.usual
                langs.append(m.languages[int(share.argmax())])
                scores.append(float(min(1.0, share.max())))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*columns, "_lang", "_score"],
            )

    return docs.mapInArrow(run, schema)
