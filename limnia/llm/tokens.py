"""Token ids of whole texts by a public tokenizer, computed once per distinct word.

The tokenizer with word ends treats each pre-token by itself: a run of letters, one digit, a
run of other signs, or an English contraction. So a worker cuts texts into pre-tokens with
array operations, asks the tokenizer about those it hasn't met, and looks up the rest. Texts
with characters beyond ASCII and Latin letters, or with spelled-out special tokens, are left
to the tokenizer itself; the result is the same ids either way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from limnia.llm.bytewords import raw, span_hashes

DEFAULT = "word_bpe_49k.json"
END_ID = 1
CACHE_WORDS = 1_000_000
ASK_WORDS = 20_000

# Byte classes: 0 white space, 1 letter, 2 digit, 3 other sign, 4 not for the quick way.
_CLASS = np.full(256, 4, np.uint8)
_CLASS[[9, 10, 13, 32]] = 0
_CLASS[33:127] = 3
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[48:58] = 2
_CLASS[[0xC3, 0xC4, 0xC5]] = 1
_CLASS[0x80:0xC0] = 1  # continues one of these three, as other lead bytes bar the text


def tokenizer_path(name: str = DEFAULT) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts; keeps what it has learnt about up to CACHE_WORDS words.

    Texts with more distinct words than that are encoded all the same, from a pool of their own.
    """

    _made: dict[str, Encoder] = {}

    def __init__(self, name: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.clear()

    @classmethod
    def of(cls, name: str = DEFAULT) -> Encoder:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if name not in cls._made:
            cls._made[name] = cls(name)
        return cls._made[name]

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint16)

    def _ask(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids, one after another, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int32, len(ids))
        return np.fromiter((x for i in ids for x in i), np.uint16, int(size.sum())), size

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        ids, size = self._ask(words)
        at = len(self.pool) + np.concatenate([[0], np.cumsum(size[:-1], dtype=np.int64)])
        self.pool = np.concatenate([self.pool, ids])
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at = np.insert(self.at, where, at)
        self.size = np.insert(self.size, where, size)

    def _look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each word, its place and size in the pool, and the pool."""
        uniq, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)

        def parts_of(which: np.ndarray):
            for part in np.array_split(which, max(1, len(which) // ASK_WORDS)):
                if len(part):
                    blob = data.tobytes() if len(part) > 1000 else None
                    yield part, [
                        (blob[starts[i] : ends[i]] if blob else data[starts[i] : ends[i]].tobytes()).decode()
                        for i in first[part]
                    ]

        if len(uniq) > CACHE_WORDS:  # more than can be kept
            ids, sizes = zip(*(self._ask(words) for _, words in parts_of(np.arange(len(uniq)))), strict=True)
            size = np.concatenate(sizes)
            at = np.concatenate([[0], np.cumsum(size[:-1], dtype=np.int64)])
            return at[inverse], size[inverse], np.concatenate(ids)

        def missing() -> np.ndarray:
            if not len(self.keys):
                return np.ones(len(uniq), bool)
            return self.keys[np.minimum(np.searchsorted(self.keys, uniq), len(self.keys) - 1)] != uniq

        new = missing()
        if len(self.keys) + int(new.sum()) > CACHE_WORDS:
            self.clear()
            new = missing()
        for part, words in parts_of(np.flatnonzero(new)):
            self._learn(uniq[part], words)
        where = np.searchsorted(self.keys, uniq)
        return self.at[where][inverse], self.size[where][inverse], self.pool

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, END_ID after each; text i has ids[offsets[i]:offsets[i + 1]].

        Null counts as empty text and has END_ID alone.
        """
        n = len(texts)
        data, offsets = raw(texts)
        kind = _CLASS[data]
        odd = np.zeros(n, bool)
        bad = kind == 4
        bad[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # times, divided by
        bad[:-1] |= (data[:-1] == 0xC4) & ((data[1:] == 0xB0) | (data[1:] == 0xB1))  # i with and without dot
        bad[:-1] |= (data[:-1] == 60) & (data[1:] == 124)  # <| begins a special token
        odd[np.searchsorted(offsets, np.flatnonzero(bad), "right") - 1] = True
        low = raw(pc.utf8_lower(pc.fill_null(texts, "")))[0] if not odd.any() else None
        if odd.any():
            quick = pc.if_else(pa.array(odd), "", pc.fill_null(texts, ""))
            low, quick_offsets = raw(pc.utf8_lower(quick))
            kind = _CLASS[low]
        else:
            quick_offsets = offsets
        starts, ends = self._pre_tokens(low, kind, quick_offsets)
        at, size, pool = np.zeros(0, np.int64), np.zeros(0, np.int32), self.pool
        if len(starts):
            at, size, pool = self._look_up(low, starts, ends)

        # one END_ID after each text: a pseudo word at the end of its words
        first = np.searchsorted(starts, quick_offsets)
        at = np.insert(at, first[1:], -1)
        size = np.insert(size, first[1:], 1)
        total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        spots = np.repeat(at - total[:-1], size) + np.arange(total[-1])
        ids = np.where(np.repeat(at, size) < 0, END_ID, pool[spots] if len(pool) else END_ID).astype(np.uint16)
        bounds = total[first + np.arange(n + 1)]
        if odd.any():
            parts, sizes = [], []
            for i in range(n):
                if odd[i]:
                    own = self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids
                    parts.append(np.array([*own, END_ID], dtype=np.uint16))
                else:
                    parts.append(ids[bounds[i] : bounds[i + 1]])
                sizes.append(len(parts[-1]))
            ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])
        return ids, bounds

    @staticmethod
    def _pre_tokens(data: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        begins = np.ones(len(data) + 1, bool)
        begins[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begins[offsets] = True
        bounds = np.flatnonzero(begins)
        starts, ends = bounds[:-1], bounds[1:].copy()
        keep = kind[starts] != 0
        starts, ends = starts[keep], ends[keep]
        # a lone ' right before letters: 's 't 'm 'd 're 've 'll take these letters along
        lone = np.flatnonzero((data[starts[:-1]] == 39) & (ends[:-1] - starts[:-1] == 1) & (starts[1:] == ends[:-1]) & (kind[starts[1:]] == 1))
        inner = np.zeros(len(data) + 1, bool)
        inner[offsets] = True
        lone = lone[~inner[starts[lone + 1]]]
        if len(lone):
            p = starts[lone + 1]
            a, room = data[p], ends[lone + 1] - p
            b = np.where(room > 1, data[np.minimum(p + 1, len(data) - 1)], 0)
            one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
            two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            take = np.where(one, 1, np.where(two, 2, 0))
            ends[lone] += take
            starts = starts.copy()
            starts[lone + 1] += take
            full = starts < ends
            starts, ends = starts[full], ends[full]
        return starts, ends
