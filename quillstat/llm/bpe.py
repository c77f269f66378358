"""Byte-level BPE with forced boundaries.

A pair of neighbouring bytes that occurs inside no vocabulary token can never
end up in one token: between such bytes every encoding has a cut.  A text is
therefore cut at the vocabulary's added tokens, at its pre-token pattern and, in
each pre-token, at every forced boundary; the fragments are merged independently
(side by side in arrays, equal pre-tokens once per worker) and their ids concatenated.  Decoding joins
the tokens' bytes.

The vocabulary file is read on the driver and sent to the tasks once (its size
is that of the file, checked against ``MAX_VOCABULARY``); texts only ever pass
through one map, one at a time.
"""

from __future__ import annotations

import heapq
import json
import struct
from collections.abc import Iterable

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_batches

#: Bytes of a vocabulary file, at most.
MAX_VOCABULARY = 64 << 20
#: Pre-tokens that a worker remembers; beyond, it starts afresh.
REMEMBERED = 600_000
#: Fragments longer than this are merged by way of a heap.
LONG = 64
#: Characters that are encoded together, about; longer texts are cut at a space that begins a pre-token.
GROUP = 500_000

#: Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


_OTHER, _LETTER, _NUMBER, _WHITE = range(4)
_SINGLE_SPACE = regex.compile(r"(?<=\S) (?=\S)")
#: An odd number whose powers tell the places of a string's characters apart.
_BASE = 0x9E3779B97F4A7C15


def _classes() -> np.ndarray:
    """Class of each code point in the pattern of pre-tokens."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for first in range(0, 0x110000, 0x800):
        if 0xD800 <= first < 0xE000:
            continue  # no characters
        text = "".join(map(chr, range(first, first + 0x800)))
        for kind, name in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_WHITE, r"\s+")):
            for run in regex.finditer(name, text):
                out[first + run.start() : first + run.end()] = kind
    return out


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Memory:
    """Ids of pre-tokens by the hash of their characters, in sorted arrays."""

    def __init__(self):
        self.keys = np.zeros(0, dtype=np.uint64)
        self.first = np.zeros(0, dtype=np.int64)  # of its ids
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        at = np.searchsorted(self.keys, keys)
        inside = np.minimum(at, max(0, len(self.keys) - 1))
        return at, (self.keys[inside] == keys) if len(self.keys) else np.zeros(len(keys), dtype=bool)

    def add(self, at: np.ndarray, keys: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        """Insert keys, sorted, at the places that ``find`` gave."""
        first = len(self.ids) + np.cumsum(count) - count
        self.keys, self.first, self.count = (
            np.insert(old, at, new) for old, new in ((self.keys, keys), (self.first, first), (self.count, count))
        )
        self.ids = np.append(self.ids, ids)


class Codec:
    """Encoder and decoder of one vocabulary file (the tokenizers library's JSON)."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        of = _byte_of_char()
        raw = lambda token: bytes(of[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.tokens = {i: raw(t) for t, i in vocab.items()}
        self.single = {self.tokens[i]: i for i in self.tokens if len(self.tokens[i]) == 1}
        self.ranks, self.made = {}, []  # pair -> rank, rank -> token
        for pair in spec["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a], vocab[b]] = len(self.made)
            self.made.append(vocab[a + b])
        self.inside = np.zeros(65536, dtype=bool)
        for token in self.tokens.values():
            t = np.frombuffer(token, dtype=np.uint8).astype(np.int64)
            self.inside[t[:-1] * 256 + t[1:]] = True
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens |= {i: t.encode("utf-8") for t, i in self.added.items()}
        by_length = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        self.memory = _Memory()
        self.kind = _classes()
        # all tokens' bytes end to end, for decoding
        known = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.size = np.array([len(t) for t in known], dtype=np.int64)
        self.place = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(known), dtype=np.uint8)
        # pair ranks as arrays: all pairs by key, and pairs of bytes at once
        self.byte_ids = np.array([self.single[bytes([b])] for b in range(256)], dtype=np.int64)
        self.wide = max(self.tokens) + 1
        pairs = sorted((x * self.wide + y, r) for (x, y), r in self.ranks.items())
        self.pair_keys, self.pair_ranks = (np.array(x, dtype=np.int64) for x in zip(*pairs))
        self.made_ids = np.array(self.made, dtype=np.int64)
        first = np.arange(256).repeat(256)
        self.byte_pair_ranks = self._ranks_of(self.byte_ids[first], self.byte_ids[np.tile(np.arange(256), 256)])

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; the number of merges where there is none."""
        key = a * self.wide + b
        at = np.searchsorted(self.pair_keys, key).clip(max=len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], len(self.made))

    def cuts(self, data: bytes) -> list[int]:
        """The forced boundaries inside ``data``."""
        t = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
        return (np.flatnonzero(~self.inside[t[:-1] * 256 + t[1:]]) + 1).tolist()

    def _learn(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each pre-token, and all ids: the pre-tokens lie end to end, are cut into fragments, and
        merge together."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pretokens]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int64)
        ends = np.cumsum([len(r) for r in raw])
        pair = data[:-1] * 256 + data[1:]
        bound = ~self.inside[pair]
        bound[ends[:-1] - 1] = True  # between pre-tokens
        token = np.full(len(data), -1, dtype=np.int64)  # at each token's first byte, its id
        fragment = np.concatenate([[0], np.cumsum(bound)])
        rank = np.append(np.where(bound, len(self.made), self.byte_pair_ranks[pair]), len(self.made))
        size = np.bincount(fragment)
        if (size > LONG).any():
            first = np.concatenate([[0], np.cumsum(size)])
            for f in np.flatnonzero(size > LONG):
                ids = self._merge_long(self.byte_ids[data[first[f] : first[f + 1]]].tolist())
                token[first[f] + np.cumsum(self.size[ids]) - self.size[ids]] = ids
        short = size[fragment] <= LONG
        self._merge_together(token, np.flatnonzero(short), self.byte_ids[data[short]], fragment[short], rank[short])
        real = token >= 0
        return np.diff(np.cumsum(real)[ends - 1], prepend=0), token[real].astype(np.uint32)

    def _merge_together(self, token, at, ids, fragment, rank) -> None:
        """In every round each fragment merges its lowest pair, the leftmost of equals; finished ones leave."""
        none = len(self.made)
        while len(ids):
            start = np.concatenate([[0], np.flatnonzero(fragment[1:] != fragment[:-1]) + 1])
            length = np.diff(np.append(start, len(ids)))
            low = np.minimum.reduceat(rank, start).repeat(length)
            over = low == none
            if over.any():
                token[at[over]] = ids[over]
                go = ~over
                at, ids, fragment, rank, low = at[go], ids[go], fragment[go], rank[go], low[go]
                if not len(ids):
                    return
            hit = np.flatnonzero(rank == low)
            hit = hit[np.concatenate([[True], fragment[hit[1:]] != fragment[hit[:-1]]])]
            ids[hit] = self.made_ids[rank[hit]]
            keep = np.ones(len(ids), dtype=bool)
            keep[hit + 1] = False
            at, ids, fragment, rank = at[keep], ids[keep], fragment[keep], rank[keep]
            hit -= np.arange(len(hit))  # as many were dropped before each
            for left in (hit, hit[hit > 0] - 1):
                right = np.minimum(left + 1, len(ids) - 1)
                same = (right > left) & (fragment[left] == fragment[right])
                found = np.full(len(left), none)
                found[same] = self._ranks_of(ids[left[same]], ids[right[same]])
                rank[left] = found

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs, for fragments of any length."""
        n, rank = len(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if (r := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # a neighbour has merged meanwhile
            ids[i], ids[j] = new, _ = self.made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank((new, ids[k]))) is not None:
                    heapq.heappush(heap, (r, i, new, ids[k]))
            if (h := before[i]) >= 0 and (r := rank((ids[h], new))) is not None:
                heapq.heappush(heap, (r, h, ids[h], new))
        return [x for x in ids if x >= 0]

    def _starts(self, points: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """Where pre-tokens start, by ``PATTERN``; ``opens`` are the places where a text starts."""
        kind = self.kind[points]
        white, space = kind == _WHITE, points == 32
        n = len(points)
        begins = np.zeros(n + 1, dtype=bool)
        begins[opens] = begins[n] = True
        ends, begins = begins[1:], begins[:-1]
        change = np.append(True, kind[1:] != kind[:-1]) | begins
        spaced = np.append(False, space[:-1]) & ~begins  # after a space, which then is the start
        last = white & ~ends & ~np.append(white[1:], True)  # the last white space before a character that is none
        starts = np.where(white, change | last, change & ~spaced)
        # 's 't 'm 'd 're 've 'll, where the apostrophe starts a pre-token
        quote = np.flatnonzero((points == 39) & starts & ~ends)
        one, two = points[quote + 1], points[np.minimum(quote + 2, n - 1)]
        pair = ~ends[quote + 1] & (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))
        cut = pair | np.isin(one, (115, 116, 109, 100))
        quote, after = quote[cut], quote[cut] + 2 + pair[cut]
        starts[quote + 1] = False
        inside = (after < n) & ~ends[np.minimum(after, n) - 1]
        after = after[inside]
        starts[after[kind[after] == _LETTER]] = True
        return np.flatnonzero(starts)

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        """Ids of non-empty texts: their pre-tokens are looked up by hash, the new ones learned once."""
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        opens = np.cumsum([0, *map(len, texts[:-1])])
        start = self._starts(points, opens)
        stop = np.append(start[1:], len(points))
        # the hash of a pre-token: its characters, each times the power of its place from the end
        power = np.full(int((stop - start).max()), _BASE, dtype=np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        left = np.repeat((stop - 1).astype(np.int32), stop - start) - np.arange(len(points), dtype=np.int32)
        product = power[left]
        product *= points + np.uint64(1)
        keys = np.add.reduceat(product, start)
        del left, product
        keys ^= (stop - start).astype(np.uint64) << np.uint64(48)
        unique, sample, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.memory.keys) > REMEMBERED:
            self.memory = _Memory()
        at, there = self.memory.find(unique)
        if not there.all():
            new = sample[~there]
            count, ids = self._learn([whole[a:b] for a, b in zip(start[new].tolist(), stop[new].tolist())])
            self.memory.add(at[~there], unique[~there], count, ids)
            at, _ = self.memory.find(unique)
        at = at[inverse]
        count = self.memory.count[at]
        ids = self.memory.ids[_ragged(self.memory.first[at], count)]
        if self._bytes_of(ids) != whole.encode("utf-8", "surrogatepass"):  # two pre-tokens of one hash
            count, ids = self._learn([whole[a:b] for a, b in zip(start.tolist(), stop.tolist())])
        upto = np.append(0, np.cumsum(count))[np.append(np.searchsorted(start, opens), len(start))]
        packed = ids.astype("<u4").tobytes()
        return [packed[4 * a : 4 * b] for a, b in zip(upto.tolist(), upto[1:].tolist())]

    def _bytes_of(self, ids: np.ndarray) -> bytes:
        return self.bytes[_ragged(self.place[ids], self.size[ids])].tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; NULL is empty."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes]:
        """The same for many texts, which share the work on their pre-tokens."""
        out: list[list[bytes]] = []
        waiting: list[str] = []
        places: list[tuple[int, int]] = []
        size = 0

        def work() -> None:
            if waiting:
                for (text, part), ids in zip(places, self._encode_group(waiting)):
                    out[text][part] = ids
            waiting.clear()
            places.clear()

        for text in texts:
            out.append([])
            for part in self.split.split(text or "") if self.split else [text or ""]:
                if part in self.added:
                    out[-1].append(struct.pack("<I", self.added[part]))
                    continue
                while part:
                    cut = _SINGLE_SPACE.search(part, GROUP) if len(part) > GROUP else None
                    piece, part = (part[: cut.start()], part[cut.start() :]) if cut else (part, "")
                    places.append((len(out) - 1, len(out[-1])))
                    out[-1].append(b"")
                    waiting.append(piece)
                    size += len(piece)
                    if size > GROUP:
                        work()
                        size = 0
        work()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: bytes | None) -> str:
        """Text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        return self._bytes_of(np.frombuffer(ids or b"", dtype="<u4")).decode("utf-8", "replace")


def _ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` of each run, ``count`` long, end to end."""
    upto = np.cumsum(count)
    return np.repeat(first - upto + count, count) + np.arange(upto[-1] if len(upto) else 0)


_CODECS: dict[int, Codec] = {}


def load(spark: SparkSession, path: str):
    """The vocabulary file's content, sent to all tasks."""
    with open(path, "rb") as f:
        content = f.read(MAX_VOCABULARY + 1)
    if len(content) > MAX_VOCABULARY:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY} bytes")
    return spark.sparkContext.broadcast(content)


def _codec(vocabulary) -> Codec:
    """The worker's codec of a broadcast vocabulary; a worker serves one query, so one is kept."""
    key = hash(vocabulary.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary.value)
    return _CODECS[key]


def encode(docs: DataFrame, text_col: str, vocabulary, out: str) -> DataFrame:
    """``docs`` with ``out binary``: the ids of each text, 4 bytes each, little-endian.

    NULL and empty texts have no ids (empty, not NULL).  Rows are encoded one by one, so repeated rows and an empty
    table need no care; an input column named ``out`` is replaced, all others stay.
    """

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        codec = _codec(vocabulary)
        return pd.Series(codec.encode_all(texts), dtype=object)

    text_batches(docs)
    return docs.withColumn(out, ids(F.col(f"`{text_col}`")))


def decode(docs: DataFrame, ids_col: str, vocabulary, out: str) -> DataFrame:
    """``docs`` with ``out string``: the text of packed ids (NULL: empty); rows and columns as with ``encode``."""

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        codec = _codec(vocabulary)
        return pd.Series([codec.decode(x) for x in ids], dtype=object)

    text_batches(docs)
    return docs.withColumn(out, text(F.col(f"`{ids_col}`")))
