"""Alignment of two tokenizers by products of token-byte incidence matrices.

Both tokenizers cut the same bytes, so each has an incidence matrix: one row per
token, one column per byte, held as CSR (row starts and column numbers, built
here by hand).  A row of ``A . B^T`` is put together after Gustavson: the rows of
``B^T`` that the entries of A's row name are merged, and an entry counts the
bytes that two tokens share.  These are the overlap links.  Links whose ranges
end together lie on the offsets where both tokenizers cut; these offsets part the
tokens into groups, and the products of the group incidences are the
shared-group links (kept as factors: a group's tokens on either side, as their
pairs grow with the square of a group).

How often a pair of ids is linked in the whole corpus is counted over blocks of
texts: a block holds its distinct pairs once, and its texts' links as places in
that list.  Spark adds up the pairs of all blocks, finds the highest count of each
B id, and joins the sums back to the blocks that asked for them, so a text never
meets more than its own pairs and no table of all pairs is ever in one place.
Blocks are bounded by the bytes of their texts; a pair that every block holds
costs one row a block, in a join that can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import MAX_VOCABULARY, Codec, _ragged
from .common import slices, stored

#: Bytes of text in a block, about (a longer text is a block by itself).
BLOCK = 1 << 20
#: Entries that a run of row products expands at a time, about.
RUN = 1 << 18
#: Bytes of text that the second tokenizer gets in one call, about.
CALL = 1 << 18


@dataclass(frozen=True)
class Csr:
    """A matrix of ones: row ``i`` has columns ``indices[starts[i]:starts[i + 1]]``, in order."""

    starts: np.ndarray
    indices: np.ndarray
    width: int

    @classmethod
    def of_ranges(cls, ends: np.ndarray) -> Csr:
        """Consecutive ranges that end before ``ends``: row ``i`` covers its range's columns."""
        size = int(ends[-1]) if len(ends) else 0
        return cls(np.append(0, ends), np.arange(size), size)

    @classmethod
    def of_labels(cls, labels: np.ndarray, width: int) -> Csr:
        """One entry a row: its label."""
        return cls(np.arange(len(labels) + 1), labels, width)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        counts = np.bincount(self.indices, minlength=self.width)
        order = np.argsort(self.indices, kind="stable")
        return Csr(np.append(0, np.cumsum(counts)), rows[order], len(self.starts) - 1)


def row_products(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of ``a . b`` as rows, columns and values, in order, a run of rows at a time."""
    rows, cols, values = [], [], []
    last = len(a.starts) - 1
    work = np.append(0, np.cumsum(np.diff(b.starts)[a.indices]))[a.starts]  # products up to each row
    at = 0
    while at < last:
        end = max(at + 1, int(np.searchsorted(work, work[at] + RUN, side="right")) - 1)
        entries = a.indices[a.starts[at] : a.starts[end]]
        row = np.repeat(np.arange(at, end), np.diff(a.starts[at : end + 1]))
        count = b.starts[entries + 1] - b.starts[entries]
        key = np.repeat(row, count) * b.width + b.indices[_ragged(b.starts[entries], count)]
        if (key[1:] < key[:-1]).any():
            key.sort(kind="stable")
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
        rows.append(key[first] // max(1, b.width))
        cols.append(key[first] % max(1, b.width))
        values.append(np.diff(np.append(first, len(key))))
        at = end
    return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (rows, cols, values))


@dataclass(frozen=True)
class Aligned:
    """Texts in two tokenizations over the same bytes, end to end.

    ``a``, ``b``: ids; ``a_ends``, ``b_ends``: byte offsets; ``a_count``, ``b_count``: tokens of each text.
    """

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_count: np.ndarray
    b_count: np.ndarray

    def overlaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Overlap links: token of A, token of B, bytes they share."""
        return row_products(Csr.of_ranges(self.a_ends), Csr.of_ranges(self.b_ends).transposed())

    def groups(self) -> tuple[Csr, Csr]:
        """Group incidences of A's and of B's tokens."""
        cuts = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        return tuple(Csr.of_labels(np.searchsorted(cuts, ends), len(cuts)) for ends in (self.a_ends, self.b_ends))

    def shared_groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shared-group links, all of them: token of A, token of B, 1.  Their number grows with the square of a group."""
        a, b = self.groups()
        return row_products(a, b.transposed())


class Aligner:
    """A byte-level BPE file (A) and a sentencepiece model (B) over the same texts."""

    def __init__(self, a: bytes, b: bytes):
        self.a = Codec(a)
        self.a.split, self.a.added = None, {}  # special tokens' strings are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        pieces = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.b_size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.b_place = np.cumsum(self.b_size) - self.b_size
        self.b_bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.written = {}

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode("utf-8")

    def _encode_b(self, texts: list[str]) -> list[np.ndarray]:
        out, waiting, size = [], [], 0
        for n, text in enumerate(texts):
            waiting.append(text)
            size += len(text)
            if size > CALL or n == len(texts) - 1:
                out += [np.array(ids, dtype=np.int64) for ids in self.b.encode(waiting, num_threads=1)]
                waiting, size = [], 0
        return out

    def align(self, texts: list[str | None]) -> Aligned:
        """Tokens of the texts; one that is NULL or empty, or that a tokenizer does not give back, has none."""
        full = [i for i, t in enumerate(texts) if t]
        raw = [(" " + texts[i]).encode("utf-8", "surrogatepass") for i in full]
        a = [np.frombuffer(x, dtype="<u4").astype(np.int64) for x in self.a.encode_all(" " + texts[i] for i in full)]
        b = self._encode_b([texts[i] for i in full])
        none = np.zeros(0, dtype=np.int64)
        all_a, all_b = [none] * len(texts), [none] * len(texts)
        for i, r, x, y in zip(full, raw, a, b):
            if int(self.a.size[x].sum()) == len(r) == int(self.b_size[y].sum()) and self.a._bytes_of(x) == r == self._bytes_of(y):
                all_a[i], all_b[i] = x, y
        joined_a, joined_b = (np.concatenate([none, *x]) for x in (all_a, all_b))
        return Aligned(
            joined_a,
            joined_b,
            np.cumsum(self.a.size[joined_a]),
            np.cumsum(self.b_size[joined_b]),
            np.array([len(x) for x in all_a], dtype=np.int64),
            np.array([len(x) for x in all_b], dtype=np.int64),
        )

    def _bytes_of(self, ids: np.ndarray) -> bytes:
        return self.b_bytes[_ragged(self.b_place[ids], self.b_size[ids])].tobytes()

    def _words(self, ids: np.ndarray, label: np.ndarray, last: str) -> np.ndarray:
        """Ids in decimal, each with what follows it: a comma, or ``last`` at a group's end."""
        out = []
        for end in (",", last):
            if end not in self.written:
                most = max(len(self.a.size), len(self.b_size))
                self.written[end] = np.array([f"{i}{end}" for i in range(most)], dtype=object)
            out.append(self.written[end][ids])
        ends = np.append(label[1:] != label[:-1], True)
        return np.where(ends, out[1], out[0])

    def group_texts(self, x: Aligned) -> list[str]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        if not len(x.a):
            return [""] * len(x.a_count)
        ga, gb = (g.indices for g in x.groups())
        words = np.concatenate([self._words(x.a, ga, "|"), self._words(x.b, gb, ";")])
        # groups in order, A's tokens before B's
        order = np.argsort(np.concatenate([2 * ga, 2 * gb + 1]), kind="stable")
        words = words[order].tolist()
        upto = np.append(0, np.cumsum(x.a_count + x.b_count)).tolist()
        return ["".join(words[i:j])[:-1] for i, j in zip(upto, upto[1:])]


def load(spark: SparkSession, a_path: str, b_path: str):
    """Both vocabularies' contents, sent to all tasks; each at most ``MAX_VOCABULARY`` bytes."""
    contents = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            contents.append(f.read(MAX_VOCABULARY + 1))
        if len(contents[-1]) > MAX_VOCABULARY:
            raise ValueError(f"{path} is larger than {MAX_VOCABULARY} bytes")
    return spark.sparkContext.broadcast(tuple(contents))


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(vocabularies) -> Aligner:
    key = hash(vocabularies.value)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*vocabularies.value)
    return _ALIGNERS[key]


_LINKS = "id long, a array<int>, b array<int>, links array<struct<a:int,b:int,bytes:int,together:boolean>>, " \
    "groups array<struct<a:array<int>,b:array<int>>>"


def links(docs: DataFrame, id_col: str, text_col: str, vocabularies) -> DataFrame:
    """All links of each text: ``id, a, b`` (ids in order), ``links`` (places of an A and a B token, the bytes they
    share, whether they end together) and ``groups`` (places of the tokens of each group, whose pairs are the
    shared-group links).  Texts without tokens have empty lists."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(vocabularies)
        for batch in batches:
            for one in range(batch.num_rows):
                x = aligner.align(batch.column("text").slice(one, 1).to_pylist())
                at, to, shared = x.overlaps()
                ends = x.a_ends[at] == x.b_ends[to]
                by_a, by_b = (g.transposed() for g in x.groups())
                members = [[g.indices[i:j].tolist() for i, j in zip(g.starts, g.starts[1:])] for g in (by_a, by_b)]
                yield pa.RecordBatch.from_pylist(
                    [{
                        "id": batch.column("id")[one].as_py(),
                        "a": x.a.tolist(),
                        "b": x.b.tolist(),
                        "links": [
                            dict(zip(("a", "b", "bytes", "together"), link))
                            for link in zip(at.tolist(), to.tolist(), shared.tolist(), ends.tolist())
                        ],
                        "groups": [{"a": p, "b": q} for p, q in zip(*members)],
                    }],
                    schema=_LINKS_ARROW,
                )

    return _slim(docs, id_col, text_col).mapInArrow(work, _LINKS)


_INTS = pa.list_(pa.int32())
_LINKS_ARROW = pa.schema([
    ("id", pa.int64()), ("a", _INTS), ("b", _INTS),
    ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32()), ("together", pa.bool_())]))),
    ("groups", pa.list_(pa.struct([("a", _INTS), ("b", _INTS)]))),
])


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))


_COUNTS = "n_a n_b n_groups n_links n_overlaps n_shared".split()
_DOC = f"id long, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string"
_BLOCK = f"docs array<struct<{', '.join(x.replace(' ', ':') for x in _DOC.split(', '))}>>, pairs binary, counts binary, links binary"


def _block(aligner: Aligner, ids: list, texts: list) -> dict:
    x = aligner.align(texts)
    at, to, _ = x.overlaps()
    together = x.a_ends[at] == x.b_ends[to]
    pairs, place, counts = np.unique(x.a[at[together]] << 32 | x.b[to[together]], return_inverse=True, return_counts=True)
    a_upto = np.append(0, np.cumsum(x.a_count))
    ga, gb = (g.transposed() for g in x.groups())
    # a text's groups, links and overlaps follow those of the text before
    groups_upto = np.searchsorted(ga.indices[ga.starts[1:] - 1], a_upto)
    shared_upto = np.append(0, np.cumsum(np.diff(ga.starts) * np.diff(gb.starts)))[groups_upto]
    columns = [
        x.a_count,
        x.b_count,
        np.diff(groups_upto),
        np.diff(np.searchsorted(at[together], a_upto)),
        np.diff(np.searchsorted(at, a_upto)),
        np.diff(shared_upto),
    ]
    shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in aligner.group_texts(x)]
    docs = [
        dict(zip(["id", *_COUNTS, "groups_sha256"], row)) for row in zip(ids, *(c.tolist() for c in columns), shas)
    ]
    return {
        "docs": docs,
        "pairs": pairs.astype("<i8").tobytes(),
        "counts": counts.astype("<i8").tobytes(),
        "links": _narrow(place, len(pairs)),
    }


def _narrow(places: np.ndarray, most: int) -> bytes:
    """Places below ``most`` in two or four bytes each, compressed: they take most of a block."""
    return zstandard.ZstdCompressor(level=1).compress(places.astype("<u2" if most <= 1 << 16 else "<u4").tobytes())


def _wide(data: bytes, count: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * count else "<u4")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "counts"))):
            pairs, counts = (np.frombuffer(x, dtype="<i8") for x in (pairs, counts))
            if len(pairs):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), block)), pa.array(np.arange(len(pairs), dtype=np.int32)), pa.array(pairs), pa.array(counts)],
                    names=["block", "at", "pair", "n"],
                )


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a block's texts with the corpus-wide counts of the block's pairs."""
    for batch in batches:
        for one in range(batch.num_rows):
            row = batch.slice(one, 1)
            known = row.column("known")[0].values
            n, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
            if known is not None and len(known):
                order = np.argsort(known.field("at").to_numpy())
                n = known.field("total").to_numpy()[order]
                best = known.field("best").to_numpy(zero_copy_only=False)[order]
            docs = row.column("docs")[0].values
            upto = np.append(0, np.cumsum(docs.field("n_links").to_numpy()))
            links = _wide(row.column("links")[0].as_py(), int(upto[-1]))
            sums = [np.append(0, np.cumsum(v[links].astype(np.int64))) for v in (best, n)]
            yield pa.RecordBatch.from_arrays(
                [*(docs.field(c) for c in ("id", *_COUNTS)), *(pa.array(s[upto[1:]] - s[upto[:-1]]) for s in sums), docs.field("groups_sha256")],
                names=["id", *_COUNTS, "n_best", "count_sum", "groups_sha256"],
            )


def align(docs: DataFrame, id_col: str, text_col: str, vocabularies, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``id``, tokens, groups and links that end together (``n_a, n_b, n_groups,
    n_links``), overlap and shared-group links (``n_overlaps, n_shared``), ``n_best`` (links whose pair of ids has the
    highest count of its B id), ``count_sum`` (the counts of all its links) and ``groups_sha256``.

    NULL and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens: all numbers
    are zero and the digest is the empty text.  Repeated rows count as often as they stand there; NULL ids are kept.
    Other columns are ignored, so none can clash; an empty table gives no rows.  A count that several pairs of a B
    id share is its highest for all of them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(vocabularies)
        for part in slices(batches, "text", block):
            row = _block(aligner, part.column("id").to_pylist(), part.column("text").to_pylist())
            yield pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)

    blocks = stored(
        _slim(docs, id_col, text_col).mapInArrow(work, _BLOCK).withColumn("block", F.monotonically_increasing_id())
    )
    pairs = blocks.select("block", "pairs", "counts").mapInArrow(_exploded, "block long, at int, pair long, n long")
    totals = stored(pairs.groupBy("pair").agg(F.sum("n").alias("total")))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    highest = totals.groupBy(b).agg(F.max("total").alias("highest"))  # a row for each id of B's vocabulary at most
    known = totals.select("pair", "total", b).join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    answers = (
        pairs.select("block", "at", "pair")
        .join(known, "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("at", "total", "best")).alias("known"))
    )
    return blocks.select("block", "docs", "links").join(answers, "block", "left").mapInArrow(
        _judged, f"id long, {', '.join(f'{c} long' for c in (*_COUNTS, 'n_best', 'count_sum'))}, groups_sha256 string"
    )


_BLOCK_ARROW = pa.schema([
    ("docs", pa.list_(pa.struct([("id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("groups_sha256", pa.string())]))),
    ("pairs", pa.binary()), ("counts", pa.binary()), ("links", pa.binary()),
])
