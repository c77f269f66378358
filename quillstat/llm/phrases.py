"""Phrase collocations by direct-address tiling of word pairs.

In a block of texts words are numbered by frequency, so the numbers of common
words are small and their pairs lie together: the table of pairs is cut into
tiles of ``TILE`` by ``TILE`` numbers.  A tile with many pairs is counted as a
dense array (``bincount`` over the cell number, which is an address); the pairs
of the other tiles are sorted and their runs counted (COO).  Pairs that are
frequent enough in the whole table are ranked in turn and take the place of the
words: a pair of neighbouring pairs is a phrase of three words, a pair of these
one of four.  Everything longer than one word is thus found by the same step, and
only over parts that are frequent themselves.

Scale.  Texts of one language are gathered into blocks of bounded size.  A block
keeps its sequence of parts, and deals its distinct pairs with their counts to
buckets by their hash, sorted and compressed, a row for each block and bucket.
Buckets are so many that about ``BUCKET`` pairs meet in each.  There the counts are
added up, pairs that are too rare end, and the others go back to the blocks that hold
them, with one number for each pair.  No vocabulary is ever in one place, a language
with most of the texts is as many blocks as it needs, and as a block sends a pair
once, no pair weighs more in its bucket than there are blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Bytes of text in a block, about (a longer text is a block by itself).
BLOCK = 8 << 20
#: Pairs or words of blocks that meet in a bucket, about.
BUCKET = 500_000
#: Ids on a tile's side, and the share of its cells that its pairs must reach to be counted densely.
TILE, DENSE = 256, 8
#: Occurrences of a candidate, words in it, results of each language.
LEAST, MOST_WORDS, FIRST = 30, 4, 2000
#: A candidate goes if a longer one with at least so many hundredths of its count holds it.
COVERED = 80
#: Fixed value: score of a phrase whose parts occur nowhere else, times two.
SCALE = 2_000_000
#: The language of texts without one.
UNKNOWN = "und"

#: What ends a piece; it becomes a full stop, a tab a space, and A-Z small.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(_ENDS))


def tokens(text: bytes) -> list[bytes]:
    """Words of a text in order, with ``b"."`` between pieces."""
    return text.translate(_FOLD).replace(b".", b" . ").split()


def count_pairs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of neighbours of a sequence of frequency ranks (negative: no part) as left, right and count,
    and for each place of the sequence but the last the number of its pair (-1: none)."""
    place = np.full(max(0, len(numbers) - 1), -1, dtype=np.int32)
    at = np.flatnonzero((numbers[:-1] >= 0) & (numbers[1:] >= 0))
    a, b = numbers[at].astype(np.int64), numbers[at + 1].astype(np.int64)
    tiles, tile = np.unique((a // TILE) << 31 | b // TILE, return_inverse=True)
    cell = (a % TILE) * TILE + b % TILE
    held = np.bincount(tile, minlength=len(tiles))
    dense = held * DENSE >= TILE * TILE
    found, counts, base = [], [], 0  # pairs as tile number and cell
    for t in np.flatnonzero(dense):
        mine = np.flatnonzero(tile == t)
        full = np.bincount(cell[mine], minlength=TILE * TILE)
        cells = np.flatnonzero(full)
        number = np.cumsum(full > 0) - 1  # by address
        place[at[mine]] = base + number[cell[mine]]
        found.append(t * TILE * TILE + cells)
        counts.append(full[cells])
        base += len(cells)
    sparse = np.flatnonzero(~dense[tile]) if len(tile) else tile
    keys, number, n = np.unique(tile[sparse] * (TILE * TILE) + cell[sparse], return_inverse=True, return_counts=True)
    place[at[sparse]] = base + number
    keys, counts = np.concatenate([*found, keys]).astype(np.int64), np.concatenate([*counts, n]).astype(np.int64)
    of, cells = tiles[keys // (TILE * TILE)], keys % (TILE * TILE)
    return (of >> 31) * TILE + cells // TILE, (of & ((1 << 31) - 1)) * TILE + cells % TILE, counts, place


#: ``words``: the words of a block, end to end with line feeds (no word has one), ``n``: how often each is there;
#: ``seq``: places in that list, from 1 (0: the end of a piece).
_WORDS = "lang string, words binary, n binary, seq binary, total long, size long"
_WORDS_ARROW = pa.schema([
    ("lang", pa.string()), ("words", pa.binary()), ("n", pa.binary()), ("seq", pa.binary()), ("total", pa.int64()), ("size", pa.int64()),
])
#: ``ids``: the parts of a block, most frequent first; ``seq``: places in that list (-1: no part); ``size``: its pairs.
_PARTS = "block long, lang string, ids binary, seq binary, size long"
#: What a block sends to a bucket: items from its place ``base`` on.
_DEALT = "bucket long, lang string, block long, base int, count int, items binary"
#: What a bucket finds: frequent items for the blocks that sent them (``known``: places and ids), and one row for each
#: (``id`` and ``a``, with ``word`` or ``left`` and ``right``).
_FOUND = "block long, known binary, lang string, id long, a long, word string, left long, right long"
_FOUND_ARROW = pa.schema([
    ("block", pa.int64()), ("known", pa.binary()), ("lang", pa.string()), ("id", pa.int64()), ("a", pa.int64()),
    ("word", pa.string()), ("left", pa.int64()), ("right", pa.int64()),
])


def _packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers, compressed by columns."""
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.astype("<i8").tobytes() for a in arrays))


def _unpacked(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="<i8").reshape(-1, count)


def _worded(block: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def row(lang: str) -> pa.RecordBatch:
            sizes[lang] = 0
            numbers = {b".": 0}
            seq = np.fromiter((numbers.setdefault(w, len(numbers)) for w in tokens(b".".join(waiting.pop(lang)))), dtype=np.int32)
            n = np.bincount(seq, minlength=len(numbers))[1:]
            values = lang, b"\n".join(list(numbers)[1:]), n.astype("<i8").tobytes(), seq.tobytes(), int(n.sum()), len(n)
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, _WORDS_ARROW)], schema=_WORDS_ARROW)

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                lang, raw = lang.as_py(), text.as_buffer().to_pybytes()
                waiting.setdefault(lang, []).append(raw)
                sizes[lang] = sizes.get(lang, 0) + len(raw)
                if sizes[lang] >= block:
                    yield row(lang)
        for lang in list(waiting):
            yield row(lang)

    return work


def _reranked(places: np.ndarray, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sequence of items (-1: none) after the frequent ones, ``at`` with ``ids``, have got ranks of their own."""
    number = np.full(int(places.max(initial=-1)) + 2, -1, dtype=np.int32)  # the last one: of no item
    number[at] = np.arange(len(at))
    seq = number[places]
    held = np.bincount(seq[seq >= 0], minlength=len(ids))
    order = np.argsort(-held, kind="stable")
    rank = np.empty(len(ids) + 1, dtype=np.int32)
    rank[order], rank[-1] = np.arange(len(ids)), -1
    seq = rank[seq]
    gap = seq < 0
    return ids[order], seq[~(gap & np.append(False, gap[:-1]))]  # one place for a stretch without parts


def _column(rows: pa.RecordBatch, name: str, row: int = 0):
    return rows.column(name)[row].as_py()


def _parts(places_of):
    """Blocks of the next step: frequent items in the places that ``places_of`` a block gives."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(batch.num_rows):
                row = batch.slice(one, 1)
                known = [np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype="<i8").reshape(2, -1) for x in _column(row, "known")]
                at, ids = np.concatenate(known, axis=1)
                ids, seq = _reranked(places_of(row), at, ids)
                size = len(count_pairs(seq)[2])
                if size:
                    yield pa.RecordBatch.from_arrays(
                        [row.column("block"), row.column("lang"), pa.array([ids.tobytes()]), pa.array([seq.tobytes()]), pa.array([size])],
                        names=["block", "lang", "ids", "seq", "size"],
                    )

    return work


def _sequence(row: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(_column(row, "seq"), dtype=np.int32)


def _ids(row: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(_column(row, "ids"), dtype=np.int64)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of pairs of ids."""
    h = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _in_buckets(buckets: np.ndarray):
    """Runs of equal buckets of a sorted array: bucket, first and last place."""
    starts = np.append(np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])), len(buckets)) if len(buckets) else [0]
    for i, j in zip(starts, starts[1:]):
        yield int(buckets[i]), int(i), int(j)


def _dealt_rows(row: pa.RecordBatch, runs) -> Iterator[pa.RecordBatch]:
    columns = list(zip(*runs))
    if columns:
        bucket, base, count, items = columns
        k = len(bucket)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket, type=pa.int64()), pa.array([_column(row, "lang")] * k, type=pa.string()),
             pa.array([_column(row, "block")] * k, type=pa.int64()), pa.array(base, type=pa.int32()), pa.array(count, type=pa.int32()),
             pa.array(items, type=pa.binary())],
            names=["bucket", "lang", "block", "base", "count", "items"],
        )


def _word_order(row: pa.RecordBatch, buckets: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words of a block, the order in which they are dealt, and their buckets in that order."""
    raw = _column(row, "words")
    words = raw.split(b"\n") if raw else []
    of = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words)) % np.uint64(buckets)
    order = np.array(sorted(range(len(words)), key=lambda i: (of[i], words[i])), dtype=np.int64)
    return words, order, of[order].astype(np.int64)


def _pair_order(row: pa.RecordBatch, buckets: int):
    """Left, right and count of a block's pairs, the order in which they are dealt, their buckets, and ``count_pairs``' places."""
    ids = _ids(row)
    left, right, n, place = count_pairs(_sequence(row))
    left, right = ids[left], ids[right]
    of = (_mixed(left, right) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((right, left, of))
    return left, right, n, order, of[order], place


def _deal_words(buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(batch.num_rows):
                row = batch.slice(one, 1)
                words, order, of = _word_order(row, buckets)
                n = np.frombuffer(_column(row, "n"), dtype="<i8")[order] if len(order) else order
                pack = zstandard.ZstdCompressor(level=3).compress
                runs = []
                for bucket, i, j in _in_buckets(of):
                    text = b"\n".join([words[w] for w in order[i:j].tolist()])
                    runs.append((bucket, i, j - i, pack(n[i:j].astype("<i8").tobytes() + text)))
                yield from _dealt_rows(row, runs)

    return work


def _deal_pairs(buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(batch.num_rows):
                row = batch.slice(one, 1)
                left, right, n, order, of, _ = _pair_order(row, buckets)
                left, right, n = left[order], right[order], n[order]
                # lefts are sorted, so their differences are small
                runs = [(b, i, j - i, _packed(np.diff(left[i:j], prepend=0), right[i:j], n[i:j])) for b, i, j in _in_buckets(of)]
                yield from _dealt_rows(row, runs)

    return work


def _by_bucket(batches: Iterator[pa.RecordBatch]):
    """Rows of each bucket, which stand together."""
    held, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = row["bucket"], row["lang"]
            if key != held and rows:
                yield held[1], rows
                rows = []
            held = key
            rows.append(row)
    if rows:
        yield held[1], rows


def _answers(rows: list[dict], key: np.ndarray, n: np.ndarray, blocks: int, least: int):
    """Of the items of a bucket, ``key`` from 0: answers to the blocks, and for each frequent item a place, id and count."""
    counts = np.array([r["count"] for r in rows])
    at = np.concatenate([np.arange(r["base"], r["base"] + r["count"], dtype=np.int64) for r in rows])
    number = at * blocks + np.repeat([r["block"] for r in rows], counts)
    total = np.zeros(int(key.max()) + 1, dtype=np.int64)
    np.add.at(total, key, n)
    first = np.full(len(total), np.iinfo(np.int64).max)
    np.minimum.at(first, key, number)
    often = total[key] >= least
    upto = np.append(0, np.cumsum(counts))
    answers = [
        (r["block"], _packed(at[i:j][often[i:j]], first[key[i:j][often[i:j]]]))
        for r, i, j in zip(rows, upto, upto[1:]) if often[i:j].any()
    ]
    chosen = np.flatnonzero(often & (number == first[key]))
    return answers, chosen, number[chosen], total[key[chosen]]


def _found_rows(lang: str, answers, ids, a, **columns) -> Iterator[pa.RecordBatch]:
    k, m = len(answers), len(ids)
    values = {
        "block": [b for b, _ in answers] + [None] * m, "known": [x for _, x in answers] + [None] * m, "lang": [lang] * (k + m),
        "id": [None] * k + ids.tolist(), "a": [None] * k + a.tolist(),
    } | {c: [None] * k + list(v) for c, v in columns.items()}
    if k + m:
        yield pa.RecordBatch.from_arrays(
            [pa.array(values.get(f.name, [None] * (k + m)), type=f.type) for f in _FOUND_ARROW], schema=_FOUND_ARROW
        )


def _merge_words(blocks: int, least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, rows in _by_bucket(batches):
            numbers: dict[bytes, int] = {}
            keys, ns, words = [], [], []
            for r in rows:
                data = zstandard.ZstdDecompressor().decompress(r["items"])
                ns.append(np.frombuffer(data[: 8 * r["count"]], dtype="<i8"))
                own = data[8 * r["count"] :].split(b"\n")
                keys.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), dtype=np.int64, count=len(own)))
                words.append(own)
            key = np.concatenate(keys)
            answers, chosen, ids, a = _answers(rows, key, np.concatenate(ns), blocks, least)
            names = list(numbers)
            yield from _found_rows(lang, answers, ids, a, word=[names[key[i]].decode("utf-8") for i in chosen.tolist()])

    return work


def _merge_pairs(blocks: int, least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, rows in _by_bucket(batches):
            left, right, n = np.concatenate([_unpacked(r["items"], r["count"]) for r in rows], axis=1)
            ends = np.cumsum([r["count"] for r in rows])
            sums = np.cumsum(left)  # lefts are differences within a row
            left = sums - np.repeat(np.append(0, sums[ends[:-1] - 1]), np.diff(ends, prepend=0))
            _, l = np.unique(left, return_inverse=True)
            kinds, r = np.unique(right, return_inverse=True)
            _, key = np.unique(l * len(kinds) + r, return_inverse=True)  # sorted COO of the bucket
            answers, chosen, ids, a = _answers(rows, key, n, blocks, least)
            yield from _found_rows(lang, answers, ids, a, left=left[chosen].tolist(), right=right[chosen].tolist())

    return work


def _frequent(blocks: DataFrame, deal, merge, numbers: int, least: int, bucket: int) -> tuple[DataFrame, int]:
    """What the buckets find, and how many there are."""
    items = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-items // bucket))
    dealt = blocks.mapInArrow(deal(buckets), _DEALT).repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang")
    return stored(dealt.mapInArrow(merge(numbers, least), _FOUND)), buckets


def _next(blocks: DataFrame, found: DataFrame, places_of) -> DataFrame:
    """The blocks with the frequent items found in them as their parts."""
    known = found.where("block IS NOT NULL").groupBy("block").agg(F.collect_list("known").alias("known"))
    return stored(blocks.join(known, "block").mapInArrow(_parts(places_of), _PARTS))


def _places(order: np.ndarray, count: int) -> np.ndarray:
    """Where each item of a block stands in the order in which it was dealt; the last one: none."""
    where = np.full(count + 1, -1, dtype=np.int64)
    where[order] = np.arange(count)
    return where


def _word_places(buckets: int):
    def places(row: pa.RecordBatch) -> np.ndarray:
        words, order, _ = _word_order(row, buckets)
        return _places(order, len(words))[_sequence(row) - 1]

    return places


def _pair_places(buckets: int):
    def places(row: pa.RecordBatch) -> np.ndarray:
        left, _, _, order, _, place = _pair_order(row, buckets)
        return _places(order, len(left))[place]

    return places


def phrase_counts(
    docs: DataFrame, text_col: str, lang_col: str, least: int = LEAST, most_words: int = MOST_WORDS, block: int = BLOCK,
    bucket: int = BUCKET,
) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of 1, 2, ... words, and ``lang, n`` (all word occurrences).

    A table has ``lang, id, a`` (occurrences), ``phrase``, ``last`` (its last word), ``pre`` and ``post``
    (occurrences of its first and last 1, 2, ... words); from two words on ``left`` and ``right``, the ids of its
    phrases without the last and the first word.  NULL texts are empty, and NULL languages are ``und``.
    """
    slim = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    blocks = stored(slim.mapInArrow(_worded(block), _WORDS).withColumn("number", F.monotonically_increasing_id()))
    # blocks are numbered closely, by partition and place in it
    part, within = F.shiftright("number", 33), F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    last, most = blocks.agg(F.max(part), F.max(within) + 1).first()
    most = most or 1
    numbers = ((last or 0) + 1) * most
    blocks = blocks.withColumn("block", part * F.lit(most) + within)
    totals = blocks.groupBy("lang").agg(F.sum("total").alias("n"))
    found, buckets = _frequent(blocks, _deal_words, _merge_words, numbers, least, bucket)
    none = F.array().cast("array<long>")
    word = F.col("word")
    items = found.where("id IS NOT NULL")
    tables = [items.select("lang", "id", "a", word.alias("phrase"), word.alias("last"), none.alias("pre"), none.alias("post"))]
    places_of = _word_places(buckets)
    for _ in range(1, most_words):
        blocks = _next(blocks, found, places_of)
        found, buckets = _frequent(blocks, _deal_pairs, _merge_pairs, numbers, least, bucket)
        places_of = _pair_places(buckets)
        ranked = found.where("id IS NOT NULL").select("id", "left", "right", "a")
        parts = tables[-1].drop("left", "right")
        head, tail = (parts.select(*(F.col(c).alias(f"{side}_{c}") for c in parts.columns)) for side in ("l", "r"))
        tables.append(
            stored(
                ranked.join(head, F.col("left") == F.col("l_id"))
                .join(tail, F.col("right") == F.col("r_id"))
                .select(
                    F.col("l_lang").alias("lang"),
                    "id",
                    "left",
                    "right",
                    "a",
                    F.concat_ws(" ", "l_phrase", "r_last").alias("phrase"),
                    F.col("r_last").alias("last"),
                    F.concat("l_pre", F.array("l_a")).alias("pre"),
                    F.concat("r_post", F.array("r_a")).alias("post"),
                )
            )
        )
    return tables, totals


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    first: int = FIRST,
    block: int = BLOCK,
    bucket: int = BUCKET,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` collocations of each language.

    ``l`` and ``r`` count the two parts of the phrase's weakest cut, ``n`` all words of the language.  Scores are
    whole numbers, computed as decimals, so products beyond 64 bits are exact.  Ties go to the shorter first part,
    and among phrases to the more frequent and then the smaller one.  Repeated rows count as often as they stand
    there; other columns are ignored; an empty table, or one without frequent phrases, gives no rows.
    """
    tables, totals = phrase_counts(docs, text_col, lang_col, least, most_words, block, bucket)
    scored = []
    for words, table in enumerate(tables[1:], 2):
        cuts = [(k, F.col("pre")[k - 1], F.col("post")[words - k - 1]) for k in range(1, words)]
        table = table.withColumn(
            "cut",
            F.array_min(
                F.array(*(F.struct(_score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")) for k, left, right in cuts))
            ),
        )
        if words < most_words:
            longer = tables[words].select(F.explode(F.array("left", "right")).alias("id"), F.col("a").alias("longer"))
            table = table.join(longer.groupBy("id").agg(F.max("longer").alias("longer")), "id", "left")
            wide = lambda c: F.col(c).cast("decimal(20,0)")
            table = table.where(F.coalesce(100 * wide("longer") < COVERED * wide("a"), F.lit(True)))
        scored.append(table.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    everything = scored[0]
    for more in scored[1:]:
        everything = everything.union(more)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = everything.withColumn("rank", place).where(F.col("rank") <= first)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def _score(a, left, right):
    """Whole part of ``SCALE * a / (left + right)``."""
    product = a.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(8,0)")
    return F.call_function("div", product, left.cast("decimal(20,0)") + right.cast("decimal(20,0)")).cast("long")
