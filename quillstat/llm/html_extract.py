"""Main text of web pages with a suffix array of each host's boilerplate.

A page is cut into blocks of text, once.  What HTML itself marks as something
else (menus, headers, footers, sidebars, forms, scripts, adverts, notices,
comments) is no content.  All other blocks stand or fall by the suffix array of
their host: the token streams of the host's pages end to end, every position with
the suffix that starts there.  A long substring that enough distinct page texts
share is boilerplate, and what unmarked blocks have of it goes.

* Outside an ``article`` or ``main`` element, ``RUN`` tokens shared by one in
  ``PER`` of the host's page texts (two at least) are boilerplate, so copies and
  phrases of a large host stay.
* Inside one, ``LONG`` tokens shared by more than half of them (``LEAST`` at
  least).  If that would take half of a page's main text, the pages are copies of
  one article, and it stays whole.

Suffixes are ordered by prefix doubling: the classes of their first ``RUN`` tokens
come first, and the class of a prefix twice as long is the pair of the classes of
its halves.  Suffixes without enough company leave the array after each step, so
what is left at ``LONG`` tokens are the starts of long shared substrings; the
starts that touch make up the maximal runs.

Scale.  Main text enters the array by its winnowed fingerprints (the smallest of
every ``LONG - RUN + 1`` neighbouring classes), of which any shared substring of
``LONG`` tokens has one; only pages that hold a shared one bring all their
suffixes.  Classes are counted by host and page text with map-side combining, so
neither a host with a third of all pages nor a sentence on all of them gathers
anywhere.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, host_of, slices, stored

#: Tokens of a shared substring outside the main element, and inside it (``RUN`` times a power of two).
RUN, LONG = 6, 24
#: Outside, a run is boilerplate on one in so many page texts of a host (two at least).
PER = 10
#: Inside, on more than half of them, and on so many at least.
LEAST = 5
#: Bytes of html that are parsed together, about.
SLICE = 4 << 20

#: Elements whose content is raw text, and elements whose content is not shown as text.
_RAW = {"script", "style", "textarea", "title"}
_UNSHOWN = set("noscript template iframe svg math object select xmp".split())
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[/!?][^>]*>""",
    re.S,
)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}
_UNQUOTED = re.compile(r"""=\s*[^\s"'>]*/\Z""")
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

#: Elements whose text is no main text, elements that hold it, and inline elements.
_OTHER = set("nav header footer aside form button head dialog menu".split())
_MAIN = {"article", "main"}
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = {f"h{n}" for n in range(1, 7)}
#: Start tags that end an open paragraph, and those that end an open svg or math.
_ENDS_P = _HEADINGS | _OTHER - {"button", "head"} | _MAIN | set(
    "p div ul ol dl section blockquote pre address figure figcaption fieldset details summary center hr search table".split()
)
_BREAKS_OUT = _ENDS_P - {"search"} | set(
    "b big body br code dd dt em embed i img li meta nobr ruby s small span strong strike sub sup tt u var".split()
)
#: Elements with optional end tags: what their start ends, and what stands between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    **dict.fromkeys(("dt", "dd"), ({"dt", "dd"}, {"dl"})),
    **dict.fromkeys(("td", "th"), ({"td", "th"}, {"tr", "table"})),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot"}, {"table"})),
}
#: Whole names in a class, id or role that mark an element as no main text.
_HINTS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent notice notices "
    "popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead comment comments "
    "reply replies disqus share sharing social related newsletter subscribe login signup search complementary contentinfo "
    "alert toolbar widget cookie-notice cookie-banner cookie-bar cookie-consent consent-banner site-header site-footer "
    "site-navigation main-nav main-menu main-navigation nav-menu navbar-nav comments-area comment-list comment-respond "
    "share-buttons social-share social-links related-posts newsletter-signup ad-banner ad-slot ad-container banner-ad "
    "adsbygoogle widget-area".split()
)


def blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """Blocks of a page in order: text, whether it is in the main element, whether it is marked as other.

    Character references are decoded; white space in a block is one space, and none around it.
    """
    source = page or ""
    low = source.lower()
    last: dict[str, int] = {}  # where the last end tag of an unshown element stands
    out: list[tuple[str, bool, bool, list]] = []
    text: list[str] = []
    stack: list[list[str]] = []  # open elements but inline ones: [name, kind]
    names, kinds = Counter(), Counter()
    seen_main = False
    at = 0

    def close() -> None:
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                hints = [x for x in stack if x[1] == "hint"] if kinds["hint"] else []
                out.append((joined, kinds["main"] > 0, kinds["other"] > 0, hints))
            text.clear()

    def pop_to(n: int) -> None:
        if any(kind in ("main", "other", "hint") for _, kind in stack[n:]):
            close()
        while len(stack) > n:
            name, kind = stack.pop()
            names[name] -= 1
            kinds[kind] -= 1

    def nearest(wanted: set, stops: set, most: int) -> int:
        for n in range(len(stack) - 1, max(-1, len(stack) - 1 - most), -1):
            name, kind = stack[n]
            if name in wanted:
                return n
            if name in stops or kind in ("main", "other"):
                break
        return -1

    while tag := _MARKUP.search(source, at):
        if tag.start() > at and not kinds["unshown"]:
            text.append(source[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        empty = name in _VOID or (tag[3].endswith("/") and not _UNQUOTED.search(tag[3]))
        if name in _RAW:
            if name == "title":
                close()
            if not tag[1] and not empty:
                end = _RAW_END[name].search(source, at)
                at = end.end() if end else len(source)
            continue
        if name not in _INLINE and (name not in _UNSHOWN or name in ("noscript", "select")):
            close()
        if tag[1]:
            if names[name]:
                whole = name in _MAIN or name in _OTHER  # such an end tag ends what was left open inside
                n = nearest({name}, set(), len(stack)) if not whole else max(i for i, x in enumerate(stack) if x[0] == name)
                if n >= 0:
                    pop_to(n)
            continue
        if kinds["unshown"] and name in _BREAKS_OUT:
            n = nearest({"svg", "math"}, {"foreignobject"}, 64)
            if n >= 0:
                pop_to(n)  # no such element stands in svg or math: it was left open
        if name == "body":
            if names["head"]:
                pop_to(max(i for i, x in enumerate(stack) if x[0] == "head"))
            continue
        if name in _ENDS_P and stack and stack[-1][0] == "p":
            pop_to(len(stack) - 1)
        elif name in _ENDS:
            n = nearest(*_ENDS[name], 64)
            if n >= 0:
                pop_to(n)
        if empty or name in _INLINE or name == "html":
            continue
        kind = ""
        if name in _MAIN:
            kind = "main"
            if not seen_main:
                seen_main = True
                for x in stack:  # what holds the main element is no other text
                    if x[1] == "hint":
                        x[1] = ""
                        kinds["hint"] -= 1
        elif name in _OTHER:
            kind = "other"
        elif name in _UNSHOWN:
            if name not in last:
                last[name] = low.rfind(f"</{name}")
            if last[name] < at:
                continue  # never ended
            kind = "unshown"
        elif _hinted(name, tag[3]):
            kind = "hint"
        stack.append([name, kind])
        names[name] += 1
        kinds[kind] += 1
    if not kinds["unshown"]:
        text.append(source[at:])
    close()
    return [(t, main, other or any(x[1] == "hint" for x in hints)) for t, main, other, hints in out]


def _hinted(name: str, attributes: str) -> bool:
    """Whether a whole name in class, id or role is a hint; the id of a heading is an anchor."""
    return any(
        word in _HINTS
        for key, value in _NAMED.findall(attributes)
        if key.lower() != "id" or name not in _HEADINGS
        for word in value.strip("\"'").lower().split()
    )


#: An odd number whose powers tell the places of a class's tokens apart.
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _classes(tokens: list[str], run: int, known: dict[str, int]) -> np.ndarray:
    """The class of the first ``run`` tokens of each suffix that has so many, as a hash."""
    if len(tokens) < run:
        return np.zeros(0, dtype=np.int64)
    for t in tokens:
        if t not in known:
            known[t] = xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"))
    hashed = np.array([known[t] for t in tokens], dtype=np.uint64)
    out = np.zeros(len(tokens) - run + 1, dtype=np.uint64)
    for i in range(run):
        out = out * _BASE + hashed[i : len(hashed) - run + 1 + i]
    out ^= out >> np.uint64(29)
    return (out * _BASE).view(np.int64)


def _winnowed(classes: np.ndarray, window: int) -> np.ndarray:
    """The places of the smallest (leftmost of equals) of every ``window`` neighbouring classes."""
    if len(classes) < window:
        return np.zeros(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(classes, window)
    return np.unique(views.argmin(axis=1) + np.arange(len(views)))


def _parsed(page: str | None, run: int, long: int, known: dict[str, int]) -> dict:
    """Unmarked blocks of a page, the classes of the stream outside the main element, and the fingerprints inside."""
    parts, outside, unmarked, main = [], [], [], []
    for text, inside, other in blocks(page):
        words = text.split(" ")
        if inside:
            if other:
                continue
            parts.append({"pos": len(main), "main": True, "text": text})
            main += words
        else:
            if not other:
                parts.append({"pos": len(outside), "main": False, "text": text})
            outside += words
            unmarked += [not other] * len(words)
    all_classes = _classes(outside, run, known)
    doubted = np.convolve(unmarked, np.ones(run, dtype=int), "valid") > 0 if len(all_classes) else all_classes
    inner = _classes(main, run, known)
    return {
        "parts": parts,
        "outside": all_classes.tolist(),
        "doubted": np.flatnonzero(doubted).tolist(),
        "inside": inner[_winnowed(inner, long - run + 1)].tolist(),
    }


def _uncovered(parts: list, starts, run: int) -> list[str | None]:
    """Blocks without the tokens that the runs from ``starts`` cover; None where nothing is left."""
    covered = {p + i for p in starts for i in range(run)} if starts is not None else set()
    out = []
    for part in parts:
        words = [w for i, w in enumerate(part["text"].split(" "), part["pos"]) if i not in covered]
        out.append(" ".join(words) if words else None)
    return out


def _composed(parts: list, outer, inner, run: int, long: int) -> str:
    """A page's text: its blocks in order without their covered runs."""
    main = [p for p in parts if p["main"]]
    left = _uncovered(main, inner, long)
    before, after = (sum(t.count(" ") + 1 for t in some if t) for some in ((p["text"] for p in main), left))
    if 2 * after <= before:
        left = [p["text"] for p in main]  # copies of one article
    rest = _uncovered([p for p in parts if not p["main"]], outer, run)
    each = {True: iter(left), False: iter(rest)}
    return " ".join(t for p in parts if (t := next(each[p["main"]])) is not None)


_PARSED = "parts array<struct<pos:int,main:boolean,text:string>>, outside array<long>, doubted array<int>, inside array<long>"
_PARSED_ARROW = pa.struct([
    ("parts", pa.list_(pa.struct([("pos", pa.int32()), ("main", pa.bool_()), ("text", pa.string())]))),
    ("outside", pa.list_(pa.int64())),
    ("doubted", pa.list_(pa.int32())),
    ("inside", pa.list_(pa.int64())),
])


def _long_runs(pages: DataFrame, shared: DataFrame, needs: DataFrame, run: int, long: int) -> DataFrame:
    """``host, hash, inner``: starts of the shared substrings of ``long`` tokens in the main text of page texts."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, int] = {}
            for host, hash_, texts in zip(*(batch.column(c).to_pylist() for c in ("host", "hash", "texts"))):
                classes = _classes([w for t in texts for w in t.split(" ")], run, known)
                n = len(classes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * n, type=pa.string()), pa.array([hash_] * n, type=pa.int64()), pa.array(range(n), type=pa.int32()), pa.array(classes)],
                    names=["host", "hash", "pos", "key"],
                )

    # page texts in doubt: they hold a fingerprint that enough others have
    held = pages.select("host", "hash", F.explode("inside").alias("key")).join(shared, ["host", "key"])
    doubt = stored(held.select("host", "hash").distinct())  # of known size: few are joined without a shuffle of texts
    texts = F.transform(F.filter("parts", lambda p: p["main"]), lambda p: p["text"])
    array = (
        pages.join(doubt, ["host", "hash"])
        .select("host", "hash", texts.alias("texts"))
        .dropDuplicates(["host", "hash"])
        .mapInArrow(suffixes, "host string, hash long, pos int, key long")
    )
    depth = run
    while True:
        array = cut(array)
        enough = array.groupBy("host", "key").agg(F.count_distinct("hash").alias("n")).join(needs, "host").where("n >= need_inside")
        array = cut(array.join(enough.select("host", "key"), ["host", "key"]))
        if depth >= long:
            return array.groupBy("host", "hash").agg(F.collect_set("pos").alias("inner"))
        half = array.select("host", "hash", (F.col("pos") - depth).alias("pos"), F.col("key").alias("next"))
        array = array.join(half, ["host", "hash", "pos"]).select("host", "hash", "pos", F.xxhash64("key", "next").alias("key"))
        depth *= 2


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN, long: int = LONG
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    NULL and empty pages have the empty text.  Pages of a NULL url, or of one
    without a host, are one host.  Rows of a host equal in html are one page text,
    so repeated rows and exact copies make no boilerplate.  Other columns are ignored.
    """
    slim = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html")
    ).withColumns({"host": host_of(F.col("url")), "hash": F.xxhash64("html")})

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html", SLICE):
            known: dict[str, int] = {}
            rows = pa.array([_parsed(x, run, long, known) for x in part.column("html").to_pylist()], type=_PARSED_ARROW)
            kept = ["page_id", "url", "host", "hash"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), *rows.flatten()], names=[*kept, *(f.name for f in _PARSED_ARROW)]
            )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.drop("html").schema)
    parsed = stored(slim.mapInArrow(parse, f"{kept}, {_PARSED}"))
    needs = cut(
        parsed.groupBy("host", "hash").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("one").alias("n")).select(
            "host",
            F.greatest(F.lit(2), F.ceil(F.col("n") / PER)).alias("need"),
            F.greatest(F.lit(LEAST), F.floor(F.col("n") / 2) + 1).alias("need_inside"),
        )
    )

    def shared(rows: DataFrame, need: str, least: int) -> DataFrame:
        """``host, key`` of the classes on enough distinct page texts; those on fewer pages than any host needs leave
        by a plain count of their hash."""
        name = F.xxhash64("host", "key").alias("name")
        often = stored(rows.groupBy(name).agg(F.count("*").alias("n")).where(F.col("n") >= least).select("name"))
        held = rows.select("*", name).join(often, "name", "left_semi").groupBy("host", "key").agg(F.count_distinct("hash").alias("n"))
        # read from files: a join on a class of all pages can split
        return cut(held.join(needs, "host").where(F.col("n") >= F.col(need)).select("host", "key"))

    asked = parsed.where(F.size("doubted") > 0).select("host", "hash", "outside", F.explode("doubted").alias("pos")).select(
        "host", "hash", "pos", F.col("outside")[F.col("pos")].alias("key")
    )
    wanted = stored(asked.select("host", "key").distinct())
    outside = parsed.select("host", "hash", F.explode("outside").alias("key")).join(wanted, ["host", "key"], "left_semi")
    boilerplate = shared(outside, "need", 2)
    fingerprints = shared(parsed.select("host", "hash", F.explode("inside").alias("key")), "need_inside", LEAST)
    outer = asked.join(boilerplate, ["host", "key"]).groupBy("host", "hash").agg(F.collect_set("pos").alias("outer"))
    inner = _long_runs(parsed, fingerprints, needs, run, long)
    starts = stored(outer.join(inner, ["host", "hash"], "full"))  # of known size, as above

    @F.pandas_udf("string")
    def composed(parts: pd.Series, outer: pd.Series, inner: pd.Series) -> pd.Series:
        return pd.Series([_composed(*x, run, long) for x in zip(parts, outer, inner)], dtype=object)

    whole = F.concat_ws(" ", F.transform("parts", lambda p: p["text"]))
    sure = parsed.join(starts, ["host", "hash"], "left_anti").select("page_id", "url", whole.alias("text"))
    doubted = parsed.join(starts, ["host", "hash"]).select("page_id", "url", composed("parts", "outer", "inner").alias("text"))
    return sure.union(doubted).withColumn("n_chars", F.char_length("text").cast("long"))
