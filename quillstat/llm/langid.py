"""Language id by rank-order n-gram profiles (out-of-place distance).

A profile is the ranking of a language's most frequent character n-grams (one
to three letters, word ends marked).  A document's own most frequent n-grams
are ranked the same way and compared with each profile: every n-gram adds the
difference of its two ranks, or the profile's size if the profile lacks it.
The nearest language wins, ties to the smaller name.

Scale.  Learning sums n-gram counts: each Arrow batch returns its own counts
per language, Spark adds them up, and the top of each language is a grouped
limit.  What reaches the tasks is ``size`` n-grams for each learned language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: n-grams in a profile, of a language and of a document.
SIZE = 400
#: The prediction for texts without a letter, and where nothing was learned.
UNKNOWN = "und"

_EDGE = 1  # stands for a word's end; not a letter
_BITS = 21  # of a code point
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


def ngrams(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of a text's words, in no particular order."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, dtype=np.int64)
    marked = np.concatenate([[_EDGE], np.where(letter, points, _EDGE), [_EDGE]])
    edge = marked == _EDGE
    marked = marked[~(edge & np.concatenate([[False], edge[:-1]]))]  # one mark between words
    edge = marked == _EDGE
    two = (marked[:-1] << _BITS) | marked[1:]
    three = (two[:-1] << _BITS) | marked[2:]
    return np.concatenate([marked[~edge], two, three[~edge[1:-1]]])


def ranked(codes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The most frequent codes, most frequent first, ties to the smaller code."""
    values, counts = np.unique(codes, return_counts=True)
    return values[np.lexsort((values, -counts))[:size]]


def learn(docs: DataFrame, text_col: str, lang_col: str, size: int = SIZE) -> DataFrame:
    """Profiles ``lang, gram long, place int`` (from 0) of all rows with text and language."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                texts, grown, codes = rows["text"], 0, []
                for i, text in enumerate(texts):
                    codes.append(ngrams(text))
                    grown += len(codes[-1])
                    if grown > 1_000_000 or i == len(texts) - 1:
                        grams, n = np.unique(np.concatenate(codes), return_counts=True)
                        yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})
                        grown, codes = 0, []

    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    total = (
        rows.dropna().mapInPandas(counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return total.withColumn("place", place - 1).where(F.col("place") < size).select("lang", "gram", "place")


@dataclass(frozen=True)
class Profiles:
    """Learned profiles as arrays: ``places[i, j]`` is the rank of ``grams[i]`` in ``langs[j]``."""

    langs: tuple[str, ...]
    grams: np.ndarray
    places: np.ndarray
    size: int

    @classmethod
    def of(cls, learned: DataFrame, size: int = SIZE) -> Profiles:
        """Fetch profiles: at most ``size`` rows for each learned language."""
        rows = learned.toPandas()
        langs = tuple(sorted(rows["lang"].unique()))
        grams = np.unique(rows["gram"].to_numpy(dtype=np.int64))
        places = np.full((len(grams), len(langs)), size, dtype=np.int32)
        for j, lang in enumerate(langs):
            own = rows[rows["lang"] == lang]
            places[np.searchsorted(grams, own["gram"].to_numpy(dtype=np.int64)), j] = own["place"]
        return cls(langs, grams, places, size)

    def judge(self, text: str | None) -> tuple[str, float]:
        """Nearest language, and one less its distance as a share of the largest possible."""
        codes = ranked(ngrams(text or ""), self.size)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, codes).clip(max=len(self.grams) - 1)
        known = self.grams[at] == codes
        away = np.full((len(codes), len(self.langs)), self.size, dtype=np.int64)
        away[known] = np.abs(self.places[at[known]] - np.flatnonzero(known)[:, None])
        away[known] = np.where(self.places[at[known]] == self.size, self.size, away[known])
        total = away.sum(axis=0)
        best = int(total.argmin())
        return self.langs[best], float(1 - total[best] / (self.size * len(codes)))


def predict(docs: DataFrame, text_col: str, profiles: Profiles, out: str) -> DataFrame:
    """``docs`` with ``out struct<lang string, score double>``.

    NULL, empty and letterless texts, and all texts if nothing was learned, are
    ``und`` with score 0.
    """

    @F.pandas_udf("lang string, score double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.judge(t) for t in texts], columns=["lang", "score"])

    return docs.withColumn(out, judged(F.col(f"`{text_col}`")))
