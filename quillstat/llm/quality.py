"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one failure bit per rule; a policy is a versioned set of rules, so applying
another policy, or asking what a rule is worth, is bit arithmetic on the ledger
and never reads a text again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window whose repeats count.
WINDOW = 5
#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

_NO_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)

#: The measurements, in order.
MEASURES = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_shouted n_lines".split()

#: Rule -> failure condition on the measurements.  A rule's place is its bit; append only.
RULES: dict[str, Callable[[Column], Column]] = {
    "few_words": lambda m: m["n_words"] < 10,
    "repeated_words": lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "duplicate_lines": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
    "shouting": lambda m: 2 * m["n_shouted"] > m["n_words"],
    "word_length": lambda m: m["word_chars"] > 20 * m["n_words"],
}


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules; a document that fails one of them is rejected."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
#: The policies by (name, version); a change is a new version.
POLICIES: Mapping[tuple[str, int], Policy] = {
    (p.name, p.version): p
    for p in (
        BASE,
        Policy("prose", 1, ("few_words", "repeated_words", "symbols")),
        Policy("prose", 2, ("few_words", "repeated_words", "symbols", "duplicate_lines", "shouting")),
    )
}
#: What the query and the pipeline apply.
PRODUCTION = POLICIES["prose", 2]


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``.

    A word is shouted if it has two letters of A-Z and none of a-z.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    joined = b"".join(words)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n >= WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW))))
        if len(set(windows)) < len(windows):
            found = Counter(windows)
            covered = 0  # words before this one are counted
            for i, w in enumerate(windows):
                if found[w] > 1:
                    repeated += i + WINDOW - max(covered, i)
                    covered = i + WINDOW
    shouted = sum(len(w.translate(None, _NO_CAPITAL)) > 1 for w in words if w.isupper())
    chars = len(joined.decode("utf-8", "surrogatepass"))
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, shouted, len(lines)


def ledger(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """``docs`` with ``out``: the measurements and ``failed long``, a bit for each rule failed.

    NULL counts as the empty text: no words, so ``few_words`` fails.  Rows are
    judged one by one, so repeated rows and an empty table need no care.
    """

    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=MEASURES, dtype="int64")

    with_measures = docs.withColumn(out, measured(F.col(f"`{text_col}`")))
    m = F.col(f"`{out}`")
    failed = F.lit(0).cast("long")
    for bit, fails in enumerate(RULES.values()):
        failed = failed.bitwiseOR(F.when(fails(m), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return with_measures.withColumn(out, F.struct(*(m[x].alias(x) for x in MEASURES), failed.alias("failed")))


def passes(failed: Column, policy: Policy = PRODUCTION) -> Column:
    """Whether a ledger row passes a policy."""
    return failed.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(failures: DataFrame, policies: list[Policy], failed_col: str = "failed") -> DataFrame:
    """What each rule of each policy is worth: ``policy, version, rule, rejected, rejected_without, alone``.

    ``rejected`` counts the documents the policy rejects, ``rejected_without``
    those it would reject without the rule, and ``alone`` their difference: the
    documents for which the rule's bit is the only one set under the mask.  The
    ledger is first counted by bit pattern (at most 2 ** rules rows).
    """
    patterns = failures.groupBy(F.col(failed_col).alias("bits")).agg(F.count("*").alias("n"))
    cases = [
        F.struct(
            F.lit(p.name).alias("policy"),
            F.lit(p.version).alias("version"),
            F.lit(r).alias("rule"),
            F.lit(p.mask).cast("long").alias("mask"),
            F.lit(p.mask & ~(1 << list(RULES).index(r))).cast("long").alias("rest"),
        )
        for p in policies
        for r in p.rules
    ]
    hit = lambda mask: F.sum(F.when(F.col("bits").bitwiseAND(F.col(mask)) != 0, F.col("n")).otherwise(0))
    return (
        patterns.select("bits", "n", F.explode(F.array(*cases)).alias("c"))
        .select("bits", "n", "c.*")
        .groupBy("policy", "version", "rule")
        .agg(hit("mask").alias("rejected"), hit("rest").alias("rejected_without"))
        .withColumn("alone", F.col("rejected") - F.col("rejected_without"))
    )
