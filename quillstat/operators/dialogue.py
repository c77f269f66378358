"""Multi-round dialogue tables.

A dialogue is a table of contributions ``(conv, round, provider, text)``.
Everything is per conversation: joins and ordered ``collect_list`` stay
inside one conversation's rows (naturally small), and conversations spread
over tasks by hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The reference's section headers and entry formats for dialogue text.
HISTORY_HEADER = "=== HISTORY (recent conversations) ==="
DATA_HEADER = "=== DONNÉES ==="
NO_DATA = "Aucune donnée disponible."
QUESTION_HEADER = "=== QUESTION ==="
PEER_BLOCK = "=== %s ===\n%s"
TRANSCRIPT_ENTRY = "[%s Tour %d]:\n%s"
MEMORY_LINE = "[%s]: %s..."


def _ordered_join(sort_key: Column, text: Column, sep: str) -> Column:
    """Aggregate: texts of the group joined by ``sep`` in ``sort_key`` order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(sort_key.alias("k"), text.alias("t")))),
                                    lambda s: s["t"]), sep)


# L9 -------------------------------------------------------------------------
def memory_window(msgs: DataFrame, conv: str, order: str, keep: int = 20) -> DataFrame:
    """Keep the last ``keep`` messages of each conversation."""
    w = Window.partitionBy(conv).orderBy(F.col(order).desc())
    return msgs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep).drop("_rn")


def memory_context(msgs: DataFrame, conv: str, order: str, role: str, text: str,
                   last: int = 5, chars: int = 200) -> DataFrame:
    """Per conversation: header + last ``last`` messages as '[role]: first 200 chars...', newline-joined."""
    recent = memory_window(msgs, conv, order, last)
    line = F.format_string(MEMORY_LINE, F.col(role), F.substring(F.col(text), 1, chars))
    return recent.groupBy(conv).agg(
        F.concat(F.lit(HISTORY_HEADER + "\n"), _ordered_join(F.col(order), line, "\n")).alias("context"))


# L10 ------------------------------------------------------------------------
def peer_context(contrib: DataFrame, conv: str, rnd: str, provider: str, text: str, chars: int = 300) -> DataFrame:
    """For each (conv, round, provider): previous round's texts of the OTHER providers,
    '=== PROVIDER ===\\n<first 300 chars>' joined by newline (provider order).  Round 0 has none."""
    prev = contrib.select(F.col(conv).alias("_c"), (F.col(rnd) + 1).alias("_r"), F.col(provider).alias("_p"),
                          F.col(text).alias("_t"))
    j = contrib.select(conv, rnd, provider).join(
        prev, (F.col(conv) == F.col("_c")) & (F.col(rnd) == F.col("_r")) & (F.col(provider) != F.col("_p")), "left")
    block = F.when(F.col("_p").isNotNull(), F.format_string(PEER_BLOCK, F.upper("_p"), F.substring("_t", 1, chars)))
    return j.groupBy(conv, rnd, provider).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(block.isNotNull(), F.struct(
            F.col("_p").alias("k"), block.alias("t"))))), lambda s: s["t"]), "\n").alias("others"))


# L11 ------------------------------------------------------------------------
def transcript(contrib: DataFrame, conv: str, rnd: str, provider: str, text: str,
               provider_rank: Column | None = None) -> DataFrame:
    """All contributions '[provider Tour r]:\\ntext' joined by blank lines, in (round, provider) order."""
    rank = provider_rank if provider_rank is not None else F.col(provider)
    entry = F.format_string(TRANSCRIPT_ENTRY, F.col(provider), F.col(rnd), F.col(text))
    return contrib.groupBy(conv).agg(_ordered_join(F.struct(F.col(rnd), rank), entry, "\n\n").alias("transcript"))


# L12 ------------------------------------------------------------------------
def assemble_prompt(system: Column, history: Column, data: Column, question: Column) -> Column:
    """system, optional history, data section (or 'no data'), question section — newline-joined."""
    data_part = F.when(F.coalesce(F.length(data), F.lit(0)) > 0, F.concat(F.lit(f"\n{DATA_HEADER}\n"), data)) \
        .otherwise(F.lit(f"\n{NO_DATA}"))
    hist_part = F.when(F.coalesce(F.length(history), F.lit(0)) > 0, F.concat(F.lit("\n"), history))
    return F.concat_ws("\n", system, hist_part, data_part, F.concat(F.lit(f"\n{QUESTION_HEADER}\n"), question))


# L13 ------------------------------------------------------------------------
# The reference's provider orders for summaries, narratives and aggregation.
PRIORITIES = {
    "summary": ("mistral", "gemini", "groq"),
    "narrative": ("gemini", "mistral", "groq"),
    "aggregator": ("groq", "gemini", "mistral"),
}


def priority_rank(provider: Column, role: str) -> Column:
    """Place of a provider in the order of a role; others come after all of them."""
    order = PRIORITIES[role]
    at = F.array_position(F.array(*[F.lit(p) for p in order]), provider)
    return F.when(at > 0, at).otherwise(F.lit(len(order) + 1))


def first_acceptable(cands: DataFrame, group: Sequence[str], rank: Column, text: str, reject_prefix: str = "[") -> DataFrame:
    """Per group: the best-ranked text not starting with ``reject_prefix``; if none, the rank-1 text."""
    ok = ~F.startswith(F.col(text), F.lit(reject_prefix))
    best = F.min_by(F.col(text), F.when(ok, rank))
    first = F.min_by(F.col(text), rank)
    return cands.groupBy(*group).agg(F.coalesce(best, first).alias("chosen"))


# L16 ------------------------------------------------------------------------
def map_to_text(m: Column) -> Column:
    """map -> 'k: v; k: v' (keys sorted)."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)),
                                    lambda e: F.concat(e["key"].cast("string"), F.lit(": "), e["value"].cast("string"))), "; ")


# L18 ------------------------------------------------------------------------
def dialogue_records(contrib: DataFrame, conv: str, rnd: str, provider: str, text: str) -> DataFrame:
    """Nest a conversation's contributions into one record: (conv, rounds array<struct<round,provider,text>>)."""
    return contrib.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct(
        F.col(rnd).alias("round"), F.col(provider).alias("provider"), F.col(text).alias("text")))).alias("rounds"))


def explode_rounds(records: DataFrame, conv: str, only_round: int | None = None) -> DataFrame:
    out = records.select(conv, F.explode("rounds").alias("r")).select(conv, "r.round", "r.provider", "r.text")
    if only_round is not None:
        out = out.where(F.col("round") == only_round)
    return out


def max_round(records: DataFrame, conv: str) -> DataFrame:
    return records.select(conv, F.array_max(F.transform("rounds", lambda r: r["round"])).alias("max_round"))
