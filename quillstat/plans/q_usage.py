"""Catalog: model-call logs and dialogue tables (L*).

The usage log is derived from ``events`` (provider = event_type, cost =
value, prompt tokens = props.k) and dialogues from ``conversations``
(round = turn, provider = role), as laid out in the survey's table mapping.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dialogue as D
from ..operators import profiling as P
from ..operators import usage as U
from .catalog import register, table

NOW_EPOCH = 1706655600  # 2024-01-30 23:00:00 UTC
MAX_CALLS = 20000


def usage_log(spark, sf):
    ev = table(spark, sf, "events")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return ev.select(
        F.col("event_id").alias("call_id"),
        F.timestamp_diff("SECOND", epoch, F.col("ts")).alias("ts"),
        F.col("event_type").alias("provider"),
        F.lit("summarize").alias("method"),
        k.alias("prompt_tokens"),
        F.floor("value").cast("int").alias("completion_tokens"),
        F.col("value").alias("cost"),
        F.struct(
            (F.col("event_type") != "error").alias("success"),
            F.lit(None).cast("string").alias("skipped"),
            F.when(F.col("event_type") == "error", F.lit("upstream error")).alias("error"),
            F.lit(None).cast("string").alias("error_type"),
            F.struct(k.alias("prompt_tokens"), F.lit(None).cast("int").alias("completion_tokens")).alias("api_usage"),
        ).alias("extra"),
        F.col("user_id"),
    )


LOG_SQL = """log AS (SELECT event_id AS call_id, date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS ts,
       event_type AS provider, 'summarize' AS method, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS prompt_tokens,
       CAST(floor(value) AS INTEGER) AS completion_tokens, value AS cost, event_type <> 'error' AS success,
       CASE WHEN event_type = 'error' THEN 'upstream error' END AS error, user_id FROM events)"""

_TOK = "CASE WHEN coalesce(length({0}), 0) > 0 THEN greatest(1, ceil(length({0}) / 4.0)) ELSE 0 END"
_RATE = "CASE {0} WHEN 'mistral' THEN 0.002 WHEN 'gemini' THEN 0.03 WHEN 'groq' THEN 0.02 ELSE 0.01 END"
# Deterministic provider label per conversation (derived column, every row kept).
_PROV_SQL = "CASE conv_id % 4 WHEN 0 THEN 'mistral' WHEN 1 THEN 'gemini' WHEN 2 THEN 'groq' ELSE 'local' END"


def _prov():
    return F.element_at(F.array(*[F.lit(p) for p in ("mistral", "gemini", "groq", "local")]),
                        (F.pmod("conv_id", F.lit(4)) + 1).cast("int"))


@register("l_token_estimate", f"SELECT conv_id, turn, CAST({_TOK.format('text')} AS BIGINT) AS tokens FROM conversations",
          ops=("L1",))
def l_token_estimate(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", U.estimate_tokens(F.col("text")).alias("tokens"))


@register("l_call_cost", f"""SELECT conv_id, turn, provider, round(tokens / 1000.0 * {_RATE.format('provider')}, 9) AS cost
FROM (SELECT conv_id, turn, {_PROV_SQL} AS provider, CAST({_TOK.format('text')} AS BIGINT) AS tokens FROM conversations)""",
          ops=("L2",))
def l_call_cost(spark, sf):
    c = table(spark, sf, "conversations").withColumn("provider", _prov()).withColumn(
        "tokens", U.estimate_tokens(F.col("text")))
    return c.select("conv_id", "turn", "provider",
                    F.round(U.call_cost(F.col("tokens"), F.lit(0), F.col("provider")), 9).alias("cost"))


@register("l_usage_totals", f"""WITH {LOG_SQL}
SELECT count(*) AS total_calls, count(*) FILTER (WHERE success) AS successful_calls,
       round(sum(coalesce(cost, 0.0)), 6) AS total_cost, {MAX_CALLS} - count(*) AS remaining FROM log""", ops=("L3", "L6"))
def l_usage_totals(spark, sf):
    t = U.usage_totals(usage_log(spark, sf), MAX_CALLS)
    return t.withColumn("total_cost", F.round("total_cost", 6))


@register("l_calls_by_provider", f"""WITH {LOG_SQL}
SELECT coalesce(provider, 'unknown') AS provider, count(*) AS calls FROM log GROUP BY 1""", ops=("L3",))
def l_calls_by_provider(spark, sf):
    return U.calls_by_provider(usage_log(spark, sf))


@register("l_last_calls", f"""WITH {LOG_SQL}
SELECT call_id, ts, provider, cost FROM log ORDER BY ts DESC, call_id DESC LIMIT 10""", ops=("L3",))
def l_last_calls(spark, sf):
    return U.last_calls(usage_log(spark, sf), 10, ("ts", "call_id")).select("call_id", "ts", "provider", "cost")


@register("l_hourly_alert", f"""WITH {LOG_SQL}
SELECT round(coalesce(sum(cost), 0.0), 6) AS cost_last_hour, count(*) AS count_last_hour,
       coalesce(sum(cost), 0.0) >= 500.0 AS alert FROM log WHERE {NOW_EPOCH} - ts <= 3600""", ops=("L4",))
def l_hourly_alert(spark, sf):
    a = U.hourly_cost_alert(usage_log(spark, sf), NOW_EPOCH, 500.0)
    return a.withColumn("cost_last_hour", F.round("cost_last_hour", 6))


def quota2_sql(src_cte: str, tcol: str, horizon: str, key: str = "user_id", tie: str = "call_id",
               time_type: str = "BIGINT") -> str:
    """Sequential admission with max 2 calls per horizon as a recursive CTE (state = two latest admitted times)."""
    return f"""WITH RECURSIVE {src_cte},
o AS (SELECT {tie}, {key}, {tcol}, row_number() OVER (PARTITION BY {key} ORDER BY {tcol}, {tie}) AS rn FROM src),
r AS (
  SELECT {key}, rn, {tie}, {tcol}, {tcol} AS a1, CAST(NULL AS {time_type}) AS a2, true AS admitted FROM o WHERE rn = 1
  UNION ALL
  SELECT o.{key}, o.rn, o.{tie}, o.{tcol},
         CASE WHEN adm THEN o.{tcol} ELSE k1 END, CASE WHEN adm THEN k1 ELSE k2 END, adm
  FROM (SELECT o.*, r.a1, r.a2,
               CASE WHEN o.{tcol} - r.a1 < {horizon} THEN r.a1 END AS k1,
               CASE WHEN o.{tcol} - r.a2 < {horizon} THEN r.a2 END AS k2,
               (CASE WHEN o.{tcol} - r.a1 < {horizon} THEN 1 ELSE 0 END
                + CASE WHEN o.{tcol} - r.a2 < {horizon} THEN 1 ELSE 0 END) < 2 AS adm
        FROM r JOIN o ON o.{key} = r.{key} AND o.rn = r.rn + 1) o)
SELECT {tie}, {key}, {tcol}, admitted FROM r"""


@register("l_quota_admission", quota2_sql(LOG_SQL.replace("log AS (", "src AS (", 1), "ts", "3600"), ops=("L5",))
def l_quota_admission(spark, sf):
    log = usage_log(spark, sf).select("call_id", "ts", "user_id")
    return U.quota_admission(log, "ts", "call_id", max_calls=2, keys=["user_id"]).select(
        "call_id", "user_id", "ts", "admitted")


@register("l_quota_window_count", f"""WITH {LOG_SQL}
SELECT call_id, user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW)
       AS calls_last_hour FROM log""", ops=("L5",))
def l_quota_window_count(spark, sf):
    log = usage_log(spark, sf).select("call_id", "user_id", "ts")
    return U.trailing_call_count(log, "ts", ["user_id"], 3600)


@register("l_log_history", f"""WITH {LOG_SQL}
SELECT to_timestamp(ts) AT TIME ZONE 'UTC' AS time, ts, provider, prompt_tokens, success, error, prompt_tokens AS api_prompt_tokens
FROM log WHERE provider = 'click' ORDER BY ts DESC, call_id DESC LIMIT 20""", ops=("L7",))
def l_log_history(spark, sf):
    h = U.log_history(usage_log(spark, sf), "click", 20, tie=["call_id"])
    return h.select("time", "ts", "provider", "prompt_tokens", "success",
                    "error", "api_prompt_tokens")


@register("l_provider_list", f"WITH {LOG_SQL} SELECT DISTINCT provider FROM log WHERE provider IS NOT NULL", ops=("L7",))
def l_provider_list(spark, sf):
    return U.provider_list(usage_log(spark, sf))


@register("l_cumulative_cost", f"""WITH {LOG_SQL}
SELECT call_id, provider, ts, round(sum(cost) OVER (PARTITION BY provider ORDER BY ts, call_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cum_cost FROM log""",
          ops=("L8",))
def l_cumulative_cost(spark, sf):
    c = U.cumulative_cost(usage_log(spark, sf).select("call_id", "provider", "ts", "cost"), ("ts", "call_id"))
    return c.select("call_id", "provider", "ts", F.round("cum_cost", 6).alias("cum_cost"))


@register("l_memory_window", """SELECT conv_id, turn, role FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn <= 20""",
          ops=("L9",))
def l_memory_window(spark, sf):
    return D.memory_window(table(spark, sf, "conversations"), "conv_id", "turn", 20).select("conv_id", "turn", "role")


_CTX_SQL = """SELECT conv_id, '=== HISTORY (recent conversations) ===' || chr(10) ||
       string_agg('[' || role || ']: ' || substring(text, 1, 200) || '...', chr(10) ORDER BY turn) AS context
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn <= 5
GROUP BY conv_id"""


@register("l_memory_context", _CTX_SQL, ops=("L9",))
def l_memory_context(spark, sf):
    return D.memory_context(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


@register("l_peer_context", """SELECT c.conv_id, c.turn, c.role,
       coalesce(string_agg('=== ' || upper(p.role) || ' ===' || chr(10) || substring(p.text, 1, 300), chr(10) ORDER BY p.role), '')
       AS others
FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn + 1 = c.turn AND p.role <> c.role
GROUP BY c.conv_id, c.turn, c.role""", ops=("L10",))
def l_peer_context(spark, sf):
    return D.peer_context(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


@register("l_transcript", """SELECT conv_id, string_agg('[' || role || ' Tour ' || turn || ']:' || chr(10) || text,
       chr(10) || chr(10) ORDER BY turn, role) AS transcript FROM conversations GROUP BY conv_id""", ops=("L11",))
def l_transcript(spark, sf):
    return D.transcript(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


_DEFAULT_SYSTEM = "Tu es un analyste de données."


@register("l_prompt", f"""WITH ctx AS ({_CTX_SQL}),
q AS (SELECT conv_id, arg_max(text, turn) FILTER (WHERE role = 'user') AS question,
             arg_min(text, turn) FILTER (WHERE role = 'system') AS system FROM conversations GROUP BY conv_id),
d AS (SELECT printf('rows=%d mean(value)=%.4f mean(user_id)=%.4f peaks=%d', count(*), round(avg(value), 4),
                    round(avg(user_id), 4), 0) AS line FROM events)
SELECT q.conv_id, md5(concat_ws(chr(10), coalesce(q.system, '{_DEFAULT_SYSTEM}'),
       CASE WHEN length(ctx.context) > 0 THEN chr(10) || ctx.context END,
       CASE WHEN length(d.line) > 0 THEN chr(10) || '=== DONNÉES ===' || chr(10) || d.line ELSE chr(10) || 'Aucune donnée disponible.' END,
       chr(10) || '=== QUESTION ===' || chr(10) || coalesce(q.question, ''))) AS prompt_md5
FROM q LEFT JOIN ctx USING (conv_id), d""", ops=("L12",))
def l_prompt(spark, sf):
    c = table(spark, sf, "conversations")
    ctx = D.memory_context(c, "conv_id", "turn", "role", "text")
    q = c.groupBy("conv_id").agg(
        F.max_by(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "user", F.col("turn"))).alias("question"),
        F.min_by(F.when(F.col("role") == "system", F.col("text")), F.when(F.col("role") == "system", F.col("turn"))).alias("system"),
    )
    data = F.broadcast(P.snapshot_line(table(spark, sf, "events"), "value", "user_id").select(F.col("line").alias("data")))
    j = q.join(ctx, "conv_id", "left").crossJoin(data)
    prompt = D.assemble_prompt(F.coalesce("system", F.lit(_DEFAULT_SYSTEM)), F.col("context"), F.col("data"),
                               F.coalesce("question", F.lit("")))
    return j.select("conv_id", F.md5(prompt).alias("prompt_md5"))


# role priority for choosing a conversation's representative answer
_ROLE_RANK_SQL = "(CASE role WHEN 'assistant' THEN 1 WHEN 'user' THEN 2 ELSE 3 END) * 100 + turn"


@register("l_first_acceptable", f"""SELECT conv_id, coalesce(arg_min(text, {_ROLE_RANK_SQL}) FILTER (WHERE NOT starts_with(text, 'E')),
       arg_min(text, {_ROLE_RANK_SQL})) AS chosen FROM conversations GROUP BY conv_id""", ops=("L13",))
def l_first_acceptable(spark, sf):
    c = table(spark, sf, "conversations")
    rank = F.when(F.col("role") == "assistant", 1).when(F.col("role") == "user", 2).otherwise(3) * 100 + F.col("turn")
    return D.first_acceptable(c, ["conv_id"], rank, "text", reject_prefix="E")


_PROVIDER_OF_TURN = "CASE turn % 4 WHEN 0 THEN 'groq' WHEN 1 THEN 'mistral' WHEN 2 THEN 'gemini' ELSE 'local' END"
_PRIORITY_SQL = "\nUNION ALL\n".join(f"""SELECT '{role}' AS role, conv_id, coalesce(arg_min(text, r) FILTER (WHERE NOT starts_with(text, 'E')), arg_min(text, r)) AS chosen
FROM (SELECT conv_id, text, turn + 1000 * (CASE {_PROVIDER_OF_TURN} {" ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(order, 1))} ELSE 4 END) AS r
      FROM conversations) GROUP BY conv_id""" for role, order in D.PRIORITIES.items())


@register("l_priority_orders", _PRIORITY_SQL, ops=("L13",))
def l_priority_orders(spark, sf):
    """The accepted answer of each conversation under each role's provider order."""
    turn = F.col("turn") % 4
    provider = F.when(turn == 0, "groq").when(turn == 1, "mistral").when(turn == 2, "gemini").otherwise("local")
    c = table(spark, sf, "conversations").withColumn("provider", provider)
    out = None
    for role in D.PRIORITIES:
        rank = F.col("turn") + 1000 * D.priority_rank(F.col("provider"), role)
        got = D.first_acceptable(c, ["conv_id"], rank, "text", reject_prefix="E").select(F.lit(role).alias("role"), "conv_id", "chosen")
        out = got if out is None else out.unionByName(got)
    return out


def _response_json_spark():
    t = F.col("text")
    shape = F.pmod("turn", F.lit(4))
    choices = F.to_json(F.struct(
        F.array(F.struct(F.struct(t.alias("content")).alias("message"))).alias("choices"),
        F.struct(F.col("turn").alias("prompt_tokens"), F.length(t).alias("completion_tokens")).alias("usage")))
    cands = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(F.struct(t.alias("text"))).alias("parts"))
                                                .alias("content"))).alias("candidates")))
    output = F.to_json(F.struct(t.alias("output")))
    err = F.to_json(F.struct(F.lit("rate limited").alias("error"), F.lit("429").alias("code")))
    return F.when(shape == 0, choices).when(shape == 1, cands).when(shape == 2, output).otherwise(err)


_RESP_SQL = """CASE turn % 4
  WHEN 0 THEN json_object('choices', json_array(json_object('message', json_object('content', text))),
                          'usage', json_object('prompt_tokens', turn, 'completion_tokens', length(text)))
  WHEN 1 THEN json_object('candidates', json_array(json_object('content', json_object('parts', json_array(json_object('text', text))))))
  WHEN 2 THEN json_object('output', text)
  ELSE json_object('error', 'rate limited', 'code', '429') END"""


def _jx(path):
    return f"nullif(json_extract_string(raw, '{path}'), '')"


def _usage_sql(names, root):
    parts = [f"json_extract_string(raw, '$.{u}.{k}')" for u in ("usage", "token_usage", "meta.usage") for k in names]
    parts += [f"json_extract_string(raw, '$.{r}')" for r in root]
    return "coalesce(" + ", ".join(parts) + ")"


_PT = _usage_sql(("prompt_tokens", "input_tokens", "prompt"), ("promptTokenCount", "inputTokenCount"))
_CT = _usage_sql(("completion_tokens", "output_tokens", "completion"), ("candidatesTokenCount", "outputTokenCount"))
_TXT = ("coalesce(" + ", ".join(_jx(p) for p in ("$.choices[0].message.content", "$.choices[0].message.text",
                                                  "$.candidates[0].content.parts[0].text", "$.output", "$.text",
                                                  "$.message", "$.body")) + ")")


@register("l_response_normalise", f"""SELECT conv_id, turn, provider, md5(txt) AS text_md5, pt AS prompt_tokens, ct AS completion_tokens,
       round((pt + ct) / 1000.0 * {_RATE.format('provider')}, 9) AS cost, err IS NULL AS success, err AS error
FROM (SELECT *, coalesce(TRY_CAST({_PT} AS BIGINT), est) AS pt,
             coalesce(TRY_CAST({_CT} AS BIGINT), CAST({_TOK.format('txt')} AS BIGINT)) AS ct
      FROM (SELECT conv_id, turn, provider, raw, est, {_TXT} AS txt, json_extract_string(raw, '$.error') AS err
            FROM (SELECT conv_id, turn, {_PROV_SQL} AS provider, {_RESP_SQL} AS raw,
                         CAST({_TOK.format('text')} AS BIGINT) AS est FROM conversations)))""", ops=("L14",))
def l_response_normalise(spark, sf):
    c = table(spark, sf, "conversations").withColumn("provider", _prov()).withColumn("raw", _response_json_spark())
    r = c.select("conv_id", "turn", "provider",
                 U.normalise_response(F.col("raw"), F.col("provider"), U.estimate_tokens(F.col("text"))).alias("r"))
    return r.select("conv_id", "turn", "provider", F.md5("r.text").alias("text_md5"),
                    F.col("r.prompt_tokens").alias("prompt_tokens"), F.col("r.completion_tokens").alias("completion_tokens"),
                    F.round("r.cost", 9).alias("cost"), F.col("r.success").alias("success"), F.col("r.error").alias("error"))


_REASON_SQL = "CASE role WHEN 'system' THEN 'disabled' WHEN 'user' THEN 'quota' ELSE (CASE turn % 3 WHEN 0 THEN 'no_key' WHEN 1 THEN 'no_url' ELSE 'timeout' END) END"


@register("l_outcome_label", f"""SELECT conv_id, turn, CASE reason
  WHEN 'disabled' THEN printf('[LLM %s by %s - DISABLED: Real API calls not enabled. Set LLM_CALLS_ENABLED=true. Input preview: %s...]', 'summarize', provider, prev)
  WHEN 'quota' THEN printf('[LLM %s by %s - QUOTA EXHAUSTED: Max 200 calls/hour reached. Input preview: %s...]', 'summarize', provider, prev)
  WHEN 'no_url' THEN printf('[LLM %s by %s - CONFIG ERROR: API URL not configured. Set %s_API_URL. Input preview: %s...]', 'summarize', provider, upper(provider), prev)
  WHEN 'no_key' THEN printf('[LLM %s by %s - CONFIG ERROR: API key not configured. Set %s_API_KEY_1. Input preview: %s...]', 'summarize', provider, upper(provider), prev)
  ELSE printf('[LLM %s by %s - ERROR: %s. Input preview: %s...]', 'summarize', provider, reason, prev) END AS label
FROM (SELECT conv_id, turn, {_PROV_SQL} AS provider, {_REASON_SQL} AS reason,
             replace(substring(coalesce(text, ''), 1, 100), chr(10), ' ') AS prev FROM conversations)""", ops=("L15",))
def l_outcome_label(spark, sf):
    c = table(spark, sf, "conversations").withColumn("provider", _prov())
    reason = (F.when(F.col("role") == "system", "disabled").when(F.col("role") == "user", "quota")
              .otherwise(F.element_at(F.array(F.lit("no_key"), F.lit("no_url"), F.lit("timeout")),
                                      (F.pmod("turn", F.lit(3)) + 1).cast("int"))))
    return c.select("conv_id", "turn", U.outcome_label(reason, F.col("provider"), F.lit("summarize"), F.col("text")).alias("label"))


@register("l_summary_text", """SELECT conv_id, string_agg(role || ': ' || n, '; ' ORDER BY role) AS summary
FROM (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY 1, 2) GROUP BY conv_id""", ops=("L16",))
def l_summary_text(spark, sf):
    c = table(spark, sf, "conversations").groupBy("conv_id", "role").agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct("role", "n"))).alias("m"))
    return m.select("conv_id", D.map_to_text(F.col("m")).alias("summary"))


@register("l_dialogue_round", "SELECT conv_id, turn AS round, role AS provider, md5(text) AS text_md5 FROM conversations WHERE turn = 1",
          ops=("L18",))
def l_dialogue_round(spark, sf):
    rec = D.dialogue_records(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    r = D.explode_rounds(rec, "conv_id", only_round=1)
    return r.select("conv_id", "round", "provider", F.md5("text").alias("text_md5"))


@register("l_dialogue_max_round", "SELECT conv_id, max(turn) AS max_round FROM conversations GROUP BY conv_id", ops=("L18",))
def l_dialogue_max_round(spark, sf):
    rec = D.dialogue_records(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    return D.max_round(rec, "conv_id")
