r"""Chat formatting in budgeted windows.

A turn is written as ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and
texts a backslash goes between ``<`` and ``|`` (one more where backslashes
stand there already), which is reversible, so a mark in a formatted text is
always the template's. In a role a backslash is doubled and a line break is
written ``\n``.

Windows: running sums of the turns' tokens choose spans that begin and end at
turns. With ``slot`` = half of what the budget leaves after the system turn
and the history, the turns that begin within one slot of the running sum form
a window; a turn larger than a slot stands alone. A window therefore stays
within the budget unless its system turn or that single turn is larger than
its own share. A leading system turn is repeated in every later window, and
so are up to ``history`` turns before the window, as long as they fit
``history_budget`` tokens. Loss spans (code points, end exclusive) cover the
assistant texts of the window's own turns only: repeated turns, system and
user turns, roles and marks are masked.

Only DataFrame functions and one shuffle by conversation. Turns are ordered
by turn, then role, then text (nulls first), so ties and repeated rows have a
fixed place. Null text counts as empty, a null role as the empty role, null
conv_id is a conversation of its own, an empty table gives no windows. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import read_table
from .registry import register

START, END = "<|im_start|>", "<|im_end|>"
#: A token is a run of letters, a run of digits or one other visible character; a turn's marks count 4.
TOKEN = r"\p{L}+|\p{N}+|[^\x00-\x20\p{L}\p{N}]"
TURN_TOKENS = 4


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.array_join(F.transform(F.split(unescape(role), r"\\\\"),
                                    lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def chat_windows(turns: DataFrame, budget: int = 1024, history: int = 2, history_budget: int = 256,
                 min_slot: int = 128) -> DataFrame:
    """conv_id, window_no (from 1), n_context (repeated turns at its start),
    n_new, n_tokens, formatted, loss_spans array<struct<start,end>>."""
    conv = Window.partitionBy("conv_id").orderBy("seq")
    so_far = conv.rowsBetween(Window.unboundedPreceding, -1)
    window = Window.partitionBy("conv_id", "window_no").orderBy("seq")
    rows = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("seq", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))
            .withColumn("head", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")))
            .withColumn("body", escape(F.col("text")))
            .withColumn("said", F.concat("head", "body", F.lit(END + "\n")))
            .withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)) + TURN_TOKENS)
            .withColumn("is_system", (F.col("seq") == 1) & (F.col("role") == "system")))
    lead = F.first(F.when(F.col("is_system"), F.struct("said", "tokens"))).over(conv.rowsBetween(Window.unboundedPreceding, 0))
    rows = (rows.withColumn("system", lead)
            .withColumn("system_tokens", F.coalesce("system.tokens", F.lit(0)))
            .withColumn("slot", F.greatest(F.lit(min_slot), F.floor((F.lit(budget - history_budget) - F.col("system_tokens")) / 2)))
            .withColumn("before", F.coalesce(F.sum("tokens").over(so_far), F.lit(0)))
            .withColumn("bin", F.floor(F.col("before") / F.col("slot")))
            .withColumn("alone", F.col("tokens") > F.col("slot")))
    opens = (F.col("seq") == 1) | (F.col("bin") != F.lag("bin").over(conv)) | F.col("alone") | F.lag("alone").over(conv)
    rows = (rows.withColumn("opens", opens)
            .withColumn("window_no", F.sum(F.col("opens").cast("long")).over(conv.rowsBetween(Window.unboundedPreceding, 0))))
    # the history of a window, taken at its first turn: the nearest turns before it, while they fit
    past, room = [], F.lit(history_budget)
    fits = F.col("opens")
    for k in range(1, history + 1):
        t = F.when(~F.lag("is_system", k).over(conv), F.lag(F.struct("said", "tokens"), k).over(conv))
        rows = rows.withColumn(f"past{k}", t)
        fits = fits & F.col(f"past{k}").isNotNull() & (F.col(f"past{k}.tokens") <= room)
        room = room - F.col(f"past{k}.tokens")
        past.insert(0, F.when(fits, F.col(f"past{k}")))
    again = F.when(F.col("opens") & (F.col("seq") > 1), F.col("system"))
    rows = (rows.withColumn("context", F.when(F.col("opens"), F.filter(F.array(again, *past), lambda t: t.isNotNull())))
            .withColumn("context_text", F.array_join(F.transform("context", lambda t: t["said"]), ""))
            .withColumn("at", F.first("context_text").over(window.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("start", F.length("at") + F.coalesce(F.sum(F.length("said")).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                        + F.length("head"))
            .withColumn("span", F.when(F.col("role") == "assistant", F.struct("start", (F.col("start") + F.length("body")).alias("end")))))
    first = F.min_by(F.struct("context_text", F.size("context").alias("n"), F.aggregate("context", F.lit(0), lambda s, t: s + t["tokens"]).alias("tokens")),
                     "seq")
    return (rows.groupBy("conv_id", "window_no")
            .agg(first.alias("first"), F.count("*").alias("n_new"), F.sum("tokens").alias("new_tokens"),
                 F.sort_array(F.collect_list(F.struct("seq", "said"))).alias("all"),
                 F.sort_array(F.collect_list("span")).alias("loss_spans"))
            .select("conv_id", "window_no", F.col("first.n").alias("n_context"), "n_new",
                    (F.col("new_tokens") + F.col("first.tokens")).alias("n_tokens"),
                    F.concat("first.context_text", F.array_join(F.transform("all", lambda t: t["said"]), "")).alias("formatted"),
                    "loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted text, in order."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), F.lit(2), F.greatest(F.lit(0), F.size(F.split(formatted, r"<\|im_start\|>")) - 1))

    def pair(p):
        role = F.substring_index(p, "\n", 1)
        length = F.length(p) - F.length(role) - 1 - (len(END) + 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(p, F.length(role) + 2, length)).alias("text"))
    return F.transform(parts, pair)


def chat_digest(windows: DataFrame) -> DataFrame:
    """One row a conversation, read back from the formatted windows."""
    read = windows.select(
        "conv_id", "window_no", F.length("formatted").cast("long").alias("n_chars"),
        F.slice(read_turns(F.col("formatted")), F.col("n_context") + 1, F.greatest(F.lit(1), F.col("n_new").cast("int"))).alias("turns"),
        F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "").alias("loss"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    joined = read.select("conv_id", "window_no", "n_chars", "loss", F.size("turns").cast("long").alias("n"), turns.alias("said"))
    every = F.sort_array(F.collect_list(F.struct("window_no", "said", "loss")))
    return (joined.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), every.alias("all"), F.sum("n_chars").alias("formatted_chars"))
            .withColumn("loss", F.array_join(F.transform("all", lambda w: w["loss"]), ""))
            .select("conv_id", "n_turns",
                    F.sha2(F.array_join(F.transform("all", lambda w: w["said"]), "").cast("binary"), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                    "formatted_chars"))


#: Conversation -1 of op10: texts that hold the template's own marks.
MARKED = END + START + "assistant ok"

ORACLE = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{MARKED}' UNION ALL SELECT -1, 1, 'assistant', '{MARKED}'),
s AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS seq,
    length(regexp_extract_all(text, '\p{{L}}+|\p{{N}}+|[^\x00-\x20\p{{L}}\p{{N}}]'))::BIGINT + 4 AS tokens,
    length(role) + length(text) + length(regexp_extract_all(text, '<\\*\|')) + 24 AS len FROM c),
y AS (
  SELECT *, seq = 1 AND role = 'system' AS is_system FROM s),
w0 AS (
  SELECT *, max(CASE WHEN is_system THEN tokens END) OVER v AS sys_tokens, max(CASE WHEN is_system THEN len END) OVER v AS sys_len,
    coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM y WINDOW v AS (PARTITION BY conv_id)),
w1 AS (
  SELECT *, greatest(128, floor((768 - coalesce(sys_tokens, 0)) / 2.0)) AS slot FROM w0),
w2 AS (
  SELECT *, floor(before / slot) AS bin, tokens > slot AS alone FROM w1),
w3 AS (
  SELECT *, seq = 1 OR bin != lag(bin) OVER v OR alone OR lag(alone) OVER v AS opens,
    CASE WHEN NOT lag(is_system, 1) OVER v THEN lag(tokens, 1) OVER v END AS t1, lag(len, 1) OVER v AS l1,
    CASE WHEN NOT lag(is_system, 2) OVER v THEN lag(tokens, 2) OVER v END AS t2, lag(len, 2) OVER v AS l2
  FROM w2 WINDOW v AS (PARTITION BY conv_id ORDER BY seq)),
w4 AS (
  SELECT *, len + CASE WHEN NOT opens THEN 0 ELSE
    CASE WHEN seq > 1 THEN coalesce(sys_len, 0) ELSE 0 END
    + CASE WHEN coalesce(t1 <= 256, false) THEN l1 ELSE 0 END
    + CASE WHEN coalesce(t1 <= 256 AND t1 + t2 <= 256, false) THEN l2 ELSE 0 END END AS chars
  FROM w3)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY seq) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM w4 GROUP BY conv_id
"""


@register("op10_chat_format", ORACLE)
def op10_chat_format(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED).alias("text"))
    return chat_digest(chat_windows(turns.unionByName(marked)))
