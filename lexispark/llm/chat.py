"""Chat formatting by event-sourced reconstruction, in DataFrame operations only.

The log has one event per row: conv_id, seq, turn, kind, role, text. Events of a turn are folded in
the order of seq: `message` opens a message of its own, so rows that repeat a turn all stay; the other kinds address the
last opened one (or open the first). `edit` sets its text, `delta` appends to it, `regenerate` sets it anew (deltas after it build
the new version) and `delete` removes it, until an `edit` or `regenerate` brings it back. The final
messages of a conversation, in the order of turn and opening, are rendered:

    <s>[INST]role[/INST]text</s>

The four control strings `<s>`, `</s>`, `[INST]` and `[/INST]` and the backslash are escaped in roles and texts:
a backslash is doubled, and one is put behind the first sign of a control string. So no control string
occurs in escaped text, and removing one backslash from each pair of backslash and sign restores it.
The loss mask is an array of (start, length) in code points of the formatted string, one for each assistant text.

Folding turns first spreads the deltas of a conversation over tasks by (conv_id, turn). A conversation
ends as one string, so its final messages do meet in one row; that is the result's own size.

Defined results: a null text or role is empty; events of a turn with equal seq are ordered by kind, role and
text; a null turn comes last; a null or unknown kind counts as `message`; an empty log gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.session import table

#: Fixed control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


#: Kinds of events that address an open message.
ADDRESSING = ("delta", "edit", "regenerate", "delete")


def fold(events: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and messages, an array of (last, turn, item, role, text) in the order of turn and opening."""
    sets = lambda e: ~e["kind"].isin("delta", "delete")
    text = F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id", "turn").orderBy("seq", "kind", F.coalesce("role", F.lit("")), "text").rowsBetween(Window.unboundedPreceding, 0)
    messages = (
        events.select("conv_id", "turn", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "role", text.alias("text"))
        .withColumn("item", F.sum(F.when(F.col("kind").isin(*ADDRESSING), 0).otherwise(1)).over(order))
        .groupBy("conv_id", "turn", "item")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("__lx_es"))
        .withColumn("__lx_from", F.array_max(F.transform("__lx_es", lambda e, i: F.when(sets(e), i + 1).otherwise(1))))
        .withColumn("__lx_gone", F.array_max(F.transform("__lx_es", lambda e, i: F.when(e["kind"] == "delete", i + 1).otherwise(0))))
        .withColumn("__lx_live", F.slice("__lx_es", F.col("__lx_from"), F.size("__lx_es")))
        .filter((F.col("__lx_gone") == 0) | (F.col("__lx_gone") < F.col("__lx_from")))
    )
    message = F.struct(
        F.col("turn").isNull().alias("last"), "turn", "item",
        F.element_at(F.concat(F.array(F.lit("")), F.filter(F.transform("__lx_es", lambda e: e["role"]), lambda r: r.isNotNull())), -1).alias("role"),
        F.array_join(F.transform("__lx_live", lambda e: e["text"]), "").alias("text"),
    )
    return messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("messages"))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: the rendered string and the spans of its assistant texts in code points."""
    open_, end_ = "<s>[INST]", "</s>"
    parts = F.transform(
        "messages",
        lambda m: F.struct(
            F.concat(F.lit(open_), escape(m["role"]), F.lit("[/INST]")).alias("head"),
            escape(m["text"]).alias("body"),
            (m["role"] == "assistant").alias("learn"),
        ),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        body_at = acc["at"] + F.length(p["head"])
        length = F.length(p["body"]).cast("long")
        span = F.array(F.struct(body_at.cast("long").alias("start"), length.alias("length")))
        return F.struct(
            (body_at + length + len(end_)).cast("long").alias("at"),
            F.when(p["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return conversations.withColumn("__lx_parts", parts).select(
        "conv_id",
        F.array_join(F.transform("__lx_parts", lambda p: F.concat(p["head"], p["body"], F.lit(end_))), "").alias("formatted"),
        F.aggregate("__lx_parts", start, step, lambda acc: acc["spans"]).alias("loss"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a rendered string, as an array of (role, text)."""
    pieces = F.filter(F.split(formatted, "</s>"), lambda p: p != "")
    head = lambda p: F.substring_index(p, "[/INST]", 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substr(head(p), F.lit(len("<s>[INST]") + 1))).alias("role"),
            unescape(F.substr(p, F.length(head(p)) + len("[/INST]") + 1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def read_back(rendered: DataFrame) -> DataFrame:
    digest = F.array_join(F.transform("__lx_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (
        rendered.withColumn("__lx_turns", parse(F.col("formatted")))
        .withColumn("__lx_loss", loss_text(F.col("formatted"), F.col("loss")))
        .select(
            "conv_id",
            F.size("__lx_turns").cast("long").alias("n_turns"),
            F.sha2(digest, 256).alias("turns_sha256"),
            F.length("__lx_loss").cast("long").alias("loss_chars"),
            F.sha2("__lx_loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def events_of(rows: DataFrame) -> DataFrame:
    """The log of plain rows (conv_id, turn, role, text): each is a `message` event, and rows that repeat a turn are ordered by role and text."""
    return rows.select("conv_id", F.lit(0).alias("seq"), "turn", F.lit("message").alias("kind"), "role", "text")


def op9_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return read_back(render(fold(events_of(rows.unionByName(extra)))))


OP9_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS escaped
  FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(escaped) + length('<s>[INST][/INST]</s>'))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
