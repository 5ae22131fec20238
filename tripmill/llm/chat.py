"""Chat formatting: logs of events folded into final messages, then rendered with a loss mask.

Events have ``conv_id, seq, turn, kind, role, text``. The log of a conversation is read in the order of ``seq``:

====================  ========================================================================
kind                  meaning
====================  ========================================================================
``message``           the message at ``turn`` begins, with this role and text
``delta``             the text is appended to the message at ``turn``
``edit``              the text replaces that of the message at ``turn``; later turns are void
``regenerate``        the message at ``turn`` begins anew with this text; later turns are void
``delete``            the message at ``turn`` is gone
====================  ========================================================================

Turns made void come back if events after that write to them again. Everything is built-in functions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripmill.llm._common import text_of

#: The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"

#: Kinds that start a message's text anew, and those that also void later turns.
RESETS = ["message", "edit", "regenerate", "delete"]
VOIDING = ["edit", "regenerate"]


def escaped(text: Column) -> Column:
    r"""The text with one more backslash inside each ``<|``, ``<\|`` ..., so that no mark can stand in it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    r"""The inverse of ``escaped``: one backslash less inside each ``<\|``, ``<\\|`` ..."""
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role on one line: marks as in texts; line ends and backslashes before n as two characters."""
    return F.replace(escaped(F.regexp_replace(role, r"\\(\\*)n", r"\\\\$1n")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    # A single backslash before n is a line end; of more of them one was added.
    line_ends = F.regexp_replace(role, r"(?<!\\)\\n", "\n")
    return unescaped(F.regexp_replace(line_ends, r"\\(\\+)n", r"$1n"))


def events_of(conversations: DataFrame) -> DataFrame:
    """Plain rows (conv_id, turn, role, text) as events: one ``message`` a row, in the order of turns."""
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("seq"),
        F.col("turn").cast("long").alias("turn"),
        F.lit("message").alias("kind"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """The final messages: ``conv_id, turn, part, role, text``, one row for each message that remains.

    Each message's events come together, not those of a whole conversation; only where a conversation has edits or
    regenerations are its turn numbers (no texts) sorted together. Texts are joined once, so that a message of
    many deltas takes time in proportion.

    A null text is empty, a null role is the last role given before, else empty. Null ids are one conversation, null turns one turn
    before all others, null sequence numbers come first; an unknown or null kind is a ``message``. Two messages begun at one turn with
    one and the same sequence number are both kept, ordered by role and text, and ``part`` tells them apart; repeated rows thus stay repeated messages.
    Deltas to a turn that no event began make an assistant's message. Other columns are not looked at.
    """
    kind = F.when(F.col("kind").isin("delta", *RESETS), F.col("kind")).otherwise(F.lit("message"))
    ev = events.select("conv_id", "turn", "seq", kind.alias("kind"), "role", text_of("text").alias("text"))
    voiding = ev.where(F.col("kind").isin(VOIDING)).groupBy("conv_id", "turn").agg(F.max("seq").alias("cut"))
    item = F.struct("seq", (F.col("kind") == "delta").cast("int").alias("late"), "role", "text", "kind")
    messages = ev.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(item)).alias("log"))
    # The turns of conversations that have cuts, with the last cut of an earlier turn.
    turns = (
        ev.select("conv_id", "turn")
        .distinct()
        .join(voiding.select("conv_id").distinct().withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi")
        .join(
            voiding.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "cut"),
            F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")),
            "left",
        )
    )
    earlier = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    cuts = turns.select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.max("cut").over(earlier).alias("void_to")
    ).where("void_to is not null")
    live = messages.join(
        cuts, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")), "left"
    ).withColumn(
        "log",
        F.when(
            F.col("void_to").isNotNull(), F.filter("log", lambda e: e["seq"] > F.col("void_to"))
        ).otherwise(F.col("log")),
    )
    # Where the last reset stands; resets with its sequence number that are messages, too, stay beside it.
    n = F.size("log")
    last = F.array_max(
        F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i).otherwise(F.lit(-1)))
    )
    same = F.filter(
        "log",
        lambda e: (e["kind"] == "message") & e["seq"].eqNullSafe(F.get(F.col("log"), F.col("last"))["seq"]),
    )
    state = (
        live.where(n > 0)
        .withColumn("last", last)
        .withColumn("first", F.get("log", F.col("last")))
        .where(F.coalesce(F.col("first")["kind"] != "delete", F.lit(True)))
        .withColumn("twins", F.when(F.col("first")["kind"] == "message", F.slice(same, 1, F.greatest(F.size(same) - 1, F.lit(0)))))
    )
    deltas = F.transform(F.slice("log", F.col("last") + 2, F.greatest(n - F.col("last") - 1, F.lit(0))), lambda e: e["text"])
    text = F.concat(F.coalesce(F.col("first")["text"], F.lit("")), F.array_join(deltas, ""))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    own = F.when(
        (F.col("last") < 0) & (F.size(roles) == 0), F.lit("assistant")
    ).otherwise(F.coalesce(F.col("first")["role"], F.when(F.col("first")["kind"] != "message", F.element_at(roles, -1)), F.when(F.col("last") < 0, F.element_at(roles, -1)), F.lit("")))
    final = F.array_append(
        F.transform(
            F.coalesce("twins", F.array().cast("array<struct<seq:bigint,late:int,role:string,text:string,kind:string>>")),
            lambda e: F.struct(F.coalesce(e["role"], F.lit("")).alias("role"), e["text"].alias("text")),
        ),
        F.struct(own.alias("role"), text.alias("text")),
    )
    return state.select("conv_id", "turn", F.posexplode(final).alias("part", "m")).select(
        "conv_id", "turn", "part", "m.role", "m.text"
    )


def render(messages: DataFrame) -> DataFrame:
    """Each message in the template, and where its loss is: ``conv_id, turn, part, segment, loss_start, loss_chars``.

    The loss mask is the text of assistants, without marks, in code points of the segment. Null where there is none.
    """
    text = escaped(F.col("text"))
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    is_loss = F.col("role") == "assistant"
    return messages.select(
        "conv_id",
        "turn",
        "part",
        F.concat(head, text, F.lit(f"{END}\n")).alias("segment"),
        F.when(is_loss, F.length(head)).cast("long").alias("loss_start"),
        F.when(is_loss, F.length(text)).cast("long").alias("loss_chars"),
    )


def assemble(segments: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_segments, formatted, loss``.

    ``loss`` is a list of (segment, start, chars), counted from 0, start within the segment. It is what a formatted text is: one row,
    so a conversation must fit Spark's row of at most 2 GB.
    """
    ordered = F.sort_array(F.collect_list(F.struct("turn", "part", "segment", "loss_start", "loss_chars")))
    spans = F.transform(
        "s",
        lambda e, i: F.when(
            e["loss_start"].isNotNull(),
            F.struct(i.alias("segment"), e["loss_start"].alias("start"), e["loss_chars"].alias("chars")),
        ),
    )
    return segments.groupBy("conv_id").agg(ordered.alias("s")).select(
        "conv_id",
        F.size("s").cast("long").alias("n_segments"),
        F.array_join(F.transform("s", lambda e: e["segment"]), "").alias("formatted"),
        F.filter(spans, lambda e: e.isNotNull()).alias("loss"),
    )


def format_chat(events: DataFrame) -> DataFrame:
    """Logs of events to formatted conversations; see ``fold``, ``render`` and ``assemble``.

    A conversation whose messages are all gone has no row. No events, no rows.
    """
    return assemble(render(fold(events)))


def read_back(formatted: DataFrame) -> DataFrame:
    """From formatted texts and masks: ``conv_id, turns`` (role, text) and ``loss`` (the texts under the mask)."""
    cut = F.split("formatted", r"(?<=<\|im_end\|>\n)")
    pieces = F.filter(cut, lambda p: p != "")
    turns = F.transform(
        "pieces",
        lambda p: F.struct(
            unescaped_role(F.regexp_extract(p, r"^<\|im_start\|>([^\n]*)\n", 1)).alias("role"),
            unescaped(F.regexp_extract(p, r"(?s)^<\|im_start\|>[^\n]*\n(.*)<\|im_end\|>\n$", 1)).alias("text"),
        ),
    )
    loss = F.transform(
        "loss",
        lambda s: unescaped(
            F.substring(F.get("pieces", s["segment"]), (s["start"] + 1).cast("int"), s["chars"].cast("int"))
        ),
    )
    return formatted.withColumn("pieces", pieces).select(
        "conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars")
    )
