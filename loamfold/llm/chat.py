"""Conversations rebuilt from event logs, rendered with a template, and read back; DataFrame functions only.

One shuffle by conversation serves every step. What a task holds is one conversation, which is one row of the result;
the folding itself is windows over its sorted events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Marks of the template, and control strings of common templates that are escaped inside texts too.
BEGIN, END = "<|im_start|>", "<|im_end|>"
CONTROLS = [BEGIN, END, "<|endoftext|>", "<|begin_of_text|>", "<|eot_id|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]


def _control(marks: str) -> str:
    """Matches a control string with backslashes after its first character; groups: first, backslashes, rest."""
    rest = "|".join(sorted({c[1:].replace("|", r"\|").replace("]", r"\]") for c in CONTROLS}, key=len, reverse=True))
    return rf"([<\[])({marks})({rest})"


ESCAPED, PLAIN = _control(r"\\*)(\\"), _control(r"\\*")


def escape(text: Column) -> Column:
    """One backslash more after the first character of every control string, so that none is left as it was."""
    return F.regexp_replace(text, PLAIN, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$4")


def _header(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role(header: Column) -> Column:
    return unescape(F.replace(F.replace(header, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, message, role, text`` of a log ``conv_id, sequence, kind, message, role, text``.

    Events apply in order of ``sequence`` (ties: by kind, text and role; null first). ``delta`` appends to its message;
    ``message`` and ``edit`` replace what it held; ``regenerate`` drops its message and all later ones as they stand.
    A message's role is that of its last event with one. A message without an event after its last ``regenerate``
    is gone. Null texts are empty; a null ``conv_id`` or ``message`` is a value of its own; unknown kinds are left out;
    an event that is there twice, with equal values in all columns, counts once. Other columns are left out.
    """
    log = events.select("conv_id", "message", F.coalesce("sequence", F.lit(-(2**63)).cast("long")).alias("sequence"), "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    log = log.where(F.col("kind").isin("message", "edit", "delta", "regenerate"))
    one = Window.partitionBy("conv_id", "message", "sequence", "kind", "text", "role").orderBy("sequence")
    upto = Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, 0)
    within = Window.partitionBy("conv_id", "message")
    log = log.repartition("conv_id").withColumn("_copy", F.row_number().over(one)).where("_copy = 1")
    log = log.withColumns({
        "_cut": F.max(F.when(F.col("kind") == "regenerate", F.col("sequence"))).over(upto),
        "_reset": F.max(F.when(F.col("kind").isin("message", "edit"), F.struct("sequence", "kind", "text"))).over(within),
    })
    after = F.col("_cut").isNull() | (F.col("sequence") > F.col("_cut"))
    since = F.col("_reset").isNull() | (F.struct("sequence", "kind", "text") >= F.col("_reset")) | ((F.col("sequence") == F.col("_reset.sequence")) & (F.col("kind") == "delta"))
    live = log.where((F.col("kind") != "regenerate") & after & since)
    # a replacement that ties with deltas comes first, as they belong to what it began
    parts = F.array_sort(F.collect_list(F.struct("sequence", (F.col("kind") == "delta").alias("late"), "kind", "text", "role")))
    return live.groupBy("conv_id", "message").agg(parts.alias("parts")).select(
        "conv_id",
        "message",
        F.element_at(F.filter(F.concat(F.array(F.lit(None).cast("string")), F.col("parts.role")), lambda r, i: r.isNotNull() | (i == 0)), -1).alias("role"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learned: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans``: each conversation's messages in order, one text.

    A message is rendered as the begin mark, its role, a line feed, its text, the end mark and a line feed; control
    strings inside texts and roles are escaped. ``loss_spans`` are the byte ranges ``start, length`` (UTF-8, from 0)
    of the texts of role ``learned``. A null role is an empty one.
    """
    before = Window.partitionBy("conv_id").orderBy("message", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    head = F.concat(F.lit(BEGIN), _header(F.coalesce("role", F.lit(""))), F.lit("\n"))
    turns = messages.select("conv_id", "message", "role", "text", head.alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body"))
    turns = turns.withColumn("whole", F.concat("head", "body", F.lit(END + "\n")))
    turns = turns.withColumns({
        "at": F.coalesce(F.sum(F.octet_length("whole").cast("long")).over(before), F.lit(0).cast("long")),
        "place": F.row_number().over(Window.partitionBy("conv_id").orderBy("message", "role", "text")),
    })
    span = F.when(F.col("role") == learned, F.struct((F.col("at") + F.octet_length("head")).alias("start"), F.octet_length("body").cast("long").alias("length")))
    parts = F.array_sort(F.collect_list(F.struct("place", "whole", span.alias("span"))))
    joined = turns.groupBy("conv_id").agg(parts.alias("parts"))
    return joined.select("conv_id", F.array_join(F.transform("parts", lambda p: p["whole"]), "").alias("formatted"), F.array_compact("parts.span").alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The messages of a rendered text: an array of ``role, text``."""
    pieces = F.split(formatted, BEGIN.replace("|", r"\|"))
    messages = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def parsed(piece: Column) -> Column:
        line = F.locate("\n", piece)
        tail = F.lit(len(END) + 1)
        return F.struct(_role(F.substring(piece, F.lit(1), line - 1)).alias("role"), unescape(F.substring(piece, line + 1, F.length(piece) - line - tail)).alias("text"))

    return F.transform(messages, parsed)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text inside the spans, unescaped, with nothing between."""
    raw = F.encode(formatted, "UTF-8")
    cut = F.transform(spans, lambda s: unescape(F.decode(F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")))
    return F.array_join(cut, "")
