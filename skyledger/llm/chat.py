"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, merged where neighbours have one role, and joined to one text,
all by array functions. Turns that are merged share a block, with a separator between their texts, so that each can be read back. Inside texts and roles a backslash is
doubled and ``<|`` becomes ``<\\|``, so no text can end a block; in roles a line break becomes ``\\n``.

    <|im_start|>user\\nfirst text<|im_sep|>second text<|im_end|>\\n<|im_start|>assistant\\n...<|im_end|>\\n

The loss mask is a list of spans (start and length in code points of the formatted text), one for each assistant text.

Turns are ordered by turn number, ties by role and text, nulls first. Null texts and roles count as empty. Rows without a
conversation id form one conversation without an id. A conversation is one row of the result, so its turns meet in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def running(lengths: str) -> Column:
    """Sums of the first 1, 2, ... elements of an array column. Sums over stretches of the square root of its length come first,
    so that long arrays take n ** 1.5 steps."""
    n = F.size(lengths)
    stretch = F.ceil(F.sqrt(n)).cast("int")
    add = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)
    sums = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / stretch).cast("int")), lambda k: add(F.slice(lengths, k * stretch + 1, stretch)))
    sums = F.transform(F.array(sums), lambda whole: F.transform(whole, lambda _, k: add(F.slice(whole, F.lit(1), k))))[0]
    within = lambda i: add(F.slice(lengths, F.floor(i / stretch).cast("int") * stretch + 1, i % stretch + 1))
    # One array of sums serves all places.
    return F.transform(F.array(sums), lambda whole: F.transform(F.col(lengths), lambda _, i: F.element_at(whole, F.floor(i / stretch).cast("int") + 1) + within(i)))[0]


def format_conversations(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans (array of start and length) of each conversation. One shuffle, by conversation."""
    rows = df.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    made = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # Each step is a column of its own. One that only a lambda of the next step read would be evaluated for each element.
    made = made.select("conv_id", F.transform("turns", lambda t: t.role).alias("roles"), F.transform("turns", lambda t: escape(t.text)).alias("bodies"))
    begins = lambda i: (i == 1) | (F.get("roles", i - 2) != F.get("roles", i - 1))  # noqa: E731  of places from 1
    made = made.select("*", F.filter(F.sequence(F.lit(1), F.size("roles")), begins).alias("starts"))
    opening = lambda r: F.concat(F.lit(START), escape_role(r), F.lit("\n"))
    merged = F.transform("starts", lambda s, k: F.struct(F.element_at("roles", s).alias("role"), F.slice("bodies", s, F.coalesce(F.get("starts", k + 1), F.size("roles") + 1) - s).alias("bodies")))
    joined = F.array_join(F.transform("blocks", lambda b: F.concat(opening(b.role), F.array_join(b.bodies, SEPARATOR), F.lit(END))), "")
    lead = lambda i: F.when(~begins(i + 1), len(SEPARATOR)).otherwise(F.char_length(opening(F.element_at("roles", i + 1))) + F.when(i == 0, 0).otherwise(len(END)))
    made = made.select("conv_id", "roles", F.transform("bodies", lambda b: F.char_length(b)).alias("sizes"), merged.alias("blocks"), F.transform("bodies", lambda b, i: (lead(i) + F.char_length(b)).cast("long")).alias("lengths"))
    made = made.select("conv_id", "roles", "sizes", joined.alias("formatted"), running("lengths").alias("ends"))
    span = lambda end, i: F.struct((end - F.get("sizes", i)).alias("start"), F.get("sizes", i).cast("long").alias("length"))
    spans = F.filter(F.transform("ends", lambda end, i: F.when(F.get("roles", i) == loss_role, span(end, i))), lambda s: s.isNotNull())
    return made.select("conv_id", "formatted", spans.alias("loss_spans"))


def turns_of(formatted: Column) -> Column:
    """The turns, as structs of role and text, that a formatted text holds."""
    blocks = F.split(formatted, r"<\|im_end\|>\n", -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        role = F.substring_index(F.substring(block, len(START) + 1, 2147483647), "\n", 1)
        texts = F.split(block.substr(F.char_length(role) + len(START) + 2, F.char_length(block)), r"<\|im_sep\|>", -1)
        return F.transform(texts, lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(formatted.substr((s.start + 1).cast("int"), s.length.cast("int"))))
