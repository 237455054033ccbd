"""Conversations as one text each, with the parts a model is to learn marked.

Template: every run of adjacent turns with the same role is one block,
``<|im_start|>role<|im_sep|>text<|im_part|>text<|im_end|>``. Control strings inside
roles and texts are escaped, so the formatted text can be read back turn by turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Turns of one conversation that are gathered at a time before they meet.
TURNS_PER_SEGMENT = 256


@dataclass(frozen=True)
class Template:
    """Marks of the template and further strings that must not appear in a text as they are.

    Control strings hold no backslash and start with ``<`` or ``[``.
    """

    start: str = "<|im_start|>"
    separator: str = "<|im_sep|>"
    part: str = "<|im_part|>"
    end: str = "<|im_end|>"
    learnt_role: str = "assistant"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.separator, self.part, self.end, *self.reserved)


def quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def escape(text: Column, template: Template = Template()) -> Column:
    """Double every backslash, then put one behind the first character of every control string."""
    rest = {}
    for control in template.controls:
        rest.setdefault(control[0], []).append(quoted(control[1:]))
    starts = "|".join(f"{quoted(first)}(?={'|'.join(tails)})" for first, tails in rest.items())
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({starts})", "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per ``conv_id`` with ``segments`` (text, loss) and ``formatted``, their texts joined.

    ``turns`` needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are
    ignored, whatever their names. Turns are ordered by (turn, role, text), nulls
    first; equal turn numbers and repeated rows are turns of their own. A null
    role or text counts as empty, a null ``conv_id`` is one conversation. Turns
    of the learnt role carry the loss, one segment per turn. An empty table
    gives no rows.

    Turns meet in two steps, by (conversation, range of turn numbers) and then
    by conversation, so that the rows of a long conversation are gathered and
    sorted in many tasks before its text is put together.
    """
    segment = F.floor(F.col("turn") / F.lit(TURNS_PER_SEGMENT))
    gathered = (
        turns.select(
            "conv_id",
            segment.alias("segment"),
            F.struct(
                F.col("turn"),
                escape(F.coalesce(F.col("role"), F.lit("")), template).alias("role"),
                escape(F.coalesce(F.col("text"), F.lit("")), template).alias("text"),
            ).alias("said"),
        )
        .groupBy("conv_id", "segment")
        .agg(F.sort_array(F.collect_list("said")).alias("said"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("segment", "said"))).alias("parts"))
        .select("conv_id", F.flatten(F.transform("parts", lambda p: p["said"])).alias("said"))
    )
    # Positions where a run of one role begins.
    opened = gathered.select(
        "conv_id",
        "said",
        F.filter(
            F.transform(
                "said",
                lambda x, i: F.when((i == 0) | (F.get(F.col("said"), i - 1)["role"] != x["role"]), i),
            ),
            lambda i: i.isNotNull(),
        ).alias("opens"),
    )
    merged = opened.select(
        "conv_id",
        F.transform(
            "opens",
            lambda begin, j: F.struct(
                F.get(F.col("said"), begin)["role"].alias("role"),
                F.transform(
                    F.slice(
                        F.col("said"),
                        begin + 1,
                        F.coalesce(F.get(F.col("opens"), j + 1), F.size("said")) - begin,
                    ),
                    lambda x: x["text"],
                ).alias("texts"),
            ),
        ).alias("runs"),
    )

    def plain(text: Column) -> Column:
        return F.struct(text.alias("text"), F.lit(False).alias("loss"))

    def segments(run: Column) -> Column:
        head = plain(F.concat(F.lit(template.start), run["role"], F.lit(template.separator)))
        learnt = run["role"] == F.lit(template.learnt_role)
        texts = F.transform(
            run["texts"],
            lambda text, i: F.array(
                plain(F.when(i == 0, F.lit("")).otherwise(F.lit(template.part))),
                F.struct(text.alias("text"), learnt.alias("loss")),
            ),
        )
        return F.concat(F.array(head), F.flatten(texts), F.array(plain(F.lit(template.end))))

    return merged.select(
        "conv_id",
        F.filter(F.flatten(F.transform("runs", segments)), lambda s: F.length(s["text"]) > 0).alias("segments"),
    ).select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The (role, text) of every turn, read from a formatted text."""
    runs = F.split(formatted, quoted(template.end), -1)
    runs = F.filter(runs, lambda run: F.length(run) > 0)

    def turns(run: Column) -> Column:
        halves = F.split(run, quoted(template.separator), -1)
        role = unescape(F.substr(F.get(halves, F.lit(0)), F.lit(len(template.start) + 1)))
        return F.transform(
            F.split(F.get(halves, F.lit(1)), quoted(template.part), -1),
            lambda text: F.struct(role.alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(runs, turns))


def learnt_text(segments: Column) -> Column:
    """All text under the loss, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
