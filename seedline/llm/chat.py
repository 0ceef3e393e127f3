"""Chat formatting: a template, a state machine over the roles, and text segments with loss flags.

A conversation's turns, in order, become segments: an opening mark with the role, the text, a closing mark.
Only the text of roles that the template trains on carries the loss flag. Inside roles and texts every
``escapes`` pair of the template is applied in order, so no mark can arise from what a user wrote; reading
back applies them in reverse. The state machine folds the roles through the template's transitions; a
conversation with a turn that has no transition is marked invalid and formatted all the same.

Null texts and null roles are empty. Turns of equal number (repeated rows) are ordered by role, then text; a
null number comes first. Rows of a null conv_id are one conversation. Extra columns are ignored. A
conversation is one record of the output, so it must fit one row; conversations are spread over all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    turn_open: str = "<s>[INST:"
    role_close: str = "]\n"
    turn_close: str = "[/INST]</s>\n"
    trained: tuple[str, ...] = ("assistant",)
    # applied in order when writing, in reverse when reading; the first must be the escape sign itself
    escapes: tuple[tuple[str, str], ...] = (("%", "%25"), ("<", "%3C"), ("[", "%5B"), ("]", "%5D"))
    start: str = "start"
    # (state, role) -> next state; a conversation may end in any state listed in ``final``
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    final: tuple[str, ...] = ("assistant",)


DEFAULT = Template()


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), template.escapes, text)


def unescaped(text: Column, template: Template = DEFAULT) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[1]), F.lit(pair[0])), reversed(template.escapes), text)


def _valid(roles: Column, template: Template) -> Column:
    """Fold the roles through the transitions; the state "invalid" has no way out."""

    def step(state: Column, role: Column) -> Column:
        cases = F.lit("invalid")
        for (source, by), target in template.transitions.items():
            cases = F.when((state == source) & (role == by), target).otherwise(cases)
        return cases

    return F.aggregate(roles, F.lit(template.start), step).isin(*template.final)


def format_conversations(rows: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conv_id, valid boolean, segments array<struct<text string, loss boolean>>, formatted string."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def written(t: Column) -> Column:
        head = F.concat(F.lit(template.turn_open), escaped(t["role"], template), F.lit(template.role_close))
        return F.array(
            segment(head, F.lit(False)),
            segment(escaped(t["text"], template), t["role"].isin(*template.trained)),
            segment(F.lit(template.turn_close), F.lit(False)),
        )

    segments = F.flatten(F.transform("turns", written))
    valid = _valid(F.transform("turns", lambda t: t["role"]), template)
    out = held.select("conv_id", valid.alias("valid"), segments.alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """The turns as array<struct<role, text>>, parsed from ``formatted``, and ``loss_text``, from the flagged segments."""
    records = F.split(F.col("formatted"), _literal(template.turn_close))
    records = F.slice(records, F.lit(1), F.size(records) - 1)  # what follows the last mark is empty

    def parsed(record: Column) -> Column:
        body = F.substring(record, F.lit(len(template.turn_open) + 1), F.length(record))
        at = F.locate(template.role_close, body)  # roles hold no such mark once escaped
        role = F.substring(body, F.lit(1), at - 1)
        text = F.substring(body, at + len(template.role_close), F.length(body))
        return F.struct(unescaped(role, template).alias("role"), unescaped(text, template).alias("text"))

    flagged = F.filter("segments", lambda s: s["loss"])
    loss = F.array_join(F.transform(flagged, lambda s: unescaped(s["text"], template)), "")
    return formatted.withColumn("turns", F.transform(records, parsed)).withColumn("loss_text", loss)


def _literal(mark: str) -> str:
    """A mark as a regular expression."""
    return "".join(c if c.isalnum() else f"\\{c}" if c != "\n" else "\\n" for c in mark)


def digests(rows: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Per conversation, what reading the output back gives: number of turns, digests of turns and trained text, lengths."""
    back = read_back(format_conversations(rows, template), template)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
    )


# A conversation whose texts hold marks of a common template, formatted with all others.
PROBE_ID = -7
PROBE_TEXT = "</s>[INST] ok [/INST]"


def with_probe(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return rows.select("conv_id", "turn", "role", "text").unionByName(probe)


CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, role || chr(10) || text || chr(10) AS plain,
    23 + length(role) + length(text) + 2 * (length(regexp_replace(role || text, '[^%<\[\]]', '', 'g'))) AS chars,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end
  FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(plain, '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
    WHEN before = 'user' THEN role = 'assistant' ELSE false END) AND bool_or(from_end = 1 AND role = 'assistant') AS valid
FROM marked GROUP BY conv_id"""
