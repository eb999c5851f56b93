"""Chat formatting with built-in functions only.

A declarative template gives each role its opening and closing marks and says
whether its text is trained on. A finite-state machine over the roles validates
the order of turns. The output is the list of text segments with their loss
flags; control strings inside texts are broken up by an escape mark, so the
concatenated text can be read back turn by turn.

Defined cases: turns are ordered by turn number (null first), ties by role and
text; a null text or role counts as empty; a role the template does not name is
formatted with the marks for other roles, never trained on, and makes the
conversation invalid; rows without conv_id form one conversation; repeated rows
are turns of their own; an empty table gives no conversation; further columns
are ignored. An invalid conversation is formatted all the same and flagged.

One conversation becomes one row: its digests are taken over its whole text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm.common import read_table


@dataclass(frozen=True)
class Marks:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``order`` maps a state and a role to the next state; ``accept`` are the states to end in."""

    roles: dict[str, Marks] = field(
        default_factory=lambda: {
            "system": Marks("<<SYS>>\n", "\n<</SYS>>\n"),
            "user": Marks("[INST] ", " [/INST]\n"),
            "assistant": Marks("<s>", "</s>\n", loss=True),
        }
    )
    other: Marks = Marks("[ROLE] ", "[/ROLE]\n")
    controls: tuple[str, ...] = (
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]",
    )
    escape: str = "␛"
    order: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "briefed",
            ("start", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    accept: tuple[str, ...] = ("asked", "answered")


DEFAULT = Template()


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    """Double the escape mark, then put one after the first character of each control string."""
    mark = template.escape
    longest = sorted(template.controls, key=len, reverse=True)
    pattern = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in longest)
    doubled = F.replace(text, F.lit(mark), F.lit(mark * 2))
    return F.regexp_replace(doubled, pattern, mark)


def unescaped(text: Column, template: Template = DEFAULT) -> Column:
    mark = re.escape(template.escape)
    return F.regexp_replace(text, f"{mark}({mark}?)", "$1")


def _by_role(role: Column, template: Template, pick) -> Column:
    chosen = F.lit(pick(template.other))
    for name, marks in template.roles.items():
        chosen = F.when(role == name, F.lit(pick(marks))).otherwise(chosen)
    return chosen


def final_state(roles: Column, template: Template = DEFAULT) -> Column:
    """Run the machine over an array of roles; ``error`` once no transition fits."""
    table = F.create_map(
        *[F.lit(x) for (state, role), then in template.order.items() for x in (f"{state}\n{role}", then)]
    )
    step = lambda state, role: F.coalesce(
        F.try_element_at(table, F.concat_ws("\n", state, role)), F.lit("error")
    )
    return F.aggregate(roles, F.lit("start"), step)


def format_conversations(rows: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: ``conv_id``, ``valid``, ``segments`` (text, loss)."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    named = list(template.roles)

    def segments(t: Column) -> Column:
        role = t["role"]
        opening = F.concat(
            _by_role(role, template, lambda m: m.opening),
            F.when(role.isin(named), F.lit("")).otherwise(F.concat(F.url_encode(role), F.lit("\n"))),
        )
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(
                escaped(t["text"], template).alias("text"),
                _by_role(role, template, lambda m: m.loss).alias("loss"),
            ),
            F.struct(
                _by_role(role, template, lambda m: m.closing).alias("text"), F.lit(False).alias("loss")
            ),
        )

    state = final_state(F.col("turns.role"), template)
    return grouped.select(
        "conv_id",
        state.isin(*template.accept).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Parse the concatenated text into turns again: adds ``formatted_text`` and ``turns`` (role, text)."""
    kinds = [*template.roles.values(), template.other]
    openings = "|".join(re.escape(m.opening) for m in kinds)
    closings = "|".join(re.escape(m.closing) for m in kinds)
    whole = F.concat_ws("", F.transform("segments", lambda s: s["text"]))
    pattern = F.lit(f"(?s)({openings})(.*?)({closings})")
    found = formatted.withColumn("formatted_text", whole).withColumn(
        "parts",
        F.arrays_zip(
            F.regexp_extract_all("formatted_text", pattern, 1).alias("opening"),
            F.regexp_extract_all("formatted_text", pattern, 2).alias("body"),
        ),
    )

    def turn(part: Column) -> Column:
        role, text = F.lit(None).cast("string"), part["body"]
        for name, marks in template.roles.items():
            role = F.when(part["opening"] == marks.opening, F.lit(name)).otherwise(role)
        other = part["opening"] == template.other.opening
        role = F.when(other, F.url_decode(F.substring_index(text, "\n", 1))).otherwise(role)
        body = F.when(other, F.substr(text, F.locate("\n", text) + 1)).otherwise(text)
        return F.struct(role.alias("role"), unescaped(body, template).alias("text"))

    return found.withColumn("turns", F.transform("parts", turn)).drop("parts")


def digests(back: DataFrame, template: Template = DEFAULT) -> DataFrame:
    trained = F.concat_ws(
        "",
        F.transform(
            F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template)
        ),
    )
    listed = F.concat_ws(
        "", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted_text").cast("long").alias("formatted_chars"),
        "valid",
    )


PROBE = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return digests(read_back(format_conversations(rows.unionByName(probe))))


_MARKS = """CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 8
    ELSE 16 + length(role) END"""

ORACLE_SQL = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
marked AS (
    SELECT *, length(text) + (length(text) - length(replace(text, chr(9243), '')))
        + len(regexp_extract_all(text, '</?s>|\\[/?INST\\]|<</?SYS>>|\\[/?ROLE\\]')) + {_MARKS} AS chars
    FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars,
    regexp_full_match(
        string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END,
            '' ORDER BY turn NULLS FIRST, role, text), 's?(ua)*ua?') AS valid
FROM marked GROUP BY conv_id
"""
