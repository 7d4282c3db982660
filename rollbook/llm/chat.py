"""Chat formatting: records of several layouts become canonical turns, and turns become one training text.

`fingerprint` hashes the sorted nested field paths of a record, so equal layouts have equal fingerprints whatever their
values. `MAPPINGS` says for each known layout where its turns are; a record of an unknown layout gives no turns and is
reported by `canonical_turns` with mapping null.

The template marks a turn as `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and texts a backslash is put after the
first character of every control string, and backslashes are doubled, so nothing in a text reads as a mark and
`read_back` restores it exactly. The loss mask covers the texts of assistant turns.

Everything is DataFrame functions. Turns of one conversation are ordered by turn (missing ones last), then role, then
text; repeated rows are repeated turns; a missing text or role is empty; rows with no conversation id form one
conversation. A formatted conversation is one cell, as its reader needs it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: the control strings of common chat templates
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
OPEN, CLOSE = CONTROL[0], CONTROL[1]
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Mapping:
    """How a layout holds its turns: either a list of records at `turns`, or single fields, each with its role. Other
    names of roles are replaced, except in rows that are turns already."""

    name: str
    example: dict
    turns: str | None = None
    role: str = ""
    text: str = ""
    fields: Sequence[tuple[str, str]] = ()
    rename: bool = True


MAPPINGS = (
    Mapping("turn", {"role": "", "text": ""}, fields=(("$.role", "$.text"),), rename=False),
    Mapping("prompt", {"prompt": "", "completion": ""}, fields=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("prompt-response", {"prompt": "", "response": ""}, fields=(("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("instruction", {"instruction": "", "output": ""}, fields=(("user", "$.instruction"), ("assistant", "$.output"))),
    Mapping("instruction-input", {"instruction": "", "input": "", "output": ""},
            fields=(("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Mapping("messages", {"messages": [{"role": "", "content": ""}]}, "$.messages", "role", "content"),
    Mapping("conversations", {"conversations": [{"from": "", "value": ""}]}, "$.conversations", "from", "value"),
    Mapping("nested", {"data": {"turns": [{"speaker": "", "text": ""}]}}, "$.data.turns", "speaker", "text"),
)
# fixed values: other names of the three roles
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def layout_of(value: object) -> str:
    """What `layout` gives for a record of this shape."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{layout_of(v)}" for k, v in sorted(value.items())) + "}"
    return f"[{layout_of(value[0])}]" if isinstance(value, list) and value else "." if not isinstance(value, list) else "[.]"


def layout(record: Column) -> Column:
    """The nested field paths of a JSON record, without values: names sorted, every scalar a dot."""
    kinds = F.schema_of_variant(F.try_parse_json(record))
    kinds = F.regexp_replace(kinds, r"OBJECT<", "{")
    kinds = F.regexp_replace(kinds, r"ARRAY<", "[")
    # a closing bracket belongs to the last one opened: innermost pairs first, as deep as the known layouts go
    for _ in range(4):
        kinds = F.regexp_replace(kinds, r"\{([^\[\]{}<>]*)>", "\u0001$1\u0002")
        kinds = F.regexp_replace(kinds, r"\[([^\[\]{}<>]*)>", "\u0003$1\u0004")
    kinds = F.regexp_replace(kinds, r": (?=[A-Z])[A-Z]+(\([0-9, ]*\))?", ":.")
    kinds = F.regexp_replace(kinds, r"(?<=\x03)[A-Z]+(\([0-9, ]*\))?(?=\x04)", ".")
    return F.translate(F.regexp_replace(kinds, r"([:,]) ", "$1"), "\u0001\u0002\u0003\u0004", "{}[]")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(layout(record))


def canonical_turns(records: DataFrame, record_col: str = "record", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """Adds `mapping` (name of the layout's mapping, null if unknown) and `turns`, an array of (role, text); a missing
    role or text is empty."""
    value = F.try_parse_json(F.col(record_col))

    def turn(role: Column, text: Column, rename: bool) -> Column:
        role = F.coalesce(role, F.lit(""))
        for other, name in ROLE_NAMES.items() if rename else ():
            role = F.when(role == other, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    def listed(m: Mapping):
        return lambda t: turn(t[m.role], t[m.text], m.rename)

    def field(path: str) -> Column:
        return F.try_variant_get(value, path, "string")

    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    shape = F.col("__layout")
    for m in mappings:
        # the hash selects; the record's own layout need not be compared
        selected = shape == F.xxhash64(F.lit(layout_of(m.example)))
        if m.turns:
            kind = f"array<struct<`{m.role}`:string,`{m.text}`:string>>"
            found = F.transform(F.try_variant_get(value, m.turns, kind), listed(m))
        else:
            found = F.array(*[turn(field(role) if role.startswith("$") else F.lit(role), field(text), m.rename) for role, text in m.fields])
        name, turns = F.when(selected, F.lit(m.name)).otherwise(name), F.when(selected, found).otherwise(turns)
    return (records.withColumn("__layout", fingerprint(F.col(record_col)))
            .withColumns({"mapping": name, "turns": F.coalesce(turns, F.array().cast("array<struct<role:string,text:string>>"))})
            .drop("__layout"))


def escape(text: Column) -> Column:
    marks = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROL)
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), marks, r"\\")


def escape_role(role: Column) -> Column:
    """A role ends at a line break, so one inside it gets a backslash too."""
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: Column) -> Column:
    """One text of all turns; turns as an array of (role, text)."""
    shown = F.transform(turns, lambda t: F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(CLOSE + "\n")))
    return F.array_join(shown, "")


TURN = rf"(?s){re.escape(OPEN)}((?:[^\\\n]|\\.)*)\n(.*?){re.escape(CLOSE)}\n"


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    roles = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(2))
    return F.zip_with(roles, texts, lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text")))


def loss_spans(formatted: Column) -> Column:
    """Places of the assistant texts in a formatted text: array of (start, length) in code points, from 0."""
    roles = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(2))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.lit(len(OPEN)) + F.length(t["role"]) + 1
        end = start + F.length(t["text"]) + F.lit(len(CLOSE) + 1)
        mine = F.struct(start.cast("int").alias("start"), F.length(t["text"]).alias("length"))
        return F.struct(end.cast("int").alias("at"),
                        F.when(t["role"] == ASSISTANT, F.array_append(state["spans"], mine)).otherwise(state["spans"]).alias("spans"))

    pairs = F.zip_with(roles, texts, lambda r, t: F.struct(r.alias("role"), t.alias("text")))
    return F.aggregate(pairs, begin, add, lambda s: s["spans"])


def format_conversations(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows by turn to a row by conversation: id, `formatted`, and `loss` as in `loss_spans`."""
    rows = df.select(df[id_col].alias("id"), df[turn_col].alias("at"),
                     F.to_json(F.struct(F.coalesce(df[role_col], F.lit("")).alias("role"),
                                        F.coalesce(df[text_col], F.lit("")).alias("text"))).alias("record"))
    turns = canonical_turns(rows)
    known = F.when(F.col("mapping").isNotNull(), F.col("turns")).otherwise(F.raise_error(F.lit("a record of an unknown layout")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("at").isNull().alias("late"), F.col("at"), known.alias("turns"))))
    whole = turns.groupBy("id").agg(F.flatten(F.transform(ordered, lambda x: x["turns"])).alias("turns"))
    formatted = whole.select(F.col("id").alias(id_col), format_turns(F.col("turns")).alias("formatted"))
    return formatted.withColumn("loss", loss_spans(F.col("formatted")))


def example_records() -> list[str]:
    """A record of each known layout, for documentation and tests."""
    return [json.dumps(m.example) for m in MAPPINGS]
