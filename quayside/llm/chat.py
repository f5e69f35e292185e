r"""Chat formatting: layouts told apart by the fingerprint of their fields, turned into one template.

A fingerprint is the SHA-256 of the sorted paths of all nested fields. Each known fingerprint names a
declarative mapping from that layout to canonical turns (conversation, position, role, text). Frames are
told apart by their schema; records of JSON text row by row, by the schema of their value.

A turn is written ``<s>role[INST] text [/INST]</s>``. Where a text or role holds one of the
template's control strings, a backslash is put after its first character; if backslashes are there already, one
more, so taking one away gives back the text, whatever it was: ``</s>`` is ``<\/s>``, ``<\/s>`` is
``<\\/s>``. A loss mask lists the places of the texts of one role.

Turns are in order of position, then role and text; repeated rows are repeated turns. A null
text or role is empty; rows with a null conversation are one conversation; a null position comes first. Columns
that no mapping names are passed over only if the fingerprint is taken of the named columns. A conversation is one
row of the result, so it must fit in one: 2 GB. An empty table gives an empty one. Only
DataFrame operations are used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
LOSS_ROLE = "assistant"


def paths_of(kind: T.DataType, prefix: str = "") -> list[str]:
    """The paths of all fields: dots between names, [] for the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in paths_of(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return paths_of(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


@dataclass(frozen=True)
class Layout:
    """A layout: its paths, and where a canonical turn's fields are.

    ``turns`` lists (role, path of the text) for layouts of a record for each conversation; ``many``
    is (path of an array, its role field, its text field); ``row`` is (conversation, position, role, text)
    for layouts of a row for each turn.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    many: tuple[str, str, str] | None = None
    row: tuple[str, str, str, str] | None = None


LAYOUTS = (
    Layout("rows by turn", ("conv_id", "turn", "role", "text"), row=("conv_id", "turn", "role", "text")),
    Layout("prompt", ("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Layout("completion", ("prompt", "completion"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", ("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
    Layout(
        "instruction with input",
        ("instruction", "input", "output"),
        turns=(("user", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Layout(
        "instruction with system",
        ("system", "instruction", "output"),
        turns=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
    ),
    Layout("messages", ("messages[].role", "messages[].content"), many=("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), many=("conversations", "from", "value")),
)
#: Names of roles that stand for a canonical one.
ROLES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}
BY_FINGERPRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}

_TURN = "struct<role:string,text:string>"


def turns_of_rows(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(conv, position, role, text) of a frame of turns, its layout found by the named columns' fingerprint."""
    named = rows.select(*columns)
    layout = BY_FINGERPRINT.get(fingerprint(paths_of(named.schema)))
    if layout is None or layout.row is None:
        raise ValueError(f"no layout of turns has the fields {sorted(paths_of(named.schema))}")
    conv, position, role, text = layout.row
    return named.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(position).cast("long").alias("position"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def _value_paths(value: Column) -> Column:
    """The sorted paths of a value of the layouts' depth: its fields, and those of elements of arrays in it."""
    fields = F.schema_of_variant(value)
    # OBJECT<a: STRING, m: ARRAY<OBJECT<role: STRING>>> : the names, with those of an array's elements after its own
    inner = F.regexp_extract_all(fields, F.lit(r"([\w]+): ARRAY<OBJECT<([^<>]*)>>"), F.lit(0))
    flat = F.regexp_replace(F.regexp_replace(fields, r"[\w]+: ARRAY<OBJECT<[^<>]*>>", ""), r"^OBJECT<|>$", "")
    outer = F.filter(F.regexp_extract_all(flat, F.lit(r"(\w+): "), F.lit(1)), lambda x: x != "")

    def nested(found: Column) -> Column:
        owner = F.regexp_extract(found, r"^(\w+):", 1)
        names = F.regexp_extract_all(F.regexp_extract(found, r"OBJECT<([^<>]*)>", 1), F.lit(r"(\w+): "), F.lit(1))
        return F.transform(names, lambda n: F.concat(owner, F.lit("[]."), n))

    return F.array_sort(F.concat(outer, F.flatten(F.transform(inner, nested))))


def turns_of_records(records: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv, layout, turns) for every row of JSON text; an unknown layout, or text that is no JSON, has null for both."""
    rows = records.select(F.col(id_col).cast("long").alias("conv"), F.try_parse_json(F.col(json_col).cast("string")).alias("value"))
    rows = rows.withColumn("print", F.sha2(F.array_join(_value_paths(F.col("value")), "\n"), 256))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{_TURN}>")
    for mark, layout in BY_FINGERPRINT.items():
        if layout.row is None:
            name = F.when(F.col("print") == mark, layout.name).otherwise(name)
            turns = F.when(F.col("print") == mark, _mapped(layout)).otherwise(turns)
    return rows.select("conv", name.alias("layout"), turns.alias("turns"))


def _mapped(layout: Layout) -> Column:
    def turn(role: Column, text: Column) -> Column:
        return F.struct(_canonical(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    if layout.many:
        array, role, text = layout.many
        found = F.try_variant_get("value", f"$.{array}", f"array<struct<`{role}`:string,`{text}`:string>>")
        return F.transform(found, lambda m: turn(m[role], m[text]))
    return F.array(*(turn(F.lit(role), F.try_variant_get("value", f"$.{path}", "string")) for role, path in layout.turns))


def _canonical(role: Column) -> Column:
    found = F.coalesce(role, F.lit(""))
    for other, canonical in ROLES.items():
        found = F.when(role == other, canonical).otherwise(found)
    return found


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"<(\\*)(/?s>)", r"<\\$1$2"), r"\[(\\*)(/?INST\])", r"[\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"<\\(\\*)(/?s>)", "<$1$2"), r"\[\\(\\*)(/?INST\])", "[$1$2")


def gathered(turns: DataFrame) -> DataFrame:
    """(conv, turns): the turns of each conversation in order, from (conv, position, role, text)."""
    own = F.array_sort(F.collect_list(F.struct("position", "role", "text")))
    return turns.groupBy("conv").agg(own.alias("turns"))


def formatted(conversations: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv, formatted, loss): the conversation as one text, and the places (start, end) of the texts to learn."""
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit("<s>"), escape(t["role"]), F.lit("[INST] ")).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == loss_role).alias("learn"),
        ),
    )
    tail = " [/INST]</s>"

    def place(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["head"])
        end = start + F.length(part["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        none = F.array().cast("array<struct<start:int,end:int>>")
        return F.struct(
            (end + len(tail)).alias("at"),
            F.concat(state["spans"], F.when(part["learn"], span).otherwise(none)).alias("spans"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return conversations.select("conv", parts.alias("parts")).select(
        "conv",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "").alias("formatted"),
        F.aggregate("parts", begin, place, lambda s: s["spans"]).alias("loss"),
    )


def parsed(texts: DataFrame) -> DataFrame:
    """``texts`` (with a column formatted) and the turns that are read back from it, as roles and texts."""
    turns = F.filter(F.split("formatted", "</s>", -1), lambda t: t != "")

    def turn(raw: Column) -> Column:
        at = F.call_function("instr", raw, F.lit("[INST] "))
        role = F.substring(raw, F.lit(4), at - 4)
        body = F.substring(raw, at + 7, F.length(raw) - at - 6 - 8)
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return texts.withColumn("turns", F.transform(turns, turn))


def masked(text: str = "formatted", loss: str = "loss") -> Column:
    """The texts under the mask, unescaped, one after another."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"]))), ""
    )
