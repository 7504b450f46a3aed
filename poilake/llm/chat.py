"""Chat formatting: layouts are told by their field paths and mapped to canonical turns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from dataclasses import field as _field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """How one record layout becomes turns.

    Either ``messages`` names an array whose elements have ``role`` and ``text`` fields, or
    ``fields`` lists (role, field, ...): the fields of one turn are joined by a blank line.
    ``system`` names a top-level field that becomes a first system turn.
    """

    name: str
    messages: str | None = None
    role: str = "role"
    text: str = "content"
    roles: Mapping[str, str] = _field(default_factory=dict)
    fields: Sequence[Sequence[str]] = ()
    system: str | None = None

    def structure(self) -> str:
        """The layout's nested field paths, as ``structure_of`` writes them."""
        if self.messages:
            inner = ", ".join(sorted((self.role, self.text)))
            names = {self.messages: f"{self.messages}: ARRAY<OBJECT<{inner}>>"}
        else:
            names = {f: f for turn in self.fields for f in turn[1:]}
        if self.system:
            names[self.system] = self.system
        return f"OBJECT<{', '.join(names[k] for k in sorted(names))}>"

    def turns(self, record: Column) -> Column:
        """The canonical turns of a JSON record of this layout."""
        if self.messages:
            kind = f"{self.messages} array<struct<`{self.role}`:string,`{self.text}`:string>>"
        else:
            kind = ", ".join(f"`{f}` string" for f in dict.fromkeys(f for turn in self.fields for f in turn[1:]))
        if self.system:
            kind += f", `{self.system}` string"
        row = F.from_json(record, kind)
        blank = F.lit("")
        if self.messages:
            known = F.create_map(*[F.lit(x) for pair in self.roles.items() for x in pair]) if self.roles else None

            def turn(m: Column) -> Column:
                role = F.coalesce(m[self.role], blank)
                role = F.coalesce(known[role], role) if known is not None else role
                return F.struct(role.alias("role"), F.coalesce(m[self.text], blank).alias("text"))

            out = F.transform(row[self.messages], turn)
        else:
            out = F.array(
                *[
                    F.struct(
                        F.lit(role).alias("role"),
                        F.array_join(F.filter(F.array(*[row[f] for f in names]), lambda t: t != ""), "\n\n").alias("text"),
                    )
                    for role, *names in self.fields
                ]
            )
        if self.system:
            first = F.struct(F.lit("system").alias("role"), F.coalesce(row[self.system], blank).alias("text"))
            out = F.concat(F.array(first), out)
        return out.cast(TURNS)


_SHARED = {"human": "user", "gpt": "assistant", "bot": "assistant"}
LAYOUTS = (
    Layout("messages", messages="messages"),
    Layout("messages_system", messages="messages", system="system"),
    Layout("conversations", messages="conversations", role="from", text="value", roles=_SHARED),
    Layout("conversations_system", messages="conversations", role="from", text="value", roles=_SHARED, system="system"),
    Layout("prompt_response", fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question_answer", fields=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction_output", fields=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input_output", fields=(("user", "instruction", "input"), ("assistant", "output"))),
    Layout("instruction_response", fields=(("user", "instruction", "context"), ("assistant", "response"))),
)


def structure_of(record: Column) -> Column:
    """A JSON record's nested field paths without their values' types; keys are in order."""
    kinds = F.schema_of_variant(F.try_parse_json(record))
    return F.regexp_replace(kinds, r": (?!OBJECT<|ARRAY<)[A-Z][A-Z0-9_]*(\([0-9,]*\))?", "")


def fingerprint_of(record: Column) -> Column:
    """The hash of the nested field paths, by which layouts are found."""
    return F.xxhash64(structure_of(record))


def to_turns(
    records: DataFrame, id_col: str, record_col: str, layouts: Sequence[Layout] = LAYOUTS
) -> DataFrame:
    """(id, fingerprint, layout, turns) for each JSON record; layout and turns are null if unknown.

    Null texts and roles become empty; an empty array of messages, whose paths don't show, is
    unknown, as are broken and null records. Additional fields make another layout. Repeated
    rows stay repeated.
    """
    rows = records.select(
        F.col(id_col).alias("id"), F.col(record_col).alias("record"), fingerprint_of(F.col(record_col)).alias("fingerprint")
    )
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        same = F.col("fingerprint") == F.xxhash64(F.lit(layout.structure()))
        name = F.when(same, layout.name).otherwise(name)
        turns = F.when(same, layout.turns(F.col("record"))).otherwise(turns)
    return rows.select("id", "fingerprint", name.alias("layout"), turns.alias("turns"))


#: The template's own marks, and the control strings of other templates.
START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")


def escape(text: Column) -> Column:
    """Doubles backslashes, then puts one behind the first letter of each control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    """Undoes ``escape``: a backslash stands for the letter behind it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """(id, segments, formatted) from (id, turns).

    ``segments`` are (text, loss) in order; ``formatted`` is their concatenation. A turn is
    marked by the role, percent-encoded, and its escaped text; only the texts of ``trained``
    turns are under the loss mask. Empty turns give empty strings, null turns null.
    """
    whole = F.transform(
        "turns",
        lambda t: F.array(
            F.struct(F.concat(F.lit(START), F.url_encode(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == trained).alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        ),
    )
    out = turns.select("id", F.flatten(whole).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string, unescaped."""
    # Marks inside texts are escaped, so the marks that are left are the template's.
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    body = F.transform(parts, lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(
        body,
        lambda p: F.struct(
            F.url_decode(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
        ),
    )


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")


def as_messages(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(id, record): rows by turn as one JSON record per conversation, in order of turn.

    Null roles and texts are empty; equal turns go by role, then text. A conversation's turns
    meet in one row, as its formatted text does.
    """
    blank = F.lit("")
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), blank).alias("role"),
        F.coalesce(F.col(text_col), blank).alias("content"),
    )
    return (
        rows.groupBy(F.col(id_col).alias("id"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(
            "id",
            F.to_json(
                F.struct(F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))
            ).alias("record"),
        )
    )
