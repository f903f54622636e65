"""Chat formatting: records of several layouts to one template, with a loss mask.

A record's **schema fingerprint** is a hash of the nested field paths it
fills, such as ``messages[].role``. Each declared layout lists the paths it
requires and those it allows; its fingerprints select the mapping that turns a
record into canonical turns ``(turn, role, text)``.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<turn:bigint,role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """One way to store a conversation.

    ``each``: an array column, with the names of its role and text fields.
    ``fields``: else, the (role, columns) of every turn in order; columns that
    are filled are joined by an empty line, and a turn without any is left out.
    ``row``: else, one turn per record: the turn, role and text columns.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    each: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    row: tuple[str, str, str] | None = None

    def path_sets(self):
        for n in range(len(self.optional) + 1):
            for chosen in itertools.combinations(self.optional, n):
                yield tuple(sorted({*self.required, *chosen}))


LAYOUTS = (
    Layout("turn rows", (), ("turn", "role", "text"), row=("turn", "role", "text")),
    Layout("messages", ("messages[].role",), ("messages[].content",), each=("messages", "role", "content")),
    Layout("from and value", ("conversations[].from",), ("conversations[].value",), each=("conversations", "from", "value")),
    Layout("instruction", ("instruction", "output"), ("input", "system"), fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("prompt and response", ("prompt", "response"), ("system",), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt and completion", ("prompt", "completion"), ("system",), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("question and answer", ("question", "answer"), ("context",), fields=(("user", ("context", "question")), ("assistant", ("answer",)))),
)
# Other names of the canonical roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

TURN_OPEN, TURN_CLOSE, END = "<|", "|>", "</s>"
# Strings that a chat template may read as control: an opening sign, then one
# of these tails. A text's own ones get one backslash more between the two.
CONTROL = "([<\\[])(\\\\*)(/?s>|/?INST\\]|\\|)"
ESCAPED = "([<\\[])\\\\(\\\\*)(/?s>|/?INST\\]|\\|)"
# Signs that may not stand in a turn's header, and what stands there instead.
HEADER_SIGNS = (("%", "%25"), ("|", "%7C"), ("<", "%3C"), ("[", "%5B"))


def _paths(schema: T.StructType) -> dict[str, Column]:
    """Nested field paths of a schema: path -> whether a record fills it."""
    found: dict[str, Column] = {}

    def walk(kind, path, filled):
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                walk(field.dataType, f"{path}.{field.name}" if path else field.name, lambda f, name=field.name, up=filled: up(lambda value: f(value[name])))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            walk(kind.elementType, f"{path}[]", lambda f, up=filled: up(lambda value: F.exists(value, f)))
        else:
            found[path] = F.coalesce(filled(lambda value: value.isNotNull()), F.lit(False))

    for field in schema.fields:
        walk(field.dataType, field.name, lambda f, name=field.name: f(F.col(f"`{name}`")))
    return found


def fingerprint(frame: DataFrame, layouts=LAYOUTS) -> Column:
    """64-bit hash of the sorted nested paths that a record fills, of those that any layout names."""
    named = {p for layout in layouts for p in (*layout.required, *layout.optional)}
    filled = {p: c for p, c in sorted(_paths(frame.schema).items()) if p in named}
    return F.xxhash64(F.array_join(F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(c, F.lit(p)) for p, c in filled.items()])), "\n"))


def _turn(turn, role, text) -> Column:
    return F.struct(turn.cast("long").alias("turn"), role.cast("string").alias("role"), text.cast("string").alias("text"))


def _mapped(layout: Layout, frame: DataFrame) -> Column:
    """The layout's turns of a record; columns the frame lacks count as NULL."""
    nothing = F.lit(None).cast("string")
    column = lambda name: F.col(f"`{name}`") if name in frame.columns else nothing
    if layout.row:
        return F.array(_turn(*map(column, layout.row)))
    if layout.each:
        array, role, text = layout.each
        inner = frame.schema[array].dataType.elementType.names
        field = lambda item, name: item[name] if name in inner else nothing
        return F.transform(column(array), lambda item, i: _turn(i, field(item, role), field(item, text)))
    turns = []
    for i, (role, columns) in enumerate(layout.fields):
        texts = [column(c) for c in columns]
        turns.append(F.when(F.coalesce(*texts).isNotNull(), _turn(F.lit(i), F.lit(role), F.concat_ws("\n\n", *texts))))
    return F.array_compact(F.array(*turns))


def canonical_turns(frame: DataFrame, conv_id: str = "conv_id", layouts=LAYOUTS) -> DataFrame:
    """``conv_id, layout, turns`` of every record, the layout chosen by its fingerprint.

    A record that matches no layout keeps its row, with NULL layout and turns.
    A record that fills nothing is a turn without role and text. Two layouts
    with one fingerprint are an error.
    """
    claimed: dict[tuple[str, ...], str] = {}
    have = set(_paths(frame.schema))
    chosen, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in reversed(layouts):
        sets = [s for s in layout.path_sets() if have >= set(s)]
        for paths in sets:
            if paths in claimed:
                raise ValueError(f"layouts {claimed[paths]!r} and {layout.name!r} share the paths {paths}")
            claimed[paths] = layout.name
        if sets:
            fits = F.col("_print").isin([]) if not sets else F.lit(False)
            for paths in sets:
                fits = fits | (F.col("_print") == F.xxhash64(F.lit("\n".join(paths))))
            chosen = F.when(fits, F.lit(layout.name)).otherwise(chosen)
            turns = F.when(fits, _mapped(layout, frame).cast(TURNS)).otherwise(turns)
    return frame.withColumn("_print", fingerprint(frame, layouts)).select(F.col(f"`{conv_id}`").alias("conv_id"), chosen.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "$1\\\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _header(role: Column) -> Column:
    for sign, code in HEADER_SIGNS:
        role = F.replace(role, F.lit(sign), F.lit(code))
    return role


def _role(header: Column) -> Column:
    for sign, code in reversed(HEADER_SIGNS):
        header = F.replace(header, F.lit(code), F.lit(sign))
    return header


def format_chats(records: DataFrame, conv_id: str = "conv_id", layouts=LAYOUTS) -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted``.

    ``segments`` cuts ``formatted`` into ``(text, loss)``: the loss mask covers
    the (escaped) texts of assistant turns. Turns are in order of turn number,
    then role and text. NULL roles and texts are empty; records of an unknown
    layout add no turn. Several records of one conversation are put together.
    """
    role = F.coalesce(F.col("item.role"), F.lit(""))
    known = F.coalesce(*[F.when(role == other, F.lit(name)) for other, name in ROLE_NAMES.items()], role)
    turns = canonical_turns(records, conv_id, layouts).select("conv_id", F.explode_outer("turns").alias("item"))
    turns = turns.select(
        "conv_id",
        F.when(F.col("item").isNotNull(), F.struct(F.col("item.turn").alias("turn"), known.alias("role"), F.coalesce(F.col("item.text"), F.lit("")).alias("text"))).alias("item"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "items",
            lambda t: F.array(
                part(F.concat(F.lit(TURN_OPEN), _header(t["role"]), F.lit(TURN_CLOSE)), F.lit(False)),
                part(escape(t["text"]), t["role"] == "assistant"),
                part(F.lit(END), F.lit(False)),
            ),
        )
    )
    return whole.select("conv_id", segments.alias("segments")).withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_turns(formatted: Column) -> Column:
    """The turns ``(role, text)`` read back from a formatted conversation."""
    pieces = F.split(formatted, END, -1)

    def turn(piece):
        header = F.substring_index(piece, TURN_CLOSE, 1)
        return F.struct(
            _role(F.substring(header, F.lit(len(TURN_OPEN) + 1), F.length(header))).alias("role"),
            unescape(F.substring(piece, F.length(header) + len(TURN_CLOSE) + 1, F.length(piece))).alias("text"),
        )

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def learnt_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, all read back from the output."""
    chats = chats.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), read_turns(F.col("formatted")).alias("turns"), learnt_text(F.col("segments")).alias("learnt"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )
