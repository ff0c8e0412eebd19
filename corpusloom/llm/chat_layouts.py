"""Chat formatting: layouts told apart by schema fingerprints, turns rendered by a reversible template.

A row's fingerprint is the hash of the nested paths of the layout fields it
fills. Each declared layout stands for the fingerprints of its field sets, and
the one that fits says how the row turns into canonical (role, text) turns.
Everything is DataFrame expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from itertools import combinations
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


class One(NamedTuple):
    """A turn of a fixed role; several fields are joined by a blank line."""

    role: str
    fields: tuple[str, ...]


class Each(NamedTuple):
    """A turn for each element of an array; ``roles`` renames roles."""

    array: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()


class Row(NamedTuple):
    """The row itself is a turn; ``order`` is its place in the conversation."""

    order: str
    role: str
    text: str


class Layout(NamedTuple):
    """``needed`` paths must be filled, ``optional`` ones (a few) may be."""

    name: str
    needed: tuple[str, ...]
    optional: tuple[str, ...]
    turns: tuple[One | Each | Row, ...]

    def path_sets(self) -> Iterable[tuple[str, ...]]:
        for n in range(len(self.optional) + 1):
            for some in combinations(self.optional, n):
                yield tuple(sorted(self.needed + some))


LAYOUTS = (
    Layout("turn rows", (), ("turn", "role", "text"), (Row("turn", "role", "text"),)),
    Layout("messages", (), ("messages[].role", "messages[].content"), (Each("messages", "role", "content"),)),
    Layout(
        "from-value",
        (),
        ("conversations[].from", "conversations[].value"),
        (Each("conversations", "from", "value", (("human", "user"), ("gpt", "assistant"))),),
    ),
    Layout("prompt-response", ("prompt",), ("response",), (One("user", ("prompt",)), One("assistant", ("response",)))),
    Layout("prompt-completion", ("prompt", "completion"), (), (One("user", ("prompt",)), One("assistant", ("completion",)))),
    Layout(
        "instruction",
        ("instruction", "output"),
        ("input", "system"),
        (One("system", ("system",)), One("user", ("instruction", "input")), One("assistant", ("output",))),
    ),
)

#: Opening and closing marks of the roles the template knows; any other role is written out.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
OTHER = ("[AS] ", " [TEXT] ", " [/TEXT]")
CONTROLS = tuple(m.strip() for pair in (*MARKS.values(), OTHER) for m in pair)


def _field(kind: T.DataType, name: str) -> T.DataType | None:
    return kind[name].dataType if isinstance(kind, T.StructType) and name in kind.fieldNames() else None


def _filled(schema: T.StructType, path: str) -> Column | None:
    """Whether a row fills the path; ``None`` if the schema has no such path."""
    head, _, rest = path.partition("[].")
    kind: T.DataType | None = schema
    for name in head.split("."):
        kind = kind and _field(kind, name)
    if kind is None:
        return None
    column = F.col(".".join(f"`{n}`" for n in head.split(".")))
    if not rest:
        return column.isNotNull()
    if not isinstance(kind, T.ArrayType) or _field(kind.elementType, rest) is None:
        return None
    return F.coalesce(F.exists(column, lambda x: x[rest].isNotNull()), F.lit(False))


def fingerprint(paths: Column) -> Column:
    """Hash of a sorted array of nested paths."""
    return F.xxhash64(F.array_join(paths, "\n"))


def _hash_of(paths: tuple[str, ...]) -> Column:
    return F.xxhash64(F.lit("\n".join(paths)))


def schema_fingerprint(schema: T.StructType, layouts: Iterable[Layout] = LAYOUTS) -> Column:
    """Fingerprint of the layout paths each row fills. Fields no layout names take no part."""
    known = sorted({p for x in layouts for p in (*x.needed, *x.optional)})
    found = [(p, c) for p in known if (c := _filled(schema, p)) is not None]
    return fingerprint(F.array_compact(F.array(*(F.when(c, F.lit(p)) for p, c in found), F.lit(None).cast("string"))))


def _turn(order: Column, place: Column, role: Column, text: Column) -> Column:
    return F.struct(
        order.cast("long").alias("at"),
        place.cast("int").alias("place"),
        F.coalesce(role.cast("string"), F.lit("")).alias("role"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    )


def _element(rule: Each, kind: T.StructType, i: int):
    """The turn of one array element, given it and its place."""

    def get(x: Column, name: str) -> Column:
        return x[name] if name in kind.fieldNames() else F.lit(None)

    def turn(x: Column, place: Column) -> Column:
        role = get(x, rule.role)
        for old, new in rule.roles:
            role = F.when(get(x, rule.role) == old, new).otherwise(role)
        return _turn(F.lit(i), place, role, get(x, rule.text))

    return turn


def _turns(schema: T.StructType, layout: Layout) -> Column:
    def get(path: str) -> Column:
        kind: T.DataType | None = schema
        for name in path.split("."):
            kind = kind and _field(kind, name)
        return F.lit(None) if kind is None else F.col(".".join(f"`{n}`" for n in path.split(".")))

    parts = []
    for i, rule in enumerate(layout.turns):
        if isinstance(rule, Row):
            parts.append(F.array(_turn(get(rule.order), F.lit(0), get(rule.role), get(rule.text))))
        elif isinstance(rule, One):
            texts = F.array_compact(F.array(*(get(f).cast("string") for f in rule.fields)))
            turn = _turn(F.lit(i), F.lit(0), F.lit(rule.role), F.array_join(texts, "\n\n"))
            parts.append(F.when(F.size(texts) > 0, F.array(turn)).otherwise(F.array().cast(_TURNS)))
        else:
            kind = schema[rule.array].dataType.elementType if rule.array in schema.fieldNames() else None
            if kind is None or not isinstance(kind, T.StructType):
                continue

            parts.append(F.coalesce(F.transform(F.col(f"`{rule.array}`"), _element(rule, kind, i)), F.array().cast(_TURNS)))
    return F.concat(*parts) if parts else F.array().cast(_TURNS)


_TURNS = "array<struct<at:bigint,place:int,role:string,text:string>>"


def canonical_turns(rows: DataFrame, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """One row per turn: ``key, layout, at, place, role, text``; conversations no layout fits have one row without a turn.

    Null roles and texts count as empty. Where two layouts share a fingerprint
    the first declared one holds.
    """
    schema, print_ = rows.schema, F.col("_fingerprint")
    rows = rows.withColumn("_fingerprint", schema_fingerprint(schema, layouts))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for x in reversed(layouts):
        fits = reduce(or_, (print_ == _hash_of(paths) for paths in x.path_sets()))
        layout, turns = F.when(fits, F.lit(x.name)).otherwise(layout), F.when(fits, _turns(schema, x)).otherwise(turns)
    picked = rows.select(F.col(f"`{key}`").alias("key"), layout.alias("layout"), F.explode_outer(turns).alias("turn"))
    return picked.select(F.col("key").alias(key), "layout", "turn.*")


def escape(text: Column) -> Column:
    """Double backslashes, then put one inside every control string."""
    inside = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROLS)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), inside, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(rows: DataFrame, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Render each conversation: ``key, formatted, loss_spans``.

    ``loss_spans`` (start, length in code points of ``formatted``) covers the text
    of each assistant turn. Turns are ordered by their place, then role and text,
    so equal places and repeated rows have one result (repeated turns stay). Rows
    with a null key form one conversation. A conversation without turns is an
    empty text. One shuffle by conversation; an output row holds its conversation.
    """
    turns = canonical_turns(rows, key, layouts).withColumnRenamed(key, "key")
    role, text = F.col("role"), escape(F.col("text"))
    opening, closing = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1])), F.lit(OTHER[2])
    for name, (a, b) in MARKS.items():
        opening, closing = F.when(role == name, a).otherwise(opening), F.when(role == name, b).otherwise(closing)
    turns = turns.select(
        "key", "at", "place", "role", "text", opening.alias("opening"), text.alias("body"), closing.alias("closing")
    ).withColumn("block", F.concat("opening", "body", "closing"))
    order = Window.partitionBy("key").orderBy("at", "place", "role", "text")
    end = F.sum(F.length("block") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))
    turns = turns.withColumn("n", F.row_number().over(order)).withColumn("end", end)
    span = F.when(
        role == "assistant",
        F.struct(
            (F.col("end") - F.length("block") - 1 + F.length("opening")).alias("start"),
            F.length("body").cast("long").alias("length"),
        ),
    )
    piece = F.when(F.col("block").isNotNull(), F.struct("n", "block", span.alias("span")))
    chats = turns.groupBy("key").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    spans = F.filter(F.col("pieces.span"), lambda s: s.isNotNull())
    return chats.select(
        F.col("key").alias(key), F.array_join("pieces.block", "\n").alias("formatted"), spans.alias("loss_spans")
    )


def parse_chat(formatted: Column) -> Column:
    """The turns of a rendered conversation: array of (role, text), unescaped."""
    blocks = [f"{re.escape(a)}.*?{re.escape(b)}" for a, b in MARKS.values()]
    blocks.append(".*?".join(map(re.escape, OTHER)))

    def turn(block: Column) -> Column:
        head = F.substring_index(block, OTHER[1], 1)
        role = unescape(F.substring(head, len(OTHER[0]) + 1, 2**31 - 1))
        start, end = F.length(head) + len(OTHER[1]), F.lit(len(OTHER[2]))
        for name, (a, b) in MARKS.items():
            is_it = F.startswith(block, F.lit(a))
            role = F.when(is_it, name).otherwise(role)
            start, end = F.when(is_it, len(a)).otherwise(start), F.when(is_it, len(b)).otherwise(end)
        return F.struct(
            role.alias("role"), unescape(F.substring(block, start + 1, F.length(block) - start - end)).alias("text")
        )

    return F.transform(F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(blocks)), F.lit(0)), turn)


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(
        spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
