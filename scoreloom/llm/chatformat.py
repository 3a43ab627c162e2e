r"""Chat formatting: schema fingerprints pick declared mappings, turns become one escaped, masked text.

Records of any layout are variants. The nested field paths of a record, as far as some mapping names
them, are hashed; that fingerprint selects the declared mapping that turns the record into (role,
text) turns. A conversation is written as ``<|im_start|>role\ntext<|im_end|>\n`` per turn, with control
strings inside roles and texts escaped so that reading the text back gives the turns again, and with the
spans that a loss is taken on. Everything is built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.llm.common import col

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
#: Names that mappings of foreign layouts give to roles; other names stay.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


@dataclass(frozen=True)
class Layout:
    """One mapping from field paths to turns.

    Either ``each`` names a list and ``role`` and ``text`` the fields of its entries (``parts`` the field of the
    text's own pieces, where it is a list again), or ``each`` is None and ``role`` and ``text`` are fields of
    the record, which is one turn, or ``fields`` lists (role, paths) of a record whose turns are fields: paths of
    one turn are joined by a blank line, a turn whose paths are all missing or empty is left out.
    ``optional`` paths may be there or not; ``names`` says whether role names are mapped.
    """

    name: str
    each: str | None = None
    role: str | None = None
    text: str | None = None
    parts: str | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    names: bool = True

    def required(self) -> list[str]:
        if self.fields:
            return [p for _, paths in self.fields for p in paths if p not in self.optional]
        top = f"{self.each}[]." if self.each else "$."
        return [top + self.role, top + self.text + (f"[].{self.parts}" if self.parts else "")]

    def path_sets(self) -> list[list[str]]:
        """All sets of paths that this mapping takes, an empty list of turns included."""
        sets = [sorted(self.required() + list(some)) for n in range(len(self.optional) + 1)
                for some in combinations(self.optional, n)]
        return sets + ([[f"{self.each}[]"]] if self.each else [])

    def turns(self, record: Column) -> Column:
        """The record's turns as an array of (role, text)."""
        def field(of: Column, path: str, kind: str = "string") -> Column:
            return F.try_variant_get(of, path, kind)

        def named(role: Column) -> Column:
            pairs = [x for pair in ROLE_NAMES.items() for x in map(F.lit, pair)]
            return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(role)), role) if self.names else role

        def one(of: Column) -> Column:
            text = field(of, "$." + self.text)
            if self.parts:
                pieces = F.transform(field(of, "$." + self.text, "array<variant>"), lambda p: field(p, "$." + self.parts))
                text = F.array_join(pieces, "")
            return F.struct(F.coalesce(named(field(of, "$." + self.role)), F.lit("")).alias("role"),
                            F.coalesce(text, F.lit("")).alias("text"))

        if self.fields:
            joined = F.array(*[F.struct(F.lit(role).alias("role"), F.array_join(F.filter(F.array(
                *[field(record, p) for p in paths]), lambda x: x != ""), "\n\n").alias("text")) for role, paths in self.fields])
            return F.filter(joined, lambda t: t["text"] != "")
        return F.transform(field(record, self.each, "array<variant>"), one) if self.each else F.array(one(record))


LAYOUTS = (
    Layout("rows", role="role", text="text", optional=("$.turn",), names=False),
    Layout("messages", each="$.messages", role="role", text="content"),
    Layout("message parts", each="$.messages", role="role", text="content", parts="text"),
    Layout("conversations", each="$.conversations", role="from", text="value"),
    Layout("prompt", fields=(("system", ("$.system",)), ("user", ("$.prompt",)), ("assistant", ("$.response",))),
           optional=("$.system",)),
    Layout("completion", fields=(("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    Layout("question", fields=(("user", ("$.context", "$.question")), ("assistant", ("$.answer",))), optional=("$.context",)),
    Layout("instruction", fields=(("system", ("$.system",)), ("user", ("$.instruction", "$.input")),
                                  ("assistant", ("$.output",))), optional=("$.system", "$.input")),
)

#: A quoted or plain field name, an opened or closed container, or a scalar type, in a schema's text.
_PIECES = r"`(?:[^`]|``)*`: |[^\s`<>,:()]+: |OBJECT<|ARRAY<|>|[A-Z_]+(?:\(\d+,\d+\))?"


def field_paths(record: Column) -> Column:
    """The nested field paths of a variant, such as ``$.messages[].role``; null for a null variant.

    The schema's text is read once from the left with a stack of names. A name or a list opens a value, a scalar
    type or a closed container ends it; scalars give the paths.
    """
    state = F.struct(F.array(F.lit("$")).alias("open"), F.array().cast("array<string>").alias("paths"))

    def step(s: Column, piece: Column) -> Column:
        name = F.regexp_replace(F.regexp_replace(F.substr(piece, F.lit(1), F.length(piece) - 2), "^`|`$", ""), "``", "`")
        popped = F.slice(s["open"], F.lit(1), F.size(s["open"]) - 1)
        pushed = (F.when(piece.endswith(": "), F.concat(s["open"], F.array(F.concat(F.lit("."), name))))
                  .when(piece == "ARRAY<", F.concat(s["open"], F.array(F.lit("[]"))))
                  .when(piece == "OBJECT<", s["open"]).otherwise(popped))
        scalar = ~(piece.endswith(": ") | piece.endswith("<") | (piece == ">"))
        return F.struct(pushed.alias("open"), F.when(scalar, F.concat(
            s["paths"], F.array(F.array_join(s["open"], "")))).otherwise(s["paths"]).alias("paths"))

    pieces = F.regexp_extract_all(F.schema_of_variant(record), F.lit(_PIECES), 0)
    return F.array_sort(F.array_distinct(F.aggregate(pieces, state, step, lambda s: s["paths"])))


def _hash(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def fingerprint(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Hash of the record's field paths that some mapping names; fields unknown to all change nothing."""
    known = sorted({p for m in layouts for paths in m.path_sets() for p in paths})
    return _hash(F.array_intersect(field_paths(record), F.array(*map(F.lit, known))))


def layout_name(print_: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """The mapping that a fingerprint selects, the first of several; null if none does."""
    first: dict[tuple, str] = {}
    for m in layouts:
        for paths in m.path_sets():
            first.setdefault(tuple(paths), m.name)
    table = [x for paths, name in first.items() for x in (_hash(F.array(*map(F.lit, paths))), F.lit(name))]
    return F.try_element_at(F.create_map(*table), print_)


def canonical_turns(records: DataFrame, id_col: str, record_col: str, turn_col: str | None = None,
                    layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``conv_id, own, turn, part, nth, layout, fingerprint, role, text``, one row per turn of each variant record.

    Null roles and texts are empty. A record whose fingerprint no mapping has (null ones too) keeps one row
    with null layout, role and text, and so does one without turns. ``own`` parts records without id, each of
    which is a conversation of its own; ``part`` and ``nth`` order the turns of list records.
    """
    record = F.col("record")
    turn = col(turn_col).cast("long") if turn_col else F.lit(None).cast("long")
    rows = records.select(col(id_col).alias("conv_id"), turn.alias("turn"), col(record_col).alias("record"))
    rows = rows.withColumn("own", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    rows = rows.withColumn("fingerprint", fingerprint(record, layouts)).withColumn("layout", layout_name(F.col("fingerprint"), layouts))
    turns = part = None
    for m in layouts:
        found = F.col("layout") == m.name
        turns = F.when(found, m.turns(record)) if turns is None else turns.when(found, m.turns(record))
        if m.each or m.fields:
            part = F.when(found, F.xxhash64(F.to_json(record))) if part is None else part.when(found, F.xxhash64(F.to_json(record)))
    part = part if part is not None else F.lit(None).cast("long")
    rows = rows.select("conv_id", "own", "turn", part.alias("part"), "layout", "fingerprint", turns.alias("turns"))
    return rows.select("conv_id", "own", "turn", "part", "layout", "fingerprint",
                       F.posexplode_outer("turns").alias("nth", "t")).select(
        "conv_id", "own", "turn", "part", "nth", "layout", "fingerprint", "t.role", "t.text")


# ------------------------------------------------------------------ the template

def escaped(text: Column) -> Column:
    r"""The text with one backslash more inside each ``<|``, ``<\|``, ``<\\|`` ...: no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escaped_role(role: Column) -> Column:
    """A role keeps to one line: a backslash is written as backslash b, a line feed as backslash n."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def format_turns(turns: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """``conv_id, layout, formatted, loss, unmapped``, one row per conversation of ``canonical_turns``.

    Turns are ordered by ``turn`` (nulls first), then record and place in it, then role and text, so that ties
    have one order and repeated rows stay. ``loss`` has an entry per turn: null, or (``start``, ``within``,
    ``length``), the span of the escaped text in code points from the begin of the whole text and of the turn.
    ``unmapped`` counts records that no mapping takes; ``layout`` is the least name of those taken. A
    conversation is one output row, so one task has it; the texts are shuffled once, by conversation.
    """
    role, text = _escaped_role(F.col("role")), escaped(F.col("text"))
    there = F.col("role").isNotNull()
    pieces = turns.select(
        "conv_id", "own", "turn", "part", "nth", "layout", "role", "text",
        F.when(there, F.concat(F.lit(START), role, F.lit("\n"))).alias("head"), F.when(there, text).alias("body"))
    whole = F.concat("head", "body", F.lit(END + "\n"))
    size = F.coalesce(F.length("head") + F.length("body") + F.lit(len(END) + 1), F.lit(0)).cast("long")
    order = W.partitionBy("conv_id", "own").orderBy("turn", "part", "nth", "role", "text")
    placed = pieces.select(
        "conv_id", "own", "layout", F.row_number().over(order).alias("at"), whole.alias("piece"), F.when(
            F.col("role") == trained, F.struct(
                (F.sum(size).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - size
                 + F.length("head")).alias("start"),
                F.length("head").cast("long").alias("within"), F.length("body").cast("long").alias("length"))).alias("span"))
    grouped = placed.groupBy("conv_id", "own").agg(
        F.min("layout").alias("layout"), F.count_if(F.col("layout").isNull()).alias("unmapped"),
        F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("at", "piece", "span")))).alias("all"))
    return grouped.select("conv_id", "layout", F.array_join(F.col("all")["piece"], "").alias("formatted"),
                          F.col("all")["span"].alias("loss"), "unmapped")


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``, the (role, text) array read from the text, and ``loss_text``, what the mask covers."""
    def turn(piece: Column) -> Column:
        inner = F.substr(piece, F.lit(len(START) + 1))
        line = F.instr(inner, "\n")
        return F.struct(_unescaped_role(F.substr(inner, F.lit(1), line - 1)).alias("role"),
                        unescaped(F.substr(inner, line + 1)).alias("text"))

    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p.startswith(START))
    under = F.zip_with(pieces, "loss", lambda piece, span: F.when(span.isNotNull(), F.substr(
        piece, (span["within"] + 1).cast("int"), span["length"].cast("int"))))
    return formatted.withColumn("turns", F.transform(pieces, turn)).withColumn(
        "loss_text", F.array_join(F.transform(under, unescaped), ""))


def digests(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, layout`` from what is read back."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "layout")


def conversation_records(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """Turn rows as records: ``conv_id, turn, record``; further columns are left out."""
    fields = [col(turn_col).alias("turn"), col(role_col).cast("string").alias("role"), col(text_col).cast("string").alias("text")]
    return rows.select(col(id_col).alias("conv_id"), col(turn_col).cast("long").alias("turn"),
                       F.to_variant_object(F.struct(*fields)).alias("record"))
