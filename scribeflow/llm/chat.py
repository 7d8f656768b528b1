"""Chat formatting by schema fingerprints.

Training conversations come in many layouts: a prompt with its completion, an instruction with an
input, a list of messages under one name or another, or a table with a row for each turn.  Each
layout is declared as data (``LAYOUTS``): which nested field holds what.  A record's fingerprint
is the hash of the nested field paths that it fills, out of the paths that any layout knows; it
selects the mapping that turns the record into canonical turns (role, text).  So one table may mix
layouts row by row, and fingerprints that no layout takes are reported (``unmapped``).

The template marks each turn::

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Control strings inside a text are escaped: a backslash goes behind their first sign, after any
that are there (``</s>`` becomes ``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``), so none is left,
and taking one away gives the text again.  In roles, line ends and percent signs are written as
%0A and %25 besides.  The loss mask covers the texts of assistant turns, as spans of code points.

Turns are sorted over ranges of (conversation, turn), so a conversation with a third of all rows is
formatted by many tasks; each writes parts of at most ``PART_CHARS`` code points (a longer turn is
a part of its own).  Reading back takes conversations known to be one part as they come, and sorts
only the parts of the others, which are digested as a stream.

Defined results: null text, role or turn: empty text, empty role, first in order; rows equal in
(conversation, turn) follow in order of their formatted role and text, and each counts; a null conversation is one of
its own; a record without turns, or of no known layout, gives none; an empty table has no rows;
texts of any length are kept whole; extra columns are not read unless a layout names them.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from scribeflow.llm.common import slices, stage

PART_CHARS = 1 << 20
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

#: Control strings of public chat templates; none may stand in a text.
CONTROL = ["<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>",
           "<bos>", "<eos>", "[SYSTEM_PROMPT]", "[/SYSTEM_PROMPT]", "[AVAILABLE_TOOLS]", "[/AVAILABLE_TOOLS]", "[TOOL_CALLS]"]
#: Any <|name|> counts as one too.
_REST = "|".join([re.escape(c[1:]) for c in CONTROL] + [r"\|[^|<>\[\\\n]*\|>"])
#: The first sign of a control string, backslashes, the rest of it.
_MARK = rf"([<\[])(\\*)(?=(?:{_REST}))"
_MARKED = re.compile(rf"([<\[])\\(\\*)(?=(?:{_REST}))")

#: The names that public data sets give to the three roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "chatgpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """One way to lay out a conversation.  ``turns``: (role or role's path, text's path) in order; a
    path with ``[]`` runs over a list, and the layout then has just that one entry.  ``order``: the
    path of the turn number, where a record is one turn.  Paths in ``optional`` may be absent."""

    name: str
    turns: tuple[tuple[str, str], ...]
    optional: frozenset[str] = field(default_factory=frozenset)
    order: str | None = None
    joined: tuple[str, ...] = ()  # texts that follow the first turn's text after a blank line

    def paths(self) -> frozenset[str]:
        named = {p for role, text in self.turns for p in (role, text) if not p.startswith("=")}
        return frozenset(named | set(self.joined) | ({self.order} if self.order else set()))


#: The layouts; ``=user`` is the role itself, not a path.
LAYOUTS = (
    Layout("turn rows", (("role", "text"),), frozenset({"role", "text", "turn"}), order="turn"),
    Layout("messages", (("messages[].role", "messages[].content"),), frozenset({"messages[].content"})),
    Layout("share", (("conversations[].from", "conversations[].value"),), frozenset({"conversations[].value"})),
    Layout("instruction", (("=system", "system"), ("=user", "instruction"), ("=assistant", "output")), frozenset({"system", "input"}),
           joined=("input",)),
    Layout("prompt", (("=system", "system"), ("=user", "prompt"), ("=assistant", "completion")), frozenset({"system"})),
    Layout("prompt and response", (("=system", "system"), ("=user", "prompt"), ("=assistant", "response")), frozenset({"system"})),
    Layout("question", (("=user", "question"), ("=assistant", "answer")), frozenset()),
)


def _hash(paths) -> int:
    h = xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def fingerprints(layouts=LAYOUTS) -> dict[int, Layout]:
    """The mapping for each fingerprint; each choice of a layout's optional paths has one.  Where
    two layouts share one, the first declared has it."""
    out: dict[int, Layout] = {}
    for layout in layouts:
        may = sorted(layout.optional & layout.paths())
        for n in range(len(may) + 1):
            for absent in combinations(may, n):
                paths = layout.paths() - set(absent)
                if paths:
                    out.setdefault(_hash(paths), layout)
    return out


def schema_paths(schema: DataType, at: str = "") -> dict[str, DataType]:
    """The nested field paths of a schema, lists marked by ``[]``."""
    out: dict[str, DataType] = {}
    if isinstance(schema, StructType):
        for f in schema.fields:
            out |= schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(schema, ArrayType) and isinstance(schema.elementType, StructType):
        out |= schema_paths(schema.elementType, at + "[]")
    else:
        out[at] = schema
    return out


def _column(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def _filled(path: str) -> Column:
    """Whether a record fills the path."""
    if "[]." not in path:
        return _column(path).isNotNull()
    lists, inner = path.split("[].", 1)
    return F.coalesce(F.exists(_column(lists), lambda m: m[inner].isNotNull()), F.lit(False))


def json_records(lines: DataFrame, column: str = "value", layouts=LAYOUTS) -> DataFrame:
    """Records of JSON text as columns: the fields that any layout knows, as strings; what cannot be
    read is a record without fields."""
    lists: dict[str, list[str]] = {}
    plain: list[str] = []
    for p in sorted(set().union(*(x.paths() for x in layouts))):
        if "[]." in p:
            a, b = p.split("[].", 1)
            lists.setdefault(a, []).append(b)
        else:
            plain.append(p)
    ddl = [f"`{p}` string" for p in plain] + [f"`{a}` array<struct<{', '.join(f'`{b}`: string' for b in sorted(bs))}>>" for a, bs in lists.items()]
    out = lines.select("*", F.from_json(F.col(column).cast("string"), ", ".join(ddl)).alias("__record"))
    names = plain + list(lists)
    return out.select(*(lines[c] for c in lines.columns if c not in names and c != column), *(out["__record"][n].alias(n) for n in names))


def fingerprint(records: DataFrame, layouts=LAYOUTS) -> Column:
    """The hash of the known paths that a record fills."""
    known = set().union(*(x.paths() for x in layouts))
    there = sorted(known & set(schema_paths(records.schema)))
    if not there:
        return F.lit(_hash(()))
    return F.xxhash64(F.array_join(F.array_compact(F.array(*(F.when(_filled(p), F.lit(p)) for p in there))), "\n"))


def _turns(layout: Layout, there: set[str]) -> Column:
    """The record's canonical turns by one layout, as an array of (role, text)."""

    def role(c: Column) -> Column:
        c = F.coalesce(c.cast("string"), F.lit(""))
        names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
        return F.coalesce(F.try_element_at(names, c), c)

    def pair(r: Column, t: Column) -> Column:
        return F.struct(r.alias("role"), F.coalesce(t.cast("string"), F.lit("")).alias("text"))

    first_role, first_text = layout.turns[0]
    if "[]." in first_text:
        lists, text = first_text.split("[].", 1)
        inner_role = first_role.split("[].", 1)[1]
        inside = {p for p in there if p.startswith(lists + "[].")}
        empty = F.lit(None).cast("string")
        return F.transform(_column(lists), lambda m: pair(role(m[inner_role] if f"{lists}[].{inner_role}" in inside else empty),
                                                          m[text] if f"{lists}[].{text}" in inside else empty))
    out = []
    joined = [F.nullif(_column(p).cast("string"), F.lit("")) for p in layout.joined if p in there]
    main = next((t for r, t in layout.turns if r == "=user"), None)
    for r, t in layout.turns:
        whole = _column(t).cast("string") if t in there else F.lit(None).cast("string")
        if r.startswith("="):
            shown = F.concat_ws("\n\n", whole, *joined) if t == main and joined else whole
            out.append(F.when(whole.isNotNull(), pair(F.lit(r[1:]), shown)))
        else:
            # a role given by the table stays as it is
            own = _column(r).cast("string") if r in there else F.lit(None).cast("string")
            out.append(pair(F.coalesce(own, F.lit("")), whole))
    return F.array_compact(F.array(*out))


def selected(records: DataFrame, layouts=LAYOUTS) -> Column:
    """The number of the layout that the record's fingerprint selects.  A fingerprint that is not
    declared goes to the layout of which it fills all paths that may not be absent, the most paths
    first; null if there is none."""
    by: dict[Layout, list[int]] = {}
    for h, layout in fingerprints(layouts).items():
        by.setdefault(layout, []).append(h)
    print_, there = fingerprint(records, layouts), set(schema_paths(records.schema))
    exact, near = [], []
    for i, layout in enumerate(layouts):
        must = layout.paths() - layout.optional
        if must - there or not layout.paths() & there:
            continue
        exact.append(F.when(print_.isin(by.get(layout, [])), F.lit(i)))
        filled = sum(_filled(p).cast("int") for p in sorted(layout.paths() & there))
        whole = F.lit(True)
        for p in sorted(must):
            whole = whole & _filled(p)
        near.append(F.when(whole & (filled > 0), F.struct(filled.alias("filled"), F.lit(-i).alias("i"))))
    if not exact:
        return F.lit(None).cast("int")
    return F.coalesce(*exact, -F.array_max(F.array(*near))["i"])


def _own(records: DataFrame, name: str) -> str:
    while name in records.columns:
        name += "_"
    return name


def canonical(records: DataFrame, key: str, layouts=LAYOUTS) -> DataFrame:
    """(conv_id, turn, at, role, text, layout): each record's turns by the mapping that its
    fingerprint selects.  ``at`` is the place within the record, ``turn`` the record's number in its
    conversation where it is one turn."""
    there, mine = set(schema_paths(records.schema)), _own(records, "layout")
    turns: Column = F.lit(None).cast("array<struct<role: string, text: string>>")
    order: Column = F.lit(None).cast("long")
    name: Column = F.lit(None).cast("string")
    for i, layout in enumerate(layouts):
        if (layout.paths() - layout.optional) - there or not layout.paths() & there:
            continue
        this = F.col(mine) == i
        turns = F.when(this, _turns(layout, there)).otherwise(turns)
        name = F.when(this, F.lit(layout.name)).otherwise(name)
        if layout.order and layout.order in there:
            order = F.when(this, _column(layout.order).cast("long")).otherwise(order)
    seen = records.withColumn(mine, selected(records, layouts))
    return (seen.select(F.col(key).cast("long").alias("conv_id"), order.alias("turn"), name.alias("layout"), F.posexplode(turns).alias("at", "t"))
            .select("conv_id", "turn", F.col("at").cast("long").alias("at"), "t.role", "t.text", "layout"))


def unmapped(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Fingerprints that no layout takes: the paths filled and how many records fill just these."""
    known = sorted(set().union(*(x.paths() for x in layouts)) & set(schema_paths(records.schema)))
    paths = F.array_compact(F.array(*(F.when(_filled(p), F.lit(p)) for p in known))) if known else F.array().cast("array<string>")
    return (records.where(selected(records, layouts).isNull())
            .select(fingerprint(records, layouts).alias("fingerprint"), paths.alias("paths"))
            .groupBy("fingerprint", "paths").agg(F.count("*").alias("records")))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_MARK), F.lit(r"$1$2\\"))


def unescape(text: str) -> str:
    return _MARKED.sub(r"\1\2", text) if "\\" in text else text


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_in(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, text, mask, whole): the formatted conversations in parts, in order
    of ``part``, with the loss mask as [start, end) pairs of code points of the part.  ``whole``:
    the part is known to be its whole conversation."""
    head = F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n"))
    pieces = turns.select("conv_id", "turn", "at", F.concat(head, escape(F.col("text")), F.lit(END + "\n")).alias("piece"),
                          F.when(F.col("role") == LOSS_ROLE, F.char_length(head)).otherwise(F.lit(-1)).alias("loss_at"))
    # ranges by a piece's first signs part even a (conversation, turn) with very many rows
    order = ["conv_id", "turn", "at", "first"]
    pieces = (pieces.withColumn("first", F.substring("piece", 1, 128)).repartitionByRange(*order)
              .sortWithinPartitions(*order, "piece").select("conv_id", "piece", "loss_at"))

    def parts(batches):
        base, count = TaskContext.get().partitionId() << 40, 0
        conv, held, size, mask, own, inner = None, [], 0, [], 0, False

        def out(ended: bool):
            """``inner``: the conversation began here; ``ended``: it ends here."""
            nonlocal count, held, size, mask, own
            count += 1
            own += 1
            row = {"conv_id": [conv], "part": [base + count], "n_turns": [len(held)], "text": ["".join(held)], "mask": [mask],
                   "whole": [ended and inner and own == 1]}
            held, size, mask = [], 0, []
            return pa.RecordBatch.from_pydict(row, schema=_PARTS)

        begun = False
        for batch in slices(batches):
            for c, piece, at in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "piece", "loss_at"))):
                if begun and c != conv:
                    yield out(True)
                    own, inner = 0, True
                elif held and size + len(piece) > PART_CHARS:
                    yield out(False)
                conv, begun = c, True
                if at >= 0:
                    mask.append({"start": size + at, "end": size + len(piece) - len(END) - 1})
                held.append(piece)
                size += len(piece)
        if held:
            yield out(False)

    return pieces.mapInArrow(parts, "conv_id long, part long, n_turns long, text string, mask array<struct<start: long, end: long>>, whole boolean")


_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("text", pa.string()),
                    ("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("whole", pa.bool_())])


def read_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted part."""
    out = []
    for piece in text.split(START)[1:]:
        role, rest = piece.split("\n", 1)
        out.append((_role_in(role), unescape(rest[:-len(END) - 1])))
    return out


def read_back(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from nothing but
    the formatted parts."""

    def digests(batches):
        conv, state = None, None

        def fresh():
            return {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}

        def row():
            return (conv, state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"])

        def batch_of(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_pydict({
                "conv_id": pa.array(cols[0], pa.int64()), "n_turns": pa.array(cols[1], pa.int64()), "turns_sha256": pa.array(cols[2], pa.string()),
                "loss_chars": pa.array(cols[3], pa.int64()), "loss_sha256": pa.array(cols[4], pa.string()),
                "formatted_chars": pa.array(cols[5], pa.int64())})

        rows = []
        for batch in slices(batches, 64):
            for c, text, mask in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "text", "mask"))):
                if state is None or c != conv:
                    if state is not None:
                        rows.append(row())
                    conv, state = c, fresh()
                for role, said in read_turns(text):
                    state["turns"].update(f"{role}\n{said}\n".encode())
                    state["n"] += 1
                for span in mask:
                    said = unescape(text[span["start"]:span["end"]])
                    state["loss"].update(said.encode())
                    state["loss_chars"] += len(said)
                state["chars"] += len(text)
            if len(rows) >= 1024:
                yield batch_of(rows)
                rows = []
        if state is not None:
            rows.append(row())
        if rows:
            yield batch_of(rows)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    # the first and last conversation of a range may go on in another one, long ones have several parts
    columns = ["conv_id", "part", "text", "mask"]
    single = parts.where("whole").select(*columns)
    several = parts.where("not whole").select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return single.mapInArrow(digests, schema).unionByName(several.mapInArrow(digests, schema))


def round_trip(turns: DataFrame) -> DataFrame:
    """Format, write, read the written parts back."""
    return read_back(stage(formatted(turns), "chat"))
