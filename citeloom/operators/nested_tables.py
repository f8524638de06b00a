"""Nested JSON documents as related flat tables, routed by the shapes of their objects.

A bottom-up tree automaton reads each document: leaves are in the state of their kind, a list is in the state of
the set of its elements' states, an object in the state of its members' names and states. The states of objects
are their shapes. Rules assign the shape of a reference to a variant, and its row goes to the typed table of that
variant, whose columns are the known fields that its shapes can have as strings. All variants share the supertype's
keys: the position of the record and of its parents.

    files       record_no, file_name, variant, n_items
    items       record_no, item_pos, doi, variant, shape, n_references
    references  record_no, item_pos, ref_pos, variant, shape, and the six known fields where they are strings
    fields      record_no, item_pos, ref_pos, variant, field_name, kind, value
    asserted, linked, unstructured, titled, serial, web, other
                record_no, item_pos, ref_pos, shape, typed, and the columns of the variant (typed_columns)

What is emitted for a reference follows from its shape alone: its route, with the variant, the known fields that are
strings and the names and kinds of all fields, is made once for each shape and looked up by state after that.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.session import spread

#: Fields of a reference with columns of their own.
KNOWN = ("DOI", "URL", "unstructured", "article-title", "journal-title", "doi-asserted-by")
#: Objects of more shapes than this make an automaton forget its memo and go on; the states stay the same.
MEMO = 100_000
#: Rows of one Arrow batch handed back to Spark.
OUT_ROWS = 20_000

#: Variants of a reference object in order; the first whose fields are strings is taken.
REFERENCE_VARIANTS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("asserted", ("DOI", "doi-asserted-by")),
    ("linked", ("DOI",)),
    ("unstructured", ("unstructured",)),
    ("titled", ("article-title",)),
    ("serial", ("journal-title",)),
    ("web", ("URL",)),
    ("other", ()),
)


def typed_columns(variant: str) -> tuple[str, ...]:
    """Known fields that references of a variant can have as strings: all but those that would make them an earlier variant."""
    names = [n for n, _ in REFERENCE_VARIANTS]
    own = set(dict(REFERENCE_VARIANTS)[variant])
    barred = {f for _, earlier in REFERENCE_VARIANTS[: names.index(variant)] for f in earlier if set(earlier) - own == {f}}
    return tuple(f for f in KNOWN if f not in barred)


def _column(field: str) -> str:
    return field.lower().replace("-", "_")


_KEYS = "record_no bigint, item_pos int, ref_pos int"
_TABLES = {
    "files": "record_no bigint, file_name string, variant string, n_items int",
    "items": "record_no bigint, item_pos int, doi string, variant string, shape bigint, n_references int",
    "references": f"{_KEYS}, variant string, shape bigint, " + ", ".join(f"{_column(f)} string" for f in KNOWN),
    "fields": f"{_KEYS}, variant string, field_name string, kind string, value string",
    **{name: f"{_KEYS}, shape bigint, typed int" + "".join(f", {_column(f)} string" for f in typed_columns(name)) for name, _ in REFERENCE_VARIANTS},
}
#: The tables that a document is cut into by default; the typed tables hold the same references again.
TABLES = ("files", "items", "references", "fields")
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _columns(names: Sequence[str], wanted: Sequence[str] | None = None) -> dict[str, str]:
    """Columns of the tables with their types; of the columns that are no keys, the wanted ones."""
    every = {f.split()[0]: f.split()[1] for t in names for f in _TABLES[t].split(", ")}
    return {c: t for c, t in every.items() if wanted is None or c in wanted or c in ("record_no", "item_pos", "ref_pos")}


class Number(str):
    """A JSON number as it is written in its document."""


_KINDS = {type(None): "null", bool: "boolean", str: "string", list: "list", dict: "object", Number: "number", int: "number", float: "number"}


def kind_of(value: object) -> str:
    """The leaf state of a JSON value."""
    return _KINDS[type(value)]


class ShapeAutomaton:
    """States of JSON values, the same in every task: a state is a 64-bit digest of its transition's arguments."""

    def __init__(self) -> None:
        self._memo: dict[tuple, int] = {}
        self._routes: dict[tuple, tuple[int, Route]] = {}
        self._leaves = {t: self._delta(k, ()) for t, k in _KINDS.items() if t not in (list, dict)}

    def _delta(self, kind: str, children: tuple) -> int:
        rule = (kind, children)
        state = self._memo.get(rule)
        if state is None:
            if len(self._memo) >= MEMO:
                self._memo.clear()
            state = self._memo[rule] = int.from_bytes(hashlib.blake2b(repr(rule).encode("utf-8", "backslashreplace"), digest_size=8).digest(), "big", signed=True)
        return state

    def state(self, value: object) -> int:
        """The state in which the automaton leaves value. Open values are on a stack of its own: no depth is too great."""
        if type(value) in self._leaves:
            return self._leaves[type(value)]
        open_ = [_Open(value)]
        while True:
            top = open_[-1]
            for name, child in top.rest:
                leaf = self._leaves.get(type(child))
                if leaf is None:
                    top.name = name
                    open_.append(_Open(child))
                    break
                top.put(name, leaf)
            else:
                done = self._delta("object" if top.named else "list", tuple(sorted(top.states)))
                open_.pop()
                if not open_:
                    return done
                open_[-1].put(open_[-1].name, done)

    def classify(self, value: object) -> tuple[int, Route]:
        """The state of value and the route of its shape."""
        if type(value) is not dict:
            state = self.state(value)
            key: tuple = (state,)
        else:
            # names and leaves' types in the order of the document stand for the state until the memo is asked
            leaves = self._leaves
            key = tuple([(k, leaves.get(type(v)) or self.state(v)) for k, v in value.items()])
            state = None
        known = self._routes.get(key)
        if known is None:
            if len(self._routes) >= MEMO:
                self._routes.clear()
            known = self._routes[key] = (self.state(value) if state is None else state, route(value))
        return known


class _Open:
    """A list or object whose elements are being read."""

    __slots__ = ("name", "named", "rest", "states")

    def __init__(self, value: list | dict) -> None:
        self.named = type(value) is dict
        self.rest = iter(value.items()) if self.named else iter([(None, v) for v in value])
        self.states: set = set()
        self.name: str | None = None

    def put(self, name: str | None, state: int) -> None:
        self.states.add((name, state) if self.named else state)


@dataclass(frozen=True)
class Route:
    """Where values of one shape go: variant, whether each known field is a string, the same as bits, names and kinds of all fields."""

    variant: str
    known: tuple[bool, ...]
    typed: int
    fields: tuple[tuple[str, str], ...]


def route(value: object) -> Route:
    """The route of any value of the same shape as value."""
    if type(value) is not dict:
        return Route(kind_of(value), (False,) * len(KNOWN), 0, ())
    strings = {name for name, v in value.items() if type(v) is str}
    variant = next(name for name, fields in REFERENCE_VARIANTS if strings.issuperset(fields))
    return Route(variant, tuple(f in strings for f in KNOWN), sum(1 << i for i, f in enumerate(KNOWN) if f in strings), tuple((name, kind_of(value[name])) for name in sorted(value)))


def _refuse(text: str) -> object:
    raise ValueError(text)


_DECODER = json.JSONDecoder(parse_constant=_refuse, parse_int=Number, parse_float=Number)


def _whole(text: str | None) -> tuple[bool, object]:
    """Whether text is one JSON value and nothing else, and the value."""
    if text is None:
        return False, None
    try:
        return True, _DECODER.decode(text)
    except (ValueError, RecursionError):
        return False, None


def _clean(text: str | None) -> str | None:
    """Lone surrogates, which no column can hold, become the replacement character."""
    if text is None or text.isascii():
        return text
    try:
        text.encode()
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


_QUOTED = json.encoder.encode_basestring
_WORDS = {None: "null", True: "true", False: "false"}


def _written(value: object) -> str:
    """A JSON value as text, its numbers as they were written."""
    out: list[str] = []
    open_: list[list] = []

    def begin(v: object) -> bool:
        if type(v) is dict or type(v) is list:
            named = type(v) is dict
            out.append("{" if named else "[")
            open_.append([named, iter(v.items()) if named else iter(v), True])
            return True
        out.append(str(v) if type(v) is Number else _QUOTED(v) if type(v) is str else _WORDS[v])
        return False

    begin(value)
    while open_:
        frame = open_[-1]
        for item in frame[1]:
            if not frame[2]:
                out.append(", ")
            frame[2] = False
            if frame[0]:
                out.append(_QUOTED(item[0]) + ": ")
                item = item[1]
            if begin(item):
                break
        else:
            out.append("}" if frame[0] else "]")
            open_.pop()
    return "".join(out)


def _spelt(value: object) -> str | None:
    if value is None:
        return None
    return _clean(value) if type(value) is str else str(value) if type(value) is Number else _clean(_written(value))


def _text(value: object) -> str | None:
    return _clean(value) if type(value) is str else None


class _Flattener:
    """Rows of the wanted tables, one list of rows for each."""

    def __init__(self, tables: Sequence[str], wanted: Sequence[str] | None) -> None:
        self.automaton, self.held = ShapeAutomaton(), {t: [] for t in tables}
        self.columns = _columns(tables, wanted)
        self.own = {t: list(_columns([t], wanted)) for t in tables}
        self.schema = pa.schema([("table_name", pa.string()), *((c, _TYPES[t]) for c, t in self.columns.items())])
        self.subtypes = {t: self._subtype(t) for t, _ in REFERENCE_VARIANTS if t in self.held}

    def _subtype(self, name: str) -> tuple[bool, bool, list[tuple[int, str]]]:
        """Whether shape and typed are wanted, and the place in KNOWN and name of the wanted fields."""
        own = self.own[name]
        return "shape" in own, "typed" in own, [(i, f) for i, f in enumerate(KNOWN) if _column(f) in own]

    def read(self, record_no: int | None, file_name: str | None, raw: str | None) -> int:
        """Add the rows of one document; how many rows are held then."""
        held, automaton = self.held, self.automaton
        valid, doc = _whole(raw)
        items = doc.get("items") if type(doc) is dict else None
        listed = items if type(items) is list else []
        if "files" in held:
            variant = "broken" if not valid else kind_of(doc) if type(doc) is not dict else "items_" + (kind_of(items) if "items" in doc else "absent")
            self._put("files", record_no, file_name, variant, len(listed))
        references, fields = held.get("references"), held.get("fields")
        below = references is not None or fields is not None or bool(self.subtypes)
        for i, item in enumerate(listed):
            refs = item.get("reference") if type(item) is dict else None
            if "items" in held:
                doi = _text(item.get("DOI")) if type(item) is dict else None
                variant = kind_of(item) if type(item) is not dict else "references_" + (kind_of(refs) if "reference" in item else "absent")
                self._put("items", record_no, i, doi, variant, automaton.state(item), len(refs) if type(refs) is list else 0)
            if type(refs) is not list or not below:
                continue
            for j, ref in enumerate(refs):
                shape, way = automaton.classify(ref)
                if references is not None:
                    references.append((record_no, i, j, way.variant, shape, *(_clean(ref[f]) if there else None for f, there in zip(KNOWN, way.known, strict=True))))
                if fields is not None:
                    for name, kind in way.fields:
                        fields.append((record_no, i, j, way.variant, _clean(name), kind, _spelt(ref[name])))
                own = self.subtypes.get(way.variant) if type(ref) is dict else None
                if own is not None:
                    row = [record_no, i, j]
                    if own[0]:
                        row.append(shape)
                    if own[1]:
                        row.append(way.typed)
                    row += [_clean(ref[f]) if way.known[k] else None for k, f in own[2]]
                    held[way.variant].append(row)
        return sum(map(len, held.values()))

    def _put(self, table: str, *row: object) -> None:
        self.held[table].append(row)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """What is held, a batch for each table; columns it lacks are NULL."""
        for table, rows in self.held.items():
            if rows:
                every = [c.split()[0] for c in _TABLES[table].split(", ")]
                found = dict(zip(every if table in TABLES else self.own[table], zip(*rows, strict=True), strict=True))
                arrays = [pa.array(found[c], _TYPES[t]) if c in self.own[table] else pa.nulls(len(rows), _TYPES[t]) for c, t in self.columns.items()]
                yield pa.RecordBatch.from_arrays([pa.array([table]).take(pa.array([0] * len(rows), pa.int32())), *arrays], schema=self.schema)
                rows.clear()


def _flattener(tables: Sequence[str], columns: Sequence[str] | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def flatten(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Flattener(tables, columns)
        for batch in batches:
            for record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out.read(*record) >= OUT_ROWS:
                    yield from out.batches()
        yield from out.batches()

    return flatten


def nested_rows(docs: DataFrame, record_no: str, file_name: str, raw_json: str, tables: Sequence[str] = TABLES, columns: Sequence[str] | None = None) -> DataFrame:
    """All rows of the wanted tables in one pass, with table_name; columns that a table lacks are NULL. With columns, only these and the keys are made.

    A document that is NULL, empty, not JSON as a whole (text behind the value included) or nested too deeply for the
    reader is "broken" in files and gives no other row. A wrongly typed item, list or field spoils only itself;
    positions count all elements. Of repeated names in one object the last holds. Numbers are kept as they are written.
    Documents delivered twice come out twice, under their own record_no. An empty docs gives no rows; other columns of
    docs are not read. References that are no objects are in no typed table.
    """
    read = docs.select(F.col(record_no).cast("bigint"), F.col(file_name).cast("string"), F.col(raw_json).cast("string"))
    schema = ", ".join(["table_name string", *(f"`{c}` {t}" for c, t in _columns(tables, columns).items())])
    return spread(read).mapInArrow(_flattener(tables, columns), schema)


def nested_table(rows: DataFrame, name: str) -> DataFrame:
    """One flat table out of nested_rows."""
    return rows.where(F.col("table_name") == name).select(*_columns([name]))


def variants_with(*fields: str) -> list[str]:
    """The variants that can have any of the known fields as a string."""
    return [name for name, _ in REFERENCE_VARIANTS if set(fields) & set(typed_columns(name))]


def is_typed(field: str) -> Column:
    """Whether a row of a typed table has the field as a string, by its column typed."""
    return F.col("typed").bitwiseAND(1 << KNOWN.index(field)) != 0
