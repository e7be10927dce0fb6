"""Deeply nested records to related flat tables.

Each record's text is read once from front to back, and every value becomes a path-value-ordinal triple as it goes by. Paths are grouped by their nearest
repeated ancestor, and each group is pivoted into one table whose rows name their parent by (record_id, parent_pos).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIPLES = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("node", T.StringType()),  # path of the repeated ancestor, "" for the record itself
    T.StructField("pos", T.StringType()),  # positions from outside in, joined by "."
    T.StructField("parent_pos", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),  # order of the triple within its record
    T.StructField("path", T.StringType()),  # path below the ancestor, "" for the item itself
    T.StructField("kind", T.StringType()),  # record, item, string, number, boolean, null or unread
    T.StructField("value", T.StringType()),
])
BATCH_ROWS = 20_000
UNREAD = "unread"  # kind of the single triple of a record whose text gives none; its path is the reason
_STRING = r'"[^"\\\x00-\x1f]*(?:\\.[^"\\\x00-\x1f]*)*"'
_BLANK = " \t\n\r"
# a member or element (its name, then a string, number, word or opening bracket) or a closing bracket, each with the comma
# behind it; a last group takes whatever is no JSON
_PART = re.compile(
    rf"(?:({_STRING})[{_BLANK}]*:[{_BLANK}]*)?(?:({_STRING})|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\w.+-]))|(true|false|null)\b|([{{\[]))[{_BLANK}]*(,?)"
    rf"|([}}\]])[{_BLANK}]*(,?)|([^{_BLANK}])", re.ASCII
)
_WHOLE_STRING = re.compile(rf"[{_BLANK}]*({_STRING})[{_BLANK}]*")
EITHER, ELEMENT, CLOSE = 0, 1, 2  # what may follow: after an opening bracket, after a comma, after an element without one


def _text(raw: str) -> str:
    """What a quoted JSON string says; half a surrogate pair, which no column can hold, becomes a question mark."""
    if "\\" not in raw:
        return raw[1:-1]
    said = json.loads(raw)
    try:
        said.encode()
    except UnicodeEncodeError:
        said = said.encode("utf-16", "surrogatepass").decode("utf-16", "replace").replace("\ufffd", "?")
    return said


class _Step:
    """One step of the repeated paths: the steps below it, and for a repeated path its name and marks."""

    def __init__(self):
        self.below: dict[str, _Step] = {}
        self.path: str | None = None
        self.marks: frozenset[str] = frozenset()


def _steps(repeated: Mapping[str, Iterable[str]]) -> _Step:
    root = _Step()
    for path, marks in repeated.items():
        step = root
        for name in path.replace("[]", ".[]").split("."):
            step = step.below.setdefault(name, _Step())
        step.path, step.marks = path, frozenset(marks)
    return root


def _by_member(text: str, at: int, marks: frozenset[str]) -> bool:
    """Whether the object that opens before `at` holds an item per member, which shows by its names and kinds of values."""
    depth = 0
    for part in _PART.finditer(text, at):
        name, said, number, word, opened, _, closed, _, _ = part.groups()
        if closed:
            if not depth:
                return True
            depth -= 1
        else:
            if not depth and (said is not None or number or word in ("true", "false") or opened == "[" or name and _text(name) in marks):
                return False
            depth += opened is not None
    return True


ITEMS, STEP, INDEX, CONTEXT, PARTS, DEPTH, NAMES, MEMBER, BEGUN = range(9)


def record_triples(text: str, root: _Step) -> list[tuple]:
    """(node, pos, parent_pos, path, kind, value) of one record's JSON object, or ValueError where the text is none.

    The text is read once from the front with a stack of open brackets, so neither depth nor length is bounded by anything
    but memory, and no tree is built. Of members with the same name the last one counts.
    """
    out: list[tuple | None] = [("", "", "", "", "record", None)]
    add = out.append
    stack: list[list] = []  # of each open bracket: ITEMS ... BEGUN
    frame: list | None = None
    may, done = EITHER, False
    for part in _PART.finditer(text):
        raw, said, number, word, opened, comma, closed, behind, odd = part.groups()
        if odd or done:
            raise ValueError("no JSON")
        if closed:
            if may == ELEMENT or frame is None or (frame[NAMES] is not None) != (closed == "}"):
                raise ValueError("no JSON")
            stack.pop()
            frame = stack[-1] if stack else None
            may = ELEMENT if behind else CLOSE
            if frame is None:
                done = True
                if behind:
                    raise ValueError("no JSON")
                continue
        elif frame is None:
            if opened != "{" or raw or comma:
                raise ValueError("no object")
            frame = [False, root, -1, ("", "", ""), [], 0, {}, None, 0]
            stack.append(frame)
            continue
        else:
            index = frame[INDEX]
            if may == CLOSE or (raw is None) != (index >= 0) or opened and comma:
                raise ValueError("no JSON")
            may = EITHER if opened else ELEMENT if comma else CLOSE
            if index < 0:
                label = raw[1:-1] if "\\" not in raw else _text(raw)
                below = "." + label
            else:
                label = str(index)
                below = f"[{label}]"
                frame[INDEX] = index + 1
            frame[MEMBER], frame[BEGUN] = label, len(out)
            context, parts, step = frame[CONTEXT], frame[PARTS], frame[STEP]
            items_ = frame[ITEMS]
            if not items_:
                del parts[frame[DEPTH] :]
                parts.append(below)
                if step is not None:
                    step = step.below.get(label if index < 0 else "[]")
                    if step is not None and step.path is not None:
                        if opened == "[" or opened and _by_member(text, part.end(5), step.marks):
                            frame = [True, step, 0 if opened == "[" else -1, context, parts, 0, None if opened == "[" else {}, None, 0]
                            stack.append(frame)
                            continue
                        label, items_ = "0", True
            if items_:
                if word != "null":
                    node, pos, _ = context
                    context, parts = (step.path, f"{pos}.{label}" if node else label, pos), []
                    add((*context, "", "item", None))
            if opened:
                frame = [False, step, 0 if opened == "[" else -1, context, parts, len(parts), None if opened == "[" else {}, None, 0]
                stack.append(frame)
                continue
            if not items_ or word != "null":
                path = "".join(parts)
                if path and path[0] == ".":
                    path = path[1:]
                if said is not None:
                    add((*context, path, "string", said[1:-1] if "\\" not in said else _text(said)))
                elif number:
                    add((*context, path, "number", number))
                elif word == "null":
                    add((*context, path, "null", None))
                else:
                    add((*context, path, "boolean", word))
        # a member is complete: a scalar, or what the bracket closed
        names = frame[NAMES]
        if names is not None:
            member = frame[MEMBER]
            if member in names:
                low, high = names[member]
                out[low:high] = [None] * (high - low)
            names[member] = (frame[BEGUN], len(out))
    if not done:
        raise ValueError("no JSON" if frame is not None else "no object")
    return [x for x in out if x is not None]


def _read(text: str, root: _Step) -> list[tuple]:
    """record_triples of a text, or of the text that it holds as a JSON string; else one triple that says why there are none."""
    try:
        while held := _WHOLE_STRING.fullmatch(text):
            text = _text(held.group(1))
        return record_triples(text, root)
    except ValueError as error:
        reason = "blank" if not text.strip() else "no object" if str(error) == "no object" else "no JSON"
        return [("", "", "", reason, UNREAD, None)]


def path_triples(records: DataFrame, record_id: str, json_text: str, repeated: Mapping[str, set[str]]) -> DataFrame:
    """Path-value-ordinal triples of each record.

    repeated maps the full path of each repeated ancestor to the names that mark one of its items. At such a path a list
    gives items at 0, 1, ...; an object that has one of these names, or any member that is not an object, is a single item
    at 0; any other object gives an item per member, whose position is the member's name. Null items give no row but count
    as positions. Arrays at other paths stay columns "name[0]", "name[1]", ... of their table. The record itself has a
    triple at the node "", also where it has no members.

    A record held as a JSON string that holds JSON is read like the record itself. Null or blank text, text that is no
    JSON (NaN and the like are none) and JSON that is no object have a single triple of the kind "unread", whose path is
    the reason: see unread(). Rows with a null record id are left out. Records are not deduplicated here. Columns other
    than the two named are not read.
    """
    root = _steps(repeated)
    schema = pa.schema([(f.name, pa.int32() if f.dataType == T.IntegerType() else pa.string()) for f in TRIPLES])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = [("", "", "", "null", UNREAD, None)] if text is None else _read(text, root)
                rows += [(key, node, pos, parent, i, path, kind, x) for i, (node, pos, parent, path, kind, x) in enumerate(out)]
                if len(rows) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    chosen = records.select(F.col(record_id).cast("string").alias("record_id"), F.col(json_text).alias("json"))
    return chosen.where("record_id IS NOT NULL").mapInArrow(parse, TRIPLES)


def unread(triples: DataFrame) -> DataFrame:
    """(record_id, reason) of every record that gave no triples: null, blank, no JSON or no object."""
    return triples.where(F.col("kind") == UNREAD).select("record_id", F.col("path").alias("reason"))


def _leaf() -> Column:
    return ~F.col("kind").isin("item", "record", UNREAD)


def items(triples: DataFrame) -> DataFrame:
    """One row per nested item: record_id, node, pos, parent_pos."""
    return triples.where("kind = 'item'").select("record_id", "node", "pos", "parent_pos")


def leaf_paths(triples: DataFrame) -> DataFrame:
    """Which columns each table has, and how many rows fill them: the schema as it is found, pre-aggregated on each task."""
    return triples.where(_leaf()).groupBy("node", "path").agg(F.count("*").alias("n_values"), F.count("value").alias("n_present"))


def flat_tables(triples: DataFrame, columns: Iterable[str] = ()) -> DataFrame:
    """The rows of all flat tables: triples grouped by their nearest repeated ancestor, each group pivoted into one row.

    Gives node, record_id, pos, parent_pos, the named leaf columns, the other leaves in the map column "rest", and n_given,
    how often the row was given: more than once only where a record id is. Every item has a row, also one without members;
    the node "" has one for each record. Triples are grouped on each task before the shuffle, and columns that nobody reads
    are not made.
    """
    columns = list(columns)
    wanted = [F.max(F.when((F.col("path") == c) & _leaf(), F.col("value"))).alias(_column(c)) for c in columns]
    other = F.when(_leaf() & ~F.col("path").isin(columns), F.struct("path", "value"))
    rest = F.map_from_entries(F.collect_list(other)).alias("rest")
    given = F.count_if(F.col("kind").isin("item", "record")).alias("n_given")
    return triples.where(F.col("kind") != UNREAD).groupBy("node", "record_id", "pos", "parent_pos").agg(*wanted, rest, given)


def pivot_table(triples: DataFrame, node: str, columns: list[str]) -> DataFrame:
    """The flat table of one repeated ancestor: record_id, pos, parent_pos, the named leaf columns, and the others in a map.

    A leaf that is absent or null is null in its column. Every item has a row, also one without members; the node "" has
    one for each record. Leaves that are not among columns stay in the map column "rest", so nothing is lost when objects
    have open member names. A column name is its path with "." and brackets turned into "_", and "value" for an item that
    is itself a leaf.
    """
    return flat_tables(triples, columns).where(F.col("node") == node).drop("node", "n_given")


def _column(path: str) -> str:
    return "".join(c if c.isalnum() else "_" for c in path) or "value"


def latest_delivery(records: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    """Of rows with the same key the one with the greatest order; copies collapse on the map side, before the shuffle.

    Rows with a null key are left out; a null order counts as the earliest.
    """
    kept = records.where(F.col(key).isNotNull())
    packed = F.max_by(F.struct(*values), F.coalesce(F.col(order).cast("timestamp"), F.lit("0001-01-01").cast("timestamp")))
    return kept.groupBy(key).agg(packed.alias("_row")).select(key, "_row.*")
