"""Schemas that drift between files: one table of all, and a log of the changes."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.operators.rangesort import running_sums
from parcelight.runtime import Workspace, ship

_SERIES = ["building_id", "module"]
#: Text that is a number, with a decimal point or comma.
_NUMBER = re.compile(r"\s*[+-]?(\d+([.,]\d*)?|[.,]\d+)([eE][+-]?\d+)?\s*\Z")
#: The key that numbers the detections of a series.
KEY = "detection_id"
#: Columns of an export record that fields of a payload never replace.
_OWN = ["export_id", "building_id", "module", "run_no", "exported_at", "rec_no"]

#: JSON types as bits. The lattice of types is that of their sets: the least type that holds two sets is their union, so a fold is a bitwise or.
TYPES = {"number": 1, "string": 2, "boolean": 4, "array": 8, "object": 16}
#: What a column of a unified table holds, by the set of types of the values taken out of arrays and objects.
_COLUMN = {1: "double", 4: "boolean"}


def promote(types: Column) -> Column:
    """Folds sets of types (an aggregate): the least set that holds them all. Grouping is free, so records fold to headers, and headers to the union schema."""
    return F.bit_or(types)


def named(types: Column) -> Column:
    """The name of a set of types: of one type its own, of several string, which can hold them all; null of none."""
    one = F.create_map(*[F.lit(x) for name, bit in TYPES.items() for x in (bit, name)])
    return F.when(types.isNotNull(), F.coalesce(F.try_element_at(one, types), F.lit("string")))


def _type(value) -> int:
    if isinstance(value, bool):
        return TYPES["boolean"]
    if isinstance(value, (int, float)):
        return TYPES["number"]
    return TYPES["string"] if isinstance(value, str) else TYPES["array"] if isinstance(value, list) else TYPES["object"]


def _plain(value):
    """A value out of its one-element array or its object's member `value`; text that is a number as that number, null as None."""
    if isinstance(value, list) and len(value) == 1:
        value = value[0]
    elif isinstance(value, dict) and value.get("value") is not None:
        value = value["value"]
    if isinstance(value, str):
        return float(value.strip().replace(",", ".")) if _NUMBER.match(value) else value
    return value


def _text(plain) -> str:
    return plain if isinstance(plain, str) else json.dumps(plain, sort_keys=True, ensure_ascii=False)


def _comparable(plain) -> str | None:
    """Numbers by value, other values as text; the first letter keeps both apart."""
    if plain is None:
        return None
    return f"n{float(plain) + 0.0!r}" if _type(plain) == TYPES["number"] else f"s{_text(plain)}"


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def _record(payload: str | None) -> dict | None:
    """A payload that is one whole JSON object; else None."""
    try:
        found = json.loads(payload, parse_constant=_no_constant) if payload else None
        return found if isinstance(found, dict) else None
    except (ValueError, RecursionError):
        return None


def _in_arrow(df: DataFrame, kernel: Callable[[pa.RecordBatch], list[list]], schema: str) -> DataFrame:
    """Runs a kernel from a batch to columns."""
    ship(df.sparkSession)
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [kinds[f.split()[1]] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(kernel(b), fields)], names)

    return df.mapInArrow(run, schema)


def headers(exports: DataFrame) -> DataFrame:
    """The header of each export: (export_id, field, types, kinds, n).

    All records are read in parallel and folded to headers where they are read.
    `types` is the set of the field's JSON types, `kinds` that of its values
    taken out of arrays and objects, n the number of its values. A payload that
    isn't one whole JSON object is skipped, a member that is null is absent.
    """

    def kernel(b: pa.RecordBatch) -> list[list]:
        seen: dict[tuple[int, str], list[int]] = {}
        for export, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for field, value in (_record(payload) or {}).items():
                if value is not None:
                    plain = _plain(value)
                    found = seen.setdefault((export, field), [0, 0, 0])
                    found[0] |= _type(value)
                    found[1] |= 0 if plain is None else _type(plain)
                    found[2] += 1
        return [[e for e, _ in seen], [f for _, f in seen], *([v[i] for v in seen.values()] for i in range(3))]

    read = _in_arrow(exports.select(F.col("export_id").cast("long"), "payload"), kernel, "export_id long, field string, types int, kinds int, n long")
    return read.groupBy("export_id", "field").agg(promote("types").alias("types"), promote("kinds").alias("kinds"), F.sum("n").alias("n"))


def successions(ws: Workspace, exports: DataFrame) -> DataFrame:
    """(export_id, next_export, first): each export with the one after it in its series, by run_no (ties: export_id); both null where there is none."""
    one = exports.groupBy(*_SERIES, "run_no", "export_id").agg(F.lit(1).cast("long").alias("one"))
    placed = running_sums(ws, one, _SERIES, ["run_no", "export_id"], "one", "placed")
    own = placed.select(*_SERIES, F.col("running").alias("place"), "export_id")
    following = placed.select(*_SERIES, (F.col("running") - 1).alias("place"), F.col("export_id").alias("next_export"))
    return own.join(following, [*_SERIES, "place"], "left").select("export_id", "next_export", (F.col("place") == 1).alias("first"))


def _compared(ws: Workspace, header: DataFrame, exports: DataFrame) -> DataFrame:
    """(export_id, old_export, field, old_types, new_types): every field of each export and of the one before it in its series."""
    order = successions(ws, exports)
    rows = header.join(order, "export_id")
    null = F.lit(None)
    as_new = F.when(~F.col("first"), F.struct(F.col("export_id").alias("pair"), null.cast("long").alias("old"), null.cast("int").alias("old_types"), F.col("types").alias("new_types")))
    as_old = F.when(F.col("next_export").isNotNull(), F.struct(F.col("next_export").alias("pair"), F.col("export_id").alias("old"), F.col("types").alias("old_types"), null.cast("int").alias("new_types")))
    sides = rows.select("field", F.explode(F.array_compact(F.array(as_new, as_old))).alias("s"))
    return sides.groupBy(F.col("s.pair").alias("export_id"), "field").agg(F.max("s.old").alias("old_export"), F.max("s.old_types").alias("old_types"), F.max("s.new_types").alias("new_types"))


def _values(exports: DataFrame, wanted: DataFrame) -> DataFrame:
    """(pair, side, key, field, plain) of the fields of `wanted` (export_id, asked: array of pair, side, field), from the records of these exports only."""

    def kernel(b: pa.RecordBatch) -> list[list]:
        out: list[list] = [[] for _ in range(5)]
        for payload, asked in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            record = _record(payload) or {}
            key = _comparable(_plain(record.get(KEY)))
            if key is None:
                continue
            for a in asked:
                plain = _comparable(_plain(record.get(a["field"])))
                if plain is not None:
                    for column, v in zip(out, (a["pair"], a["side"], key, a["field"], plain)):
                        column.append(v)
        return out

    rows = exports.select(F.col("export_id").cast("long"), "payload").join(wanted, "export_id").select("payload", "asked")
    return _in_arrow(rows, kernel, "pair long, side int, key string, field string, plain string")


def field_changes(ws: Workspace, exports: DataFrame) -> DataFrame:
    """(export_id, change, old_field, new_field): what changes from an export to the next of its series.

    Headers are read in parallel and folded through the lattice; headers of
    neighbours are compared by one aggregate on (export, field). Only where a
    field is gone and another is new, their values are read: the two are
    `renamed` if they agree in all detections that have both, at least one; if
    several qualify, each field is used once, those with the most agreeing
    detections first (ties: by name). Rows delivered twice change nothing.
    Series of one export have no changes.
    """
    header = ws.write(headers(exports), "headers")
    both = ws.write(_compared(ws, header, exports), "compared")
    gone, new = F.col("new_types").isNull(), F.col("old_types").isNull()
    open_ = both.filter((gone | new) & (F.col("field") != KEY))
    pairs = open_.groupBy("export_id").agg(F.max("old_export").alias("old_export"), F.collect_list(F.struct(gone.cast("int").alias("gone"), "field")).alias("fields")).filter(F.exists("fields", lambda f: f["gone"] == 1) & F.exists("fields", lambda f: f["gone"] == 0))
    sides = F.transform("fields", lambda f: F.struct(F.when(f["gone"] == 1, F.col("old_export")).otherwise(F.col("export_id")).alias("export"), F.col("export_id").alias("pair"), f["gone"].alias("side"), f["field"].alias("field")))
    wanted = pairs.select(F.explode(sides).alias("a")).groupBy(F.col("a.export").alias("export_id")).agg(F.collect_list(F.struct("a.pair", "a.side", "a.field")).alias("asked"))
    values = ws.write(_values(exports, wanted), "values")
    old_values = values.filter("side = 1").select("pair", "key", F.col("field").alias("old_field"), F.col("plain").alias("old_plain"))
    new_values = values.filter("side = 0").select("pair", "key", F.col("field").alias("new_field"), F.col("plain").alias("new_plain"))
    agreed = old_values.join(new_values, ["pair", "key"]).groupBy("pair", "old_field", "new_field").agg(F.bool_and(F.col("old_plain") == F.col("new_plain")).alias("all"), F.count_distinct("key").alias("n")).filter("all")
    # Per export a handful of pairs: each takes the best pair that is left of both its fields.
    candidates = agreed.groupBy("pair").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "old_field", "new_field"))).alias("pairs"))
    chosen = F.expr("aggregate(pairs, filter(pairs, p -> false), (kept, p) -> if(exists(kept, k -> k.old_field = p.old_field or k.new_field = p.new_field), kept, concat(kept, array(p))))")
    renamed = candidates.select(F.col("pair").alias("export_id"), F.explode(chosen).alias("p")).select("export_id", "p.old_field", "p.new_field")
    renamed = ws.write(renamed, "renamed")
    side = lambda f: F.struct("export_id", F.col(f).alias("field"))
    used = renamed.select(F.explode(F.array(side("old_field"), side("new_field"))).alias("u")).select("u.*")
    types = both.select("export_id", "field", F.coalesce("old_types", "new_types").alias("t"))
    typed = renamed.join(types.withColumnsRenamed({"field": "old_field", "t": "old_t"}), ["export_id", "old_field"]).join(types.withColumnsRenamed({"field": "new_field", "t": "new_t"}), ["export_id", "new_field"])
    left = both.filter(gone | new).join(used, ["export_id", "field"], "left_anti")
    row = lambda df, change, old, new: df.select("export_id", F.lit(change).alias("change") if isinstance(change, str) else change.alias("change"), old.alias("old_field"), new.alias("new_field"))
    nothing, field = F.lit(""), F.col("field")
    return (
        row(renamed, "renamed", F.col("old_field"), F.col("new_field"))
        .unionAll(row(left, F.when(gone, "removed").otherwise("added"), F.when(gone, field).otherwise(nothing), F.when(gone, nothing).otherwise(field)))
        .unionAll(row(typed.filter(named(F.col("old_t")) != named(F.col("new_t"))), "retyped", F.col("old_field"), F.col("new_field")))
        .unionAll(row(both.filter(named(F.col("old_types")) != named(F.col("new_types"))), "retyped", field, field))
    )


def change_log(ws: Workspace, exports: DataFrame) -> DataFrame:
    """field_changes with building_id, module, run_no, in the order of series, run, export, change and fields."""
    changes = ws.write(field_changes(ws, exports), "changes")
    of = exports.groupBy("export_id").agg(F.min(F.struct(*_SERIES, "run_no")).alias("e")).select("export_id", "e.*")
    log = ws.write(changes.join(of, "export_id").select(*_SERIES, "run_no", *changes.columns), "log")
    return log.orderBy(*_SERIES, "run_no", "export_id", "change", "old_field", "new_field")


#: Most different field names that a unified table may have; more is refused, as each becomes a column.
MOST_FIELDS = 5_000


def _families(names: dict[str, int], links: dict[tuple[str, str], int], together: dict[tuple[str, str], int]) -> dict[str, str]:
    """Name -> common name: names that were renamed to each other are one family, called by its most frequent name.

    The most frequent renamings are followed first. One that would put names
    into one family which stand side by side in more exports than they were
    renamed in is a coincidence of values and isn't followed.
    """
    member = {n: [n] for n in names}
    both: dict[tuple[str, str], int] = {}
    for (a, b), n in links.items():
        both[min(a, b), max(a, b)] = both.get((min(a, b), max(a, b)), 0) + n
    for (a, b), _ in sorted(both.items(), key=lambda x: (-x[1], x[0])):
        if member[a] is member[b]:
            continue
        cross = [(min(x, y), max(x, y)) for x in member[a] for y in member[b]]
        if sum(together.get(p, 0) for p in cross) <= sum(both.get(p, 0) for p in cross):
            merged = member[a] + member[b]
            for n in merged:
                member[n] = merged
    return {n: min(member[n], key=lambda m: (-names[m], m)) for n in names}


def unify(ws: Workspace, exports: DataFrame) -> DataFrame:
    """All readable records as one table: the record's own columns, detection_id and one column per field family.

    Names that series renamed to each other form a family and share the column
    of its most frequent name, unless they often stand side by side. The
    headers of all exports are folded through the lattice; a column is double
    or boolean if its values, taken out of arrays and objects of one, all are,
    else text, and every file is cast to that union schema. A record with
    several members of a family takes the one with the most frequent name. A
    record delivered twice comes out once (if the deliveries differ, the lesser
    values). A field whose name differs from another column at most in case
    gets the suffix `_field`.
    """
    changes = ws.write(field_changes(ws, exports), "changes")
    links = changes.filter("change = 'renamed'").groupBy("old_field", "new_field").agg(F.count("*").alias("n"))
    # Names and links grow with the schema, not with the records; both are checked.
    header = ws.spark.read.parquet(ws.path("headers"))
    names = header.groupBy("field").agg(F.sum("n").alias("n"), promote("kinds").alias("kinds")).limit(MOST_FIELDS + 1).collect()
    if len(names) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} different fields")
    rank = {r.field: r.n for r in names}
    linked = links.select(F.explode(F.array("old_field", "new_field")).alias("field")).distinct()
    side = header.join(linked, "field", "left_semi").select("export_id", "field")
    pairs = side.join(side.withColumnRenamed("field", "other"), "export_id").filter("field < other").groupBy("field", "other").agg(F.count("*").alias("n"))
    family = _families(rank, {(r.old_field, r.new_field): r.n for r in links.collect()}, {(r.field, r.other): r.n for r in pairs.collect()})
    kinds: dict[str, int] = {}
    for r in names:
        kinds[family[r.field]] = kinds.get(family[r.field], 0) | r.kinds
    columns, used = {}, {c.lower() for c in [*_OWN, KEY]}
    for name in sorted(set(family.values()) - {KEY}):
        column = name
        while column.lower() in used:
            column += "_field"
        used.add(column.lower())
        columns[name] = (column, _COLUMN.get(kinds[name], "string"))
    order = {f: (-rank[f], f) for f in rank}
    members = sorted((f for f in family if family[f] in columns), key=order.__getitem__)
    arrow = {"double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {f: family[f] for f in members}
        place = {f: i for i, f in enumerate(members)}
        for b in batches:
            records = [_record(p) for p in b.column(len(_OWN)).to_pylist()]
            own = b.select(_OWN).filter(pa.array([r is not None for r in records]))
            records = [r for r in records if r is not None]
            values: dict[str, list] = {name: [None] * len(records) for name in columns}
            ids = []
            for i, record in enumerate(records):
                key = _plain(record.get(KEY))
                ids.append(int(key) if isinstance(key, (int, float)) and abs(key) < 1 << 63 else None)
                for field in sorted((f for f in record if f in wanted), key=place.__getitem__):
                    name, plain = wanted[field], _plain(record[field])
                    if plain is not None and values[name][i] is None:
                        kind = columns[name][1]
                        values[name][i] = float(plain) if kind == "double" else plain if kind == "boolean" else _text(_raw(record[field]))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(ids, pa.int64()), *(pa.array(values[n], arrow[k]) for n, (_, k) in columns.items())], [*_OWN, KEY, *(c for c, _ in columns.values())])

    ship(ws.spark)
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    source = exports.select(*_OWN, "payload")
    schema = ", ".join([f"{c} {source.schema[c].dataType.simpleString()}" for c in _OWN] + [f"{KEY} long"] + [f"{quoted(c)} {k}" for c, k in columns.values()])
    table = source.mapInArrow(cast, schema)
    rest = [quoted(c) for c in table.columns[len(_OWN) :]]
    return table.groupBy(*_OWN).agg(F.min(F.struct(*rest)).alias("_r")).select(*_OWN, *[F.col(f"_r.{c}") for c in rest])


def _raw(value):
    """A value out of its one-element array or its object's member `value`, text as it is."""
    if isinstance(value, list) and len(value) == 1:
        return value[0]
    return value["value"] if isinstance(value, dict) and value.get("value") is not None else value
