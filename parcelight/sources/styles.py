"""Style documents: their rules as conditions."""

from __future__ import annotations

import xml.etree.ElementTree as ET

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Comparisons of the filter language.
_COMPARE = {"PropertyIsEqualTo": "=", "PropertyIsNotEqualTo": "<>", "PropertyIsLessThan": "<", "PropertyIsLessThanOrEqualTo": "<=", "PropertyIsGreaterThan": ">", "PropertyIsGreaterThanOrEqualTo": ">="}


def _name(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def _value(text: str) -> object:
    try:
        return float(text)
    except ValueError:
        return text


def _compare(column: Column, op: str, value: object) -> Column:
    v = F.lit(value)
    return {"=": column == v, "<>": column != v, "<": column < v, "<=": column <= v, ">": column > v, ">=": column >= v}[op]


def _condition(e: ET.Element) -> Column:
    name = _name(e)
    if name in ("And", "Or"):
        parts = [_condition(x) for x in e]
        out = parts[0]
        for p in parts[1:]:
            out = out & p if name == "And" else out | p
        return out
    if name == "Not":
        return ~_condition(e[0])
    if name == "PropertyIsNull":
        return F.col(e[0].text.strip()).isNull()
    if name == "PropertyIsBetween":
        low, high = (_value(x[0].text.strip() if len(x) else x.text.strip()) for x in e[1:3])
        return F.col(e[0].text.strip()).between(low, high)
    if name in _COMPARE:
        return _compare(F.col(e[0].text.strip()), _COMPARE[name], _value((e[1].text or "").strip()))
    raise ValueError(f"filter {name} is not supported")


def rules(document: str) -> list[tuple[str, Column | None]]:
    """(name, condition) of each rule of a style, in order; a rule without a filter has no condition, it always holds."""
    root = ET.fromstring(document)
    out = []
    for rule in (e for e in root.iter() if _name(e) == "Rule"):
        title = next((e.text for e in rule if _name(e) in ("Title", "Name") and e.text), "")
        found = next((e for e in rule if _name(e) == "Filter"), None)
        out.append((title.strip(), _condition(found[0]) if found is not None and len(found) else None))
    return out


def classified(document: str) -> Column:
    """Name of the first rule that holds for a row; null if none does. A comparison with null doesn't hold."""
    out = None
    for name, condition in rules(document):
        condition = F.lit(True) if condition is None else condition
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return out if out is not None else F.lit(None).cast("string")
