"""Classes by rules, as style documents state them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Upper bounds of the power classes in kW and their names; what is above the last bound is in OVER.
POWER, OVER = [(5, "0-5"), (25, "5-25"), (100, "25-100")], ">100"


def power_class(kw: Column) -> Column:
    """Class of an installed power; null for null and negative powers."""
    out, low = F.when(kw < 0, None), None
    for bound, name in POWER:
        inside = (kw <= bound) & ((kw > low) if low is not None else (kw >= 0))
        out, low = out.when(inside, name), bound
    return out.when(kw > low, OVER)


_TESTS = {"=": lambda a, b: a == b, "<>": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def condition(clauses: list[list[tuple[str, str, object]]]) -> Column:
    """A disjunction of conjunctions of (column, comparison, value). No clause: true."""
    if not clauses:
        return F.lit(True)
    alternatives = []
    for clause in clauses:
        tests = [_TESTS[op](F.col(name), F.lit(value)) for name, op, value in clause]
        both = tests[0]
        for t in tests[1:]:
            both = both & t
        alternatives.append(both)
    out = alternatives[0]
    for a in alternatives[1:]:
        out = out | a
    return out


def status_class(rules: list[tuple[str, list[list[tuple[str, str, object]]]]]) -> Column:
    """Name of the first rule that holds, null if none does; a comparison with null doesn't hold."""
    out = None
    for name, clauses in rules:
        out = F.when(condition(clauses), name) if out is None else out.when(condition(clauses), name)
    return out if out is not None else F.lit(None).cast("string")
