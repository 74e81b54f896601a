from __future__ import annotations

import random

import pytest

from parcelight.operators import rangesort


@pytest.mark.parametrize("n", [0, 1, 5_000])
def test_running_sums_match_brute_force(spark, ws, n):
    rng = random.Random(n)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None, "c"]), float("nan") if i % 50 == 0 else float(i % 7), i, rng.choice([1, 2, 5, None]), "clash") for i in range(n)]
    df = spark.createDataFrame(rows, "g string, v double, i long, w long, total string").drop("total")
    got = {r.i: (r.running, r.total) for r in rangesort.running_sums(ws, df.repartition(3), ["g"], ["v", "i"], "w", "sums").collect()}
    want, sums = {}, {}
    for g, v, i, w, _ in sorted(rows, key=lambda r: (r[0] or "", r[1] != r[1], r[1] if r[1] == r[1] else 0, r[2])):
        sums[g] = sums.get(g, 0) + (w or 0)
        want[i] = sums[g]
    assert got == {i: (want[i], sums[g]) for g, _, i, _, _ in rows}


def test_groups_of_several_columns_and_none(spark, ws):
    df = spark.range(20_000).selectExpr("id", "id % 3 as a", "if(id % 2 = 0, cast('NaN' as double), null) as b", "1.5 as w")
    got = rangesort.running_sums(ws, df, ["a", "b"], ["id"], "w", "two").groupBy("a", "b").agg({"running": "max", "total": "min", "id": "count"}).collect()
    assert len(got) == 6 and all(r["max(running)"] == r["min(total)"] == 1.5 * r["count(id)"] for r in got)
    whole = rangesort.running_sums(ws, df, [], ["id"], "w", "one")
    assert whole.filter("running <> 1.5 * (id + 1) or total <> 30000").count() == 0
