"""Ordered target statistics against a loop over the rows."""

import hashlib

from attrition.operators.encode import ordered_target_apply, ordered_target_encode

SCHEMA = "row_id long, churn int, city string, plan string"


def _rows(n=300):
    # a third of the rows share one city; some categories and labels are missing
    return [(i, None if i % 41 == 0 else (i * 7 // 3) % 2, "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"c{i % 60}"), f"p{i % 4}")
            for i in range(n)]


def _brute(rows, at, seed=42):
    seen, out = {}, {}
    for r in sorted(rows, key=lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest(), r[0])):
        s, n = seen.get(r[at], (0, 0))
        out[r[0]] = (s + 0.5) / (n + 1)
        if r[1] is not None:
            seen[r[at]] = s + r[1], n + 1
    return out, seen


def test_equals_a_loop(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.row_id: r for r in ordered_target_encode(df, ["city", "plan"]).collect()}
    assert len(got) == len(rows)
    for at, c in ((2, "city_ots"), (3, "plan_ots")):
        want, _ = _brute(rows, at)
        assert all(abs(got[i][c] - v) < 1e-12 for i, v in want.items())


def test_no_row_sees_its_own_label(spark):
    rows = _rows()
    i = 30
    other = [(*r[:1], 1 - r[1], *r[2:]) if r[0] == i else r for r in rows]
    values = [{r.row_id: r.city_ots for r in ordered_target_encode(spark.createDataFrame(x, SCHEMA), ["city"]).collect()}
              for x in (rows, other)]
    assert values[0][i] == values[1][i]
    assert values[0] != values[1]


def test_applied_to_other_rows(spark):
    rows = _rows()
    test = spark.createDataFrame([(900, "hot"), (901, None), (902, "new"), (903, "c1")], "row_id long, city string")
    got = {r.row_id: r.city_ots for r in ordered_target_apply(spark.createDataFrame(rows, SCHEMA), test, ["city"]).collect()}
    _, seen = _brute(rows, 2)
    for i, c in ((900, "hot"), (901, None), (903, "c1")):
        assert abs(got[i] - (seen[c][0] + 0.5) / (seen[c][1] + 1)) < 1e-12
    assert got[902] == 0.5


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = ordered_target_encode(empty, ["city"])
    assert out.count() == 0 and "city_ots" in out.columns
