"""Running sums of months without counts."""

from fathomline.operators import selection
from fathomline.schema import COUNTERS


def test_months_without_counts_are_added_after_the_running_sums(spark):
    rows = spark.createDataFrame([("a", "2020-01", *range(1, 8)), ("a", "2020-04", *range(7)), (None, "2020-02", *range(7))],
                                 f"cell string, month string, {' long, '.join(COUNTERS)} long")
    passes = spark.createDataFrame([("b", "2020-03", 4), ("b", "2019-01", 4)], "cell string, month string, clear long")
    months = spark.createDataFrame([(f"2020-0{m}",) for m in range(1, 6)], "month string")
    out = selection.running_sums(rows, passes, months)
    got = {(r.cell, r.month): (r.n_DJF, r.n_MAM, r.clear_MAM) for r in out.collect()}
    first = {"a": 1, "b": 3, None: 2}
    assert set(got) == {(c, f"2020-0{m}") for c, k in first.items() for m in range(k, 6)}
    assert got["a", "2020-03"] == (1, 0, 0) and got["a", "2020-05"] == (1, 0, 0) and got["b", "2020-05"] == (0, 0, 4)
    assert got[None, "2020-04"] == (0, 0, 0)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = lambda name: next(i for i, line in enumerate(plan) if name in line)
    assert at("Generate") < at("Window")  # the plan prints the last step first
    assert not any("LeftOuter" in line for line in plan)
