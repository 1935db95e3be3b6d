"""Rejects split from the rows that go on."""

from partwise.operators.rejects import reject_split
from partwise.operators.sizes import normalise_sizes


def test_rules_are_not_repeated_in_the_filter(spark):
    """the size rules stood six times and more in the filter of each half, and were run for each."""
    texts = ["5M", "6G", "1 K", "", ".", "1.5.2", None, "0.5 Gi", "8E", "12 foo"]
    raw = spark.createDataFrame([(t, i) for i, t in enumerate(texts * 3)], "raw string, n int").filter("n < 20")
    good, bad = reject_split(normalise_sizes(raw, "raw").select("reject_reason", "raw", "bytes", "n"), "reject_reason")
    assert good.columns == ["raw", "bytes", "n"]
    assert bad.columns == ["error_class", "raw", "bytes", "n", "exit_code"]
    assert sorted(map(tuple, good.select("raw", "bytes").distinct().collect())) == [("0.5 Gi", 512 * 1024**2), ("5M", 5 * 1024**2)]
    assert (good.count(), bad.count()) == (4, 16)
    assert {(r["error_class"], r["exit_code"]) for r in bad.collect()} == {("UserError", 2)}
    assert bad.filter("bytes is null").select("raw").distinct().count() == 6
    for half in (good, bad):
        plan = half._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if "Filter" in line]
        assert filters and not any("regexp" in line for line in filters)
