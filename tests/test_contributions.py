from datetime import date

from navloom.plans import ranking as plan
from navloom.sources import catalogs


def test_holdings_of_a_run_are_resolved_once(spark):
    measured = spark.createDataFrame([("a", []), ("b", []), ("c", ["x"])], "code string, failures array<string>")
    totals = spark.createDataFrame([(c, f"R{c}", date(2026, 6, 30), 1.0, 90.0) for c in "abc"],
                                   "code string, announcement_id string, report_date date, direct_us_pct double, fund_investment_pct double")
    holdings = spark.createDataFrame([(f"R{c}", i, f"FUND {i}", 10.0, None) for c in "abc" for i in (1, 2)],
                                     "announcement_id string, rank int, fund_name string, weight_pct double, reported_category string")
    tables = plan.Tables(*[None] * 7, catalogs.load_instruments(spark), totals, holdings)
    held = plan.with_contributions(tables, measured, plan.Params(as_of=date(2026, 7, 1)))
    assert {r.code for r in held.contributed.collect()} == {"a", "b"}
    # What follows reads the staged rows, not the holdings.
    again = plan.replace(held, report_holdings=None)
    for codes in (["a"], ["a", "b"]):
        wanted = spark.createDataFrame([(c,) for c in codes], "code string")
        told = [sorted(map(str, (r.asDict() for r in plan.contributed_holdings(t, wanted)[1].select(*held.contributed.columns).collect())))
                for t in (tables, again)]
        assert told[0] == told[1] and len(told[0]) == 2 * len(codes)
