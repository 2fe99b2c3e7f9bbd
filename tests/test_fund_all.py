"""All categories from one parse, their rows made by compiled code (findings
of round 4)."""

from functools import reduce

import pytest

from bourse.operators import fundamentals as FU
from bourse.plans.jobs import job_fundamental

TYPE = '"Type":"Common Stock"'
DOCS = [
    # repeated keys, escapes, empty and missing objects, other types
    '{"General":{"Code":"A",%s,"Exchange":"X"},"Valuation":{"TrailingPE":1,"TrailingPE":2.50}}',
    '{"General":{"Code":"B","Type":"Common\\u0020Stock"},"Valuation":{},"Highlights":{"x":1},"Technicals":null}',
    '{"General":{"Code":"C","Type":"ETF"},"Valuation":{"TrailingPE":1}}',
    '{"General":{%s,"AddressData":"x","Listings":[1],"Officers":"Common Stock"}}',
    '{"General":{%s,"AddressData":{"Street":"S","Street":"T"},"Listings":{"0":null,"1":{"Code":"a\\"b"}},"Officers":{}}}',
    '{"General":{%s,"AddressData":null,"Listings":{},"Officers":{"0":{"Name":{"a":1.50}}}},"Highlights":5,"SplitsDividends":{"PayoutRatio":1}}',
    # a record that is null, records without dates, keys that are no metrics elsewhere
    '{"General":{"Code":"D",%s},"Financials":{"Balance_Sheet":{"yearly":{"a":{"date":"2001-02-28","date":"1999-01-01","q":1},"b":null},'
    '"quarterly":{"a":{"date":"2001-05-28","filing_date":"2001-06-01","currency_symbol":"E","currency_symbol":"F","q":1,"q":2,"z":null,"reportDate":"r"},"c":{}}},'
    '"Cash_Flow":{"yearly":{},"quarterly":null},"Income_Statement":{"yearly":"x"}}}',
    '{"General":{"Code":"E",%s},"outstandingShares":{"annual":{"0":null,"1":{"dateFormatted":"2001-2-3","filing_date":"2001-02-03","shares":5,"currency_symbol":"U"},'
    '"2":{"date":"2000-01-01"}},"quarterly":{}},"Earnings":{"History":{"a":{"date":"2001-11-30","reportDate":"2001-12-31","filing_date":"f","epsActual":1.50}},'
    '"Trend":{"a":{"growth":"1"},"b":[1]},"Annual":{"x":{"date":"0000-01-01","e":{"n":[1, 2]}}}}}',
    "Common Stock", "{", "", None, '{"General":null}', '{"General":{}}', '{"General":{%s},"Valuation":{"TrailingPE":1',
]


def _rows(df):
    # dates as text: Python has no year 0
    return sorted(map(str, df.withColumns({c: df[c].cast("string") for c in ("period", "published_at")}).collect()))


def test_all_categories_are_those_of_each(spark):
    docs = spark.createDataFrame([(t and t.replace("%s", TYPE),) for t in DOCS], "doc_text string")
    rows = FU.fund_all(docs)
    each = [FU.fund_category(docs, name) for name in FU.CATEGORIES]
    assert rows.dtypes == each[0].dtypes
    assert _rows(rows) == _rows(reduce(lambda a, b: a.union(b), each))
    got = {(r.category, r.metric, r.value, r.currency, str(r.period), r.period_type, str(r.published_at)) for r in rows.where("security_code in ('D', 'E') and period > '1900-01-01'").collect()}
    assert got == {("balance_sheet", "q", "1", "E", "2001-04-01", "quarterly", "2001-06-01"), ("balance_sheet", "q", "2", "E", "2001-04-01", "quarterly", "2001-06-01"),
                   ("balance_sheet", "z", None, "E", "2001-04-01", "quarterly", "2001-06-01"), ("balance_sheet", "reportDate", "r", "E", "2001-04-01", "quarterly", "2001-06-01"),
                   ("earning_history", "epsActual", "1.5", None, "2001-10-01", "quarterly", "2001-12-31"), ("earning_history", "filing_date", "f", None, "2001-10-01", "quarterly", "2001-12-31")}


@pytest.mark.parametrize("rows_of", [FU.fund_all, lambda docs: job_fundamental(docs)[0]], ids=["fund_all", "job_fundamental"])
def test_metric_rows_are_made_by_compiled_code(spark, rows_of):
    rows = rows_of(spark.createDataFrame([(DOCS[0].replace("%s", TYPE),)], "doc_text string"))
    execution = rows._jdf.queryExecution()
    generators = [line for line in execution.optimizedPlan().toString().splitlines() if "Generate inline" in line]
    assert generators and not any("lambdafunction" in g for g in generators)
    stages = execution.debug().codegenToSeq()
    sizes = {stages.apply(i)._1(): stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())}
    # the JVM leaves methods of over 8,000 bytes uncompiled
    assert max(sizes.values()) < 8000 and any("Generate inline" in plan for plan in sizes)
