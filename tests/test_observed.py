import json
from dataclasses import replace

import pytest

from bondscope import CORP, MUNI
from bondscope.operators.observed import (
    mover_ids,
    observed_prices,
    payload_of,
    quote_weights,
    quoted_rows,
    quotes_of,
    weighted_price,
)
from bondscope.operators.snapshot import eod_snapshot
from tests.golden import WINDOW, at, corp_row, muni_row, quote, rows_of, table


def securities(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "SecurityId long")


def debug(spark, quotes):
    return table(
        spark,
        "corp_composite_debug",
        [{"CorpCompositeID": i, "DebugData": q if isinstance(q, str) else json.dumps({"BdWts": q})} for i, q in quotes],
    )


CASES = {
    1: [quote("100", "1"), quote("110", "0.5", "0.5")],  # 105
    2: [quote("100", "1"), quote("90", "1", kind="SPREAD")],  # 100
    3: [quote("100", "0"), quote("110", "0")],  # weights add up to 0
    4: [quote("100"), quote("110", "2")],  # no weights: the quote drops out
    5: "{broken",
    6: [quote("n/a", "1"), quote("100", "1")],  # unreadable value counts in the weights only
    7: [quote("100", "x"), quote("110", "2")],  # unreadable weight is skipped
    8: '{"BdWts":[]}',
    9: '{"other":[1]}',
    10: [{"AggId": 1, "Prv": "P", "QT": "PRICE", "VL": 101.5, "Wts": [{"Wt": 2}]}],  # bare numbers
}
EXPECTED = {1: 105.0, 2: 100.0, 3: None, 4: 110.0, 6: 50.0, 7: 110.0, 10: 101.5}


def corp_prices(spark):
    eod = eod_snapshot(
        table(spark, "corp_composite", [corp_row(n, n, at("2024-01-25")) for n in [*CASES, 11]]), WINDOW, CORP
    )
    payload = debug(spark, [*CASES.items(), (99, [quote("1", "1")])])
    return observed_prices(eod, securities(spark, *CASES, 1), CORP, payload)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_corporate_prices_with_and_without_broadcast(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = corp_prices(spark)
        assert got.columns == ["SecurityId", "Date", "Period", "WeightedPrice"]
        assert dict(rows_of(got, "SecurityId", "WeightedPrice")) == EXPECTED
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_wanted_securities_and_periods(spark):
    rows = [
        corp_row(1, 1, at("2024-01-12")),  # lead-in day
        corp_row(2, 1, at("2024-01-19")),
        corp_row(3, 1, at("2024-01-25")),
        corp_row(4, 2, at("2024-01-25")),
    ]
    eod = eod_snapshot(table(spark, "corp_composite", rows), WINDOW, CORP)
    payload = debug(spark, [(n, [quote("100", "1")]) for n in (1, 2, 3, 4)])
    got = observed_prices(eod, securities(spark, 1), CORP, payload)
    assert sorted(rows_of(got, "SecurityId", "Period")) == [(1, 1), (1, 2)]


def test_muni_prices_from_the_row_or_a_payload(spark):
    rows = [
        muni_row(1, 1, at("2024-01-25"), quotes=[quote("100", "1"), quote("104", "3")]),
        muni_row(2, 2, at("2024-01-25")),
    ]
    composites = table(spark, "muni_composite", rows)
    eod = eod_snapshot(composites, WINDOW, MUNI)
    own = observed_prices(eod, securities(spark, 1, 2), MUNI)
    joined = observed_prices(eod.drop("JsonDetail"), securities(spark, 1, 2), MUNI, composites)
    assert rows_of(own, "SecurityId", "WeightedPrice") == rows_of(joined, "SecurityId", "WeightedPrice") == [(1, 103.0)]


def test_quote_type_case_can_be_folded(spark):
    payload = debug(spark, [(1, [quote("100", "1", kind="price"), quote("100", "1", kind="PRICE ")])])
    assert quotes_of(payload, CORP).count() == 1
    assert quotes_of(payload, replace(CORP, fold_quote_type=True)).count() == 2


def test_weights_summed_per_quote_give_the_same_price(spark):
    quotes = quotes_of(debug(spark, [(1, CASES[1] * 2), (2, CASES[7])]), CORP)
    per_quote = quote_weights(quotes, ["CorpCompositeID"])
    assert sorted(rows_of(per_quote, "CorpCompositeID", "Value", "SumWeights")) == [
        (1, 100.0, 2.0),
        (1, 110.0, 2.0),
        (2, 100.0, None),
        (2, 110.0, 2.0),
    ]
    keys = ["CorpCompositeID"]
    single = weighted_price(quotes, keys, "Value", "Weight")
    summed = weighted_price(per_quote, keys, "Value", "SumWeights")
    assert sorted(rows_of(single)) == sorted(rows_of(summed)) == [(1, 105.0), (2, 110.0)]


def test_a_security_in_both_lists_counts_once(spark):
    ids = mover_ids(securities(spark, 1, 2), securities(spark, 2, 3))
    assert sorted(rows_of(ids)) == [(1,), (2,), (3,)]


def test_payload_is_cut_to_a_range_of_ids(spark):
    payload = debug(spark, [(n, "{}") for n in range(1, 10)])
    assert sorted(rows_of(payload_of(payload, CORP, 5, 7), "CorpCompositeID")) == [(5,), (6,), (7,)]
    assert payload_of(payload, CORP, None, None).count() == 0


def test_price_lies_between_the_quotes(spark):
    eod = eod_snapshot(table(spark, "corp_composite", [corp_row(1, 1, at("2024-01-25"))]), WINDOW, CORP)
    payload = debug(spark, [(1, [quote(str(90 + i), str(i + 1)) for i in range(20)])])
    values = [r.Value for r in quoted_rows(eod, securities(spark, 1), CORP, payload).collect()]
    price = observed_prices(eod, securities(spark, 1), CORP, payload).first().WeightedPrice
    assert min(values) < price < max(values)
