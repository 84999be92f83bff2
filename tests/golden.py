"""Small literal input tables in the shape the reports read."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta
from decimal import Decimal

from bondscope import report_window
from bondscope.sources.tables import SCHEMAS, columns_of

WINDOW = report_window(report_date=date(2024, 1, 26))  # Friday; the period before ends on the 19th


def at(day: str, clock: str = "15:00:00") -> datetime:
    return datetime.fromisoformat(f"{day} {clock}")


def table(spark, name: str, rows: list[dict]):
    """Input table ``name`` with NULL where a row gives no value."""
    unknown = {key for row in rows for key in row} - set(columns_of(name))
    assert not unknown, unknown
    return spark.createDataFrame([tuple(row.get(c) for c in columns_of(name)) for row in rows], SCHEMAS[name])


def corp_row(cid, sid, moment, bid=100, offer=101, counts=(5, 3, 4), **more) -> dict:
    """A corporate composite; ``counts`` are providers, bids and offers."""
    text = {}
    if counts is not None:
        text["Counts"] = {"All": dict(zip(("PVR", "BID", "OFR"), counts))}
    for key, name in (("og_bid", "OgBidCmp"), ("og_offer", "OgOfrCmp")):
        if key in more:
            text[name] = more.pop(key)
    return {
        "CorpCompositeId": cid,
        "SecurityId": sid,
        "Date": moment,
        "BidComposite": None if bid is None else Decimal(str(bid)),
        "OfferComposite": None if offer is None else Decimal(str(offer)),
        "IsSnap": True,
        "AdditionalData": json.dumps(text),
        **more,
    }


def muni_row(cid, sid, moment, bid=100.0, offer=101.0, counts=(5, 3, 4), quotes=None, **more) -> dict:
    text = {} if quotes is None else {"OfWts": quotes}
    for key, name in (("og_bid", "OgBdCmp"), ("og_offer", "OgOfCmp"), ("message", "BdOfSprMsg")):
        if key in more:
            text[name] = more.pop(key)
    return {
        "MuniCompositeId": cid,
        "SecurityId": sid,
        "Date": moment,
        "BidComposite": bid,
        "OfferComposite": offer,
        "ProviderCount": counts[0],
        "BidCount": counts[1],
        "OfferCount": counts[2],
        "IsSnap": True,
        "JsonDetail": json.dumps(text),
        **more,
    }


def quote(value, *weights, kind="PRICE", agg=1, provider="P1") -> dict:
    return {"AggId": agg, "Prv": provider, "QT": kind, "VL": value, "PRC": value, "Wts": [{"Wt": w} for w in weights]}


def rows_of(frame, *columns) -> list[tuple]:
    return [tuple(r) for r in (frame.select(*columns) if columns else frame).collect()]


def business_days(first: date, last: date) -> list[date]:
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    return [d for d in days if d.weekday() < 5]
