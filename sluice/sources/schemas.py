"""Explicit schemas of raw tables, and what the jobs need to know of each dataset."""

from __future__ import annotations

from dataclasses import dataclass

TRADES = "instrument_name string, trade_id bigint, side string, price double, size double, created_time bigint"
BOOKS = "instId string, action string, ts bigint, asks string, bids string"
KLINES = "open_time bigint, open double, high double, low double, close double"
FUNDING = "instrument_name string, funding_rate double, funding_time bigint"


@dataclass(frozen=True)
class Dataset:
    """Name, schema, unique key, event time (epoch ms), file period and gap threshold of a dataset."""

    name: str
    schema: str
    key: str
    time: str
    period: str = "day"
    gap_ms: int | None = None


DATASETS = {
    d.name: d
    for d in (
        Dataset("spot_trades", TRADES, "trade_id", "created_time", gap_ms=60_000),
        Dataset("perpetual_trades", TRADES, "trade_id", "created_time", gap_ms=60_000),
        Dataset("perpetual_orderBook", BOOKS, "ts", "ts"),
        Dataset("indexPriceKlines", KLINES, "open_time", "open_time", gap_ms=90_000),
        Dataset("perpetual_markPriceKlines", KLINES, "open_time", "open_time", gap_ms=90_000),
        Dataset("perpetual_fundingRate", FUNDING, "funding_time", "funding_time", "month", 43_200_000),
    )
}
