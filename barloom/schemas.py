"""Explicit schemas of the canonical tables; nothing is inferred."""

from __future__ import annotations

# Field names and headers as the providers write them.
QUOTES = "exchangeCode string, symbolCode string, interval string, dateStamp string, open decimal(30,10), high decimal(30,10), low decimal(30,10), close decimal(30,10), volume decimal(30,8), _corrupt_record string"
SYMBOLS = "code string, name string, type string, currency string"
HISTORY_CSV = "ticker string, per string, date string, time string, open string, high string, low string, close string, vol string, openint string"
HISTORY_HEADER = ["<TICKER>", "<PER>", "<DATE>", "<TIME>", "<OPEN>", "<HIGH>", "<LOW>", "<CLOSE>", "<VOL>", "<OPENINT>"]
CHART = (
    "chart struct<result:array<struct<meta:struct<symbol:string,exchangeName:string,exchangeTimezoneName:string>,timestamp:array<bigint>,"
    "indicators:struct<quote:array<struct<open:array<decimal(30,10)>,high:array<decimal(30,10)>,low:array<decimal(30,10)>,close:array<decimal(30,10)>,volume:array<decimal(30,8)>>>>>>>"
)
