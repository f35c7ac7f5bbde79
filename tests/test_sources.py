import json
import zipfile
from decimal import Decimal
from pathlib import Path

import pytest

from barloom.sources import providers


@pytest.fixture
def file(tmp_path):
    def write(name, value):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(value if isinstance(value, str) else json.dumps(value))
        return str(path)

    return write


def quote(**kw):
    return {"exchangeCode": "X", "symbolCode": "a", "interval": "d", "dateStamp": "2026-01-02T00:00:00", "open": 1.1, "high": 2.0, "low": 1.0, "close": 1.5, "volume": 0} | kw


def test_quotes_split_into_good_and_rejected(spark, file):
    path = file("q.json", [quote(), quote(symbolCode=" "), quote(exchangeCode="Y"), quote(high=0.5), quote(volume=-1), quote(dateStamp="2026-01-03"), quote(close=None)])
    good, bad = providers.split_rejects(providers.read_quotes(spark, path, "X", "2026-01-02"))
    assert [(r.ticker, r.open) for r in good.collect()] == [("a", Decimal("1.1000000000"))]
    assert sorted(r.reasons for r in bad.collect()) == ["date", "exchange", "price", "relation", "symbol", "volume"]


def test_symbols_ignore_numeric_types(spark, file):
    rows = providers.read_symbols(spark, file("s.json", [{"code": "A", "name": " ", "type": 7, "currency": "USD"}, {"code": "B", "name": "b", "type": "EQUITY"}])).collect()
    assert [tuple(r) for r in rows] == [("A", None, None, "USD", ""), ("B", "b", "EQUITY", None, "")]
    assert [r.reasons for r in providers.read_symbols(spark, file("t.json", [{"code": " "}])).collect()] == ["code"]


def test_chart_dates_are_of_the_declared_zone(spark, file):
    arrays = {k: [1.0, 2.0] for k in ("open", "high", "low", "close")} | {"volume": [None, 5]}
    body = {"chart": {"result": [{"meta": {"symbol": "S", "exchangeTimezoneName": "America/New_York"}, "timestamp": [1735700400, 1735776000], "indicators": {"quote": [arrays]}}]}}
    rows = sorted(providers.read_chart(spark, file("c.json", body), "America/New_York").collect(), key=lambda r: r.trading_date)
    assert [(str(r.trading_date), r.volume, r.reasons) for r in rows] == [("2024-12-31", None, ""), ("2025-01-01", Decimal("5.00000000"), "")]
    assert {r.reasons for r in providers.read_chart(spark, file("c.json", body), "UTC").collect()} == {"time_zone"}


def test_chart_payloads_that_are_rejected_whole(spark, file):
    arrays = {k: [1.0, 2.0] for k in ("open", "high", "low", "close", "volume")}
    result = lambda quote: {"meta": {"symbol": "S", "exchangeTimezoneName": "UTC"}, "timestamp": [0, 86400], "indicators": {"quote": [quote]}}
    bodies = {"none": {"chart": {"result": None, "error": {"code": "x"}}}, "short": {"chart": {"result": [result(arrays | {"close": [1.0]})]}}, "good": {"chart": {"result": [result(arrays)]}}}
    found = {name: [r.reasons for r in providers.read_chart(spark, file(f"{name}.json", body), "UTC").collect()] for name, body in bodies.items()}
    assert found == {"none": ["payload"], "short": ["shape"], "good": ["", ""]}


HEADER = "<TICKER>,<PER>,<DATE>,<TIME>,<OPEN>,<HIGH>,<LOW>,<CLOSE>,<VOL>,<OPENINT>\n"
LINES = HEADER + "A.US,D,20260102,000000,1,2,1,1.5,10.5,0\nB.US,D,20261302,000000,1,2,1,1.5,10,0\nC.US,D,20260102,000000, 1,2,1,1.5,10,0\nD.US,D,20260102,000000,1,2,1,1.5,10,0,extra\nE.US,D\n"


def test_history_csv_and_zip_agree(spark, file, tmp_path):
    file("nasdaq/b.txt", "wrong\n1\n")
    csv = providers.read_history_csv(spark, str(Path(file("nasdaq/a.txt", LINES)).parent))
    assert csv.where("reasons = 'member'").count() == 1
    path = tmp_path / "h.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("data/nasdaq/a.txt", LINES)
        z.writestr("data/nasdaq/b.txt", "wrong\n1\n")
        z.writestr("../evil.txt", LINES)
    zipped = providers.read_history_zip(spark, str(path))
    keep = lambda df: sorted((r.market, r.ticker or "", str(r.trading_date), str(r.volume), r.reasons) for r in df.where("reasons <> 'member'").collect())
    assert keep(csv) == keep(zipped) == sorted([("nasdaq", "A.US", "2026-01-02", "10.50000000", ""), ("nasdaq", "B.US", "None", "10.00000000", "date"), ("nasdaq", "C.US", "2026-01-02", "10.00000000", "price"), ("nasdaq", "D.US", "2026-01-02", "10.00000000", "fields"), ("nasdaq", "E.US", "None", "None", "fields,date,price")])
    assert zipped.where("reasons = 'member'").count() == 2


def test_positional_and_keyed_json(spark, file):
    rows = providers.read_fields_data(spark, file("f.json", {"fields": ["cik", "name"], "data": [[1, "x"], [2, None]]})).orderBy("n").collect()
    assert [r.row for r in rows] == [{"cik": "1", "name": "x"}, {"cik": "2", "name": None}]
    rows = providers.read_keyed_objects(spark, file("k.json", {"0": {"cik_str": 5, "ticker": "T", "title": "t"}, "1": {"cik_str": "6", "title": "u"}})).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [(0, "5", "T", "t", ""), (1, "6", None, "u", "")]
    short = providers.read_fields_data(spark, file("g.json", {"fields": ["cik", "name"], "data": [[1], [2, "y"], [3, "z", 4]]})).orderBy("n").collect()
    assert [(r.row, r.reasons) for r in short] == [(None, "fields"), ({"cik": "2", "name": "y"}, ""), (None, "fields")]
