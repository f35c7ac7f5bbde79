"""Registered queries of readers, ledgers, session times, objects, publication and streaming, with their SQL.

Readers need files: each query writes the tables' rows in a provider's format
to a scratch folder and reads them back, good rows and rejects alike.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import time
from ..operators import objects
from ..schemas import HISTORY_HEADER
from ..sources import adapters, providers
from ..sources.adapters import BARS_SQL
from ..storage import scratch
from ..streaming import ingest
from . import ledger
from .publication import Publication

FIELDS = ["open", "high", "low", "close", "volume"]


def _bars(spark, sf_dir):
    return adapters.bars(spark, sf_dir).withColumn("k", F.col("listing") * 7 + F.dayofyear("trading_date"))


def _documents(spark, rows, by, value, label):
    """One text file with ``value`` (a document) for each ``by``."""
    path = f"{scratch(spark, label)}/in"
    rows.select(by, value.alias("value")).repartition(by).write.partitionBy(by).text(path)
    return path


def scan_quotes(spark, sf_dir):
    """Quotes of two years, a file a listing: those of one market and date are good, others say why not."""
    b = _bars(spark, sf_dir).where("year(trading_date) IN (1995, 1996)")
    price = lambda c: F.col(c).cast("decimal(30,10)").alias(c)
    one = F.struct(
        F.col("market").alias("exchangeCode"), F.when(F.col("k") % 13 != 0, F.col("ticker")).otherwise(" ").alias("symbolCode"), F.when(F.col("k") % 11 != 0, "d").otherwise("w").alias("interval"),
        F.concat(F.col("trading_date").cast("string"), F.lit("T00:00:00")).alias("dateStamp"), price("open"), F.when(F.col("k") % 17 == 0, F.col("low") - 1).otherwise(F.col("high")).cast("decimal(30,10)").alias("high"),
        price("low"), F.when(F.col("k") % 19 != 0, F.col("close")).cast("decimal(30,10)").alias("close"), F.when(F.col("k") % 23 == 0, -1).otherwise(F.col("volume")).cast("decimal(30,8)").alias("volume"),
    )
    files = b.groupBy("listing").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(F.to_json(one))), F.lit("]")).alias("text"))
    found = providers.read_quotes(spark, _documents(spark, files, "listing", F.col("text"), "quotes"), "ASIA", "1996-03-05")
    return found.groupBy("reasons").agg(F.count("*").alias("rows"), F.count("volume").alias("volumes"), F.round(F.sum("close").cast("double"), 4).alias("close"))


def scan_symbols(spark, sf_dir):
    """Symbol lists, one a size: numeric types are ignored, blanks are null, rows without a code rejected."""
    p = adapters.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    code = F.when(k % 7 == 0, " ").otherwise(F.concat(F.lit("P"), k.cast("string")))
    one = F.concat(
        F.lit('{"code":"'), code, F.lit('","name":"'), F.when(k % 5 != 0, F.col("p_brand")).otherwise(""), F.lit('","type":'), F.when(k % 3 == 0, "7").otherwise('" EQUITY "'),
        F.when(k % 2 == 0, F.lit(',"currency":"USD"')).otherwise(""), F.lit("}"),
    )
    files = p.groupBy("p_size").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(one)), F.lit("]")).alias("text"))
    return providers.read_symbols(spark, _documents(spark, files, "p_size", F.col("text"), "symbols"))


def scan_chart(spark, sf_dir):
    """Charts of parallel arrays, one a listing; some listings have an error, arrays of other lengths, or another time zone."""
    b = _bars(spark, sf_dir).groupBy("listing").agg(F.sort_array(F.collect_list(F.struct("trading_date", *FIELDS))).alias("b"), F.max("ticker").alias("ticker"))
    # 05:30 of the day in New York is 09:30 or 10:30 UTC
    stamps = F.transform("b", lambda x: F.unix_date(x["trading_date"]).cast("long") * 86400 + 36000)
    column = lambda c: F.transform("b", lambda x: x[c].cast("decimal(30,8)" if c == "volume" else "decimal(30,10)"))
    short = F.when(F.col("listing") % 9 == 2, F.slice(column("close"), 1, 3)).otherwise(column("close"))
    quote = F.struct(*[(short if c == "close" else column(c)).alias(c) for c in FIELDS])
    zone = F.when(F.col("listing") % 9 == 3, "Asia/Tokyo").otherwise("America/New_York")
    meta = F.struct(F.col("ticker").alias("symbol"), F.lit("X").alias("exchangeName"), zone.alias("exchangeTimezoneName"))
    result = F.array(F.struct(meta.alias("meta"), stamps.alias("timestamp"), F.struct(F.array(quote).alias("quote")).alias("indicators")))
    body = F.when(F.col("listing") % 9 == 1, F.lit('{"chart":{"result":null,"error":{"code":"Not Found"}}}')).otherwise(F.to_json(F.struct(F.struct(result.alias("result")).alias("chart"))))
    found = providers.read_chart(spark, _documents(spark, b, "listing", body, "charts"), "America/New_York")
    return found.groupBy("ticker", "reasons").agg(
        F.count("*").alias("rows"), F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"), F.round(F.sum("close").cast("double"), 2).alias("close"),
    )


def scan_history_csv(spark, sf_dir):
    """Extracted history lines below a folder a market; the files of one market have no header, some lines are broken."""
    b = _bars(spark, sf_dir)
    text = lambda c: F.col(c).cast("decimal(20,4)").cast("string")
    day = F.when(F.col("k") % 29 == 0, F.lit("20261399")).otherwise(F.date_format("trading_date", "yyyyMMdd"))
    price = F.when(F.col("k") % 31 == 0, F.concat(F.lit(" "), text("open"))).otherwise(text("open"))
    line = F.concat_ws(",", F.col("ticker"), F.lit("D"), day, F.lit("000000"), price, text("high"), text("low"), text("close"), F.coalesce(text("volume"), F.lit("")), F.lit("0"))
    lines = b.select("market", F.when(F.col("k") % 37 == 0, F.concat(line, F.lit(",x"))).otherwise(line).alias("value"))
    heads = adapters.listings(spark, sf_dir).where("market <> 'AFRICA'").select("market", F.lit(",".join(HISTORY_HEADER)).alias("value")).distinct()
    path = f"{scratch(spark, 'history')}/in"
    lines.unionByName(heads).repartition("market").write.partitionBy("market").text(path)
    found = providers.read_history_csv(spark, path)
    # a rejected file has its path for a name
    ticker = F.when(F.col("reasons") == "member", F.regexp_extract("ticker", "market=([^/]*)/", 1)).otherwise(F.col("ticker"))
    return found.groupBy(F.regexp_replace("market", "^market=", "").alias("market"), ticker.alias("ticker"), "reasons").agg(F.count("*").alias("rows"), F.count("trading_date").alias("dates"), F.round(F.sum("open").cast("double"), 2).alias("open"))


def scan_fields_data(spark, sf_dir):
    """Positional rows by nation; some have one value too few."""
    s = adapters.table(spark, sf_dir, "supplier")
    row = F.array(F.col("s_suppkey").cast("string"), F.col("s_name"), F.when(F.col("s_suppkey") % 4 != 0, "N"))
    row = F.when(F.col("s_suppkey") % 6 == 0, F.slice(row, 1, 2)).otherwise(row)
    files = s.groupBy("s_nationkey").agg(F.to_json(F.struct(F.array(F.lit("cik"), F.lit("name"), F.lit("exchange")).alias("fields"), F.collect_list(row).alias("data"))).alias("text"))
    found = providers.read_fields_data(spark, _documents(spark, files, "s_nationkey", F.col("text"), "positional"))
    return found.select(F.element_at("row", "cik").alias("cik"), F.element_at("row", "name").alias("name"), F.element_at("row", "exchange").alias("exchange"), "reasons")


def scan_keyed_objects(spark, sf_dir):
    """Objects by number; numbers and texts alike, some without cik."""
    s, k = adapters.table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    cik = F.when(k % 5 == 0, "").when(k % 2 == 0, F.concat(F.lit('"cik_str":'), k.cast("string"), F.lit(","))).otherwise(F.concat(F.lit('"cik_str":"'), k.cast("string"), F.lit('",')))
    one = F.concat(F.lit('"'), k.cast("string"), F.lit('":{'), cik, F.lit('"title":"'), F.col("s_name"), F.lit('"}'))
    files = s.groupBy("s_nationkey").agg(F.concat(F.lit("{"), F.concat_ws(",", F.collect_list(one)), F.lit("}")).alias("text"))
    return providers.read_keyed_objects(spark, _documents(spark, files, "s_nationkey", F.col("text"), "keyed"))


def _run_events(spark, sf_dir):
    e = adapters.table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "view", "STARTED").when(F.col("event_type") == "click", "HEARTBEAT").when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED")
    job = F.concat(F.lit("job"), (F.col("user_id") % 3).cast("string"))
    return e.select(F.col("user_id").cast("string").alias("run_id"), job.alias("job"), status.alias("status"), F.date_trunc("second", "ts").alias("at"), F.col("event_id").alias("seq"), F.col("event_type").alias("summary"))


def run_states(spark, sf_dir):
    return ledger.run_state(_run_events(spark, sf_dir))


def stale_runs(spark, sf_dir):
    return ledger.stale_runs(_run_events(spark, sf_dir), F.lit("2024-01-31 00:00:00").cast("timestamp"), 6 * 3600).select("run_id", "job", "status", "last_at")


def session_dates(spark, sf_dir):
    """Local dates, strict cut-offs and measurements of events; Tokyo keeps one offset."""
    e = adapters.table(spark, sf_dir, "events")
    day = time.session_date(F.unix_timestamp("ts"), "Asia/Tokyo")
    value = time.measurement(F.when(F.col("event_id") % 3 != 0, F.round("value", 4)), "mm")
    return e.select("event_id", day.alias("session"), time.eligible_after(day, "15:30", "Asia/Tokyo", 45).alias("eligible_at"), value["value"].alias("value"), value["unit"].alias("unit"))


def daily_measures(spark, sf_dir):
    """Hourly observations as arrays beside each other, exploded and gathered by local date: least, most and total."""
    e = adapters.table(spark, sf_dir, "events").select("user_id", "ts", F.when(F.col("event_id") % 5 != 0, F.round("value", 4)).alias("value"))
    packed = e.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("ts", "value"))).alias("x"))
    hourly = packed.select("user_id", F.col("x.ts").alias("time"), F.col("x.value").alias("value"))
    rows = hourly.select("user_id", F.explode(F.arrays_zip("time", "value")).alias("z")).select("user_id", F.to_date(F.from_utc_timestamp("z.time", "Asia/Tokyo")).alias("day"), "z.value")
    return rows.groupBy("user_id", "day").agg(F.count("*").alias("hours"), F.count("value").alias("known"), F.min("value").alias("least"), F.max("value").alias("most"), F.round(F.sum("value"), 3).alias("total"))


def object_cleanup(spark, sf_dir):
    """What is due among stored objects, in batches of a hundred a bucket; the digest counts batches."""
    o, k = adapters.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    kind = F.when(k % 3 == 0, "report").when(k % 3 == 1, "raw")
    key, day = F.lpad(k.cast("string"), 12, "0"), F.date_trunc("day", "o_orderdate")
    stored = o.select(
        key.alias("object_key"), F.lit(1).cast("long").alias("seq"), F.lit("STORED").alias("event"), F.md5(key).alias("sha256"), k.alias("size"), F.lit("t").alias("content_type"), kind.alias("kind"),
        F.when(k % 4 != 0, F.timestamp_add("DAY", F.lit(90), day)).alias("expires_at"), F.lit(None).cast("timestamp").alias("purge_after"),
    )
    deleted = stored.where(F.col("size") % 5 == 0).withColumns({"seq": F.lit(2).cast("long"), "event": F.lit("DELETED"), "purge_after": F.timestamp_add("DAY", F.lit(30), F.coalesce("expires_at", F.lit("1996-01-01").cast("timestamp")))})
    purged = stored.where(F.col("size") % 35 == 0).withColumns({"seq": F.lit(3).cast("long"), "event": F.lit("PURGED")})
    state = objects.object_state(stored.unionByName(deleted).unionByName(purged))
    due = objects.cleanup_actions(state, F.lit("1997-06-01").cast("timestamp"), {"report": 60}, 7)
    numbered = objects.in_batches(due, 100)
    return numbered.select("object_key", "action", "next_purge_after", F.substring_index("batch", "-", 1).cast("int").alias("bucket"))


def published_runs(spark, sf_dir):
    """Three runs published one after the other; each writes to the slots that aren't active."""
    b = _bars(spark, sf_dir).select("listing", "trading_date", "close")
    p = Publication(spark, scratch(spark, "publication"))
    for run, condition, more in (("r1", "true", 0.0), ("r2", "listing % 2 = 0", 1.0), ("r3", "listing % 3 = 0", 2.0)):
        rows = b.where(condition).withColumn("close", F.col("close") + more)
        p.build(run, rows)
        p.finalize(run, rows.count(), ["listing", "trading_date"])
    return p.view().select("listing", "trading_date", "slot", F.round("close", 4).alias("close"))


def stream_ingest(spark, sf_dir):
    """Bars from files of three batches; the last by ``seq`` wins, also against an older one that comes later."""
    root = scratch(spark, "stream")
    b = _bars(spark, sf_dir).select("listing", "trading_date", *FIELDS, F.col("k").cast("long").alias("k"))
    for condition, seq, more in (("k % 5 <> 0", 20, 0.0), ("k % 3 = 0", 10, 100.0), ("k % 7 = 0", 30, 200.0)):
        rows = b.where(condition).withColumns({"close": F.col("close") + more, "seq": F.lit(seq).cast("long")}).drop("k")
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
        found = ingest.run_once(spark, f"{root}/in", f"{root}/table", f"{root}/checkpoint", compact_every=2)
    return found.select("listing", "trading_date", F.round("close", 4).alias("close"), "seq", "batch")


QUERIES = {f.__name__: f for f in (
    scan_quotes, scan_symbols, scan_chart, scan_history_csv, scan_fields_data, scan_keyed_objects, run_states, stale_runs, session_dates, daily_measures, object_cleanup, published_runs, stream_ingest,
)}

_K = f"WITH {BARS_SQL}, k AS (SELECT *, listing * 7 + dayofyear(trading_date) AS k FROM bars)"


def _names(**rules):
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in rules.items()) + ")"


_QUOTES = f"""{_K}, q AS (SELECT *, CASE WHEN k % 17 = 0 THEN low - 1 ELSE high END AS h, CASE WHEN k % 19 <> 0 THEN close END AS c, CASE WHEN k % 23 = 0 THEN -1 ELSE volume END AS v
  FROM k WHERE year(trading_date) IN (1995, 1996)),
r AS (SELECT *, {_names(exchange="market <> 'ASIA'", interval='k % 11 = 0', date="trading_date <> DATE '1996-03-05'", symbol='k % 13 = 0', price='c IS NULL',
relation='h < greatest(open, c, low) OR low > least(open, c)', volume='v < 0')} AS reasons FROM q)"""
_RUNS = """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS run_id, 'job' || (user_id % 3) AS job, CASE event_type WHEN 'view' THEN 'STARTED' WHEN 'click' THEN 'HEARTBEAT' WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
  date_trunc('second', ts) AS t, event_id AS seq, event_type AS summary FROM events),
s AS (SELECT run_id, max(job) AS job, min(t) AS started, arg_max(status, seq) AS status, arg_max(t, seq) AS last_at, arg_max(summary, seq) AS summary FROM e GROUP BY 1)"""

SQL = {
    "scan_quotes": f"{_QUOTES} SELECT reasons, count(*) AS rows, count(v) AS volumes, round(sum(c), 4) AS close FROM r GROUP BY 1",
    "scan_symbols": """SELECT CASE WHEN p_partkey % 7 <> 0 THEN 'P' || p_partkey END AS code, CASE WHEN p_partkey % 5 <> 0 THEN nullif(trim(p_brand), '') END AS name, CASE WHEN p_partkey % 3 <> 0 THEN 'EQUITY' END AS type,
        CASE WHEN p_partkey % 2 = 0 THEN 'USD' END AS currency, CASE WHEN p_partkey % 7 = 0 THEN 'code' ELSE '' END AS reasons FROM part""",
    "scan_chart": f"""{_K}, g AS (SELECT CASE listing % 9 WHEN 1 THEN NULL ELSE ticker END AS ticker, CASE listing % 9 WHEN 1 THEN 'payload' WHEN 2 THEN 'shape' WHEN 3 THEN 'time_zone' ELSE '' END AS reasons, listing, trading_date, close FROM k)
        SELECT ticker, reasons, CASE WHEN reasons IN ('payload', 'shape') THEN count(DISTINCT listing) ELSE count(*) END AS rows, CASE WHEN reasons
          NOT IN ('payload', 'shape') THEN min(trading_date) END AS first_date,
        CASE WHEN reasons NOT IN ('payload', 'shape') THEN max(trading_date) END AS last_date, CASE WHEN reasons NOT IN ('payload', 'shape') THEN
          round(sum(close), 2) END AS close FROM g GROUP BY 1, 2""",
    "scan_history_csv": f"""{_K}, f AS (SELECT market, ticker, {_names(fields='k % 37 = 0', date='k % 29 = 0', price='k % 31 = 0')} AS reasons, CASE WHEN k % 29 <> 0 THEN trading_date END AS d, CASE WHEN k % 31 <> 0 THEN open END AS o FROM k WHERE market <> 'AFRICA')
        SELECT market, ticker, reasons, count(*) AS rows, count(d) AS dates, round(sum(o), 2) AS open FROM f GROUP BY 1, 2, 3 UNION ALL SELECT NULL, 'AFRICA', 'member', 1, 0, NULL""",
    "scan_fields_data": """SELECT CASE WHEN s_suppkey % 6 <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS cik, CASE WHEN s_suppkey % 6 <> 0 THEN s_name END AS name, CASE WHEN s_suppkey % 6 <> 0 AND s_suppkey % 4 <> 0 THEN 'N' END AS exchange,
        CASE WHEN s_suppkey % 6 = 0 THEN 'fields' ELSE '' END AS reasons FROM supplier""",
    "scan_keyed_objects": (
        "SELECT s_suppkey AS n, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS cik, CAST(NULL AS VARCHAR) AS ticker, "
        "s_name AS title, CASE WHEN s_suppkey % 5 = 0 THEN 'cik' ELSE '' END AS reasons FROM supplier"
    ),
    "run_states": f"{_RUNS} SELECT * FROM s",
    "stale_runs": f"{_RUNS} SELECT run_id, job, status, last_at FROM s WHERE status IN ('STARTED', 'HEARTBEAT') AND epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(last_at) > 21600",
    "session_dates": """SELECT event_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS session, CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS TIMESTAMP) + INTERVAL 7 HOUR + INTERVAL 15 MINUTE AS eligible_at,
        CASE WHEN event_id % 3 <> 0 THEN round(value, 4) END AS value, CASE WHEN event_id % 3 <> 0 AND value IS NOT NULL THEN 'mm' END AS unit FROM events""",
    "daily_measures": """WITH v AS (SELECT user_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS day, CASE WHEN event_id % 5 <> 0 THEN round(value, 4) END AS value FROM events)
        SELECT user_id, day, count(*) AS hours, count(value) AS known, min(value) AS least, max(value) AS most, round(sum(value), 3) AS total FROM v GROUP BY 1, 2""",
    "object_cleanup": """WITH o AS (SELECT o_orderkey AS k, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS object_key, CASE o_orderkey % 3 WHEN 0 THEN 'report' WHEN 1 THEN 'raw' END AS kind,
        CASE WHEN o_orderkey % 4 <> 0 THEN date_trunc('day', o_orderdate) + INTERVAL 90 DAY END AS expires_at FROM orders WHERE o_orderkey % 35 <> 0),
        s AS (SELECT *, k % 5 = 0 AS deleted, coalesce(expires_at, TIMESTAMP '1996-01-01') + INTERVAL 30 DAY AS purge_after FROM o),
        a AS (SELECT *, CASE WHEN deleted AND purge_after <= TIMESTAMP '1997-06-01' THEN 'PURGE' WHEN NOT deleted AND expires_at <= TIMESTAMP '1997-06-01' THEN 'EXPIRE' END AS action FROM s)
        SELECT object_key, action, CASE WHEN action = 'EXPIRE' THEN TIMESTAMP '1997-06-01' + INTERVAL 7 DAY + CASE WHEN kind = 'report' THEN
          INTERVAL 60 DAY ELSE INTERVAL 0 DAY END END AS next_purge_after,
        CAST(('0x' || md5(object_key)[1:2]) AS INTEGER) AS bucket FROM a WHERE action IS NOT NULL""",
    "published_runs": f"""{_K} SELECT listing, trading_date, CASE WHEN (listing % 2 = 0) <> (listing % 3 = 0) THEN 'B' ELSE 'A' END AS slot,
        round(close + CASE WHEN listing % 3 = 0 THEN 2 WHEN listing % 2 = 0 THEN 1 ELSE 0 END, 4) AS close FROM k""",
    "stream_ingest": f"""{_K}, c AS (SELECT listing, trading_date, close, 20 AS seq, 0 AS batch FROM k WHERE k % 5 <> 0 UNION ALL SELECT listing, trading_date, close + 100, 10, 1 FROM k WHERE k % 3 = 0
        UNION ALL SELECT listing, trading_date, close + 200, 30, 2 FROM k WHERE k % 7 = 0)
        SELECT listing, trading_date, round(arg_max(close, seq), 4) AS close, CAST(max(seq) AS BIGINT) AS seq, CAST(arg_max(batch, seq) AS BIGINT) AS batch FROM c GROUP BY 1, 2""",
}
