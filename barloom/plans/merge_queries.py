"""Registered merge, planning and publication queries with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numeric import equivalent
from ..operators import coverage, merge, planning
from ..operators import indicators as ti
from ..sources import adapters
from ..sources.adapters import BARS_SQL

KEY = merge.BAR_KEY
RAW = [*KEY, *merge.BAR_FIELDS]


def _bars(spark, sf_dir):
    return adapters.raw_bars(spark, sf_dir).select(*RAW).withColumn("k", F.col("listing") * 7 + F.dayofyear("trading_date"))


def _stored(spark, sf_dir):
    return _bars(spark, sf_dir).where("k % 7 <> 0").select(*RAW)


def _incoming(spark, sf_dir):
    return _bars(spark, sf_dir).where("k % 13 <> 0").withColumn("close", F.when(F.col("k") % 11 == 0, F.col("high")).otherwise(F.col("close"))).select(*RAW)


def bar_compare(spark, sf_dir):
    return merge.compare_bars(_incoming(spark, sf_dir), _stored(spark, sf_dir))


def source_copy_drift(spark, sf_dir):
    i, s = _incoming(spark, sf_dir), _stored(spark, sf_dir)
    j = i.alias("i").join(s.alias("s"), KEY)
    differ = ~F.struct(*[f"i.{f}" for f in merge.BAR_FIELDS]).eqNullSafe(F.struct(*[f"s.{f}" for f in merge.BAR_FIELDS]))
    return j.where(differ).groupBy("listing").agg(F.count("*").alias("drifted"), F.min("trading_date").alias("since"))


def _doubles(df, *columns):
    return df.select(*KEY, *[F.round(F.col(c).cast("double"), 8).alias(c) for c in columns])


DERIVED = ("change", "changepct", "typ", "hl_range", "oc_range")


def bar_derived(spark, sf_dir):
    return _doubles(merge.derived(_stored(spark, sf_dir)), *DERIVED)


def bar_upsert(spark, sf_dir):
    return _doubles(merge.upsert_bars(_incoming(spark, sf_dir), _stored(spark, sf_dir)), "close", "volume", *DERIVED)


def recon_summary(spark, sf_dir):
    """Field-difference counts of a comparison."""
    found = bar_compare(spark, sf_dir)
    return found.agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(k.lower()) for k in ("INSERTED", "CORRECTED", "UNCHANGED")], *[F.count(F.when(F.array_contains(F.split("differing", ","), f), 1)).alias(f"{f}_differs") for f in merge.BAR_FIELDS])


def dup_classify(spark, sf_dir):
    return merge.classify_duplicates(adapters.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], ["l_returnflag", "l_linestatus", "l_linenumber"])


def symbol_merge(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part").select((F.col("p_partkey") % 500).alias("code"), "p_brand", F.when(F.col("p_size") > 25, F.col("p_type")).otherwise("  ").alias("p_type"))
    return merge.merge_optional(p, ["code"], ["p_brand", "p_type"])


def quote_reconcile(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders").where("o_custkey % 3 <> 0").select(F.col("o_custkey").alias("k")).distinct()
    c = adapters.table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"))
    return planning.image_check(o, c, ["k"])


def bar_validate(spark, sf_dir):
    b = _bars(spark, sf_dir)
    broken = b.withColumn("high", F.when(F.col("k") % 17 == 0, F.col("low") - 1).otherwise(F.col("high")))
    broken = broken.withColumn("volume", F.when(F.col("k") % 19 == 0, F.lit(-1.0)).otherwise(F.col("volume")))
    wild = F.when(F.col("k") % 41 == 0, float("nan")).when(F.col("k") % 43 == 0, float("inf")).otherwise(F.col("open"))
    broken = broken.withColumn("open", wild)
    return merge.bar_violations(broken).select(*KEY, "violations")


def _sma(rows):
    return ti.sma(rows, (20,)).select(*KEY, F.round("sma_20", 6).alias("sma_20"), F.col("close"))


def _features(spark, sf_dir):
    b = _bars(spark, sf_dir)
    f = _sma(b.select(*RAW)).join(b.select(*KEY, "k"), KEY)
    stored = f.where("k % 7 <> 0").select(*KEY, (F.col("sma_20") * F.when(F.col("k") % 5 == 0, 1 + 1e-12).otherwise(1.0)).alias("sma_20"), F.when(F.col("k") % 9 == 0, F.col("close") + 5).otherwise(F.col("close")).alias("close"))
    return f.where("k % 13 <> 0").select(*KEY, "sma_20", "close"), stored


def feature_merge(spark, sf_dir):
    incoming, stored = _features(spark, sf_dir)
    return merge.merge_features(incoming, stored, KEY, ["sma_20", "close"]).select(*KEY, F.round("sma_20", 5).alias("sma_20"), "close", "kind")


def float_equiv(spark, sf_dir):
    incoming, stored = _features(spark, sf_dir)
    j = incoming.alias("i").join(stored.alias("s"), KEY)
    return j.select(*KEY, equivalent(F.col("i.sma_20"), F.col("s.sma_20")).alias("same_sma"), equivalent(F.col("i.close"), F.col("s.close")).alias("same_close"))


def insert_absent(spark, sf_dir):
    c = adapters.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return merge.insert_absent(c.where("c_custkey % 2 = 0").withColumn("c_mktsegment", F.lit("NEW")), c.where("c_custkey % 3 = 0"), ["c_custkey"])


def listing_upsert(spark, sf_dir):
    c = adapters.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    new = c.where("c_custkey % 2 = 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 == 0, "UNKNOWN").when(F.col("c_custkey") % 10 == 0, F.lit(None)).otherwise("NEW"))
    return merge.upsert_known(new, c.where("c_custkey % 3 = 0"), ["c_custkey"], ["c_mktsegment"])


def _events(spark, sf_dir):
    return adapters.table(spark, sf_dir, "events")


def object_upsert(spark, sf_dir):
    return merge.latest(_events(spark, sf_dir).select("user_id", "event_type", "event_id", F.round("value", 6).alias("value")), ["user_id", "event_type"], "event_id")


def latest_per_key(spark, sf_dir):
    return merge.latest(_events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")


def latest_run(spark, sf_dir):
    return _events(spark, sf_dir).where("event_type = 'purchase'").orderBy(F.col("ts").desc_nulls_last(), F.desc("event_id")).limit(1).select("event_id", "user_id")


def keyset_page(spark, sf_dir):
    b = adapters.raw_bars(spark, sf_dir).select(*KEY, "close")
    after = (F.col("listing") > 3) | ((F.col("listing") == 3) & (F.col("trading_date") > F.lit("1995-06-30").cast("date")))
    return b.where(after).orderBy("listing", "trading_date").limit(500)


def scd2_history(spark, sf_dir):
    h = merge.symbol_history(_events(spark, sf_dir).select("user_id", "event_type", "event_id", F.col("event_id").alias("at")), "user_id", "event_type", "at", "event_id")
    return h


def _payload(spark, sf_dir):
    b = _bars(spark, sf_dir)
    n = F.row_number().over(Window.partitionBy("listing").orderBy("trading_date"))
    kept = b.withColumn("history_count", n).where((F.col("k") % 23 != 0) & (F.col("trading_date") < F.lit("1998-06-01").cast("date")) & (F.col("listing") != 24))
    return kept.select(*KEY, "open", F.when(F.col("k") % 29 == 0, F.col("high") + 1).otherwise(F.col("high")).alias("high"), "low", "close", "volume", F.when((F.col("listing") == 5) & (F.col("history_count") > 50), F.col("history_count") + 1).otherwise(F.col("history_count")).alias("history_count"), F.when(F.col("listing") % 8 == 0, "v0").otherwise("v1").alias("version"))


def state_comparison(spark, sf_dir):
    return planning.state_comparison(_bars(spark, sf_dir).select(*RAW), _payload(spark, sf_dir), "v1")


def _slots(spark, sf_dir):
    f = _sma(_bars(spark, sf_dir).select(*RAW))
    member = adapters.listings(spark, sf_dir).where("listing <> 7").select("listing", F.when(F.col("listing") % 3 == 0, "B").otherwise("A").alias("slot"))
    return f.where("listing % 4 <> 1"), f.where("listing % 4 <> 2").withColumn("close", F.col("close") + 1), member


def published_view(spark, sf_dir):
    return planning.published(*_slots(spark, sf_dir)).select(*KEY, "slot", "sma_20", "close")


def published_coverage(spark, sf_dir):
    return published_view(spark, sf_dir).groupBy("listing").agg(F.count("*").alias("rows"), F.count("sma_20").alias("populated"), F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"), F.concat_ws(",", F.sort_array(F.collect_set("slot"))).alias("slots"))


def published_freshness(spark, sf_dir):
    return published_view(spark, sf_dir).where("trading_date <= '1997-06-30'").groupBy("slot").agg(F.max("trading_date").alias("last_date"), F.count_distinct("listing").alias("listings"))


def slot_selection(spark, sf_dir):
    return planning.select_slots(adapters.listings(spark, sf_dir), _slots(spark, sf_dir)[2])


def candidate_image_check(spark, sf_dir):
    return planning.image_check(_bars(spark, sf_dir), published_view(spark, sf_dir), KEY)


def feature_ranking(spark, sf_dir):
    return planning.feature_ranking(_sma(_bars(spark, sf_dir).select(*RAW)), "sma_20")


def history_count(spark, sf_dir):
    return adapters.raw_bars(spark, sf_dir).select(*KEY, F.row_number().over(ti.series()).alias("history_count"))


def history_coverage(spark, sf_dir):
    return adapters.raw_bars(spark, sf_dir).groupBy("listing").agg((F.floor(F.count("*") / 50) * 50).alias("history")).groupBy("history").agg(F.count("*").alias("listings"))


def dimension_coverage(spark, sf_dir):
    b = adapters.bars(spark, sf_dir)
    parts = [b.groupBy(value.alias("value")).agg(F.count("*").alias("rows"), F.count_distinct("listing").alias("listings")).withColumn("dimension", F.lit(name)) for name, value in (("market", F.col("market")), ("ticker", F.col("ticker")), ("year", F.year("trading_date").cast("string")))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def report_summary(spark, sf_dir):
    rows, cov = published_view(spark, sf_dir), published_coverage(spark, sf_dir)
    a = rows.agg(F.count("*").alias("rows"), F.count("sma_20").alias("populated"), F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"))
    return a.crossJoin(F.broadcast(cov.agg(F.count("*").alias("listings"), F.max("rows").alias("longest"))))


def top_n_other(spark, sf_dir):
    return planning.top_and_other(adapters.table(spark, sf_dir, "part"), "p_brand", 8)


QUERIES = {f.__name__: f for f in (
    bar_compare, source_copy_drift, bar_derived, bar_upsert, recon_summary, dup_classify, symbol_merge, quote_reconcile, bar_validate, feature_merge, float_equiv, insert_absent, listing_upsert,
    object_upsert, latest_per_key, latest_run, keyset_page, scd2_history, state_comparison, published_view, published_coverage, published_freshness, slot_selection,
    candidate_image_check, feature_ranking, history_count, history_coverage, dimension_coverage, report_summary, top_n_other,
)}

_F = ", ".join(merge.BAR_FIELDS)
_BASE = f"""WITH {BARS_SQL}, k AS (SELECT listing, trading_date, {_F}, listing * 7 + dayofyear(trading_date) AS k FROM raw_bars),
stored AS (SELECT * EXCLUDE k FROM k WHERE k % 7 <> 0),
incoming AS (SELECT listing, trading_date, open, high, low, CASE WHEN k % 11 = 0 THEN high ELSE close END AS close, volume FROM k WHERE k % 13 <> 0)"""
_NAMES = "concat_ws(',', " + ", ".join(f"CASE WHEN i.{f} IS DISTINCT FROM s.{f} THEN '{f}' END" for f in merge.BAR_FIELDS) + ")"
_CMP = (
    f"{_BASE}, cmp AS (SELECT i.listing, i.trading_date, CASE WHEN s.there IS NULL THEN 'INSERTED' WHEN {_NAMES} <> '' THEN 'CORRECTED' "
    f"ELSE 'UNCHANGED' END AS kind, CASE WHEN s.there IS NULL THEN '' ELSE {_NAMES} END AS differing FROM incoming i LEFT JOIN (SELECT "
    f"*, true AS there FROM stored) s USING (listing, trading_date))"
)
_DER = ", ".join([
    "round(close - lag(close) OVER w, 8) AS change", "round((close - lag(close) OVER w) / nullif(lag(close) OVER w, 0), 8) AS changepct",
    "round((high + low + close) / 3, 8) AS typ", "round(high - low, 8) AS hl_range", "round(close - open, 8) AS oc_range",
])
_WIN = "WINDOW w AS (PARTITION BY listing ORDER BY trading_date)"
_SMA = (
    f"sma AS (SELECT listing, trading_date, close, k, round(CASE WHEN count(close) OVER z = 20 THEN avg(close) OVER z END, 6) AS sma_20 "
    f"FROM k WINDOW z AS (PARTITION BY listing ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"
)
_FM = f"""{_BASE}, {_SMA}, fs AS (SELECT listing, trading_date, sma_20 * CASE WHEN k % 5 = 0 THEN 1 + 1e-12 ELSE 1.0 END AS sma_20, CASE WHEN k % 9 = 0 THEN close + 5 ELSE close END AS close FROM sma WHERE k % 7 <> 0),
fi AS (SELECT listing, trading_date, sma_20, close FROM sma WHERE k % 13 <> 0)"""


def _eq(a, b):
    return f"coalesce(abs({a} - {b}) <= greatest(1e-12, 1e-10 * greatest(abs({a}), abs({b}))), {a} IS NULL AND {b} IS NULL)"


_STATE = f"""{_BASE}, n AS (SELECT *, row_number() OVER (PARTITION BY listing ORDER BY trading_date) AS n FROM k),
payload AS (SELECT listing, trading_date, open, CASE WHEN k % 29 = 0 THEN high + 1 ELSE high END AS high, low, close, volume, CASE WHEN
  listing = 5 AND n > 50 THEN n + 1 ELSE n END AS history_count, CASE WHEN listing % 8 = 0 THEN 'v0' ELSE 'v1' END AS version
  FROM n WHERE k % 23 <> 0 AND trading_date < DATE '1998-06-01' AND listing <> 24),
tail AS (SELECT listing, max(trading_date) AS payload_last FROM payload GROUP BY 1),
flags AS (SELECT n.listing, n.trading_date, payload_last, p.version IS NULL AND (payload_last IS NULL OR n.trading_date > payload_last) AS
  tail_append, coalesce(p.version IS NULL AND n.trading_date <= payload_last, false) AS missing,
  p.version IS NOT NULL AND (n.open, n.high, n.low, n.close, n.volume) IS DISTINCT FROM (p.open, p.high, p.low, p.close, p.volume) AS
    source_drift, coalesce(p.version IS NOT NULL AND history_count <> n, false) AS history_drift, coalesce(version <> 'v1', false) AS
    version_drift
  FROM n LEFT JOIN payload p USING (listing, trading_date) LEFT JOIN tail USING (listing)),
state AS (SELECT listing, count(*) AS source_bars, min(trading_date) AS source_first, max(trading_date) AS source_last, max(payload_last) AS payload_last, """ + ", ".join(f"count(*) FILTER ({r}) AS {r}, min(trading_date) FILTER ({r}) AS {r}_from" for r in planning.COMPARED) + " FROM flags GROUP BY 1)"
_PUB = f"""{_BASE}, {_SMA}, member AS (SELECT listing, CASE WHEN listing % 3 = 0 THEN 'B' ELSE 'A' END AS slot FROM listings WHERE listing <> 7),
pub AS (SELECT listing, trading_date, slot, sma_20, close FROM (SELECT listing, trading_date, 'A' AS slot, sma_20, close FROM sma WHERE
  listing % 4 <> 1 UNION ALL SELECT listing, trading_date, 'B', sma_20, close + 1 FROM sma WHERE listing % 4 <> 2) JOIN member USING
  (listing, slot)),
cover AS (SELECT listing, count(*) AS rows, count(sma_20) AS populated, min(trading_date) AS first_date, max(trading_date) AS last_date, string_agg(DISTINCT slot, ',') AS slots FROM pub GROUP BY 1)"""
SQL = {
    "bar_compare": f"{_CMP} SELECT * FROM cmp",
    "source_copy_drift": f"{_BASE} SELECT listing, count(*) AS drifted, min(trading_date) AS since FROM incoming i JOIN stored s USING (listing, trading_date) WHERE {_NAMES} <> '' GROUP BY 1",
    "bar_derived": f"{_BASE} SELECT listing, trading_date, {_DER} FROM stored {_WIN}",
    "bar_upsert": (
        f"{_BASE}, m AS (SELECT * FROM incoming UNION ALL SELECT * FROM stored ANTI JOIN incoming USING (listing, trading_date)) SELECT "
        f"listing, trading_date, close, volume, {_DER} FROM m {_WIN}"
    ),
    "recon_summary": f"{_CMP} SELECT count(*) FILTER (kind = 'INSERTED') AS inserted, count(*) FILTER (kind = 'CORRECTED') AS corrected, count(*) FILTER (kind = 'UNCHANGED') AS unchanged, " + ", ".join(f"count(*) FILTER (list_contains(string_split(differing, ','), '{f}')) AS {f}_differs" for f in merge.BAR_FIELDS) + " FROM cmp",
    "dup_classify": """WITH g AS (SELECT l_partkey, l_suppkey, count(*) AS n, concat_ws(',', CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'l_returnflag' END, CASE WHEN count(DISTINCT l_linestatus) > 1 THEN 'l_linestatus' END, CASE WHEN count(DISTINCT l_linenumber) > 1 THEN 'l_linenumber' END) AS differing FROM lineitem GROUP BY 1, 2)
        SELECT l_partkey, l_suppkey, n, CASE WHEN n = 1 THEN 'SINGLE' WHEN differing = '' THEN 'IDENTICAL' ELSE 'CONFLICT' END AS kind, differing FROM g""",
    "symbol_merge": """WITH p AS (SELECT p_partkey % 500 AS code, nullif(trim(p_brand), '') AS b, nullif(trim(CASE WHEN p_size > 25 THEN p_type ELSE '  ' END), '') AS t FROM part)
        SELECT code, CASE WHEN count(DISTINCT b) <= 1 THEN min(b) END AS p_brand, CASE WHEN count(DISTINCT t) <= 1 THEN min(t) END AS p_type,
          concat_ws(',', CASE WHEN count(DISTINCT b) > 1 THEN 'p_brand' END, CASE WHEN count(DISTINCT t) > 1 THEN 'p_type' END) AS conflicts FROM p
          GROUP BY 1""",
    "quote_reconcile": "WITH o AS (SELECT DISTINCT o_custkey AS k, 1 AS e FROM orders WHERE o_custkey % 3 <> 0), c AS (SELECT c_custkey AS k, 1 AS f FROM customer WHERE c_custkey % 5 <> 0) SELECT count(*) FILTER (e = 1 AND f = 1) AS \"both\", count(*) FILTER (f IS NULL) AS only_expected, count(*) FILTER (e IS NULL) AS only_found FROM o FULL JOIN c USING (k)",
    "bar_validate": f"""{_BASE}, b AS (SELECT listing, trading_date, CASE WHEN k % 41 = 0 THEN 'nan'::DOUBLE WHEN k % 43 = 0 THEN 'inf'::DOUBLE ELSE open END AS open, CASE WHEN k % 17 = 0 THEN low - 1 ELSE high END AS high, low, close, CASE WHEN k % 19 = 0 THEN -1 ELSE volume END AS volume FROM k),
        v AS (SELECT listing, trading_date, CASE WHEN NOT isfinite(open) THEN 'not_finite' ELSE concat_ws(',', CASE WHEN high < low OR high < open
          OR high < close THEN 'high_below' END, CASE WHEN low > open OR low > close THEN 'low_above' END, CASE WHEN volume < 0 THEN
          'negative_volume' END) END AS violations FROM b) SELECT * FROM v WHERE violations <> ''""",
    "feature_merge": f"""{_FM}, j AS (SELECT listing, trading_date, i.sma_20 AS ia, i.close AS ic, s.sma_20 AS sa, s.close AS sc, CASE WHEN i.close IS NULL THEN 'KEEP' WHEN s.close IS NULL THEN 'INSERT' WHEN {_eq('i.sma_20', 's.sma_20')} AND {_eq('i.close', 's.close')} THEN 'UNCHANGED' ELSE 'UPDATE' END AS kind FROM fi i FULL JOIN fs s USING (listing, trading_date))
        SELECT listing, trading_date, round(CASE WHEN kind IN ('INSERT', 'UPDATE') THEN ia ELSE sa END, 5) AS sma_20, CASE WHEN kind IN ('INSERT',
          'UPDATE') THEN ic ELSE sc END AS close, kind FROM j""",
    "float_equiv": f"{_FM} SELECT listing, trading_date, {_eq('i.sma_20', 's.sma_20')} AS same_sma, {_eq('i.close', 's.close')} AS same_close FROM fi i JOIN fs s USING (listing, trading_date)",
    "insert_absent": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'NEW' FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0",
    "listing_upsert": """WITH n AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'UNKNOWN' WHEN c_custkey % 10 = 0 THEN NULL ELSE 'NEW' END AS v FROM customer WHERE c_custkey % 2 = 0), s AS (SELECT c_custkey, c_mktsegment AS v FROM customer WHERE c_custkey % 3 = 0)
        SELECT c_custkey, coalesce(nullif(n.v, 'UNKNOWN'), s.v, n.v) AS c_mktsegment FROM n FULL JOIN s USING (c_custkey)""",
    "object_upsert": "SELECT user_id, event_type, max(event_id) AS event_id, round(arg_max(value, event_id), 6) AS value FROM events GROUP BY 1, 2",
    "latest_per_key": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1",
    "latest_run": "SELECT event_id, user_id FROM events WHERE event_type = 'purchase' ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 1",
    "keyset_page": f"WITH {BARS_SQL} SELECT listing, trading_date, close FROM raw_bars WHERE (listing, trading_date) > (3, DATE '1995-06-30') ORDER BY listing, trading_date LIMIT 500",
    "scd2_history": (
        "WITH c AS (SELECT user_id, event_type, event_id FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS "
        "b FROM events) WHERE b IS DISTINCT FROM event_type) SELECT user_id, event_type, event_id AS valid_from, lead(event_id) OVER "
        "(PARTITION BY user_id ORDER BY event_id) AS valid_to FROM c"
    ),
    "state_comparison": f"{_STATE} SELECT * FROM state",
    "published_view": f"{_PUB} SELECT * FROM pub",
    "published_coverage": f"{_PUB} SELECT * FROM cover",
    "published_freshness": f"{_PUB} SELECT slot, max(trading_date) AS last_date, count(DISTINCT listing) AS listings FROM pub WHERE trading_date <= DATE '1997-06-30' GROUP BY 1",
    "slot_selection": f"{_PUB} SELECT listing, CASE WHEN slot = 'A' THEN 'B' ELSE 'A' END AS write_slot FROM listings LEFT JOIN member USING (listing)",
    "candidate_image_check": f"{_PUB} SELECT count(*) FILTER (k.k IS NOT NULL AND p.slot IS NOT NULL) AS \"both\", count(*) FILTER (p.slot IS NULL) AS only_expected, count(*) FILTER (k.k IS NULL) AS only_found FROM k FULL JOIN pub p USING (listing, trading_date)",
    "feature_ranking": f"{_BASE}, {_SMA} SELECT listing, trading_date, sma_20 AS value FROM sma ORDER BY value DESC NULLS LAST, listing, trading_date LIMIT 12",
    "history_count": f"WITH {BARS_SQL} SELECT listing, trading_date, CAST(row_number() OVER (PARTITION BY listing ORDER BY trading_date) AS INTEGER) AS history_count FROM raw_bars",
    "history_coverage": f"WITH {BARS_SQL}, c AS (SELECT listing, CAST(count(*) // 50 * 50 AS BIGINT) AS history FROM raw_bars GROUP BY 1) SELECT history, count(*) AS listings FROM c GROUP BY 1",
    "dimension_coverage": (
        f"WITH {BARS_SQL} SELECT market AS value, count(*) AS rows, count(DISTINCT listing) AS listings, 'market' AS dimension FROM bars "
        f"GROUP BY 1 UNION ALL SELECT ticker, count(*), count(DISTINCT listing), 'ticker' FROM bars GROUP BY 1 UNION ALL SELECT "
        f"CAST(year(trading_date) AS VARCHAR), count(*), count(DISTINCT listing), 'year' FROM bars GROUP BY 1"
    ),
    "report_summary": (
        f"{_PUB} SELECT count(*) AS rows, count(sma_20) AS populated, min(trading_date) AS first_date, max(trading_date) AS last_date, "
        f"(SELECT count(*) FROM cover) AS listings, (SELECT max(rows) FROM cover) AS longest FROM pub"
    ),
    "top_n_other": (
        "WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1), k AS (SELECT p_brand FROM c ORDER BY n DESC, p_brand LIMIT 8) "
        "SELECT CASE WHEN p_brand IN (SELECT p_brand FROM k) THEN p_brand ELSE 'OTHER' END AS p_brand, CAST(sum(n) AS BIGINT) AS count "
        "FROM c GROUP BY 1"
    ),
}
