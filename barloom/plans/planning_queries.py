"""Registered planning, readiness and coverage queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import indicators as ti
from ..operators import planning, readiness
from ..operators.relative import COLUMNS as BENCHMARK
from ..sources import adapters
from ..sources.adapters import BARS_SQL
from . import feature_queries, merge_queries
from .merge_queries import _STATE

# ---- affected ranges ----

END, START, DRIFT, REBUILD = "1998-03-31", "1996-01-01", "1997-03-03", [3, 11, 18]


def affected_ranges(spark, sf_dir):
    """Ranges of listings, some inactive; some of those have no drift of their own."""
    x = F.col("listing")
    listings = adapters.listings(spark, sf_dir).select("listing", (x % 6 != 0).alias("active"), (F.col("market") != "AFRICA").alias("supported"))
    state, clean = merge_queries.state_comparison(spark, sf_dir), x % 12 == 0
    for r in planning.COMPARED:
        state = state.withColumns({r: F.when(clean, 0).otherwise(F.col(r)), f"{r}_from": F.when(~clean, F.col(f"{r}_from"))})
    return planning.affected_ranges(listings, state, END, START, DRIFT, REBUILD)


def _since(reason):
    if reason == "version_drift":
        return "CASE WHEN version_drift > 0 AND listing % 12 <> 0 THEN source_first END"
    if reason == "explicit_rebuild":
        return f"CASE WHEN listing IN ({', '.join(map(str, REBUILD))}) AND greatest(source_first, DATE '{START}') <= horizon THEN greatest(source_first, DATE '{START}') END"
    return f"CASE WHEN {reason} > 0 AND listing % 12 <> 0 AND {reason}_from <= horizon THEN {reason}_from END"


_OWN = [r for r in planning.REASONS if r != "benchmark_drift"]
_AFFECTED = f"""{_STATE}, h AS (SELECT state.*, least(DATE '{END}', source_last) AS horizon, listing % 6 <> 0 AS active, market <> 'AFRICA' AS supported FROM state JOIN listings USING (listing)),
d AS (SELECT *, {', '.join(f'{_since(r)} AS d_{r}' for r in _OWN)} FROM h WHERE horizon >= source_first),
o AS (SELECT *, coalesce({', '.join(f'd_{r}' for r in _OWN)}) IS NOT NULL AS other FROM d),
b AS (SELECT *, CASE WHEN supported AND source_first <= DATE '{DRIFT}'
  AND DATE '{DRIFT}' <= CASE WHEN active OR other THEN horizon WHEN payload_last IS NOT NULL THEN least(horizon, payload_last) END THEN DATE '{DRIFT}' END AS d_benchmark_drift FROM o),
w AS (SELECT *, least({', '.join(f'd_{r}' for r in planning.REASONS)}) AS write_start, CASE WHEN NOT active AND NOT other AND payload_last
  IS NOT NULL THEN least(horizon, payload_last) ELSE horizon END AS until FROM b),
e AS (SELECT *, least(CASE WHEN write_start <= payload_last THEN greatest(until, payload_last) ELSE until END, source_last) AS write_end FROM w)
SELECT listing, source_first AS calculation_start, write_start, write_end, concat_ws(',', {', '.join(f"CASE WHEN d_{r} IS NOT NULL THEN '{r}' END" for r in planning.REASONS)}) AS reasons
FROM e WHERE write_start <= write_end"""

# ---- source readiness ----

JOBS = {readiness.DAILY: "eoddata_daily", readiness.INDEX: "yahoo_daily"}
INDEX_LISTING = 4


def _runs(spark, sf_dir):
    """Runs of the two sources' jobs with evidence that is sometimes incomplete."""
    e, n = adapters.table(spark, sf_dir, "events"), F.col("event_id")
    day = F.date_add(F.lit("1995-01-01").cast("date"), (n * 7 % 600).cast("int"))
    rows = e.select(n, "ts", day.alias("effective_date"), F.when(F.col("event_type") == "purchase", JOBS["EODDATA"]).when(F.col("event_type") == "error", "other").otherwise(JOBS["YAHOO"]).alias("job"))
    text, outcome = F.col("effective_date").cast("string"), F.when(n % 10 == 3, "FAIL").when(n % 10 == 4, "WARN").otherwise("PASS")
    daily = F.concat(F.lit('{"provider_code":"EODDATA","effective_date":"'), text, F.lit('","failure_count":'), F.when(n % 3 == 0, "1").otherwise("0"), F.lit(',"missing_session_count":0,"report_outcome":"'), outcome, F.lit('"}'))
    tickers = F.when(n % 4 == 0, "[]").when(n % 4 == 1, '["SPX","X"]').when(n % 4 == 2, '["X"]').otherwise('"SPX"')
    index = F.concat(F.lit('{"provider_code":"YAHOO","source_code":"yahoo_daily","outcome":"succeeded","scope":{"effective_date":"'), text, F.lit('","tickers":'), tickers, F.lit('},"report_outcome":"'), outcome, F.lit('"}'))
    return rows.select(
        F.lpad(n.cast("string"), 9, "0").alias("run_id"), "job", "effective_date", F.when(n % 7 == 0, "failed").otherwise("succeeded").alias("status"),
        F.when(n % 11 != 0, F.col("ts").cast("timestamp")).alias("completed_at"), F.when(F.col("job") == JOBS["EODDATA"], daily).otherwise(index).alias("summary"),
    )


def source_readiness(spark, sf_dir):
    x, runs = F.col("listing"), _runs(spark, sf_dir)
    provider = F.when(x % 5 == 4, "YAHOO").when(x % 5 == 3, "STOOQ").otherwise("EODDATA")
    listings = adapters.listings(spark, sf_dir).where(x % 9 != 8).select("listing", provider.alias("provider"))
    return readiness.source_readiness(runs.select("effective_date"), listings, adapters.raw_bars(spark, sf_dir), runs, JOBS, INDEX_LISTING)


_RUNS = """runs AS (SELECT lpad(CAST(event_id AS VARCHAR), 9, '0') AS run_id, event_id AS n, CASE event_type WHEN 'purchase' THEN 'eoddata_daily' WHEN 'error' THEN 'other' ELSE 'yahoo_daily' END AS job,
  DATE '1995-01-01' + CAST(event_id * 7 % 600 AS INTEGER) AS effective_date, ts FROM events),
proof AS (SELECT effective_date, job, first(run_id ORDER BY ts DESC, run_id) AS run_id FROM runs
  WHERE n % 7 <> 0 AND n % 11 <> 0 AND n % 10 <> 3 AND ((job = 'eoddata_daily' AND n % 3 <> 0) OR (job = 'yahoo_daily' AND n % 4 IN (0, 1))) GROUP BY 1, 2)"""
_SOURCES = f"""WITH {BARS_SQL}, {_RUNS},
l AS (SELECT listing, CASE listing % 5 WHEN 4 THEN 'YAHOO' WHEN 3 THEN 'STOOQ' ELSE 'EODDATA' END AS provider FROM listings WHERE listing % 9 <> 8),
own AS (SELECT trading_date AS effective_date, count(*) AS bars, count(*) FILTER (provider <> 'YAHOO') AS supported_bars FROM raw_bars JOIN l USING (listing) GROUP BY 1),
r AS (SELECT d.effective_date, (SELECT count(*) FROM l) AS selected, (SELECT count(*) FROM l WHERE provider = 'EODDATA') AS eoddata, (SELECT count(*) FROM l WHERE provider = 'STOOQ') AS stooq,
  (SELECT count(*) FROM l WHERE provider = 'YAHOO') AS yahoo, coalesce(bars, 0) AS bars, coalesce(supported_bars, 0) AS supported_bars,
  d.effective_date IN (SELECT trading_date FROM raw_bars WHERE listing = {INDEX_LISTING}) AS benchmark_bar, a.run_id AS eoddata_run_id, b.run_id AS yahoo_run_id
  FROM (SELECT DISTINCT effective_date FROM runs) d LEFT JOIN own USING (effective_date)
  LEFT JOIN proof a ON a.effective_date = d.effective_date AND a.job = 'eoddata_daily' LEFT JOIN proof b ON b.effective_date = d.effective_date AND b.job = 'yahoo_daily'),
q AS (SELECT *, selected > 0 AS benchmark_required, eoddata > 0 AS eoddata_required, yahoo > 0 OR supported_bars > 0 AS yahoo_required FROM r),
s AS (SELECT *, concat_ws(',', CASE WHEN selected = 0 THEN 'NO_ELIGIBLE_LISTINGS' END, CASE WHEN eoddata_required AND eoddata_run_id IS NULL THEN 'EODDATA_SOURCE_EVIDENCE_MISSING' END,
  CASE WHEN yahoo_required AND yahoo_run_id IS NULL THEN 'YAHOO_SOURCE_EVIDENCE_MISSING' END, CASE WHEN supported_bars > 0 AND NOT benchmark_bar THEN 'SPX_COVERAGE_INCOMPLETE' END) AS reasons FROM q)
SELECT *, reasons = '' AS ready FROM s"""

# ---- model inputs ----

ON, VERSION, CONTRACT, MOST_ROWS = "1996-03-05", "V1", "B1", 25_000


def _scoped(spark, sf_dir):
    """Listings by market with their memberships: a fault or two in every market but one."""
    b, x, m = adapters.raw_bars(spark, sf_dir), F.col("listing"), F.col("market")
    own = b.groupBy("listing").agg(F.count("*").alias("source_count"), F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"), F.bool_or(F.col("trading_date") == ON).alias("has_bar"))
    rows = adapters.listings(spark, sf_dir).join(own, "listing").withColumns({"scope": m, "supported": m != "AFRICA", "on": F.lit(ON).cast("date")})
    member = (m != "EUROPE") | (x % 3 != 0)
    benchmark = F.when(F.col("supported"), F.lit(INDEX_LISTING))
    made = {
        "action": F.lit("PRESENT"), "slot": F.when(x % 2 == 0, "A").otherwise("B"), "status": F.when((m == "MIDDLE EAST") & (x % 2 == 0), "PREPARED").otherwise("PUBLISHED"),
        "calculation_version": F.when((m == "AMERICA") & (x % 2 == 1), "V0").otherwise(VERSION), "publication_version": F.lit(VERSION),
        "source_rows": F.col("source_count"), "payload_rows": F.col("source_count") + (m == "MIDDLE EAST").cast("int"), "coverage_start": F.col("first_date"), "coverage_end": F.col("last_date"),
        "benchmark_id": benchmark, "publication_benchmark_id": benchmark, "benchmark_required": F.lit(True), "contract_version": F.when(m == "EUROPE", "B0").otherwise(CONTRACT),
    }
    return rows.withColumns({name: F.when(member, value) for name, value in made.items()})


def model_input_reasons(spark, sf_dir):
    rows = _scoped(spark, sf_dir)
    drifted = rows.where("market = 'AFRICA' AND listing % 2 = 0").select("listing")
    given = F.when(F.col("scope") == "AMERICA", "YAHOO_SOURCE_EVIDENCE_MISSING,SPX_COVERAGE_INCOMPLETE").otherwise("")
    sources = rows.select("scope").distinct().unionByName(spark.createDataFrame([("NOWHERE",)], "scope string")).withColumn("reasons", given)
    return readiness.input_reasons(rows, drifted, sources, VERSION, F.lit(INDEX_LISTING), CONTRACT, MOST_ROWS)


def model_inputs(spark, sf_dir):
    rows = ti.sma(ti.returns(adapters.bars(spark, sf_dir))).withColumn("scope", F.col("market"))
    out = readiness.model_inputs(rows, ["return_1d_pct", "sma_20"], set(MINIMUM), F.lit(ON).cast("date"), model_input_reasons(spark, sf_dir))
    return out.select("scope", "listing", "trading_date", F.round("return_1d_pct", 8).alias("return_1d_pct"), F.round("sma_20", 6).alias("sma_20"))


_WITHHELD = f"""WITH {BARS_SQL}, own AS (SELECT market AS scope, count(*) FILTER (EXISTS (SELECT 1 FROM raw_bars b WHERE b.listing = l.listing AND trading_date = DATE '{ON}')) AS rows,
  bool_or(listing % 3 = 0) AS third, bool_or(listing % 2 = 0) AS even, bool_or(listing % 2 = 1) AS odd, bool_or(listing % 3 <> 0) AS member
    FROM listings l WHERE listing IN (SELECT listing FROM raw_bars) GROUP BY 1),
w AS (SELECT scope, rows, concat_ws(',', CASE WHEN scope = 'EUROPE' AND third THEN 'NO_ACTIVE_PUBLICATION' END, CASE WHEN scope = 'MIDDLE EAST' THEN 'COVERAGE_INCOMPLETE' END,
  CASE WHEN scope = 'AMERICA' AND odd THEN 'VERSION_MISMATCH' END, CASE WHEN scope = 'AMERICA' OR (scope = 'AFRICA' AND even) THEN
    'SOURCE_DRIFT' END, CASE WHEN scope = 'MIDDLE EAST' AND even THEN 'PUBLICATION_NOT_READY' END,
  CASE WHEN scope = 'EUROPE' AND member THEN 'BENCHMARK_MISMATCH' END, CASE WHEN scope = 'AMERICA' THEN 'SPX_COVERAGE_INCOMPLETE' END) AS reasons FROM own
  UNION ALL SELECT 'NOWHERE', 0, 'SCOPE_MISMATCH')"""
_INPUTS = f"""{_WITHHELD}, f AS (SELECT market AS scope, listing, trading_date, round(close / nullif(lag(close) OVER w, 0) - 1, 8) AS return_1d_pct,
  round(CASE WHEN count(close) OVER z = 20 THEN avg(close) OVER z END, 6) AS sma_20 FROM bars
  WINDOW w AS (PARTITION BY listing ORDER BY trading_date), z AS (PARTITION BY listing ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT f.* FROM f JOIN w USING (scope) WHERE reasons = '' AND trading_date = DATE '{ON}'"""

# ---- feature coverage ----

#: Observations that each feature needs.
MINIMUM = (
    {f"return_{n}d_pct": n + 1 for n in ti.RETURN_LAGS}
    | {"gap_1d_pct": 2}
    | dict.fromkeys(["intraday_return_1d_pct", "daily_range_pct", "close_location_1d", "dollar_volume", "consecutive_up_days", "consecutive_down_days", "rel_spx"], 1)
    | {f"{p}sma_{n}": n for p in ("", "pct_") for n in (20, 50, 200)}
    | {"ema_12": 12, "ema_26": 26}
    | {f"{p}ema_{n}": n for p in ("", "pct_") for n in (20, 50)}
    | {"sma_50_change_20d_pct": 70, "sma_200_change_20d_pct": 220, "pct_sma_20_vs_50": 50, "pct_sma_20_vs_200": 200, "pct_sma_50_vs_200": 200}
    | {f"{p}hh_{n}": n for p in ("", "pct_") for n in (20, 50, 252)}
    | {f"{p}ll_{n}": n for p in ("", "pct_") for n in (20, 50)}
    | dict.fromkeys(["rsi_14", "atr_14", "atr_pct_14", "plus_di_14", "minus_di_14"], 15)
    | {"adx_14": 28}
    | {"return_volatility_20d_pct": 21, "return_volatility_60d_pct": 61, "return_1d_zscore_20d": 22, "return_3d_zscore_20d": 24}
    | dict.fromkeys(["price_stddev_20", "bollinger_percent_b_20_2", "bollinger_bandwidth_20_2", "volume_avg_20", "dollar_volume_avg_20", "volume_ratio_20", "pct_rel_spx_20"], 20)
    | {"volume_avg_60": 60, "pct_rel_spx_50": 50}
    | dict.fromkeys(["macd_12_26", "macd_signal_12_26_9", "macd_histogram_12_26_9", "macd_12_26_pct", "macd_histogram_12_26_9_pct"], 34)
    | {f"relative_return_spx_{n}d_pct": n + 1 for n in (20, 63, 126, 252)}
    | {f"spx_{x}_{n}d": n + 1 for x in ("beta", "correlation") for n in (60, 252)}
)
#: Features that are there for every row after the warm-up.
GUARANTEED = {
    "sma_20", "sma_50", "sma_200", "ema_12", "ema_20", "ema_26", "ema_50", "hh_20", "hh_50", "hh_252", "ll_20", "ll_50", "rsi_14", "atr_14", "price_stddev_20", "plus_di_14", "minus_di_14", "adx_14",
    "macd_12_26", "macd_signal_12_26_9", "macd_histogram_12_26_9", "consecutive_up_days", "consecutive_down_days",
}
FAMILIES = {
    "returns": ["ti_returns", "ti_bar_structure"], "averages": ["ti_sma", "ti_ema", "ti_ma_trends"], "ranges": ["ti_ranges"], "momentum": ["ti_rsi", "ti_dmi", "ti_macd", "ti_streaks"],
    "volatility": ["ti_volatility", "ti_zscore", "ti_atr", "ti_bollinger"], "volume": ["ti_volume"], "benchmark": ["bm_ratio", "bm_relative_return", "bm_beta", "bm_correlation"],
}
FAMILY_OF = {f: family for family, groups in FAMILIES.items() for group in groups for f in feature_queries.DIGITS[group]}


def feature_coverage(spark, sf_dir):
    rows = feature_queries.features(spark, sf_dir).withColumns({"supported": F.col("market") != "AFRICA", "history_count": F.row_number().over(ti.series())})
    rows = rows.withColumns({c: F.when(F.col("supported"), F.col(c)) for c in BENCHMARK})
    return planning.feature_counts(rows, MINIMUM, set(BENCHMARK), GUARANTEED)


def family_coverage(spark, sf_dir):
    family = F.element_at(F.create_map(*[F.lit(x) for kv in FAMILY_OF.items() for x in kv]), F.col("feature"))
    sums = [F.sum(c).alias(c) for c in ("populated", "warm_up", "dependency", "unsupported", "unexpected")]
    return feature_coverage(spark, sf_dir).groupBy(family.alias("family")).agg(F.count("*").alias("features"), *sums)


def _covered(feature, minimum):
    on = "supported" if feature in BENCHMARK else "true"
    value = f"CASE WHEN {on} THEN {feature} END"
    lost = f"count(*) FILTER (({value}) IS NULL AND h >= {minimum})" if feature in GUARANTEED else "0"
    return f"count({value}) AS p_{feature}, count(*) FILTER (h < {minimum} AND {on}) AS w_{feature}, {lost} AS x_{feature}"


def _coverage_row(feature):
    unsupported = "n_unsupported" if feature in BENCHMARK else "CAST(0 AS BIGINT)"
    nulls = f"n - p_{feature}"
    return (
        f"SELECT '{feature}' AS feature, n AS eligible, p_{feature} AS populated, {nulls} AS nulls, w_{feature} AS warm_up, "
        f"{nulls} - w_{feature} - {unsupported} - x_{feature} AS dependency, {unsupported} AS unsupported, CAST(x_{feature} AS BIGINT) AS unexpected FROM c"
    )


_COVERED = f"""WITH f AS ({feature_queries.SQL['ti_features']}), r AS (SELECT f.*, row_number() OVER (PARTITION BY listing ORDER BY trading_date) AS h, r_name <> 'AFRICA' AS supported
  FROM f JOIN nation ON n_nationkey = listing JOIN region ON r_regionkey = n_regionkey),
c AS (SELECT count(*) AS n, count(*) FILTER (NOT supported) AS n_unsupported, {', '.join(_covered(f, n) for f, n in MINIMUM.items())} FROM r),
fc AS ({' UNION ALL '.join(map(_coverage_row, MINIMUM))})"""
_FAMILY = "CASE " + " ".join(f"WHEN feature = '{f}' THEN '{family}'" for f, family in FAMILY_OF.items()) + " END"

QUERIES = {f.__name__: f for f in (affected_ranges, source_readiness, model_input_reasons, model_inputs, feature_coverage, family_coverage)}
SQL = {
    "affected_ranges": _AFFECTED,
    "source_readiness": _SOURCES,
    "model_input_reasons": f"{_WITHHELD} SELECT * FROM w",
    "model_inputs": _INPUTS,
    "feature_coverage": f"{_COVERED} SELECT * FROM fc",
    "family_coverage": f"{_COVERED} SELECT {_FAMILY} AS family, count(*) AS features, "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("populated", "warm_up", "dependency", "unsupported", "unexpected"))
    + " FROM fc GROUP BY 1",
}
