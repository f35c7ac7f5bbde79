"""Registered entity, quality, text and nested-data queries with their SQL.

The star schema stands in for a security master: suppliers are issuers, parts
securities, and line items the observations of a provider.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import audit
from ..operators import entities as en
from ..sources.adapters import table


def _issuers(spark, sf_dir):
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("issuer"), F.when(k % 17 != 0, F.lpad((k % 90).cast("string"), 10, "0")).alias("cik"), F.concat(F.lit("Firm "), (k % 60).cast("string"), F.when(k % 3 == 0, ", Inc.").when(k % 3 == 1, " CORP").otherwise(" Holdings")).alias("name"))


def _securities(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("security"), (k % 100).alias("issuer"), F.concat(F.lit("T"), (k % 150).cast("string")).alias("ticker"))


def _listings(spark, sf_dir):
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k.alias("security"), "p_size")
    one = p.select((k := F.col("security") * 10).alias("listing"), "security", F.concat(F.lit("X"), (F.col("p_size") % 7).cast("string")).alias("exchange"), (F.col("p_size") % 5 != 0).alias("active"))
    two = p.where("security % 50 = 0").select((k + 1).alias("listing"), "security", F.concat(F.lit("X"), (F.col("p_size") % 7).cast("string")).alias("exchange"), F.lit(True).alias("active"))
    return one.unionByName(two)


def _symbols(spark, sf_dir):
    own = _listings(spark, sf_dir).where("listing % 70 <> 0").select("listing", F.concat(F.lit("S"), F.col("listing").cast("string")).alias("symbol"))
    return own.unionByName(own.where("listing % 110 = 0").withColumn("symbol", F.concat("symbol", F.lit("B"))))


def _observations(spark, sf_dir):
    s, p, n = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + n).alias("observation"), s.alias("issuer"), p.alias("security"), F.lpad(((s + (n == 7).cast("int")) % 90).cast("string"), 10, "0").alias("cik"),
        F.concat(F.lit("T"), ((p + (n == 6).cast("int")) % 150).cast("string")).alias("ticker"), F.concat(F.when(n == 2, "x").otherwise("X"), (p % 9).cast("string")).alias("raw_exchange"),
        F.when(n != 5, p * 10).alias("listing"), F.to_date("l_shipdate").alias("seen"), n.alias("run"),
    )


def _aliases(spark):
    return spark.createDataFrame([(f"X{i}", f"X{i}") for i in range(5)] + [("x7", "X0")], "alias string, exchange string")


def _codes(spark):
    return spark.createDataFrame([(f"X{i}",) for i in range(7)], "exchange string")


def _resolved(spark, sf_dir):
    return en.resolve_alias(_observations(spark, sf_dir), "raw_exchange", _aliases(spark), _codes(spark))


def _conflict(name, severity, build):
    def query(spark, sf_dir):
        return build(spark, sf_dir, f"conflict_{name}", severity)

    query.__name__ = f"conflict_{name}"
    return query


def _cik_name_variants(spark, sf_dir, name, severity):
    rows = _issuers(spark, sf_dir).where("cik IS NOT NULL").withColumn("plain", text.normalized_name(F.col("name")))
    g = rows.groupBy("cik").agg(F.count_distinct("name").alias("n"), F.count_distinct("plain").alias("m")).where("n > 1")
    return g.select(F.lit(name).alias("conflict"), F.when(F.col("m") > 1, "WARN").otherwise("INFO").alias("severity"), F.col("cik").alias("key"), "n", F.lit("").alias("sample"))


def _active(spark, sf_dir):
    return _listings(spark, sf_dir).where("active")


def _active_named(spark, sf_dir):
    return _active(spark, sf_dir).join(_securities(spark, sf_dir), "security")


CONFLICTS = {
    "cik_identifier_multiple_issuers": ("FAIL", lambda s, d, n, v: en.many_targets(_issuers(s, d).where("cik IS NOT NULL"), ["cik"], "issuer", n, v)),
    "issuer_missing_cik_from_sec_evidence": ("WARN", lambda s, d, n, v: en.mismatch(_issuers(s, d).where("cik IS NULL").withColumn("none", F.lit("none")), _observations(s, d).select("issuer", F.col("cik").alias("seen_cik")), ["issuer"], "none", "seen_cik", ["issuer"], n, v)),
    "observation_cik_issuer_identifier_mismatch": ("WARN", lambda s, d, n, v: en.mismatch(_observations(s, d).select("issuer", F.col("cik").alias("seen_cik")), _issuers(s, d).select("issuer", F.col("cik").alias("own_cik")), ["issuer"], "own_cik", "seen_cik", ["issuer"], n, v)),
    "same_issuer_ticker_multiple_securities": ("WARN", lambda s, d, n, v: en.many_targets(_securities(s, d), ["issuer", "ticker"], "security", n, v)),
    "ticker_exchange_multiple_securities": ("FAIL", lambda s, d, n, v: en.many_targets(_active_named(s, d), ["ticker", "exchange"], "security", n, v)),
    "ticker_exchange_multiple_issuers": ("WARN", lambda s, d, n, v: en.many_targets(_active_named(s, d), ["ticker", "exchange"], "issuer", n, v)),
    "observation_ticker_security_identifier_mismatch": ("WARN", lambda s, d, n, v: en.mismatch(_observations(s, d).select("security", F.col("ticker").alias("seen_ticker")), _securities(s, d).select("security", F.col("ticker").alias("own_ticker")), ["security"], "own_ticker", "seen_ticker", ["security"], n, v)),
    "ticker_exchange_multiple_active_listings": ("FAIL", lambda s, d, n, v: en.many_targets(_active_named(s, d), ["ticker", "exchange"], "listing", n, v)),
    "security_exchange_multiple_active_listings": ("WARN", lambda s, d, n, v: en.many_targets(_active(s, d), ["security", "exchange"], "listing", n, v)),
    "active_listing_missing_current_symbol": ("WARN", lambda s, d, n, v: en.absent(_active(s, d), _symbols(s, d), ["listing"], ["listing"], n, v)),
    "listing_multiple_current_symbols": ("WARN", lambda s, d, n, v: en.many_targets(_symbols(s, d), ["listing"], "symbol", n, v)),
    "cik_name_variants": ("WARN", _cik_name_variants),
    "unknown_exchange_mapping": ("WARN", lambda s, d, n, v: en.absent(_observations(s, d).withColumn("k", F.lower("raw_exchange")), _aliases(s).select(F.lower("alias").alias("k")), ["k"], ["raw_exchange"], n, v)),
    "listing_exchange_observation_disagreement": ("WARN", lambda s, d, n, v: en.mismatch(_resolved(s, d).where("exchange IS NOT NULL").select("listing", F.col("exchange").alias("seen_exchange")), _listings(s, d).select("listing", F.col("exchange").alias("own_exchange")), ["listing"], "own_exchange", "seen_exchange", ["listing"], n, v)),
    "security_current_sec_multiple_exchanges": ("INFO", lambda s, d, n, v: en.many_targets(_listings(s, d).join(_securities(s, d), "security"), ["issuer", "ticker"], "exchange", n, v)),
    "exchange_observation_missing_listing_evidence": ("WARN", lambda s, d, n, v: en.absent(_observations(s, d).where("run >= 5"), _listings(s, d), ["listing"], ["security"], n, v)),
    "evidence_missing_target_rows": ("FAIL", lambda s, d, n, v: en.absent(_observations(s, d).where("listing IS NOT NULL"), _active(s, d), ["listing"], ["listing"], n, v)),
    "observation_multiple_targets": ("WARN", lambda s, d, n, v: en.many_targets(_observations(s, d), ["security", "seen"], "issuer", n, v)),
}
QUERIES = {f"conflict_{k}": _conflict(k, v, b) for k, (v, b) in CONFLICTS.items()}


def _all_conflicts(spark, sf_dir):
    out = None
    for q in QUERIES_CONFLICT.values():
        found = q(spark, sf_dir)
        out = found if out is None else out.unionByName(found)
    return out


QUERIES_CONFLICT = dict(QUERIES)


def severity_rollup(spark, sf_dir):
    return en.severity_rollup(_all_conflicts(spark, sf_dir))


def alias_resolve(spark, sf_dir):
    return _resolved(spark, sf_dir).groupBy("raw_exchange", "exchange").agg(F.count("*").alias("n"))


def unmapped_values(spark, sf_dir):
    return _resolved(spark, sf_dir).where("exchange IS NULL").select("raw_exchange").distinct()


def missing_evidence(spark, sf_dir):
    return _securities(spark, sf_dir).join(_observations(spark, sf_dir).where("run = 7"), "security", "left_anti").select("security")


def run_scope_semi(spark, sf_dir):
    """Observations of a run by any of three keys: a union of equi semi-joins, each row once."""
    o = _observations(spark, sf_dir).select("observation", "issuer", "security", "run")
    keys = [o.where("run = 7 AND issuer % 40 = 0").select("issuer").distinct(), o.where("run = 7 AND security % 300 = 0").select("security").distinct()]
    parts = [o.join(k, k.columns[0], "left_semi").select("observation") for k in keys] + [o.where("observation % 1000 = 1").select("observation")]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


def unreconciled_obs(spark, sf_dir):
    o = _observations(spark, sf_dir).where("run <= 2").select("observation", "security", "seen")
    e = _observations(spark, sf_dir).where("run = 3").select("security", F.col("seen").alias("evidence_at"))
    return o.join(e, (o.security == e.security) & (e.evidence_at >= o.seen), "left_anti").select("observation")


def orphans(spark, sf_dir):
    o = _observations(spark, sf_dir)
    j = o.join(_issuers(spark, sf_dir).where("issuer % 19 <> 0").select("issuer", F.lit(1).alias("i")), "issuer", "left").join(_active(spark, sf_dir).select("listing", F.lit(1).alias("l")), "listing", "left")
    return j.where("i IS NULL OR (listing IS NOT NULL AND l IS NULL)").groupBy("run").agg(F.count("*").alias("orphans"))


def id_mismatch(spark, sf_dir):
    return QUERIES_CONFLICT["conflict_observation_cik_issuer_identifier_mismatch"](spark, sf_dir).select("key", "n")


def ticker_mismatch(spark, sf_dir):
    """Securities of whose observed tickers none is their own."""
    j = _observations(spark, sf_dir).where("run >= 6").select("security", F.col("ticker").alias("seen")).join(_securities(spark, sf_dir), "security")
    return j.groupBy("security").agg(F.bool_or(F.col("seen") == F.col("ticker")).alias("any"), F.count("*").alias("n")).where("NOT any").select("security", "n")


def successor_asof(spark, sf_dir):
    """The issuer relation in force when an observation was seen: latest effective date wins."""
    o = _observations(spark, sf_dir).where("run = 1").select("observation", "issuer", "seen").distinct()
    rel = _issuers(spark, sf_dir).select("issuer", F.explode(F.array(*[F.struct(F.lit(f"{y}-01-01").cast("date").alias("effective"), F.lit(y).alias("successor")) for y in (1995, 1997, 1999)])).alias("r")).select("issuer", "r.*")
    key = ["observation", "issuer", "seen"]
    found = o.join(rel, "issuer").where("effective <= seen").groupBy(*key).agg(F.max_by("successor", "effective").alias("successor"))
    return o.join(found, key, "left").select(*key, "successor")


def entity_counts(spark, sf_dir):
    return _observations(spark, sf_dir).agg(*[F.count_distinct(c).alias(c) for c in ("issuer", "security", "listing", "cik", "ticker", "raw_exchange")])


def market_snapshot(spark, sf_dir):
    return _active_named(spark, sf_dir).groupBy("exchange").agg(F.count_distinct("issuer").alias("issuers"), F.count_distinct("security").alias("securities"), F.count_distinct("listing").alias("listings"), F.count_distinct(F.when(F.col("issuer") % 2 == 0, F.col("security"))).alias("even_securities"))


def coverage_sets(spark, sf_dir):
    o = _observations(spark, sf_dir)
    return o.groupBy("security").agg(F.concat_ws(",", F.sort_array(F.collect_set("raw_exchange"))).alias("exchanges"), F.concat_ws(",", F.sort_array(F.collect_set(F.when(F.col("run") >= 6, F.col("cik"))))).alias("late_ciks"))


def nested_children(spark, sf_dir):
    """Ordered child lists as JSON text."""
    o = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return o.groupBy("l_orderkey").agg(F.to_json(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"))))).alias("children"))


def evidence_derive(spark, sf_dir):
    o = _observations(spark, sf_dir)
    return o.groupBy("security").agg(
        F.bool_or(F.lpad((F.col("issuer") % 90).cast("string"), 10, "0") == F.col("cik")).alias("cik_match"), (F.count_distinct("ticker") == 1).alias("ticker_stable"), (F.count_distinct(F.upper("raw_exchange")) == 1).alias("exchange_stable"),
        F.count_distinct("seen").alias("n_snapshots"), F.datediff(F.max("seen"), F.min("seen")).cast("long").alias("span_days"), (F.count_distinct("cik") - 1 > 20).cast("int").alias("conflicts"),
    ).withColumnRenamed("security", "subject")


def confidence_score(spark, sf_dir):
    return en.confidence(evidence_derive(spark, sf_dir), 3, 30)


def entity_resolve(spark, sf_dir):
    """Issuer of an observed CIK: the earliest created of those that own it; last seen only grows."""
    o = _observations(spark, sf_dir).groupBy("cik").agg(F.max("seen").alias("last_seen"))
    own = _issuers(spark, sf_dir).where("cik IS NOT NULL").groupBy("cik").agg(F.min("issuer").alias("issuer"))
    return o.join(own, "cik", "left").select("cik", "issuer", F.greatest("last_seen", F.lit("1999-01-01").cast("date")).alias("last_seen"))


def listing_resolve(spark, sf_dir):
    """A ticker change on a listing with an active symbol is blocked; new listings are created."""
    i = _observations(spark, sf_dir).where("run = 6 AND listing IS NOT NULL").groupBy("listing").agg(F.min("ticker").alias("ticker"))
    known = _active(spark, sf_dir).join(_securities(spark, sf_dir), "security").select("listing", F.col("ticker").alias("own"))
    kind = F.when(F.col("own").isNull(), "CREATE").when(F.col("own") == F.col("ticker"), "SAME").otherwise("BLOCKED")
    return i.join(known, "listing", "left").select("listing", kind.alias("decision"))


def _dq(spark, sf_dir):
    i, o = _issuers(spark, sf_dir), _observations(spark, sf_dir)
    a = i.agg(F.count(F.when(F.col("cik").isNull(), 1)).alias("missing_cik"), F.count(F.when(F.trim("name") == "", 1)).alias("missing_name"))
    b = o.agg(F.count(F.when(F.col("listing").isNull(), 1)).alias("missing_listing"), F.count(F.when(F.col("seen") > F.lit("2001-06-01").cast("date"), 1)).alias("late"))
    return a.crossJoin(F.broadcast(b))


def dq_counters(spark, sf_dir):
    return _dq(spark, sf_dir)


def dq_findings(spark, sf_dir):
    return en.findings(_dq(spark, sf_dir), {"missing_cik": "WARN", "missing_name": "FAIL", "missing_listing": "WARN", "late": "FAIL"})


def snapshot_diff(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("at")).agg(F.count("*").alias("size"))
    return en.snapshot_diff(e.select(F.col("event_type").alias("source"), "at", (F.col("size") % 3).alias("sha"), "size"))


def entity_deltas(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderstatus", F.to_date("o_orderdate").alias("d"))
    return o.groupBy("o_orderstatus").agg(F.count(F.when(F.col("d").between(F.lit("1996-01-01").cast("date"), F.lit("1996-03-31").cast("date")), 1)).alias("created"), F.count(F.when(F.col("d") < F.lit("1996-01-01").cast("date"), 1)).alias("before"))


def zero_delta(spark, sf_dir):
    reason = F.when(F.col("created") > 0, "HAS_DELTA").when(F.col("before") == 0, "NEVER_SEEN").otherwise("NO_CHANGE")
    return entity_deltas(spark, sf_dir).select("o_orderstatus", reason.alias("reason"))


def expired_objects(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("created"))
    return o.where((F.date_add("created", 365) < F.lit("1996-06-01").cast("date")) & (F.col("o_orderkey") > 100)).orderBy("o_orderkey").limit(200).select("o_orderkey")


def json_evidence(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "props")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", k.cast("long").alias("k"), F.get_json_object("props", "$.absent").isNull().alias("absent"), F.json_object_keys("props").getItem(0).alias("first_key"))


def normalize_symbol(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" "))
    return p.select("p_partkey", text.normalized_symbol(raw).alias("symbol"), text.padded_cik(F.col("p_partkey")).alias("cik"))


def name_variants(spark, sf_dir):
    return _issuers(spark, sf_dir).groupBy(text.normalized_name(F.col("name")).alias("plain")).agg(F.count_distinct("name").alias("variants"), F.count("*").alias("n"))


def row_hash(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.row_hash("p_partkey", "p_brand", "p_size").alias("hash"))


def duration_parse(spark, sf_dir):
    k = F.col("o_orderkey")
    made = F.when(k % 5 == 0, F.concat(F.lit("PT"), (k % 70).cast("string"), F.lit("S"))).when(k % 5 == 1, F.concat(F.lit("P"), (k % 3).cast("string"), F.lit("DT"), (k % 24).cast("string"), F.lit("H"), (k % 60).cast("string"), F.lit("M"))).when(k % 5 == 2, "PT").otherwise(F.concat(F.lit("PT"), (k % 9).cast("string"), F.lit("H")))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.duration_seconds(made).alias("seconds")).withColumn("clock", text.clock(F.col("seconds")))


def friendly_name(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.friendly_name(F.col("text")).alias("name"))


def provenance_merge(spark, sf_dir):
    """Events merged by user: the newest, and every origin once in the order in which it was first seen."""
    e = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"), F.count("*").alias("n"))
    origins = F.transform(F.array_sort(F.collect_list(F.struct("first", "event_type"))), lambda x: x["event_type"])
    return e.groupBy("user_id").agg(F.max("last").alias("newest"), F.concat_ws(",", origins).alias("origins"), F.sum("n").alias("n"))


def evidence_coverage(spark, sf_dir):
    """Evidence by the first of its targets, and observations that have evidence for each target."""
    o = _observations(spark, sf_dir)
    kept = {"listing": F.col("run") % 4 != 1, "security": F.col("run") % 3 != 1, "issuer": F.col("run") % 2 == 0}
    e = o.select("observation", *[F.when(rule, F.col(c)).alias(c) for c, rule in kept.items()])
    return en.evidence_coverage(e, list(kept))


def audit_inserts(spark, sf_dir):
    """What a reconciliation of bars writes to the audit, counted by action and field; a second run adds nothing."""
    from .merge_queries import _incoming, _stored

    rows = audit.audit_rows(_incoming(spark, sf_dir), _stored(spark, sf_dir), ["listing", "trading_date"], ["open", "close"], "r1", "bar")
    again = audit.append_absent(rows, rows)
    return rows.groupBy("action", "field").agg(F.count_distinct("audit_id").alias("entries")).unionByName(again.groupBy("action", "field").agg(F.count("*").alias("entries")))


def nested_regroup(spark, sf_dir):
    """Values by user and day as ordered nested JSON."""
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type")
    return e.groupBy("user_id", "day").agg(F.to_json(F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("e"), F.col("event_type").alias("t"))))).alias("items"))


TYPES = ["click", "purchase", "signup", "view"]


def provider_pivot(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", TYPES).agg(F.count(F.lit(1))).na.fill(0)


def outcome_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    n = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("returned"))
    return o.join(n, "o_orderkey", "left")


def success_rate(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("good"), F.count(F.when(F.col("o_orderstatus").isin("F", "O"), 1)).alias("n"))
    rate = F.round(F.coalesce(F.col("good") / F.nullif("n", F.lit(0)), F.lit(1.0)), 6)
    return o.select("o_orderpriority", rate.alias("rate"), (rate >= 0.5).alias("passed"))


def lenient_filter(spark, sf_dir):
    """Filters that unknown values pass."""
    p = table(spark, sf_dir, "part").withColumn("size", F.when(F.col("p_partkey") % 4 != 0, F.col("p_size")))
    return p.where(F.coalesce(F.col("size") >= 20, F.lit(True))).select("p_partkey", "size")


def scope_filter(spark, sf_dir):
    from ..sources.adapters import bars

    return bars(spark, sf_dir).where(F.col("market").isin("ASIA", "EUROPE") & F.col("trading_date").between(F.lit("1996-01-01").cast("date"), F.lit("1996-06-30").cast("date")) & (F.col("listing") != 8)).select("listing", "trading_date", "close")


def eligible_listings(spark, sf_dir):
    """Listings of any of three provider cohorts."""
    from ..sources.adapters import listings

    x = F.col("listing")
    return listings(spark, sf_dir).where((F.upper(F.trim("market")) == "ASIA") | ((x % 3 == 0) & (F.col("market") != "AFRICA")) | x.isin(1, 2)).select("listing", "market")


def subject_support(spark, sf_dir):
    from ..sources.adapters import listings

    return listings(spark, sf_dir).select("listing", F.col("market").isin("AMERICA", "EUROPE").alias("supported"))


def resolve_benchmark(spark, sf_dir):
    """The one active row of a type; more or none is an error."""
    from ..sources.adapters import listings

    found = listings(spark, sf_dir).where("listing % 25 = 3").groupBy("market").agg(F.count("*").alias("n"), F.min("listing").alias("listing"))
    return found.select("market", F.when(F.col("n") == 1, F.col("listing")).otherwise(F.raise_error(F.lit("benchmark is not unique"))).cast("int").alias("listing"))


QUERIES |= {f.__name__: f for f in (
    severity_rollup, alias_resolve, unmapped_values, missing_evidence, run_scope_semi, unreconciled_obs, orphans, id_mismatch, ticker_mismatch, successor_asof, entity_counts, market_snapshot,
    coverage_sets, nested_children, evidence_derive, confidence_score, entity_resolve, listing_resolve, dq_counters, dq_findings, snapshot_diff, entity_deltas, zero_delta, expired_objects, json_evidence, normalize_symbol,
    name_variants, row_hash, duration_parse, friendly_name, provenance_merge, evidence_coverage, audit_inserts, nested_regroup, provider_pivot, outcome_join, success_rate, lenient_filter, scope_filter, eligible_listings, subject_support, resolve_benchmark,
)}

_B = """issuers AS (SELECT s_suppkey AS issuer, CASE WHEN s_suppkey % 17 <> 0 THEN lpad(CAST(s_suppkey % 90 AS VARCHAR), 10, '0') END AS cik, 'Firm ' || (s_suppkey % 60) || CASE s_suppkey % 3 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' CORP' ELSE ' Holdings' END AS name FROM supplier),
securities AS (SELECT p_partkey AS security, p_partkey % 100 AS issuer, 'T' || (p_partkey % 150) AS ticker FROM part),
lst AS (SELECT p_partkey * 10 AS listing, p_partkey AS security, 'X' || (p_size % 7) AS exchange, p_size % 5 <> 0 AS active FROM part UNION
  ALL SELECT p_partkey * 10 + 1, p_partkey, 'X' || (p_size % 7), true FROM part WHERE p_partkey % 50 = 0),
act AS (SELECT * FROM lst WHERE active), named AS (SELECT * FROM act JOIN securities USING (security)),
sym0 AS (SELECT listing, 'S' || listing AS symbol FROM lst WHERE listing % 70 <> 0), sym AS (SELECT * FROM sym0 UNION ALL SELECT listing, symbol || 'B' FROM sym0 WHERE listing % 110 = 0),
obs AS (SELECT l_orderkey * 10 + l_linenumber AS observation, l_suppkey AS issuer, l_partkey AS security, lpad(CAST((l_suppkey + CASE WHEN
  l_linenumber = 7 THEN 1 ELSE 0 END) % 90 AS VARCHAR), 10, '0') AS cik,
  'T' || ((l_partkey + CASE WHEN l_linenumber = 6 THEN 1 ELSE 0 END) % 150) AS ticker, CASE WHEN l_linenumber = 2 THEN 'x' ELSE 'X' END ||
    (l_partkey % 9) AS raw_exchange, CASE WHEN l_linenumber <> 5 THEN l_partkey * 10 END AS listing, CAST(l_shipdate AS DATE) AS seen,
    l_linenumber AS run FROM lineitem),
res AS (SELECT *, CASE WHEN lower(raw_exchange) IN ('x0', 'x1', 'x2', 'x3', 'x4', 'x5', 'x6') THEN upper(raw_exchange) WHEN lower(raw_exchange) = 'x7' THEN 'X0' END AS exchange FROM obs)"""


def _many(source, key, target, name, severity, where="true"):
    k = " || '|' || ".join(key)
    return (
        f"SELECT 'conflict_{name}' AS conflict, '{severity}' AS severity, CAST({k} AS VARCHAR) AS key, count(DISTINCT {target}) AS n, "
        f"array_to_string(list_sort(list(DISTINCT {target}))[1:3], ',') AS sample FROM {source} WHERE {target} IS NOT NULL AND {where} "
        f"GROUP BY {', '.join(key)} HAVING count(DISTINCT {target}) > 1"
    )


def _differ(source, a, b, key, name, severity):
    return (
        f"SELECT 'conflict_{name}' AS conflict, '{severity}' AS severity, CAST({key} AS VARCHAR) AS key, count(*) AS n, min({a} || '<>' || "
        f"{b}) AS sample FROM {source} WHERE {a} <> {b} GROUP BY {key}"
    )


def _lost(source, key, name, severity):
    return f"SELECT 'conflict_{name}' AS conflict, '{severity}' AS severity, CAST({key} AS VARCHAR) AS key, count(*) AS n, '' AS sample FROM {source} GROUP BY {key}"


_BARE = "regexp_replace(lower(trim(name)), '[^a-z0-9]+', ' ', 'g')"
_PLAIN = rf"nullif(trim(regexp_replace({_BARE}, '\b(?:{'|'.join(text.LEGAL_WORDS)})\b', '', 'g')), '')"
_C = {
    "cik_identifier_multiple_issuers": _many("issuers", ["cik"], "issuer", "cik_identifier_multiple_issuers", "FAIL", "cik IS NOT NULL"),
    "issuer_missing_cik_from_sec_evidence": _differ("(SELECT issuer, 'none' AS a, o.cik AS b FROM issuers i JOIN obs o USING (issuer) WHERE i.cik IS NULL)", "a", "b", "issuer", "issuer_missing_cik_from_sec_evidence", "WARN"),
    "observation_cik_issuer_identifier_mismatch": _differ("(SELECT issuer, i.cik AS a, o.cik AS b FROM issuers i JOIN obs o USING (issuer))", "a", "b", "issuer", "observation_cik_issuer_identifier_mismatch", "WARN"),
    "same_issuer_ticker_multiple_securities": _many("securities", ["issuer", "ticker"], "security", "same_issuer_ticker_multiple_securities", "WARN"),
    "ticker_exchange_multiple_securities": _many("named", ["ticker", "exchange"], "security", "ticker_exchange_multiple_securities", "FAIL"),
    "ticker_exchange_multiple_issuers": _many("named", ["ticker", "exchange"], "issuer", "ticker_exchange_multiple_issuers", "WARN"),
    "observation_ticker_security_identifier_mismatch": _differ("(SELECT security, s.ticker AS a, o.ticker AS b FROM securities s JOIN obs o USING (security))", "a", "b", "security", "observation_ticker_security_identifier_mismatch", "WARN"),
    "ticker_exchange_multiple_active_listings": _many("named", ["ticker", "exchange"], "listing", "ticker_exchange_multiple_active_listings", "FAIL"),
    "security_exchange_multiple_active_listings": _many("act", ["security", "exchange"], "listing", "security_exchange_multiple_active_listings", "WARN"),
    "active_listing_missing_current_symbol": _lost("(SELECT listing FROM act ANTI JOIN sym USING (listing))", "listing", "active_listing_missing_current_symbol", "WARN"),
    "listing_multiple_current_symbols": _many("sym", ["listing"], "symbol", "listing_multiple_current_symbols", "WARN"),
    "cik_name_variants": (
        f"SELECT 'conflict_cik_name_variants' AS conflict, CASE WHEN count(DISTINCT {_PLAIN}) > 1 THEN 'WARN' ELSE 'INFO' END AS severity, "
        f"cik AS key, count(DISTINCT name) AS n, '' AS sample FROM issuers WHERE cik IS NOT NULL GROUP BY cik HAVING count(DISTINCT name) > "
        f"1"
    ),
    "unknown_exchange_mapping": _lost("(SELECT raw_exchange FROM obs WHERE lower(raw_exchange) NOT IN ('x0', 'x1', 'x2', 'x3', 'x4', 'x7'))", "raw_exchange", "unknown_exchange_mapping", "WARN"),
    "listing_exchange_observation_disagreement": _differ("(SELECT listing, l.exchange AS a, r.exchange AS b FROM lst l JOIN res r USING (listing) WHERE r.exchange IS NOT NULL)", "a", "b", "listing", "listing_exchange_observation_disagreement", "WARN"),
    "security_current_sec_multiple_exchanges": _many("(SELECT s.issuer, s.ticker, l.exchange FROM lst l JOIN securities s USING (security))", ["issuer", "ticker"], "exchange", "security_current_sec_multiple_exchanges", "INFO"),
    "exchange_observation_missing_listing_evidence": _lost("(SELECT security FROM obs ANTI JOIN lst USING (listing) WHERE run >= 5)", "security", "exchange_observation_missing_listing_evidence", "WARN"),
    "evidence_missing_target_rows": _lost("(SELECT listing FROM obs ANTI JOIN act USING (listing) WHERE listing IS NOT NULL)", "listing", "evidence_missing_target_rows", "FAIL"),
    "observation_multiple_targets": _many("obs", ["security", "seen"], "issuer", "observation_multiple_targets", "WARN"),
}
SQL = {f"conflict_{k}": f"WITH {_B} {s}" for k, s in _C.items()}
_ALL = "c AS (" + " UNION ALL ".join(f"SELECT conflict, severity FROM ({s})" for s in _C.values()) + ")"
_WORST = "CASE WHEN bool_or(severity = 'FAIL') THEN 'FAIL' WHEN bool_or(severity = 'WARN') THEN 'WARN' ELSE 'PASS' END AS status"
_EVID = (
    f"WITH {_B}, ev AS (SELECT security AS subject, bool_or(lpad(CAST(issuer % 90 AS VARCHAR), 10, '0') = cik) AS cik_match, "
    f"count(DISTINCT ticker) = 1 AS ticker_stable, count(DISTINCT upper(raw_exchange)) = 1 AS exchange_stable, count(DISTINCT seen) AS "
    f"n_snapshots, CAST(max(seen) - min(seen) AS BIGINT) AS span_days, CAST(count(DISTINCT cik) - 1 > 20 AS INTEGER) AS conflicts FROM "
    f"obs GROUP BY 1)"
)
_DQ = (
    f"WITH {_B}, dq AS (SELECT * FROM (SELECT count(*) FILTER (cik IS NULL) AS missing_cik, count(*) FILTER (trim(name) = '') AS "
    f"missing_name FROM issuers), (SELECT count(*) FILTER (listing IS NULL) AS missing_listing, count(*) FILTER (seen > DATE "
    f"'2001-06-01') AS late FROM obs))"
)
_DELTA = (
    "WITH d AS (SELECT o_orderstatus, count(*) FILTER (CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31') AS "
    "created, count(*) FILTER (CAST(o_orderdate AS DATE) < DATE '1996-01-01') AS before FROM orders GROUP BY 1)"
)
_ACCENTS = f"{text.ACCENTED}', '{text.PLAIN}"
from ..sources.adapters import BARS_SQL  # noqa: E402
from .merge_queries import _BASE as _AUDIT_BASE  # noqa: E402

SQL |= {
    "severity_rollup": f"WITH {_B}, {_ALL} SELECT conflict, count(*) AS n, {_WORST} FROM c GROUP BY 1 UNION ALL SELECT 'ALL', count(*), {_WORST} FROM c",
    "alias_resolve": f"WITH {_B} SELECT raw_exchange, exchange, count(*) AS n FROM res GROUP BY 1, 2",
    "unmapped_values": f"WITH {_B} SELECT DISTINCT raw_exchange FROM res WHERE exchange IS NULL",
    "missing_evidence": f"WITH {_B} SELECT security FROM securities ANTI JOIN (SELECT * FROM obs WHERE run = 7) USING (security)",
    "run_scope_semi": (
        f"WITH {_B} SELECT DISTINCT observation FROM obs WHERE issuer IN (SELECT issuer FROM obs WHERE run = 7 AND issuer % 40 = 0) OR "
        f"security IN (SELECT security FROM obs WHERE run = 7 AND security % 300 = 0) OR observation % 1000 = 1"
    ),
    "unreconciled_obs": f"WITH {_B} SELECT observation FROM obs o WHERE run <= 2 AND NOT EXISTS (SELECT 1 FROM obs e WHERE e.run = 3 AND e.security = o.security AND e.seen >= o.seen)",
    "orphans": (
        f"WITH {_B} SELECT run, count(*) AS orphans FROM obs o LEFT JOIN (SELECT issuer, 1 AS i FROM issuers WHERE issuer % 19 <> 0) USING "
        f"(issuer) LEFT JOIN (SELECT listing, 1 AS l FROM act) USING (listing) WHERE i IS NULL OR (listing IS NOT NULL AND l IS NULL) GROUP "
        f"BY 1"
    ),
    "id_mismatch": f"WITH {_B} SELECT key, n FROM ({_C['observation_cik_issuer_identifier_mismatch']})",
    "ticker_mismatch": f"WITH {_B} SELECT security, count(*) AS n FROM obs o JOIN securities s USING (security) WHERE run >= 6 GROUP BY 1 HAVING NOT bool_or(o.ticker = s.ticker)",
    "successor_asof": (
        f"WITH {_B} SELECT DISTINCT observation, issuer, seen, CASE WHEN issuer NOT IN (SELECT issuer FROM issuers) THEN NULL WHEN seen >= "
        f"DATE '1999-01-01' THEN 1999 WHEN seen >= DATE '1997-01-01' THEN 1997 WHEN seen >= DATE '1995-01-01' THEN 1995 END AS successor "
        f"FROM obs WHERE run = 1"
    ),
    "entity_counts": f"WITH {_B} SELECT " + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in ("issuer", "security", "listing", "cik", "ticker", "raw_exchange")) + " FROM obs",
    "market_snapshot": (
        f"WITH {_B} SELECT exchange, count(DISTINCT issuer) AS issuers, count(DISTINCT security) AS securities, count(DISTINCT listing) AS "
        f"listings, count(DISTINCT security) FILTER (issuer % 2 = 0) AS even_securities FROM named GROUP BY 1"
    ),
    "coverage_sets": (
        f"WITH {_B} SELECT security, string_agg(DISTINCT raw_exchange, ',' ORDER BY raw_exchange) AS exchanges, "
        f"coalesce(string_agg(DISTINCT cik, ',' ORDER BY cik) FILTER (run >= 6), '') AS late_ciks FROM obs GROUP BY 1"
    ),
    "nested_children": "SELECT l_orderkey, '[' || string_agg('{\"n\":' || l_linenumber || ',\"p\":' || l_partkey || '}', ',' ORDER BY l_linenumber, l_partkey) || ']' AS children FROM lineitem GROUP BY 1",
    "evidence_derive": f"{_EVID} SELECT * FROM ev",
    "confidence_score": f"""{_EVID}, p AS (SELECT *, n_snapshots >= 3 AND span_days >= 30 AS enough FROM ev),
        q AS (SELECT subject, CAST(CASE WHEN cik_match THEN 25 ELSE 0 END + CASE WHEN ticker_stable AND enough THEN 25 ELSE 0 END + CASE WHEN
          exchange_stable AND enough THEN 20 ELSE 0 END AS INTEGER) AS points, concat_ws(',', CASE WHEN conflicts > 0 THEN 'CONFLICT' END, CASE WHEN
          NOT enough THEN 'INSUFFICIENT_EVIDENCE' END) AS blockers FROM p)
        SELECT *, CASE WHEN contains(blockers, 'CONFLICT') THEN 'REFUSED' WHEN points >= 70 THEN 'HIGH' WHEN points >= 45 THEN 'MEDIUM' ELSE 'LOW' END AS level FROM q""",
    "entity_resolve": (
        f"WITH {_B} SELECT cik, issuer, greatest(last_seen, DATE '1999-01-01') AS last_seen FROM (SELECT cik, max(seen) AS last_seen FROM "
        f"obs GROUP BY 1) LEFT JOIN (SELECT cik, min(issuer) AS issuer FROM issuers WHERE cik IS NOT NULL GROUP BY 1) USING (cik)"
    ),
    "listing_resolve": (
        f"WITH {_B} SELECT i.listing, CASE WHEN n.ticker IS NULL THEN 'CREATE' WHEN n.ticker = i.ticker THEN 'SAME' ELSE 'BLOCKED' END AS "
        f"decision FROM (SELECT listing, min(ticker) AS ticker FROM obs WHERE run = 6 AND listing IS NOT NULL GROUP BY 1) i LEFT JOIN named "
        f"n USING (listing)"
    ),
    "dq_counters": f"{_DQ} SELECT * FROM dq",
    "dq_findings": f"{_DQ} " + " UNION ALL ".join(f"SELECT '{k}' AS code, {k} AS n, CASE WHEN {k} > 0 THEN '{s}' ELSE 'PASS' END AS status FROM dq" for k, s in (("missing_cik", "WARN"), ("missing_name", "FAIL"), ("missing_listing", "WARN"), ("late", "FAIL"))),
    "snapshot_diff": (
        "WITH e AS (SELECT event_type AS source, CAST(ts AS DATE) AS d, count(*) AS size, count(*) % 3 AS sha FROM events GROUP BY 1, 2), "
        "l AS (SELECT *, lag(sha) OVER w AS bs, lag(size) OVER w AS bz, row_number() OVER (PARTITION BY source ORDER BY d DESC) AS k FROM "
        "e WINDOW w AS (PARTITION BY source ORDER BY d)) SELECT source, CASE WHEN bs IS NULL THEN 'UNKNOWN' WHEN sha = bs THEN 'UNCHANGED' "
        "ELSE 'CHANGED' END AS change, size - bz AS size_delta FROM l WHERE k = 1"
    ),
    "entity_deltas": f"{_DELTA} SELECT * FROM d",
    "zero_delta": f"{_DELTA} SELECT o_orderstatus, CASE WHEN created > 0 THEN 'HAS_DELTA' WHEN before = 0 THEN 'NEVER_SEEN' ELSE 'NO_CHANGE' END AS reason FROM d",
    "expired_objects": "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) + 365 < DATE '1996-06-01' AND o_orderkey > 100 ORDER BY o_orderkey LIMIT 200",
    "json_evidence": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract(props, '$.absent') IS NULL AS absent, json_keys(props)[1] AS first_key FROM events",
    "normalize_symbol": "SELECT p_partkey, nullif(upper(trim(' ' || lower(p_brand) || ' ')), '') AS symbol, lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS cik FROM part",
    "name_variants": f"WITH {_B} SELECT {_PLAIN} AS plain, count(DISTINCT name) AS variants, count(*) AS n FROM issuers GROUP BY 1",
    "row_hash": "SELECT p_partkey, sha256(p_partkey || chr(31) || coalesce(p_brand, chr(0)) || chr(31) || p_size) AS hash FROM part",
    "duration_parse": """WITH s AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderkey % 70 WHEN 1 THEN o_orderkey % 3 * 86400 + o_orderkey % 24 * 3600 + o_orderkey % 60 * 60 WHEN 2 THEN NULL ELSE o_orderkey % 9 * 3600 END AS seconds FROM orders)
        SELECT o_orderkey, seconds, CASE WHEN seconds IS NOT NULL THEN printf('%d:%02d:%02d', seconds // 3600, seconds % 3600 // 60, seconds % 60) ELSE 'null:null:null' END AS clock FROM s""",
    "friendly_name": f"""WITH s AS (SELECT doc_id, regexp_replace(regexp_replace(translate(lower(text), '{_ACCENTS}'), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS safe FROM documents)
        SELECT doc_id, coalesce(nullif(CASE WHEN length(safe) <= 40 THEN safe ELSE regexp_replace(substring(safe, 1, 41), '_?[^_]*$', '') END, ''), 'untitled') AS name FROM s""",
    "provenance_merge": """WITH f AS (SELECT user_id, event_type, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM events GROUP BY 1, 2)
        SELECT user_id, max(last) AS newest, string_agg(event_type, ',' ORDER BY first) AS origins, CAST(sum(n) AS BIGINT) AS n FROM f GROUP BY 1""",
    "evidence_coverage": f"""WITH {_B}, e AS (SELECT observation, CASE WHEN run % 4 <> 1 THEN listing END AS listing, CASE WHEN run % 3 <> 1 THEN security END AS security, CASE WHEN run % 2 = 0 THEN issuer END AS issuer FROM obs)
        SELECT target, CAST(n AS BIGINT) AS n FROM (SELECT 'rows:' || CASE WHEN listing IS NOT NULL THEN 'listing' WHEN security IS NOT NULL THEN
          'security' WHEN issuer IS NOT NULL THEN 'issuer' ELSE 'none' END AS target, count(*) AS n FROM e GROUP BY 1
        UNION ALL SELECT 'observations:issuer', count(DISTINCT observation) FILTER (issuer IS NOT NULL) FROM e UNION ALL SELECT
          'observations:security', count(DISTINCT observation) FILTER (security IS NOT NULL) FROM e
        UNION ALL SELECT 'observations:listing', count(DISTINCT observation) FILTER (listing IS NOT NULL) FROM e)""",
    "audit_inserts": f"""{_AUDIT_BASE}, j AS (SELECT i.*, s.open AS so, s.close AS sc, s.there FROM incoming i LEFT JOIN (SELECT *, true AS there FROM stored) s USING (listing, trading_date)),
        k2 AS (SELECT CASE WHEN there IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action, CASE WHEN there THEN unnest(['open', 'close']) ELSE NULL END AS field, * FROM j)
        SELECT action, field, count(*) AS entries FROM (SELECT DISTINCT action, field, listing, trading_date FROM k2 WHERE there IS NULL OR (field
          = 'open' AND open IS DISTINCT FROM so) OR (field = 'close' AND close IS DISTINCT FROM sc)) GROUP BY 1, 2""",
    "nested_regroup": "SELECT user_id, CAST(ts AS DATE) AS day, '[' || string_agg('{\"e\":' || event_id || ',\"t\":\"' || event_type || '\"}', ',' ORDER BY event_id) || ']' AS items FROM events GROUP BY 1, 2",
    "provider_pivot": "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS \"{t}\"" for t in TYPES) + " FROM events GROUP BY 1",
    "outcome_join": (
        "SELECT o_orderkey, o_orderstatus, returned FROM orders LEFT JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS returned FROM "
        "lineitem WHERE l_returnflag = 'R' GROUP BY 1) USING (o_orderkey)"
    ),
    "success_rate": (
        "WITH r AS (SELECT o_orderpriority, round(coalesce(count(*) FILTER (o_orderstatus = 'F') / nullif(count(*) FILTER (o_orderstatus "
        "IN ('F', 'O')), 0), 1.0), 6) AS rate FROM orders GROUP BY 1) SELECT o_orderpriority, rate, rate >= 0.5 AS passed FROM r"
    ),
    "lenient_filter": "WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS size FROM part) SELECT * FROM s WHERE coalesce(size >= 20, true)",
    "scope_filter": (
        f"WITH {BARS_SQL} SELECT listing, trading_date, close FROM bars WHERE market IN ('ASIA', 'EUROPE') AND trading_date BETWEEN DATE "
        f"'1996-01-01' AND DATE '1996-06-30' AND listing <> 8"
    ),
    "eligible_listings": f"WITH {BARS_SQL} SELECT listing, market FROM listings WHERE market = 'ASIA' OR (listing % 3 = 0 AND market <> 'AFRICA') OR listing IN (1, 2)",
    "subject_support": f"WITH {BARS_SQL} SELECT listing, market IN ('AMERICA', 'EUROPE') AS supported FROM listings",
    "resolve_benchmark": f"WITH {BARS_SQL} SELECT market, CAST(min(listing) AS INTEGER) AS listing FROM listings WHERE listing % 25 = 3 GROUP BY 1",
}
