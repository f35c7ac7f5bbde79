"""Whether a date's sources are complete, and model inputs that fail closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reasons why a date's sources aren't ready, in their order.
SOURCE_REASONS = ["NO_ELIGIBLE_LISTINGS", "BENCHMARK_UNAVAILABLE", "EODDATA_SOURCE_EVIDENCE_MISSING", "YAHOO_SOURCE_EVIDENCE_MISSING", "SPX_COVERAGE_INCOMPLETE"]
#: Reasons why model inputs are withheld, in their order.
INPUT_REASONS = [
    "NO_ACTIVE_PUBLICATION", "SCOPE_MISMATCH", "COVERAGE_INCOMPLETE", "VERSION_MISMATCH", "SOURCE_DRIFT",
    "PUBLICATION_NOT_READY", "BENCHMARK_UNAVAILABLE", "BENCHMARK_MISMATCH", "SPX_COVERAGE_INCOMPLETE",
]
#: The sources whose bars are compared with the benchmark, and the benchmark's source.
DAILY, HISTORY, INDEX = "EODDATA", "STOOQ", "YAHOO"


def ordered(flags: dict[str, Column], order: list[str]) -> Column:
    """Names of the flags that hold, in ``order``."""
    return F.array_compact(F.array(*[F.when(F.coalesce(flags[name], F.lit(False)), name) for name in order if name in flags]))


def source_evidence(runs: DataFrame, jobs: dict[str, str], symbol: str = "SPX") -> DataFrame:
    """(effective_date, provider, run_id): the last run of each source's job that proves a date complete.

    ``runs``: run_id, job, effective_date, status, completed_at, summary (JSON).
    The daily source's run must have no failure and no missing session; the
    index source's must have been for all tickers (an empty list) or for
    ``symbol`` too.  Both must agree on the date and have passed their report.
    """
    text = lambda path: F.get_json_object("summary", f"$.{path}")
    day = F.col("effective_date").cast("string")
    tickers = text("scope.tickers")
    listed = F.when(tickers.startswith("["), F.from_json(tickers, "array<string>"))
    reported = text("report_outcome").isin("PASS", "WARN")
    daily = (text("provider_code") == DAILY) & (text("effective_date") == day) & (text("failure_count") == "0") & (text("missing_session_count") == "0")
    index = (text("provider_code") == INDEX) & (text("source_code") == "yahoo_daily") & (text("outcome") == "succeeded") & (text("scope.effective_date") == day)
    index = index & ((F.size(listed) == 0) | F.array_contains(listed, symbol))
    proves = ((F.col("job") == jobs[DAILY]) & daily) | ((F.col("job") == jobs[INDEX]) & index)
    done = runs.where((F.col("status") == "succeeded") & F.col("completed_at").isNotNull() & reported & proves)
    provider = F.when(F.col("job") == jobs[DAILY], DAILY).otherwise(INDEX)
    # the latest, and of equal times the first by id
    best = F.min_by("run_id", F.struct(-F.unix_micros("completed_at"), "run_id"))
    return done.groupBy("effective_date", provider.alias("provider")).agg(best.alias("run_id"))


def source_readiness(dates: DataFrame, listings: DataFrame, bars: DataFrame, runs: DataFrame, jobs: dict[str, str], benchmark: int | None) -> DataFrame:
    """One row for each ``effective_date`` of ``dates``: counts, what is required, what is there, and ordered reasons.

    ``listings`` (listing, provider) are those selected; ``bars`` (listing,
    trading_date) include the benchmark's.  Without any listing nothing else is
    required.
    """
    count = lambda p: F.count(F.when(F.col("provider") == p, 1))
    selected = listings.agg(F.count("*").alias("selected"), *[count(p).alias(p.lower()) for p in (DAILY, HISTORY, INDEX)])
    day = bars.withColumnRenamed("trading_date", "effective_date").select("listing", "effective_date").distinct()
    own = day.join(listings, "listing").groupBy("effective_date").agg(F.count("*").alias("bars"), F.count(F.when(F.col("provider").isin(DAILY, HISTORY), 1)).alias("supported_bars"))
    index = day.where(F.col("listing") == F.lit(benchmark)).select("effective_date", F.lit(True).alias("benchmark_bar"))
    proof = source_evidence(runs, jobs)
    rows = dates.select("effective_date").distinct().join(own, "effective_date", "left").join(index, "effective_date", "left")
    for p in (DAILY, INDEX):
        rows = rows.join(proof.where(F.col("provider") == p).select("effective_date", F.col("run_id").alias(f"{p.lower()}_run_id")), "effective_date", "left")
    rows = rows.crossJoin(F.broadcast(selected))  # one row
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("bars", "supported_bars")})
    identity = F.lit(benchmark).isNotNull()
    needs_bar = F.col("supported_bars") > 0
    needs = {"benchmark_required": F.col("selected") > 0, "eoddata_required": F.col("eoddata") > 0, "yahoo_required": (F.col("yahoo") > 0) | needs_bar}
    there = F.coalesce("benchmark_bar", F.lit(False))
    flags = {
        "NO_ELIGIBLE_LISTINGS": F.col("selected") == 0,
        "BENCHMARK_UNAVAILABLE": needs["benchmark_required"] & ~identity,
        "EODDATA_SOURCE_EVIDENCE_MISSING": needs["eoddata_required"] & F.col("eoddata_run_id").isNull(),
        "YAHOO_SOURCE_EVIDENCE_MISSING": needs["yahoo_required"] & F.col("yahoo_run_id").isNull(),
        "SPX_COVERAGE_INCOMPLETE": needs_bar & identity & ~there,
    }
    reasons = F.concat_ws(",", ordered(flags, SOURCE_REASONS))
    return rows.select(
        "effective_date", "selected", "eoddata", "stooq", "yahoo", "bars", "supported_bars", *[c.alias(n) for n, c in needs.items()],
        there.alias("benchmark_bar"), "eoddata_run_id", "yahoo_run_id", reasons.alias("reasons"), (reasons == "").alias("ready"),
    )


def membership_flags(version: str, benchmark: Column, contract: str) -> dict[str, Column]:
    """Flags of one listing beside its active membership.

    Columns: supported, source_count, first_date, last_date, has_bar (on the
    date), on (the date), and of the membership (null: none) action, slot,
    status, calculation_version, publication_version, source_rows,
    payload_rows, coverage_start, coverage_end, benchmark_id,
    publication_benchmark_id, benchmark_required, contract_version.
    """
    there = F.col("action").isNotNull()
    other = lambda a, b: ~a.eqNullSafe(b)
    c = F.col
    incomplete = other(c("source_rows"), c("source_count")) | other(c("payload_rows"), c("source_count")) | other(c("coverage_start"), c("first_date")) | other(c("coverage_end"), c("last_date"))
    outside = c("has_bar") & ~F.coalesce(c("on").between(c("coverage_start"), c("coverage_end")), F.lit(False))
    mismatch = other(c("benchmark_id"), benchmark) | other(c("publication_benchmark_id"), benchmark) | ~c("benchmark_required") | other(c("contract_version"), F.lit(contract))
    return {
        "NO_ACTIVE_PUBLICATION": ~there,
        "PUBLICATION_NOT_READY": there & ((c("action") != "PRESENT") | ~c("slot").isin("A", "B") | (c("status") != "PUBLISHED")),
        "VERSION_MISMATCH": there & (other(c("calculation_version"), F.lit(version)) | other(c("publication_version"), F.lit(version))),
        "COVERAGE_INCOMPLETE": there & (incomplete | outside),
        "BENCHMARK_UNAVAILABLE": there & c("supported") & benchmark.isNull(),
        "BENCHMARK_MISMATCH": there & F.when(c("supported"), mismatch).otherwise(c("benchmark_id").isNotNull()),
    }


#: Reasons of a date's sources as reasons of the input.
FROM_SOURCE = {"NO_ELIGIBLE_LISTINGS": "SCOPE_MISMATCH", "BENCHMARK_UNAVAILABLE": "BENCHMARK_UNAVAILABLE", "SPX_COVERAGE_INCOMPLETE": "SPX_COVERAGE_INCOMPLETE"}


def input_reasons(listings: DataFrame, drifted: DataFrame, sources: DataFrame, version: str, benchmark: Column, contract: str, most_rows: int) -> DataFrame:
    """(scope, rows, reasons): ordered reasons why each scope's inputs of a date are withheld; none: they may be read.

    ``listings`` have ``scope`` and the columns of ``membership_flags``;
    ``drifted`` (listing) lists those whose published rows differ from their
    source; ``sources`` (scope, reasons) are the reasons of ``source_readiness``
    for the date.  A scope with more than ``most_rows`` bars is incomplete.
    """
    drift = drifted.select("listing").distinct().withColumn("drifted", F.lit(True))
    rows = listings.join(drift, "listing", "left").withColumn("drifted", F.coalesce("drifted", F.lit(False)))
    flags = membership_flags(version, benchmark, contract)
    flags["SOURCE_DRIFT"] = F.col("drifted")
    own = rows.groupBy("scope").agg(F.count(F.when(F.col("has_bar"), 1)).alias("rows"), *[F.bool_or(F.coalesce(f, F.lit(False))).alias(n) for n, f in flags.items()])
    both = sources.join(own, "scope", "left")
    given = F.split("reasons", ",")
    found = {n: F.coalesce(n, F.lit(False)) for n in flags}
    found["COVERAGE_INCOMPLETE"] = found["COVERAGE_INCOMPLETE"] | F.coalesce(F.col("rows") > most_rows, F.lit(False))
    for source in SOURCE_REASONS:
        name = FROM_SOURCE.get(source, "SOURCE_DRIFT")
        found[name] = found.get(name, F.lit(False)) | F.array_contains(given, source)
    found["SCOPE_MISMATCH"] = found["SCOPE_MISMATCH"] | F.col("rows").isNull()
    return both.select("scope", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.concat_ws(",", ordered(found, INPUT_REASONS)).alias("reasons"))


def model_inputs(rows: DataFrame, features: list[str], allowed: set[str], on, reasons: DataFrame) -> DataFrame:
    """Rows (scope, listing, features) of one date for the scopes that have no reason against them."""
    if unknown := [f for f in features if f not in allowed]:
        raise ValueError(f"unknown features {unknown}")
    open_ = reasons.where("reasons = ''").select("scope")
    return rows.where(F.col("trading_date") == on).join(open_, "scope", "left_semi").select("scope", "listing", "trading_date", *features)
