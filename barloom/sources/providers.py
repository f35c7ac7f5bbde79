"""Readers of provider files: every one splits rows into good ones and rejects with reasons."""

from __future__ import annotations

import csv
import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

#: Limits of an archive member: path length, size in bytes, and lines of a chunk.
MAX_PATH, MAX_MEMBER_BYTES = 240, 512 << 20


def _reasons(rules: dict[str, Column]) -> Column:
    return F.concat_ws(",", F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()])))


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with ``reasons``)."""
    return rows.where("reasons = ''").drop("reasons"), rows.where("reasons <> ''")


def read_quotes(spark: SparkSession, path: str, exchange: str, effective_date: str) -> DataFrame:
    """Daily quotes from files with a JSON array, decimals exact, with ``reasons`` for rows not of this exchange, interval or date."""
    rows = spark.read.schema(schemas.QUOTES).option("multiLine", True).option("mode", "PERMISSIVE").option("allowNonNumericNumbers", False).json(path)
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    missing = prices[0].isNull()
    for p in prices[1:]:
        missing = missing | p.isNull()
    rules = {
        "corrupt": F.col("_corrupt_record").isNotNull(),
        "exchange": F.col("exchangeCode") != exchange,
        "interval": F.col("interval") != "d",
        "date": ~F.substring("dateStamp", 1, 10).eqNullSafe(F.lit(effective_date)),
        "symbol": F.coalesce(F.trim("symbolCode"), F.lit("")) == "",
        "price": missing,
        "relation": (F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close")),
        "volume": F.col("volume") < 0,
    }
    named = rows.withColumn("reasons", _reasons(rules))
    return named.select(F.col("exchangeCode").alias("market"), F.col("symbolCode").alias("ticker"), F.to_date(F.substring("dateStamp", 1, 10)).alias("trading_date"), *prices, "volume", "reasons")


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Symbol list rows with ``reasons``; a type that isn't text is ignored, blanks are null, a row needs a code."""
    rows = spark.read.schema("code string, name string, type variant, currency string").option("multiLine", True).json(path)
    text = F.when(F.schema_of_variant("type") == "STRING", F.col("type").cast("string"))
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    made = {"code": blank(F.col("code")), "name": blank(F.col("name")), "type": blank(text), "currency": blank(F.col("currency"))}
    return rows.select(*[c.alias(n) for n, c in made.items()], _reasons({"code": made["code"].isNull()}).alias("reasons"))


def read_chart(spark: SparkSession, path: str, timezone: str) -> DataFrame:
    """Rows of chart JSON with parallel arrays; the session date is the provider's epoch in the declared time zone.

    A payload without a result (an error) and one whose arrays differ in length
    are rejected whole, as one row.
    """
    rows = spark.read.schema(schemas.CHART).option("multiLine", True).json(path).select(F.explode_outer("chart.result").alias("r"))
    quote = F.col("r.indicators.quote")[0]
    arrays = [quote[c] for c in ("open", "high", "low", "close", "volume")]
    shape = F.lit(True)
    for a in arrays:
        shape = shape & F.coalesce(F.size(a) == F.size("r.timestamp"), F.lit(False))
    zipped = F.arrays_zip(F.col("r.timestamp").alias("timestamp"), *[a.alias(n) for a, n in zip(arrays, ("open", "high", "low", "close", "volume"))])
    there = F.col("r.timestamp").isNotNull().alias("there")
    out = rows.select(F.col("r.meta.symbol").alias("ticker"), F.col("r.meta.exchangeTimezoneName").alias("zone"), there, shape.alias("shape"), F.explode_outer(F.when(shape, zipped)).alias("z"))
    out = out.select("ticker", "zone", "there", "shape", "z.*")
    at = F.from_utc_timestamp(F.timestamp_seconds("timestamp"), timezone)
    good = F.col("there") & F.col("shape")
    rules = {"payload": ~F.col("there"), "shape": F.col("there") & ~F.col("shape"), "time_zone": good & (F.col("zone") != timezone), "price": good & (F.col("close").isNull() | F.col("open").isNull())}
    return out.select("ticker", F.to_date(at).alias("trading_date"), "open", "high", "low", "close", "volume", _reasons(rules).alias("reasons"))


def _history_rows(rows: DataFrame) -> DataFrame:
    """Typed history lines; text with surrounding blanks is rejected, since casts would trim it."""
    strict = lambda c: F.when(F.trim(c) == F.col(c), F.col(c))
    number = lambda c, kind: F.expr(f"try_cast({c} AS {kind})")
    date = F.when(F.col("date").rlike(r"^\d{8}$"), F.expr("try_to_date(date, 'yyyyMMdd')"))
    prices = [F.when(F.trim(c) == F.col(c), number(c, "decimal(30,10)")).alias(c) for c in ("open", "high", "low", "close")]
    volume = F.when(F.trim("vol") == F.col("vol"), number("vol", "decimal(30,8)")).alias("volume")
    typed = rows.select("market", strict("ticker").alias("ticker"), date.alias("trading_date"), *prices, volume, "bad_fields")
    rules = {"fields": F.col("bad_fields"), "ticker": F.col("ticker").isNull(), "date": F.col("trading_date").isNull(), "price": F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull() | F.col("close").isNull(), "volume": F.col("volume") < 0}
    return typed.withColumn("reasons", _reasons(rules)).drop("bad_fields")


def _with_bad_members(rows: DataFrame, bad: DataFrame) -> DataFrame:
    """``rows``, and a rejected one for each file (name) of ``bad``."""
    typed = _history_rows(rows)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in typed.schema if f.name not in ("ticker", "reasons")]
    return typed.unionByName(bad.select(F.col("name").alias("ticker"), *empty, F.lit("member").alias("reasons")))


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """Extracted history files; the market is the name of their directory.

    A file without the header line is rejected whole, a line of more or fewer
    fields by itself.
    """
    rows = spark.read.schema(f"{schemas.HISTORY_CSV}, broken string").option("columnNameOfCorruptRecord", "broken").csv(path)
    rows = rows.withColumn("name", F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))).withColumn("bad_fields", F.col("broken").isNotNull())
    is_header = F.concat_ws(",", *[f.split(" ")[0] for f in schemas.HISTORY_CSV.split(", ")]) == ",".join(schemas.HISTORY_HEADER)
    rows = rows.withColumn("is_header", is_header)
    headed = rows.groupBy("name").agg(F.bool_or("is_header").alias("headed"))
    lines = rows.where("NOT is_header").join(headed.where("headed"), "name").withColumn("market", F.regexp_extract("name", r"/([^/]+)/[^/]+$", 1))
    return _with_bad_members(lines, headed.where("NOT headed"))


def read_history_zip(spark: SparkSession, path: str) -> DataFrame:
    """History lines of zip archives, member by member; unsafe, oversized or mis-headed members are rejected whole."""
    columns = ["market", *[f.split(" ")[0] for f in schemas.HISTORY_CSV.split(", ")], "bad_fields", "bad_member"]
    rejected = lambda name: pd.DataFrame([[None] * (len(columns) - 2) + [False, name]], columns=columns)

    def run(batches):
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(data)) as archive:
                    for member in archive.infolist():
                        parts = member.filename.split("/")
                        if member.is_dir():
                            continue
                        if len(member.filename) > MAX_PATH or ".." in parts or member.filename.startswith("/") or member.file_size > MAX_MEMBER_BYTES:
                            yield rejected(member.filename)
                            continue
                        with archive.open(member) as stream:
                            lines = csv.reader(io.TextIOWrapper(stream, "utf-8", newline=""))
                            if next(lines, None) != schemas.HISTORY_HEADER:
                                yield rejected(member.filename)
                                continue
                            market, chunk = parts[-2] if len(parts) > 1 else "", []
                            for line in lines:
                                chunk.append([market, *(line + [None] * 10)[:10], len(line) != 10, None])
                                if len(chunk) == 50_000:
                                    yield pd.DataFrame(chunk, columns=columns)
                                    chunk = []
                            if chunk:
                                yield pd.DataFrame(chunk, columns=columns)

    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = raw.mapInPandas(run, f"market string, {schemas.HISTORY_CSV}, bad_fields boolean, bad_member string")
    return _with_bad_members(rows.where("bad_member IS NULL"), rows.where("bad_member IS NOT NULL").select(F.col("bad_member").alias("name")))


def read_fields_data(spark: SparkSession, path: str) -> DataFrame:
    """JSON of {"fields": [...], "data": [[...]]}: one map of texts a row, by field name; a row of another length is rejected."""
    rows = spark.read.schema("fields array<string>, data array<array<string>>").option("multiLine", True).json(path)
    each = rows.select("fields", F.posexplode("data").alias("n", "row"))
    fits = F.coalesce(F.size("fields") == F.size("row"), F.lit(False))
    return each.select("n", F.when(fits, F.map_from_arrays("fields", F.when(fits, F.col("row")))).alias("row"), _reasons({"fields": ~fits}).alias("reasons"))


def read_keyed_objects(spark: SparkSession, path: str) -> DataFrame:
    """JSON of {"0": {...}, "1": {...}}: one row an object (cik, ticker, title), numbers and texts alike; one without cik is rejected."""
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "map<string,struct<cik_str:string,ticker:string,title:string>>")
    each = text.select(F.explode(parsed).alias("key", "o")).select(F.col("key").cast("long").alias("n"), F.col("o.cik_str").alias("cik"), F.col("o.ticker").alias("ticker"), F.col("o.title").alias("title"))
    return each.withColumn("reasons", _reasons({"cik": F.col("cik").isNull()}))
