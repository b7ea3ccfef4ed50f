"""Row-wise projections and filters of the ingest and silver stages
(raw normalisation, distribution key, ingest stamp, typing)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions.casts import snapshot_asset, to_decimal, trade_asset
from tidewatch.functions.time import iso_to_ntz, iso_utc_text, millis_to_ntz

# Exchange event type kept, and the raw → clean key names.
TRADE_EVENT_TYPE = "aggTrade"
RAW_TRADE_KEYS = {"a": "trade_id", "s": "symbol", "p": "price", "q": "quantity",
                  "T": "trade_time", "m": "is_buyer_maker"}


def parse_raw_events(df: DataFrame, col: str = "message") -> DataFrame:
    """Text messages (bare or inside a ``data`` envelope) → raw event columns
    ``e, s, a, p, q, T, m``; non-JSON messages and ill-typed values give nulls.

    ``json_tuple`` is a generator: it parses each message once, and a later
    filter on its outputs cannot be pushed below it (a filter on a
    ``from_json`` projection is pushed down by inlining the parse, which then
    runs once per reference).  Enveloped messages are parsed a second time
    for the ``data`` object."""
    keys = S.RAW_TRADE_EVENT.fieldNames()
    keep = [c for c in df.columns if c != col]
    outer = df.select(*keep, F.json_tuple(F.col(col), *keys, "data")
                      .alias(*[f"_o{k}" for k in keys], "_data"))
    inner = outer.select("*", F.json_tuple(F.col("_data"), *keys)
                         .alias(*[f"_i{k}" for k in keys]))
    types = {f.name: f.dataType.simpleString() for f in S.RAW_TRADE_EVENT.fields}
    env = F.col("_data").isNotNull()
    return inner.select(*keep, *[
        F.when(env, F.col(f"_i{k}")).otherwise(F.col(f"_o{k}")).try_cast(types[k]).alias(k)
        for k in keys])


def keep_trade_events(df: DataFrame) -> DataFrame:
    """Only ``e == 'aggTrade'``; other and missing types are dropped."""
    return df.where(F.col("e") == TRADE_EVENT_TYPE)


def normalize_trades(df: DataFrame) -> DataFrame:
    """Raw single-letter keys → clean names; price and quantity stay text."""
    return df.select(*[F.col(k).alias(v) for k, v in RAW_TRADE_KEYS.items()])


def partition_key(symbol: str = "symbol", trade_id: str = "trade_id") -> Column:
    """``symbol-tradeId``: spreads one busy asset over all partitions."""
    return F.concat_ws("-", F.col(symbol), F.col(trade_id).cast("string"))


def with_partition_key(df: DataFrame, num_partitions: int | None = None,
                       col: str = "partition_key") -> DataFrame:
    out = df.withColumn(col, partition_key())
    return out.repartition(num_partitions, col) if num_partitions else out


def stamp_ingested_at(df: DataFrame, now: dt.datetime | None = None,
                      col: str = "ingested_at") -> DataFrame:
    """One ISO-8601 UTC stamp for the whole batch, replacing any incoming one.

    Without ``now`` the stamp is ``current_timestamp()``: constant within a
    query (and within a streaming micro-batch, identical on replay)."""
    if now is not None:
        text = F.lit(now.astimezone(dt.timezone.utc).isoformat())
    else:
        text = iso_utc_text(F.current_timestamp())
    return df.withColumn(col, text)


def ingest_time(legacy: bool = True, strict: bool = False) -> Column:
    """``COALESCE(ingested_at, _ingested_at)`` parsed to a UTC timestamp."""
    c = F.coalesce(F.col("ingested_at"), F.col("_ingested_at")) if legacy \
        else F.col("ingested_at")
    return iso_to_ntz(c, strict)


def type_trades(bronze: DataFrame, strict: bool = True) -> DataFrame:
    """bronze.trades → silver.trades types.  ``strict``: text that is no number
    or no time fails the job; otherwise it becomes null."""
    return bronze.select(*_trade_columns(strict))


def _trade_columns(strict: bool) -> list[Column]:
    return [
        F.col("trade_id").cast("long").alias("trade_id"),
        F.col("symbol"),
        trade_asset("symbol").alias("asset_symbol"),
        to_decimal("price", strict=strict).alias("price"),
        to_decimal("quantity", strict=strict).alias("quantity"),
        millis_to_ntz("trade_time").alias("trade_time"),
        F.col("is_buyer_maker"),
        ingest_time(strict=strict).alias("ingested_at"),
    ]


def type_snapshots(bronze: DataFrame, strict: bool = True) -> DataFrame:
    """bronze.market → silver.market_snapshot types (29 columns)."""
    out = []
    for name in S.SILVER_SNAPSHOT_COLS:
        if name == "asset_symbol":
            out.append(snapshot_asset("symbol").alias(name))
        elif name == "ingested_at":
            out.append(ingest_time(strict=strict).alias(name))
        elif name in S.SNAPSHOT_MONEY_COLS:
            out.append(to_decimal(name, 38, 8, strict).alias(name))
        elif name in S.SNAPSHOT_PERCENT_COLS:
            out.append(to_decimal(name, 18, 8, strict).alias(name))
        elif name in S.SNAPSHOT_TIME_COLS:
            out.append(iso_to_ntz(name, strict).alias(name))
        elif name == "market_cap_rank":
            out.append(F.col(name).cast("int").alias(name))
        else:
            out.append(F.col(name))
    return bronze.select(*out)


def _reason(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first check that holds; null when none does."""
    return F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks])


def quarantine_trades(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed trades, rejects): rows whose key, price, quantity or times cannot
    be typed are set aside with a ``reason`` and their text, the others go on."""
    raw = bronze.select(F.struct("*").alias("_raw")).select("_raw", *[
        F.col(f"_raw.{c}").alias(c) for c in bronze.columns])
    both = raw.select("_raw", F.struct(*_trade_columns(strict=False)).alias("_t"))
    marked = both.withColumn("reason", _reason([
        ("trade_id", F.col("_t.trade_id").isNull()),
        ("symbol", F.col("_t.symbol").isNull()),
        ("price", F.col("_t.price").isNull()),
        ("quantity", F.col("_t.quantity").isNull()),
        ("trade_time", F.col("_t.trade_time").isNull()),
        ("ingested_at", F.col("_t.ingested_at").isNull())]))
    return (marked.where("reason is null").select("_t.*"),
            marked.where("reason is not null").select("reason", "_raw.*"))
