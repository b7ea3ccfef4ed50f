"""Declared table schemas (bronze, silver, gold) and table names."""

from __future__ import annotations

from pyspark.sql import types as T

PARTITION_COLS = ["year", "month", "day", "hour"]

# Bronze snapshot numeric columns, in declared order.
SNAPSHOT_MONEY_COLS = [
    "current_price", "market_cap", "fully_diluted_valuation", "total_volume",
    "high_24h", "low_24h", "price_change_24h", "market_cap_change_24h",
    "circulating_supply", "total_supply", "max_supply", "ath", "atl",
]
SNAPSHOT_PERCENT_COLS = [
    "price_change_percentage_24h", "market_cap_change_percentage_24h",
    "ath_change_percentage", "atl_change_percentage",
    "price_change_percentage_1h_in_currency",
    "price_change_percentage_24h_in_currency",
    "price_change_percentage_7d_in_currency",
]
SNAPSHOT_TIME_COLS = ["ath_date", "atl_date", "last_updated"]

# Column order of the bronze snapshot table (fixed values).
SNAPSHOT_BUSINESS_COLS = [
    "id", "symbol", "name", "current_price", "market_cap", "market_cap_rank",
    "fully_diluted_valuation", "total_volume", "high_24h", "low_24h",
    "price_change_24h", "price_change_percentage_24h", "market_cap_change_24h",
    "market_cap_change_percentage_24h", "circulating_supply", "total_supply",
    "max_supply", "ath", "ath_change_percentage", "ath_date", "atl",
    "atl_change_percentage", "atl_date", "last_updated",
    "price_change_percentage_1h_in_currency",
    "price_change_percentage_24h_in_currency",
    "price_change_percentage_7d_in_currency",
]

_PART = [T.StructField(c, T.StringType()) for c in PARTITION_COLS]

BRONZE_TRADES = T.StructType([
    T.StructField("trade_id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("trade_time", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("_ingested_at", T.StringType()),
] + _PART)


def _snapshot_field(name: str) -> T.StructField:
    if name == "market_cap_rank":
        return T.StructField(name, T.IntegerType())
    if name in SNAPSHOT_MONEY_COLS or name in SNAPSHOT_PERCENT_COLS:
        return T.StructField(name, T.DoubleType())
    return T.StructField(name, T.StringType())


BRONZE_SNAPSHOTS = T.StructType(
    [_snapshot_field(c) for c in SNAPSHOT_BUSINESS_COLS]
    + [T.StructField("ingested_at", T.StringType()),
       T.StructField("_ingested_at", T.StringType())]
    + _PART)

# Raw trade as sent by the producer after normalisation (price/quantity text).
TRADE_PAYLOAD = T.StructType([
    T.StructField("trade_id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("trade_time", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
])

# Exchange event before normalisation (single-letter keys).
RAW_TRADE_EVENT = T.StructType([
    T.StructField("e", T.StringType()),
    T.StructField("s", T.StringType()),
    T.StructField("a", T.LongType()),
    T.StructField("p", T.StringType()),
    T.StructField("q", T.StringType()),
    T.StructField("T", T.LongType()),
    T.StructField("m", T.BooleanType()),
])

# Stream record envelope: base64 payload plus the source sequence number.
STREAM_RECORD = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("sequence_number", T.StringType()),
])

DEC_MONEY = T.DecimalType(38, 8)
DEC_PERCENT = T.DecimalType(18, 8)

SILVER_TRADES = T.StructType([
    T.StructField("trade_id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("asset_symbol", T.StringType()),
    T.StructField("price", DEC_MONEY),
    T.StructField("quantity", DEC_MONEY),
    T.StructField("trade_time", T.TimestampNTZType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
])


def _silver_snapshot_field(name: str) -> T.StructField:
    if name == "market_cap_rank":
        return T.StructField(name, T.IntegerType())
    if name in SNAPSHOT_MONEY_COLS:
        return T.StructField(name, DEC_MONEY)
    if name in SNAPSHOT_PERCENT_COLS:
        return T.StructField(name, DEC_PERCENT)
    if name in SNAPSHOT_TIME_COLS:
        return T.StructField(name, T.TimestampNTZType())
    return T.StructField(name, T.StringType())


SILVER_SNAPSHOT_COLS = (["id", "symbol", "asset_symbol", "name"]
                        + SNAPSHOT_BUSINESS_COLS[3:] + ["ingested_at"])
SILVER_SNAPSHOTS = T.StructType(
    [_silver_snapshot_field(c) if c != "asset_symbol"
     else T.StructField(c, T.StringType()) for c in SILVER_SNAPSHOT_COLS[:-1]]
    + [T.StructField("ingested_at", T.TimestampNTZType())])

GOLD_ANOMALIES = T.StructType([
    T.StructField("asset_symbol", T.StringType()),
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("vwap", DEC_MONEY),
    T.StructField("volume", DEC_MONEY),
    T.StructField("trade_count", T.LongType()),
    T.StructField("baseline_mean", DEC_MONEY),
    T.StructField("baseline_stddev", DEC_MONEY),
    T.StructField("z_score", DEC_PERCENT),
    T.StructField("is_anomaly", T.BooleanType()),
])

# Day column derived for the hidden day(...) partitioning of silver and gold.
DAY_COL = "part_day"
