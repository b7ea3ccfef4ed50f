"""Role mapping of the driver's parquet tables onto the engine's inputs.

The driver supplies an ``events(event_id, ts, user_id, event_type, value,
props)`` table.  Every row is both

* a trade: ``trade_id = event_id``, asset = ``event_type``,
  ``symbol = upper(event_type) || 'USDT'``, ``price = value``,
  ``quantity = props.k + 1``, ``trade_time = ts``,
  ``is_buyer_maker = user_id is even``; and
* a market snapshot of asset ``event_type`` with ``current_price = value``
  taken at ``ingested_at = ts``,

so a query over trades, or over snapshots, works on the whole table.

Bronze text forms render those rows the way the landing jobs write them:
price and quantity as text, trade time as epoch millis, ingest stamps as
ISO-8601 text, and the legacy ``_ingested_at`` name used by one row in seven.
Merge roles split the table into an overlapping target (ids below 60 % of the
maximum) and source (ids from 40 %, with ``value + 1``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.time import ntz_micros, partition_parts

# Fixed values of the role mapping.
TRADE_QUOTE = "USDT"
LEGACY_STAMP_EVERY = 7          # event_id % 7 = 0 → only _ingested_at is set
DUPLICATE_EVERY = 10            # id % 10 = 1 → row repeated in a source
DUPLICATE_RESIDUE = 1
MALFORMED_EVERY = 11            # event_id % 11 = 0 → payload is not JSON
MALFORMED_PAYLOAD = "%% not json %%"
TARGET_SHARE = 0.6
SOURCE_SHARE = 0.4


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _quantity() -> Column:
    return F.get_json_object("props", "$.k").cast("long") + 1


def trades(events: DataFrame) -> DataFrame:
    """Typed trades in double precision (the flagship query's input)."""
    return events.select(
        F.col("event_id").alias("trade_id"),
        F.concat(F.upper("event_type"), F.lit(TRADE_QUOTE)).alias("symbol"),
        F.col("event_type").alias("asset_symbol"),
        F.col("value").alias("price"),
        _quantity().cast("double").alias("quantity"),
        F.col("ts").alias("trade_time"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        F.col("ts").alias("ingested_at"),
    )


def snapshots(events: DataFrame) -> DataFrame:
    """Market snapshots: asset, price and the time they were taken."""
    return events.select(
        F.col("event_type").alias("asset_symbol"),
        F.col("value").alias("current_price"),
        F.col("ts").alias("ingested_at"),
    )


def iso_text(ts: Column) -> Column:
    """Python ``datetime.isoformat()`` of a UTC time: micros and ``+00:00``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def _stamps(ts: Column) -> list[Column]:
    legacy = F.col("event_id") % LEGACY_STAMP_EVERY == 0
    return [
        F.when(~legacy, iso_text(ts)).alias("ingested_at"),
        F.when(legacy, iso_text(ts)).alias("_ingested_at"),
    ]


def _parts(ts: Column) -> list[Column]:
    return [c.alias(n) for n, c in partition_parts(ts).items()]


def bronze_trades(events: DataFrame) -> DataFrame:
    """Trades as landed in bronze (text price/quantity, epoch-millis time)."""
    ts = F.col("ts")
    return events.select(
        F.col("event_id").alias("trade_id"),
        F.concat(F.upper("event_type"), F.lit(TRADE_QUOTE)).alias("symbol"),
        F.col("value").cast("string").alias("price"),
        _quantity().cast("string").alias("quantity"),
        F.floor(ntz_micros(ts) / 1000).cast("long").alias("trade_time"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        *_stamps(ts), *_parts(ts),
    )


def bronze_snapshots(events: DataFrame) -> DataFrame:
    """Snapshots as landed in bronze; the fields the feed would carry are
    derived from ``value`` / ``user_id`` / ``ts``."""
    ts, v = F.col("ts"), F.col("value")
    cols = {
        "id": F.col("event_type"),
        "symbol": F.col("event_type"),
        "name": F.initcap("event_type"),
        "current_price": v,
        "market_cap": v * F.lit(1000.0),
        "market_cap_rank": (F.col("user_id") % 100 + 1).cast("int"),
        "fully_diluted_valuation": v * F.lit(1100.0),
        "total_volume": v * F.lit(10.0),
        "high_24h": v + F.lit(1.0),
        "low_24h": v - F.lit(1.0),
        "price_change_24h": v - F.lit(2.0),
        "price_change_percentage_24h": v / F.lit(100.0),
        "market_cap_change_24h": v * F.lit(3.0),
        "market_cap_change_percentage_24h": v / F.lit(50.0),
        "circulating_supply": v * F.lit(7.0),
        "total_supply": v * F.lit(8.0),
        "max_supply": v * F.lit(9.0),
        "ath": v + F.lit(100.0),
        "ath_change_percentage": v / F.lit(200.0),
        "ath_date": iso_text(F.timestamp_add("DAY", F.lit(-30), ts)),
        "atl": v / F.lit(10.0),
        "atl_change_percentage": v / F.lit(4.0),
        # offset text, and text without any offset, in turn
        "atl_date": F.when(F.col("event_id") % 2 == 0, F.concat(F.date_format(
            F.timestamp_add("HOUR", F.lit(2), ts), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")),
        "last_updated": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        "price_change_percentage_1h_in_currency": v / F.lit(1000.0),
        "price_change_percentage_24h_in_currency": v / F.lit(500.0),
        "price_change_percentage_7d_in_currency": v / F.lit(20.0),
    }
    return events.select(
        *[c.alias(n) for n, c in cols.items()], *_stamps(ts), *_parts(ts))


def merge_roles(df: DataFrame, id_col: str = "event_id",
                value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(target, source): ids below 60 % of the max vs ids from 40 %, with the
    source's ``value`` raised by one so upsert and insert-only differ.
    The maximum is a scalar subquery, evaluated inside the plan."""
    max_id = df.select(F.max(id_col)).scalar()
    # integer arithmetic: id < 0.6 * max  <=>  10 * id < 6 * max
    target = df.where(F.col(id_col) * 10 < max_id * int(TARGET_SHARE * 10))
    source = (df.where(F.col(id_col) * 10 >= max_id * int(SOURCE_SHARE * 10))
                .withColumn(value_col, F.col(value_col) + 1))
    return target, source


def with_replays(df: DataFrame, id_col: str = "event_id",
                 value_col: str = "value") -> DataFrame:
    """Source with in-source repeats: rows with ``id % 10 = 1`` appear twice;
    the repeat arrives later (``seq`` 1) and carries ``value + 100``."""
    first = df.withColumn("seq", F.lit(0))
    again = (df.where(F.col(id_col) % DUPLICATE_EVERY == DUPLICATE_RESIDUE)
               .withColumn(value_col, F.col(value_col) + 100)
               .withColumn("seq", F.lit(1)))
    return first.unionByName(again)


def raw_trade_events(events: DataFrame) -> DataFrame:
    """Exchange messages for every event: one ``aggTrade`` and one of another
    type; every third event's are wrapped in a ``{"stream": ..., "data": ...}``
    envelope.  Column ``message`` is text."""
    rows = events.withColumn("_e", F.explode(F.array(F.lit("aggTrade"), F.lit("markPrice"))))
    inner = F.to_json(F.struct(
        F.col("_e").alias("e"),
        F.concat(F.upper("event_type"), F.lit(TRADE_QUOTE)).alias("s"),
        F.col("event_id").alias("a"),
        F.col("value").cast("string").alias("p"),
        _quantity().cast("string").alias("q"),
        F.floor(ntz_micros("ts") / 1000).cast("long").alias("T"),
        (F.col("user_id") % 2 == 0).alias("m"),
    ))
    wrapped = F.concat(F.lit('{"stream":"'), F.lower("event_type"), F.lit("@"), F.col("_e"),
                       F.lit('","data":'), inner, F.lit("}"))
    return rows.select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, wrapped).otherwise(inner).alias("message"))


def flawed_bronze_trades(events: DataFrame) -> DataFrame:
    """Bronze trades of which some have a bad price, a bad ingest time or no
    key (fixed residues of the id); ``event_id`` names the row."""
    i = F.col("trade_id")
    return bronze_trades(events).select("*", i.alias("event_id")).withColumns({
        "price": F.when(i % 13 == 0, F.lit("n/a")).otherwise(F.col("price")),
        "ingested_at": F.when(i % 17 == 0, F.lit("yesterday")).otherwise(F.col("ingested_at")),
        "trade_id": F.when(i % 19 != 0, i)})


def fine_bronze_trades(events: DataFrame) -> DataFrame:
    """Bronze trades with eight-digit prices, tiny quantities, and for every
    fifth event a quantity above 1e10."""
    i = F.col("trade_id")
    digits = F.lpad(F.pmod(i * 7919, F.lit(100_000_000)).cast("string"), 8, "0")
    return bronze_trades(events).withColumns({
        "price": F.concat(F.col("price").cast("decimal(18,2)").cast("string"),
                          F.lpad(F.pmod(i * 104_729, F.lit(1_000_000)).cast("string"), 6, "0")),
        "quantity": F.concat(F.when(i % 5 == 0, (F.lit(20_000_000_000) + i).cast("string"))
                             .otherwise(F.lit("0")), F.lit("."), digits)})


def trade_arrival() -> Column:
    """When an event's trade reaches silver: every seventh is ten hours late."""
    late = F.when(F.col("event_id") % 7 == 0, F.lit(10)).otherwise(F.lit(0))
    return F.timestamp_add("HOUR", late, F.col("ts"))


def snapshot_arrival() -> Column:
    """When its snapshot is merged: every eleventh three hours after it was taken."""
    late = F.when(F.col("event_id") % 11 == 0, F.lit(3)).otherwise(F.lit(0))
    return F.timestamp_add("HOUR", late, F.col("ts"))


def stream_copy(events: DataFrame, copy: int, mended: bool = False) -> DataFrame:
    """Stream records (base64 payload + sequence number) of one sending of
    every event's trade; a repeat (``copy`` above 0) carries another price.
    Payloads of ``id % 11 = 0`` are not JSON (unless ``mended``)."""
    price = F.col("value").cast("string")
    if copy:
        price = (F.col("value").cast("decimal(18,2)") + 100 * copy).cast("string")
    payload = F.to_json(F.struct(
        F.col("event_id").alias("trade_id"),
        F.concat(F.upper("event_type"), F.lit(TRADE_QUOTE)).alias("symbol"),
        price.alias("price"),
        _quantity().cast("string").alias("quantity"),
        F.floor(ntz_micros("ts") / 1000).cast("long").alias("trade_time"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
    ))
    bad = F.lit(False) if mended else F.col("event_id") % MALFORMED_EVERY == 0
    text = F.when(bad, F.lit(MALFORMED_PAYLOAD)).otherwise(payload)
    return events.select(
        F.base64(F.encode(text, "UTF-8")).alias("data"),
        F.format_string("%012d-%d", F.col("event_id"), F.lit(copy)).alias("sequence_number"),
        "event_id")


def stream_records(events: DataFrame) -> DataFrame:
    """One record per event, and a second one for ``id % 10 = 1``."""
    return stream_copy(events, 0).unionByName(
        stream_copy(events.where(F.col("event_id") % DUPLICATE_EVERY == DUPLICATE_RESIDUE), 1))


def trade_arrivals(events: DataFrame) -> DataFrame:
    """Trades with an arrival time for the lag report: a trade of user ``u``
    reaches the consumer ``u`` seconds after it happened."""
    return events.select(
        F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("asset_symbol"),
        F.col("ts").alias("trade_time"),
        F.timestamp_add("SECOND", F.col("user_id"), F.col("ts")).alias("arrived_at"))
