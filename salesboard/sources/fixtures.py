"""Sale-record inputs derived from the driver's tables.

``raw_ticks``  one record per ``events`` row, with adversarial lines mixed in
               (wrong arity, range prices, blank shops, junk prices).
``raw_sales``  one record per ``lineitem`` row of the star schema.

Both are pure projections/joins of the given tables, so their size grows with
the tables; each has a SQL twin in ``salesboard.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesboard.schema import FIELD_SEPARATOR, TIME_FORMAT
from salesboard.session import use_utc

# --- fixed values (fixture construction rules, see FIXTURES.md) -------------
TOPIC = "sales"
N_TOPIC_PARTITIONS = 3
PRODUCT_MOD = 97
ADVERSARIAL_MOD = 50
# rest of event_id % 50 -> what the line becomes
R_SHORT_LINE = 0        # replaced by "x^y^id"            -> bad_arity
R_BLANK_SHOP_NAME = 1   # last field empty, so it drops    -> bad_arity
R_RANGE_PRICE = 2       # price "v - 99999"                -> ok, price v
R_BLANK_SHOP_ID = 3     # shop id empty                    -> ok, not ranked
R_JUNK_PRICE = 4        # price "n/a"                      -> bad_price
R_TRAILING_EMPTY = 5    # "^^^" appended                   -> ok
R_EXTRA_FIELD = 6       # "^x" appended (14 fields)        -> bad_arity
R_BAD_TIME = 7          # month 13 in the time field       -> ok, in the total and its shop, not in the trend
SHORT_LINE = "x^y^id"
RANGE_SUFFIX = " - 99999"
JUNK_PRICE = "n/a"
BAD_TIME_FORMAT = "yyyy-'13'-dd HH:mm:ss"
# --- end of fixed values ----------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line(fields: list[Column]) -> Column:
    return F.concat_ws(FIELD_SEPARATOR, *fields)


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic envelope ``(topic, partition, offset, timestamp, value)`` from ``events``.

    partition = ``event_id % 3``, offset = ``event_id div 3``; ``timestamp`` is
    ``ts`` (so ingest time equals event time); ``value`` is the 13-field line.
    """
    return tick_lines(tick_events(spark, sf_dir))


def tick_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``events`` that a ``raw_ticks`` row is made of: a fraction of the line's size."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def tick_lines(ev: DataFrame) -> DataFrame:
    """The envelope of every row of ``tick_events``, in the order of the rows."""
    eid, uid = F.col("event_id"), F.col("user_id").cast("string")
    pid = (eid % PRODUCT_MOD).cast("string")
    price = F.col("value").cast("decimal(18,2)").cast("string")
    rest = eid % ADVERSARIAL_MOD
    fields = [
        F.when(rest == R_BAD_TIME, F.date_format(F.col("ts"), BAD_TIME_FORMAT)).otherwise(F.date_format(F.col("ts"), TIME_FORMAT)),
        F.concat(F.lit("https://item.example/"), pid),
        pid,
        F.concat(F.lit("item "), pid),
        F.col("event_type"),
        F.concat(F.lit("p"), (eid % 7 + 1).cast("string")),
        F.when(rest == R_RANGE_PRICE, F.concat(price, F.lit(RANGE_SUFFIX)))
         .when(rest == R_JUNK_PRICE, F.lit(JUNK_PRICE)).otherwise(price),
        price,
        (eid % 5 + 1).cast("string"),
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string"),
                 F.lit(" C"), (F.col("user_id") % 23).cast("string")),
        F.when(rest == R_BLANK_SHOP_ID, F.lit("")).otherwise(uid),
        (eid % 11).cast("string"),
        F.when(rest == R_BLANK_SHOP_NAME, F.lit("")).otherwise(F.concat(F.lit("Shop "), uid)),
    ]
    line = _line(fields)
    line = (F.when(rest == R_SHORT_LINE, F.lit(SHORT_LINE))
            .when(rest == R_TRAILING_EMPTY, F.concat(line, F.lit("^^^")))
            .when(rest == R_EXTRA_FIELD, F.concat(line, F.lit("^x")))
            .otherwise(line))
    return ev.select(
        F.lit(TOPIC).alias("topic"),
        _tick_partition(eid).alias("partition"),
        _tick_offset(eid).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        line.alias("value"),
    )


def _tick_partition(event_id: Column) -> Column:
    return (event_id % N_TOPIC_PARTITIONS).cast("int")


def _tick_offset(event_id: Column) -> Column:
    return F.floor(event_id / N_TOPIC_PARTITIONS).cast("long")


def envelope_ordinal(partition="partition", offset="offset") -> Column:
    """The source ordinal of a ``raw_ticks`` row (its ``event_id``)."""
    partition, offset = (F.col(c) if isinstance(c, str) else c for c in (partition, offset))
    return offset * N_TOPIC_PARTITIONS + partition


def event_ordinal() -> Column:
    """The same ordinal from a row of ``tick_events``."""
    return envelope_ordinal(_tick_partition(F.col("event_id")), _tick_offset(F.col("event_id")))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ordinal, value)`` lines from lineitem ⋈ orders ⋈ part ⋈ supplier ⋈ nation ⋈ region.

    ``l_linenumber`` 1 gives a range price, 2 a blank shop id, 3 a blank shop
    name (so the line has 12 fields and is rejected).  ``ordinal`` is
    ``l_orderkey * 8 + l_linenumber`` (unique, ordered by order).

    Join plan: orders, supplier and part are left to the optimizer and AQE (they
    grow with the data), nation and region have a fixed size and are broadcast.  What
    is shuffled for a join is as narrow as it can be: orders adds a date, supplier a
    name, and only the last shuffled join, part, adds its long texts.  Names of
    regions and the line itself come after it and are never shuffled.
    """
    use_utc(spark)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    geo = (table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
           .join(F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name")),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(p, F.col("l_partkey") == F.col("p_partkey"))
         .join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey")))
    ln = F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    shop = F.col("s_suppkey").cast("string")
    fields = [
        F.date_format(F.col("o_orderdate"), TIME_FORMAT),
        F.concat(F.lit("https://item.example/"), F.col("p_partkey").cast("string")),
        F.col("p_partkey").cast("string"),
        F.col("p_name"),
        F.col("p_type"),
        F.concat(F.lit("p"), ln.cast("string")),
        F.when(ln == 1, F.concat(price, F.lit(" - "), F.col("p_retailprice").cast("string")))
         .otherwise(price),
        F.col("p_retailprice").cast("string"),
        F.col("l_quantity").cast("int").cast("string"),
        F.concat(F.col("r_name"), F.lit(" "), F.col("n_name")),
        F.when(ln == 2, F.lit("")).otherwise(shop),
        ln.cast("string"),
        F.when(ln == 3, F.lit("")).otherwise(F.col("s_name")),
    ]
    return j.select((F.col("l_orderkey") * 8 + ln).alias("ordinal"), _line(fields).alias("value"))
