"""Upserts of a later batch of orders into the orders stored so far."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.registry import query, read
from millrace.operators.merge import delete_then_append as replace_rows
from millrace.operators.lastwriter import RANKS, ranked
from millrace.operators.merge import merge, same_key

KEYS = ["o_orderkey"]

# Orders in two deliveries that overlap by one year and together cover the
# whole table.  The second corrects the price and leaves some priorities open.
ORDERS = """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           cast(o_orderdate as date) as o_orderdate, o_orderpriority from orders
"""
STORED = f"select * from ({ORDERS}) where o_orderdate < date '1999-01-01'"


def _later(start: str) -> str:
    return f"""
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100 as o_totalprice,
               o_orderdate, nullif(o_orderpriority, '4-NOT SPECIFIED') as o_orderpriority
        from ({ORDERS}) where o_orderdate >= date '{start}'
    """


LATER = _later("1998-01-01")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("date"))


def corrected(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + 100,
            "o_orderpriority": F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")),
        }
    )


def later(spark: SparkSession, sf_dir: str, start: str = "1998-01-01") -> DataFrame:
    return corrected(
        orders(spark, sf_dir).filter(F.col("o_orderdate") >= F.lit(start).cast("date"))
    )


UPSERTED = f"""
    select coalesce(n.o_orderkey, b.o_orderkey) as o_orderkey,
           coalesce(n.o_custkey, b.o_custkey) as o_custkey,
           coalesce(n.o_orderstatus, b.o_orderstatus) as o_orderstatus,
           coalesce(n.o_totalprice, b.o_totalprice) as o_totalprice,
           coalesce(n.o_orderdate, b.o_orderdate) as o_orderdate,
           coalesce(n.o_orderpriority, b.o_orderpriority) as o_orderpriority
    from ({STORED}) b full join ({LATER}) n on b.o_orderkey = n.o_orderkey
"""


@query(f"""
    select b.o_orderkey as stored_key, n.o_orderkey as incoming_key,
           b.o_totalprice as stored_price, n.o_totalprice as incoming_price
    from ({STORED}) b full join ({LATER}) n on b.o_orderkey = n.o_orderkey
""")
def full_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = stored(spark, sf_dir).select(
        F.col("o_orderkey").alias("stored_key"), F.col("o_totalprice").alias("stored_price")
    )
    n = later(spark, sf_dir).select(
        F.col("o_orderkey").alias("incoming_key"), F.col("o_totalprice").alias("incoming_price")
    )
    return b.join(n, same_key(["stored_key"], ["incoming_key"]), "full_outer")


@query(UPSERTED)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge(stored(spark, sf_dir), later(spark, sf_dir), KEYS)


@query(UPSERTED)
def merge_upsert_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result with the batch held against an unshuffled base."""
    return merge(stored(spark, sf_dir), later(spark, sf_dir), KEYS, strategy="patch")


@query(UPSERTED)
def merge_upsert_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result by one shuffled join, for batches too large to broadcast."""
    return merge(stored(spark, sf_dir), later(spark, sf_dir), KEYS, strategy="full_outer")


@query(f"""
    select coalesce(n.o_orderkey, b.o_orderkey) as o_orderkey,
           coalesce(n.o_totalprice, b.o_totalprice) as o_totalprice,
           coalesce(b.batch_date, n.batch_date) as batch_date,
           coalesce(n.last_batch_date, b.last_batch_date) as last_batch_date
    from (select *, '1998-12-31' as batch_date, '1998-12-31' as last_batch_date
          from ({STORED})) b
    full join (select *, '2001-08-01' as batch_date, '2001-08-01' as last_batch_date
               from ({LATER})) n
    on b.o_orderkey = n.o_orderkey
""")
def merge_upsert_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    def dated(df: DataFrame, day: str) -> DataFrame:
        return df.select(
            "o_orderkey", "o_totalprice",
            F.lit(day).alias("batch_date"), F.lit(day).alias("last_batch_date"),
        )

    return merge(
        dated(stored(spark, sf_dir), "1998-12-31"),
        dated(later(spark, sf_dir), "2001-08-01"),
        KEYS,
        first_wins=["batch_date"],
    )


@query(f"""
    select coalesce(n.o_orderkey, b.o_orderkey) as o_orderkey,
           case when n.o_orderkey is not null then n.o_totalprice else b.o_totalprice end
               as o_totalprice,
           case when n.o_orderkey is not null then n.o_orderpriority else b.o_orderpriority end
               as o_orderpriority
    from ({STORED}) b full join ({LATER}) n on b.o_orderkey = n.o_orderkey
""")
def merge_upsert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls of the batch overwrite stored values."""
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    return merge(
        stored(spark, sf_dir).select(columns),
        later(spark, sf_dir).select(columns),
        KEYS,
        null_policy="overwrite",
    )


@query(f"{STORED} union all ({_later('1999-01-01')})")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge(stored(spark, sf_dir), later(spark, sf_dir, "1999-01-01"), KEYS)


@query(f"""
    select b.o_orderkey, b.o_custkey, b.o_orderstatus,
           coalesce(n.o_totalprice, b.o_totalprice) as o_totalprice, b.o_orderdate,
           coalesce(n.o_orderpriority, b.o_orderpriority) as o_orderpriority
    from ({ORDERS}) b left join ({LATER}) n on b.o_orderkey = n.o_orderkey
""")
def merge_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge(orders(spark, sf_dir), later(spark, sf_dir), KEYS)


@query(f"""
    select b.* from ({STORED}) b
    where not exists (select 1 from ({LATER}) n where n.o_orderkey = b.o_orderkey)
    union all ({LATER})
""")
def delete_then_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_rows(stored(spark, sf_dir), later(spark, sf_dir), KEYS)


# Three deliveries, each with gaps of its own.  The last writer of a column is
# the newest day that has a value for it, whichever order the days come in.

_DAYS = {
    1: f"select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from ({ORDERS}) where o_orderdate < date '2000-01-01'",
    2: f"""select o_orderkey, nullif(o_orderstatus, 'F') as o_orderstatus, o_totalprice + 100 as o_totalprice,
                  nullif(o_orderpriority, '4-NOT SPECIFIED') as o_orderpriority from ({ORDERS}) where o_orderdate >= date '1996-01-01'""",
    3: f"""select o_orderkey, 'X' as o_orderstatus, case when o_orderstatus = 'O' then o_totalprice + 200 end as o_totalprice,
                  cast(null as varchar) as o_orderpriority from ({ORDERS}) where month(o_orderdate) <= 6""",
}
_COLUMNS = ("o_orderstatus", "o_totalprice", "o_orderpriority")


def _days(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    rows, date = orders(spark, sf_dir), F.col("o_orderdate")
    days = {
        1: rows.filter(date < F.lit("2000-01-01").cast("date")),
        2: corrected(rows.filter(date >= F.lit("1996-01-01").cast("date"))).withColumn(
            "o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("F"))),
        3: rows.filter(F.month(date) <= 6).withColumns({
            "o_totalprice": F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 200),
            "o_orderpriority": F.lit(None).cast("string"), "o_orderstatus": F.lit("X")}),
    }
    return {day: ranked(df.select(*KEYS, *_COLUMNS), _COLUMNS, F.lit(day)) for day, df in days.items()}


@query(f"""
    select arrival, o_orderkey,
           {', '.join(f'coalesce(c.{c}, b.{c}, a.{c}) as {c}' for c in _COLUMNS)},
           case when c.o_totalprice is not null then 3 when b.o_totalprice is not null then 2
                when a.o_totalprice is not null then 1 end as price_day
    from ({_DAYS[1]}) a full join ({_DAYS[2]}) b using (o_orderkey) full join ({_DAYS[3]}) c using (o_orderkey),
         (select unnest(['123', '132', '213', '231', '312', '321']) as arrival)
""")
def merge_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries merged in all six orders: six times the same rows."""
    days, results = _days(spark, sf_dir), []
    for arrival in permutations(days):
        table = days[arrival[0]]
        for day in arrival[1:]:
            table = merge(table, days[day], KEYS, ranks=RANKS)
        results.append(table.select(
            F.lit("".join(map(str, arrival))).alias("arrival"), *KEYS, *_COLUMNS, F.col(f"{RANKS}.o_totalprice").alias("price_day")))
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    return every
