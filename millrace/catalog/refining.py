"""Duplicates, nulls, dates, consistency and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.catalog.registry import (
    DAYS,
    ENROLMENTS,
    LABEL,
    SCORE,
    SPEC,
    enrolments,
    query,
    read,
)
from millrace.operators import dedup, quality
from millrace.operators.incremental import stamp_batch
from millrace.plans import conform as conforming

LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query("""
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, cast(l_shipdate as date) as l_shipdate
    from (select *, row_number() over (
              partition by l_orderkey, l_linenumber
              order by l_shipdate desc nulls last, l_partkey nulls last, l_suppkey nulls last,
                       l_quantity nulls last, l_extendedprice nulls last, l_discount nulls last,
                       l_tax nulls last, l_returnflag nulls last, l_linestatus nulls last) as rn
          from lineitem)
    where rn = 1
""")
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = [F.col("l_shipdate").desc_nulls_last()]
    rows = dedup.dedup_by_key(read(spark, sf_dir, "lineitem"), LINE_KEYS, newest)
    return rows.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query("""
    select distinct l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, cast(l_shipdate as date) as l_shipdate
    from lineitem
""")
def dedup_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items, the returned ones delivered a second time."""
    items = read(spark, sf_dir, "lineitem").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )
    return dedup.dedup_rows(items.unionByName(items.filter(F.col("l_returnflag") == "R")))


@query("select distinct l_orderkey, l_linenumber from lineitem")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.distinct_keys(read(spark, sf_dir, "lineitem"), LINE_KEYS)


@query(f"""
    select count(*) as n_rows,
           count(*) filter (where l_shipdate >= o_orderdate) as n_consistent,
           count(*) filter (where not coalesce(l_shipdate >= o_orderdate, false)) as n_inconsistent,
           count(*) filter (where {DAYS} > 90) as n_delayed,
           count(*) filter (where o_orderpriority is null) as n_missing_priority
    from ({ENROLMENTS})
""")
def quality_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = quality.in_order("o_orderdate", "l_shipdate")
    return quality.audit(
        enrolments(spark, sf_dir),
        {
            "n_consistent": rule,
            "n_inconsistent": ~F.coalesce(rule, F.lit(False)),
            "n_delayed": fn.days_between("o_orderdate", "l_shipdate") > 90,
            "n_missing_priority": quality.is_missing(["o_orderpriority"]),
        },
    )


@query("""
    select event_id, user_id, event_type, value, '2024-01-15' as processing_date from events
""")
def stamp_batch_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return stamp_batch(rows, "2024-01-15", "processing_date")


# Events as a careless source would deliver them: gaps in several columns.
_GAPPY = """
    select event_id, case when event_type <> 'signup' then user_id end as user_id,
           nullif(event_type, 'error') as event_type,
           case when event_type <> 'view' then value end as value
    from events
"""


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind != "signup", F.col("user_id")).alias("user_id"),
        F.nullif(kind, F.lit("error")).alias("event_type"),
        F.when(kind != "view", F.col("value")).alias("value"),
    )


@query(f"select * from ({_GAPPY}) where user_id is not null and event_type is not null")
def drop_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_missing(_gappy_events(spark, sf_dir), ["user_id", "event_type"])


@query(f"select * from ({_GAPPY}) where user_id is null or event_type is null")
def missing_key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complement of ``drop_missing_keys``."""
    return quality.split_missing(_gappy_events(spark, sf_dir), ["user_id", "event_type"])[1]


@query(f"""
    select event_id, coalesce(user_id, 0) as user_id,
           coalesce(event_type, 'Unknown') as event_type, coalesce(value, 0.0) as value
    from ({_GAPPY})
""")
def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = {"user_id": 0, "event_type": "Unknown", "value": 0.0}
    return quality.fill_defaults(_gappy_events(spark, sf_dir), policy)


@query("""
    select o_orderkey,
           case when o_orderpriority <> '4-NOT SPECIFIED' then cast(o_orderdate as date) end
               as order_date
    from orders
""")
def parse_us_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written as M/d/yyyy, some in another notation that must not parse."""
    day = F.col("o_orderdate")
    text = F.when(
        F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format(day, "yyyy-MM-dd")
    ).otherwise(F.date_format(day, "M/d/yyyy"))
    return read(spark, sf_dir, "orders").select("o_orderkey", fn.parse_date(text).alias("order_date"))


@query(f"select l_orderkey, l_linenumber, l_partkey, {DAYS} as days from ({ENROLMENTS})")
def days_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrolments(spark, sf_dir).select(
        *LINE_KEYS, "l_partkey", fn.days_between("o_orderdate", "l_shipdate").alias("days")
    )


_DATED = ["l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "l_shipdate"]


@query(f"select {', '.join(_DATED)} from ({ENROLMENTS}) where l_shipdate >= o_orderdate")
def consistency_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = quality.in_order("o_orderdate", "l_shipdate")
    return quality.keep_consistent(enrolments(spark, sf_dir).select(*_DATED), rule)


@query(f"""
    select {', '.join(_DATED)} from ({ENROLMENTS})
    where not coalesce(l_shipdate >= o_orderdate, false)
""")
def consistency_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = quality.in_order("o_orderdate", "l_shipdate")
    return quality.reject_inconsistent(enrolments(spark, sf_dir).select(*_DATED), rule)


@query(f"select l_orderkey, l_linenumber, l_partkey, {SCORE} as score from lineitem")
def weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = fn.weighted_score(SPEC.weights, via=SPEC.exact_score).alias("score")
    return read(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_partkey", score)


@query(f"select l_orderkey, l_linenumber, l_partkey, {LABEL} as label from ({ENROLMENTS})")
def threshold_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fn.days_between("o_orderdate", "l_shipdate")
    label = fn.threshold_label(days, 90, "On-Time", "Delayed").alias("label")
    return enrolments(spark, sf_dir).select(*LINE_KEYS, "l_partkey", label)


@query(f"""
    select l_orderkey, l_linenumber, l_partkey, {DAYS} as days, {SCORE} as score, {LABEL} as label
    from ({ENROLMENTS})
""")
def derive_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conforming.derive_metrics(enrolments(spark, sf_dir), SPEC)
    return rows.select(*LINE_KEYS, "l_partkey", "days", "score", "label")


# Enrolments as raw text rows: open end dates, unreadable or absent start
# dates, and gaps that the null policy fills.
RAW_ENROLMENTS = f"""
    select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
           nullif(l_tax, 0.0) as l_tax, nullif(l_linestatus, 'F') as l_linestatus,
           case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then null
                when o_orderpriority = '4-NOT SPECIFIED' then 'unknown'
                else concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))
           end as o_orderdate,
           case when l_returnflag <> 'N'
                then concat(month(l_shipdate), '/', day(l_shipdate), '/', year(l_shipdate))
           end as l_shipdate
    from ({ENROLMENTS})
"""


def raw_enrolments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw row per line.

    Repeated lines go before the join with the order, which they share: fewer
    rows reach the join, and the line number spreads an order of many lines.
    """
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("l_linestatus"),
        F.when(F.col("l_returnflag") != "N", F.date_format("l_shipdate", "M/d/yyyy"))
        .alias("l_shipdate"),
    )
    priority = F.col("o_orderpriority")
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when((F.col("o_orderstatus") == "P") & (priority == "5-LOW"), None)
        .when(priority == "4-NOT SPECIFIED", "unknown")
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
        .alias("o_orderdate"),
    )
    once = dedup.dedup_by_key(lines, LINE_KEYS)
    return once.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


RAW_DEDUPED = f"""
    select * exclude (rn) from (
        select *, row_number() over (
            partition by l_orderkey, l_linenumber
            order by l_partkey nulls last, l_quantity nulls last, l_extendedprice nulls last,
                     l_tax nulls last, l_linestatus nulls last, o_orderdate nulls last,
                     l_shipdate nulls last) as rn
        from ({RAW_ENROLMENTS}))
    where rn = 1
"""

CONFORMED = f"""
    select l_orderkey, l_linenumber, l_partkey, l_linestatus, l_tax, o_orderdate, l_shipdate,
           {DAYS} as days, {SCORE} as score, {LABEL} as label
    from (select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
                 coalesce(l_tax, 0.0) as l_tax, coalesce(l_linestatus, 'Unknown') as l_linestatus,
                 cast(try_strptime(o_orderdate, '%m/%d/%Y') as date) as o_orderdate,
                 cast(try_strptime(coalesce(l_shipdate, '12/31/9999'), '%m/%d/%Y') as date)
                     as l_shipdate
          from ({RAW_DEDUPED})
          where l_orderkey is not null and l_linenumber is not null and o_orderdate is not null)
    where l_shipdate >= o_orderdate
"""


def conformed_enrolments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conforming.conform(raw_enrolments(spark, sf_dir), SPEC, unique=True)


@query(f"""
    select l_orderkey, l_linenumber, l_partkey, l_linestatus, l_tax,
           cast(o_orderdate as varchar) as start_date, cast(l_shipdate as varchar) as end_date,
           days, score, label
    from ({CONFORMED})
""")
def refine_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates, null policy, dates, consistency and metrics in one plan."""
    return conformed_enrolments(spark, sf_dir).select(
        *LINE_KEYS, "l_partkey", "l_linestatus", "l_tax",
        F.col("o_orderdate").cast("string").alias("start_date"),
        F.col("l_shipdate").cast("string").alias("end_date"),
        "days", "score", "label",
    )


@query(f"""
    select count(*) as n_rows,
           count(*) filter (where coalesce(l_shipdate >= o_orderdate, false)) as n_kept,
           count(*) filter (where start_text is null) as n_missing,
           count(*) filter (where start_text is not null
                            and not coalesce(l_shipdate >= o_orderdate, false)) as n_inconsistent
    from (select o_orderdate as start_text,
                 try_strptime(o_orderdate, '%m/%d/%Y') as o_orderdate,
                 try_strptime(coalesce(l_shipdate, '12/31/9999'), '%m/%d/%Y') as l_shipdate
          from ({RAW_DEDUPED}))
""")
def refine_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows ``refine_end_to_end`` keeps and rejects, in one pass."""
    return conforming.audit(raw_enrolments(spark, sf_dir), SPEC)


@query(f"""
    select l_orderkey, l_linenumber, l_partkey,
           case when o_orderdate is null then 'missing critical value'
                else 'dates missing or out of order' end as reason
    from ({RAW_DEDUPED})
    where o_orderdate is null
       or not coalesce(try_strptime(coalesce(l_shipdate, '12/31/9999'), '%m/%d/%Y')
                       >= try_strptime(o_orderdate, '%m/%d/%Y'), false)
""")
def refine_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``refine_end_to_end`` leaves out, with the reason."""
    return conforming.rejects(raw_enrolments(spark, sf_dir), SPEC).select(
        *LINE_KEYS, "l_partkey", F.col(conforming.REASON).alias("reason")
    )
