"""The stored layers end to end: streamed drops, landing, bronze, silver, star schema."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog.merging import KEYS, UPSERTED, later, stored
from millrace.catalog.registry import ENROLMENTS, query, read
from millrace.functions import parse_date
from millrace.operators.dedup import dedup_by_key
from millrace.plans import lms
from millrace.plans.refine import Layers, ingest, rejects_of
from millrace.session import fits_broadcast, scratch_path
from millrace.sources import csv, files
from millrace.sources.tables import Table
from millrace.streaming import drops


@query(UPSERTED)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries dropped as CSV and merged by two runs of one stream."""
    root = scratch_path(spark, "stream_upsert")
    first = stored(spark, sf_dir)
    table = Table(spark, f"{root}/orders", first.schema)
    text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "o_orderdate" else f.dataType)
         for f in first.schema.fields]
    )
    for delivery in (first, later(spark, sf_dir)):
        delivery.withColumn("o_orderdate", F.date_format("o_orderdate", "M/d/yyyy")).write.mode(
            "append"
        ).option("header", True).csv(f"{root}/drops")
        rows = csv.scan_stream(spark, f"{root}/drops", text).withColumn(
            "o_orderdate", parse_date(F.col("o_orderdate"))
        )
        drops.run_available(rows, drops.merging_into(table, KEYS), f"{root}/checkpoint")
    return table.read()


@query(UPSERTED)
def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two deliveries in folders of their own, each read by its own stream into one table."""
    root = scratch_path(spark, "stream_two_sources")
    first = stored(spark, sf_dir)
    table = Table(spark, f"{root}/orders", first.schema)
    for name, delivery in (("first", first), ("later", later(spark, sf_dir))):
        delivery.write.parquet(f"{root}/{name}")
        rows = spark.readStream.schema(first.schema).parquet(f"{root}/{name}")
        drops.run_available(rows, drops.merging_into(table, KEYS), f"{root}/checkpoint-{name}")
    return table.read()


@query("""
    select o_orderkey as id, case when o_orderstatus = 'P' then 'missing key' else 'kept' end as fate
    from orders
""")
def stream_key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in progress come without their key; each order is either merged or kept as a reject."""
    root = scratch_path(spark, "stream_key_rejects")
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    rows = read(spark, sf_dir, "orders").select(key.alias("key"), F.col("o_orderkey").alias("id"))
    rows.write.parquet(f"{root}/drops")
    table = Table(spark, f"{root}/orders", rows.schema)
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/drops")
    drops.run_available(stream, drops.merging_into(table, ["key"]), f"{root}/checkpoint")
    lost = F.get_json_object("Line", "$.id").cast(rows.schema["id"].dataType)
    return table.read().select("id", F.lit("kept").alias("fate")).unionByName(
        rejects_of(table).read().select(lost.alias("id"), F.col("Reason").alias("fate"))
    )


# Enrolments in the layout of the learning-management extract, as two drops
# that overlap by a year and together cover every line item.  Columns without
# a counterpart stay empty for the null policy to fill.

_COLUMNS = {
    "Student_ID": "cast(o_custkey as varchar)",
    "Name": "c_name",
    "Grade_Level": "cast(p_size as varchar)",
    "Course_ID": "cast(l_partkey as varchar)",
    "Course_Name": "p_name",
    "Enrollment_Date": "concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))",
    "Completion_Date": """case when l_returnflag <> 'N' then
        concat(month(l_shipdate), '/', day(l_shipdate), '/', year(l_shipdate)) end""",
    "Status": "nullif(o_orderstatus, 'P')",
    "Assignments_Completed": "l_linenumber",
    "Quiz_Average_Score": "l_quantity",
    "Assignment_Average_Score": "l_extendedprice",
    "Project_Score": "nullif(l_tax, 0.0)",
    "Demographic_Group": "c_mktsegment",
}

_DROP = f"""
    select {', '.join(f'{sql} as {name}' for name, sql in _COLUMNS.items())}
    from ({ENROLMENTS})
    join customer on o_custkey = c_custkey
    join part on l_partkey = p_partkey
"""


def _unique(rows: str, where: str) -> str:
    order = ", ".join(f"{c} nulls last" for c in _COLUMNS if c not in lms.KEYS)
    return f"""
        select * exclude (rn) from (
            select *, row_number() over (partition by Student_ID, Course_ID order by {order}) as rn
            from ({rows}) where {where})
        where rn = 1
    """


_START = "cast(try_strptime(Enrollment_Date, '%m/%d/%Y') as date)"
_OTHERS = [c for c in _COLUMNS if c not in lms.KEYS]


def _conformed(rows: str) -> str:
    return f"""
        select *, cast(date_diff('day', Enrollment_Date, Completion_Date) as integer)
                   as Completion_Time_Days,
               cast(round(cast(Quiz_Average_Score as decimal(18, 2)) * 0.2
                          + cast(Assignment_Average_Score as decimal(18, 2)) * 0.2
                          + cast(Project_Score as decimal(18, 2)) * 0.1, 2) as double)
                   as Performance_Score
        from (select * replace ({_START} as Enrollment_Date,
                                cast(try_strptime(coalesce(Completion_Date, '12/31/9999'),
                                                  '%m/%d/%Y') as date) as Completion_Date,
                                coalesce(Status, 'In-progress') as Status,
                                coalesce(Project_Score, 0.0) as Project_Score)
              from ({rows}))
        where Completion_Date >= Enrollment_Date
    """


_LAYERS = f"""
    with first_drop as ({_unique(_DROP, f"{_START} < date '1999-01-01'")}),
    second_drop as ({_unique(_DROP, f"{_START} >= date '1998-01-01'")}),
    second_bronze as (
        select n.Student_ID, n.Course_ID,
               {', '.join(f'coalesce(n.{c}, b.{c}) as {c}' for c in _OTHERS)},
               case when b.Student_ID is null then date '2024-01-16' else date '2024-01-15' end
                   as Processing_Date
        from second_drop n left join first_drop b
        on n.Student_ID = b.Student_ID and n.Course_ID = b.Course_ID),
    first_silver as ({_conformed("select *, date '2024-01-15' as Processing_Date from first_drop")}),
    second_silver as ({_conformed("select * from second_bronze")})
"""

_FACT = ["Student_ID", "Course_ID", "Enrollment_Date", "Status", "Assignments_Completed",
         "Quiz_Average_Score", "Assignment_Average_Score", "Project_Score",
         "Completion_Time_Days", "Performance_Score"]


def _drop_rows(spark: SparkSession, sf_dir: str, drops: dict[int, Column]) -> DataFrame:
    """The rows of all drops, each with the number of its drop, one per key and drop.

    One pass for all of them.  Line items are shuffled twice: to their order
    and to their key.  Names and texts are put in after that where they can be
    broadcast; else an order brings its customer's, and the second shuffle is to
    the part.  Either way the rows of a key lie together in the end, so looking
    for the one that stays takes no third.
    """
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    orders = read(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    small = fits_broadcast(customer) and fits_broadcast(part)
    of_customer = F.col("o_custkey") == F.col("c_custkey")
    if not small:
        # Their files alone may look small enough.
        customer, part = customer.hint("merge"), part.hint("merge")
        orders = orders.join(customer, of_customer)
    rows = read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if small:
        rows = rows.repartition("o_custkey", "l_partkey").join(customer, of_customer)
    rows = (
        rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("drop", F.explode(F.array_compact(F.array(*[F.when(holds, n) for n, holds in drops.items()]))))
    )
    rows = rows.select(
        "drop", "o_custkey", "l_partkey",
        F.col("c_name").alias("Name"),
        F.col("p_size").cast("string").alias("Grade_Level"),
        F.col("p_name").alias("Course_Name"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("Enrollment_Date"),
        F.when(F.col("l_returnflag") != "N", F.date_format(F.col("l_shipdate").cast("date"), "M/d/yyyy"))
        .alias("Completion_Date"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("Status"),
        F.col("l_linenumber").alias("Assignments_Completed"),
        F.col("l_quantity").alias("Quiz_Average_Score"),
        F.col("l_extendedprice").alias("Assignment_Average_Score"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("Project_Score"),
        F.col("c_mktsegment").alias("Demographic_Group"),
    )
    once = dedup_by_key(rows, ["drop", "o_custkey", "l_partkey"])
    return once.withColumns({"Student_ID": F.col("o_custkey").cast("string"), "Course_ID": F.col("l_partkey").cast("string")}).select(
        "drop", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in lms.EXTRACT.fields if f.name in _COLUMNS])


def _run_layers(spark: SparkSession, sf_dir: str, name: str, late: str | None = None) -> Layers:
    """Two days of drops through the layers; those of the first day's ``late`` segment come after both."""
    root = scratch_path(spark, name)
    layers = Layers(spark, root, replace(lms.CONFORM, exact_score=T.DecimalType(18, 2)))
    day = F.col("o_orderdate")
    first, second = day < F.lit("1999-01-01").cast("date"), day >= F.lit("1998-01-01").cast("date")
    deliveries = [("2024-01-15", first), ("2024-01-16", second)]
    if late is not None:
        is_late = F.col("c_mktsegment") == late
        deliveries = [("2024-01-15", first & ~is_late), ("2024-01-16", second), ("2024-01-15", first & is_late)]
    rows = _drop_rows(spark, sf_dir, {n: holds for n, (_, holds) in enumerate(deliveries)})
    # A drop lacks the columns nobody fills; those are bound by header name and empty.
    rows.write.partitionBy("drop").option("header", True).option("compression", "gzip").csv(f"{root}/drops")
    for n, (batch_date, _) in enumerate(deliveries):
        folder = f"{root}/drops/drop={n}"
        if files.exists(spark, folder):
            files.touch(spark, folder)
            ingest(spark, folder, layers.landing, batch_date)
        layers.refresh_pending()
    return layers


def _fact_sql(before: str, after: str) -> str:
    return f"""
    select coalesce(n.Student_ID, b.Student_ID) as Student_ID,
           coalesce(n.Course_ID, b.Course_ID) as Course_ID,
           {', '.join(f'coalesce(n.{c}, b.{c}) as {c}' for c in _FACT[2:])},
           cast(coalesce(n.Completion_Date, b.Completion_Date) as varchar) as Completion_Date,
           case when coalesce(n.Completion_Time_Days, b.Completion_Time_Days) <= 90
                then 'On-Time' else 'Delayed' end as Course_Completion_Rate,
           'N/A' as Final_Grade, cast(0 as double) as Attendance_Rate,
           coalesce(b.Processing_Date, n.Processing_Date) as Processing_Date
    from {before} b full join {after} n
    on b.Student_ID = n.Student_ID and b.Course_ID = n.Course_ID
    """


def _fact_rows(layers: Layers) -> DataFrame:
    return layers.fact.read().select(
        *_FACT, F.col("Completion_Date").cast("string").alias("Completion_Date"),
        "Course_Completion_Rate", "Final_Grade", "Attendance_Rate", "Processing_Date",
    )


@query(_LAYERS + _fact_sql("first_silver", "second_silver"))
def layered_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops through all stored layers; the fact table at the end."""
    return _fact_rows(_run_layers(spark, sf_dir, "layered_fact"))


# The late segment's keys of the second drop: first conformed without the
# first drop's values, then once more with their gaps filled.
_LATE = f"""
    {_LAYERS},
    alone as ({_conformed("""select *, date '2024-01-16' as Processing_Date from second_drop
                             where Demographic_Group = 'BUILDING'""")}),
    before as (
        select * from alone
        union all by name
        select f.* from first_silver f left join second_drop s
        on f.Student_ID = s.Student_ID and f.Course_ID = s.Course_ID
        where f.Demographic_Group <> 'BUILDING' or s.Student_ID is null),
    after as (
        select * replace (case when Demographic_Group = 'BUILDING' then date '2024-01-16'
                               else Processing_Date end as Processing_Date)
        from second_silver)
"""


@query(_LATE + _fact_sql("before", "after"))
def layered_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One segment of the first day lands after the second day, and reverts nothing; the fact table."""
    return _fact_rows(_run_layers(spark, sf_dir, "layered_late_file", late="BUILDING"))


def _newest_student(silver: str) -> str:
    return f"""
        (select Student_ID, Name, Demographic_Group from (
            select *, row_number() over (
                partition by Student_ID
                order by Enrollment_Date desc, Name, Demographic_Group) as rn
            from {silver})
         where rn = 1)
    """


@query(f"""
    {_LAYERS}
    select coalesce(n.Student_ID, b.Student_ID) as Student_ID, coalesce(n.Name, b.Name) as Name,
           cast(0 as integer) as Age, 'Unknown' as Gender,
           coalesce(n.Demographic_Group, b.Demographic_Group) as Demographic_Group,
           'Unknown' as Internet_Access, 'Unknown' as Learning_Disabilities,
           'Unknown' as Language_Proficiency, 'Unknown' as Parent_Involvement
    from {_newest_student('first_silver')} b full join {_newest_student('second_silver')} n
    on b.Student_ID = n.Student_ID
""")
def layered_dim_student(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops through all stored layers; one row per student at the end."""
    return _run_layers(spark, sf_dir, "layered_dim_student").star["dim_student"].read()


def _newest_course(silver: str) -> str:
    return f"""
        (select Course_ID, Course_Name, Grade_Level from (
            select *, row_number() over (
                partition by Course_ID
                order by Enrollment_Date desc, Course_Name, Grade_Level) as rn
            from {silver})
         where rn = 1)
    """


@query(f"""
    {_LAYERS}
    select coalesce(n.Course_ID, b.Course_ID) as Course_ID, coalesce(n.Course_Name, b.Course_Name) as Course_Name,
           coalesce(n.Grade_Level, b.Grade_Level) as Grade_Level
    from {_newest_course('first_silver')} b full join {_newest_course('second_silver')} n
    on b.Course_ID = n.Course_ID
""")
def layered_dim_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops through all stored layers; one row per course at the end."""
    return _run_layers(spark, sf_dir, "layered_dim_course").star["dim_course"].read()


def _counts(layer: str, day: str, read_rows: str, kept: str) -> str:
    return f"""
        select '{layer}' as layer, '{day}' as batch, (select count(*) from {read_rows}) as n_read, (select count(*) from {kept}) as n_kept,
               (select count(*) from {read_rows}) - (select count(*) from {kept}) as n_rejected
    """


@query(_LAYERS + " union all ".join([
    _counts("bronze", "2024-01-15", "first_drop", "first_drop"), _counts("silver", "2024-01-15", "first_drop", "first_silver"),
    _counts("bronze", "2024-01-16", "second_drop", "second_drop"), _counts("silver", "2024-01-16", "second_bronze", "second_silver"),
]))
def layered_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops through all stored layers; what each step counted as read, kept and rejected while it ran."""
    layers = _run_layers(spark, sf_dir, "layered_audit")
    return layers.audits["bronze"].latest().unionByName(layers.audits["silver"].latest())
