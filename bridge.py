"""Report-shaped rows derived from the ``events`` table.

The SQL text of a report runs in Spark and in the oracle. Copies are a union in
the oracle and one generator over a single scan here; a generator also keeps the
derived columns from being worked out again inside every filter above it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.times import date_parts
from wakeline.schema import REPORT_SCHEMA

BASE_SQL = """
  select
    event_id as report_id,
    substr(cast(ts as string), 1, 10) as source_date,
    case when event_id % 103 = 0 then null
         when event_id % 101 = 0 then cast(12345 as bigint)
         else 366000000 + user_id end as mmsi,
    case when event_id % 97 = 0 then 'not-a-time'
         when event_id % 2 = 0 then replace(substr(cast(ts as string), 1, 19), ' ', 'T')
         else substr(cast(ts as string), 1, 19) end as base_date_time,
    case when event_id % 89 = 0 then 0.0E0
         else -125.0E0 + (event_id * 10473 % 58000) / 1000.0E0 end as longitude,
    case when event_id % 89 = 0 then 0.0E0
         when event_id % 83 = 0 then 91.0E0
         else 24.0E0 + (event_id * 7919 % 25000) / 1000.0E0 end as latitude,
    case when event_id % 79 = 0 then -1.0E0
         when event_id % 61 = 0 then 102.3E0
         when event_type = 'error' then null
         else value / 4.0E0 end as sog,
    cast(event_id * 37 % 380 as double) as cog,
    cast(event_id * 53 % 360 as double) as heading,
    case when event_id % 3 = 0 then null else concat('VESSEL ', cast(user_id as string)) end as vessel_name,
    case when event_id % 5 = 0 then null else concat('IMO', cast(9000000 + user_id as string)) end as imo,
    case when event_id % 7 = 0 then null else concat('WD', cast(user_id as string)) end as call_sign,
    cast(case when event_id % 11 = 0 then null else (user_id % 9 + 1) * 10 end as int) as vessel_type,
    cast(event_id % 16 as int) as status,
    case when event_id % 13 = 0 then null else cast(user_id % 300 as double) end as length,
    case when event_id % 13 = 0 then null else cast(user_id % 40 as double) end as width,
    cast(user_id % 15 as double) as draft,
    cast(user_id % 100 as int) as cargo,
    case when event_id % 2 = 0 then 'A' else 'B' end as transceiver
  from {events}
"""

# Every fiftieth report is sent twice, the copy with another speed.
REPORTS_SQL = """
  select * from {base}
  union all
  select report_id + 1000000000, source_date, mmsi, base_date_time, longitude, latitude,
         sog + 1.0E0, cog, heading, vessel_name, imo, call_sign, vessel_type, status, length,
         width, draft, cargo, transceiver
  from {base} where report_id % 50 = 0
"""

# One row per attempt to load a file: a file per day and user, failed attempts included.
ATTEMPTS_SQL = """
  select
    event_id as attempt_id,
    concat('ais-', substr(cast(ts as string), 1, 10), '-', cast(user_id as string), '.csv.zst') as file_name,
    ts as ingested_at,
    cast(floor(value * 100) as bigint) as row_count,
    substr(cast(ts as string), 1, 10) as source_date,
    case when event_type = 'error' then 'failed' else 'success' end as status,
    case when event_type = 'error' then props end as error
  from {events}
"""

# One row per stage of a run: a run per day and user.
STAGES_SQL = """
  select
    concat(substr(cast(ts as string), 1, 10), '_', cast(user_id % 20 as string)) as run_id,
    event_type as stage,
    ts as started_at,
    ts as completed_at,
    value as duration_seconds,
    user_id * 100 as input_rows,
    user_id * 90 as output_rows,
    case when value > 50 then 'failed' else 'success' end as status,
    props as error
  from {events}
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = spark.sql(BASE_SQL, events=events(spark, sf_dir))
    changed = {"report_id": F.col("report_id") + 1_000_000_000, "sog": F.col("sog") + 1.0}
    sent = F.struct(*base.columns)
    copy = F.struct(*[changed.get(c, F.col(c)).alias(c) for c in base.columns])
    twice = F.col("report_id") % 50 == 0
    return base.select(F.inline(F.when(twice, F.array(sent, copy)).otherwise(F.array(sent))))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("*", *date_parts(F.col("source_date")))


RAW_PATTERN = "ais-*.csv.gz"


def raw_files(spark: SparkSession, sf_dir: str, broken: bool = False) -> str:
    """A folder of daily files of all reports, named as senders name them but for the codec.

    ``broken`` gives every seventh report two fields too many.
    """
    folder = scratch(spark)
    names = REPORT_SCHEMA.names
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    surplus = F.when(F.lit(broken) & (F.col("report_id") % 7 == 0), ",x,y").otherwise("")
    lines = reports(spark, sf_dir).select("source_date", F.concat(F.concat_ws(",", *fields), surplus).alias(",".join(names)))
    writer = lines.repartition("source_date").write.partitionBy("source_date").option("header", True)
    writer = writer.option("sep", "\u0001").option("quote", "\u0000")
    writer.option("compression", "gzip").csv(f"{folder}/days")
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(at(f"{folder}/raw"))
    # a listing of files, one for each day
    for status in files.globStatus(at(f"{folder}/days/source_date=*/part-*")):
        day = status.getPath().getParent().getName().removeprefix("source_date=")
        files.rename(status.getPath(), at(f"{folder}/raw/ais-{day}.csv.gz"))
    return f"{folder}/raw"


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ATTEMPTS_SQL, events=events(spark, sf_dir))


def stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(STAGES_SQL, events=events(spark, sf_dir))


def scratch(spark: SparkSession) -> str:
    """A new place in the folder all executors share, for queries that write and read back.

    Only a local session, as in tests, may have none configured.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        shared = tempfile.mkdtemp(prefix="run-scratch-", dir="/tmp")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"
