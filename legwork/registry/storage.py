"""Readers and writers, checked by reading back what was written."""

from pyspark.sql import functions as F

from legwork.registry.base import query, raw, sql
from legwork.schemas import RAW_LEG_TYPES
from legwork.session import scratch_path
from legwork.sources import archive, sinks, tables, views

_COLS = ", ".join(f'"{c}"' for c in RAW_LEG_TYPES)


def written_months(spark, d):
    """The raw records as one file per month of the source, and their years."""
    root = scratch_path(spark, "months")
    rows = raw(spark, d).drop("FlightID")
    months = sorted(tuple(r) for r in rows.select("Year", "Month").distinct().collect())
    for year, month in months:  # absent months are skipped by the reader
        part = rows.filter((F.col("Year") == year) & (F.col("Month") == month))
        sinks.write_csv(part, tables.month_paths(root, [year], [month])[0])
    return root, sorted({y for y, _ in months})


@query("csv_roundtrip", sql(["raw"], f"SELECT {_COLS} FROM raw"))
def csv_roundtrip(spark, d):
    path = sinks.write_csv(raw(spark, d).drop("FlightID"), scratch_path(spark, "raw") + ".csv")
    return tables.read_raw_csv(spark, [path])


@query("month_scan", sql(["raw"], """
SELECT "Year", "Month", CAST(count(*) AS BIGINT) AS legs, CAST(sum(Distance) AS BIGINT) AS distance FROM raw GROUP BY ALL"""))
def month_scan(spark, d):
    found = tables.read_months(spark, *written_months(spark, d))
    return found.groupBy("Year", "Month").agg(
        F.count(F.lit(1)).alias("legs"), F.sum("Distance").cast("bigint").alias("distance"))


@query("monthly_copy", sql(["raw"], """
SELECT CAST("Year" AS INTEGER) AS "Year", CAST("Month" AS INTEGER) AS "Month", CAST(count(*) AS BIGINT) AS legs, CAST(count(ArrTime) AS BIGINT) AS arrived FROM raw GROUP BY ALL"""))
def monthly_copy(spark, d):
    path = sinks.copy_raw_months(raw(spark, d).drop("FlightID"), scratch_path(spark, "copy"))
    return spark.read.option("header", True).csv(path).groupBy("Year", "Month").agg(
        F.count(F.lit(1)).alias("legs"), F.count("ArrTime").alias("arrived"))


@query("archive_ingest", sql(["raw"], f"SELECT {_COLS} FROM raw"))
def archive_ingest(spark, d):
    """Two ingests: the second reads only the archives that the first did not load."""
    path = scratch_path(spark, "archives")
    written = archive.write_archives(raw(spark, d), path)
    first = written.filter(F.crc32("archive") % 2 == 0)
    early = archive.read_archives(spark, path, written.join(first, "archive", "left_anti"))
    return early.unionByName(archive.read_archives(spark, path, first)).drop("archive")


@query("scan_by_suffix", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_by_suffix(spark, d):
    customer = tables.read_table(spark, f"{d}/customer.parquet")
    path = sinks.write_csv(customer, scratch_path(spark, "customer") + ".tsv", sep="\t")
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return tables.read_table(spark, path, schema)


@query("message_text", """
SELECT user_id AS src, CAST(json_extract_string(props, '$.k') AS BIGINT) AS dst, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS unix_ts FROM events""")
def message_text(spark, d):
    path = scratch_path(spark, "messages")
    views.messages(spark, d).write.option("sep", " ").csv(path)
    return tables.read_messages(spark, path)


@query("edge_csv", "SELECT user_id AS src_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS target_id FROM events")
def edge_csv(spark, d):
    path = sinks.write_csv(views.edges(spark, d), scratch_path(spark, "edges"))
    nodes = sinks.write_csv(views.nodes(spark, d), scratch_path(spark, "nodes"))
    return tables.read_graph(spark, path, nodes)[0]


@query("node_csv", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END AS dead_account,
  ['EN', 'DE', 'FR', 'ES', 'NL', 'OTHER'][c_nationkey % 6 + 1] AS language,
  CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS affiliate_status,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS explicit_content,
  CAST(floor(greatest(c_acctbal, 0)) AS BIGINT) AS view_count, c_custkey * 37 % 2000 AS account_lifetime FROM customer""")
def node_csv(spark, d):
    path = sinks.write_csv(views.edges(spark, d), scratch_path(spark, "edges"))
    nodes = sinks.write_csv(views.nodes(spark, d), scratch_path(spark, "nodes"))
    columns = ["id", "dead_account", "language", "affiliate_status", "explicit_content", "view_count", "account_lifetime"]
    return tables.read_graph(spark, path, nodes)[1].select(*columns)


@query("station_columns", sql(["airport_dim"], """
SELECT iata_code, airport_station, closest_station_1, CAST(closest_station_1_distance AS DOUBLE) AS closest_station_1_distance, closest_station_2,
  CAST(closest_station_2_distance AS DOUBLE) AS closest_station_2_distance, closest_station_3, CAST(closest_station_3_distance AS DOUBLE) AS closest_station_3_distance FROM airport_dim"""))
def station_columns(spark, d):
    from legwork.operators import weather
    return weather.station_columns(views.airports(spark, d))


@query("preview")
def preview(spark, d):
    return tables.preview(views.table(spark, d, "events"), 1000)


@query("json_rows", "SELECT n_nationkey, CAST(to_json(nation) AS VARCHAR) AS json FROM nation")
def json_rows(spark, d):
    nation = views.table(spark, d, "nation")
    return nation.select("n_nationkey", F.to_json(F.struct(*nation.columns)).alias("json"))
