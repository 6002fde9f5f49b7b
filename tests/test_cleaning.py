"""Clock times, zones, rollovers, targets: literal expected values."""

import pytest
from pyspark.sql import functions as F

from legwork import schemas, session
from legwork.functions import scalars as s
from legwork.functions import times as t
from legwork.operators import calendar, clean, target
from legwork.sources import views



def one(df):
    return df.collect()


@pytest.mark.parametrize("hhmm,expected", [(2400, 0), (5, 5), (1260, None), (None, None), (2359, 1439), (2500, None), (-5, None)])
def test_hhmm(spark, hhmm, expected):
    df = spark.createDataFrame([(hhmm,)], "x double" if hhmm is None else "x int")
    assert df.select(t.minutes_of_hhmm(F.col("x"))).first()[0] == expected


@pytest.mark.parametrize(
    "local,zone,utc",
    [
        ("2014-03-09 02:30:00", "America/New_York", "2014-03-09 07:00:00"),  # spring gap
        ("2014-11-02 01:30:00", "America/New_York", "2014-11-02 05:30:00"),  # autumn fold
        ("2014-01-05 10:15:00", "America/Los_Angeles", "2014-01-05 18:15:00"),
    ],
)
def test_to_utc(spark, local, zone, utc):
    df = spark.sql(f"SELECT timestamp_ntz '{local}' AS l, '{zone}' AS z")
    df = df.withColumn("u", t.to_utc("l", "z")).withColumn("u", t.leave_gap("u", "l", "z"))
    assert str(df.first()["u"]) == utc


@pytest.mark.parametrize("ts,up", [("10:00:00", "10:00:00"), ("10:00:01", "11:00:00"), ("10:59:59.999999", "11:00:00")])
def test_ceil_hour(spark, ts, up):
    df = spark.sql(f"SELECT timestamp_ntz '2024-01-01 {ts}' AS x").select(t.ceil_hour(F.col("x")).alias("y"))
    assert str(df.first()["y"]) == f"2024-01-01 {up}"


def raw_leg(**values):
    base = {n: None for n in schemas.RAW_LEG_TYPES}
    base.update(
        Year=2014, Month=5, DayofMonth=10, DayOfWeek=6, FlightDate="2014-05-10", Reporting_Airline="AA",
        Tail_Number="N1", Flight_Number_Reporting_Airline=1, Origin="JFK", Dest="LAX", CRSDepTime=1000,
        CRSArrTime=1300, DistanceGroup=1, Cancelled=0.0, Diverted=0.0, CRSElapsedTime=360.0,
    )
    base.update(values)
    return tuple(base[n] for n in schemas.RAW_LEG_TYPES)


def cleaned(spark, *legs):
    raw = spark.createDataFrame(list(legs), schemas.RAW_LEG_SCHEMA)
    airports = spark.createDataFrame([("JFK", "America/New_York"), ("LAX", "America/Los_Angeles")], "iata_code string, TZ string")
    return clean.clean_legs(raw, airports)


def test_late_past_midnight_and_red_eye(spark):
    late = raw_leg(CRSDepTime=2350, DepTime=20.0, DepDelay=30.0, ArrTime=400.0, CRSArrTime=330)
    row = cleaned(spark, late).first()
    assert str(row["DepDateTime"]) == "2014-05-11 00:20:00"
    assert str(row["CRSArrDateTime"]) == "2014-05-11 03:30:00"
    assert str(row["CRSArrDateTime_UTC"]) == "2014-05-11 10:30:00"
    assert str(row["Information_time"]) == "2014-05-10 21:50:00"
    assert str(row["floor_informationtime_UTC"]) == "2014-05-11 01:00:00"


def test_cancelled_and_lost(spark):
    cancelled = raw_leg(Cancelled=1.0, Tail_Number="C")
    lost = raw_leg(DepTime=1000.0, Tail_Number="L")
    diverted = raw_leg(Diverted=1.0, DepTime=1000.0, ArrTime=1300.0, Tail_Number="D")
    rows = {r["Tail_Number"]: r for r in cleaned(spark, cancelled, lost, diverted).collect()}
    assert set(rows) == {"C", "D"}
    assert rows["C"]["DepTime"] is None and rows["D"]["ArrTime"] is None


def test_unknown_airport_fails(spark):
    with pytest.raises(Exception, match="Missing timezone data"):
        cleaned(spark, raw_leg(Dest="XXX", ArrTime=1.0)).select("TZ_Dest").collect()


def test_delay_classes(spark):
    cases = [(15.0, "no_delay"), (15.01, "small_delay"), (60.0, "small_delay"), (180.0, "medium_delay"),
             (180.5, "large_delay"), (-3.0, "no_delay"), (None, None), (float("nan"), None)]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, x double")
    got = dict(df.select("i", s.delay_class(F.col("x"))).collect())
    assert [got[i] for i in range(len(cases))] == [e for _, e in cases]
    assert target.add_delay_class(df, "x").count() == 6
    with pytest.raises(ValueError):
        target.add_delay_class(df, "absent")


def test_unknown_label_and_weights(spark):
    with pytest.raises(Exception, match="Unknown target label"):
        target.encode_label(spark.createDataFrame([("huge",)], "delay_class string")).collect()
    rows = spark.createDataFrame([(0.0,)] * 6 + [(1.0,)] * 2, "label double")
    got = {r["label"]: r["weight"] for r in target.class_weights(rows).collect()}
    assert got == {0.0: 8 / (2 * 6), 1.0: 8 / (2 * 2)}
    with pytest.raises(ValueError):
        target.class_weights(rows, weights=3)


def test_hash_is_exact_for_large_ids(spark):
    ids = [0, 1, 65535, 65536, 2**31, 2**33 + 7, 2**62 + 11]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "x bigint").select(s.hash32(F.col("x"))).collect()]
    assert got == [i * 2654435761 % 2**32 for i in ids]


def test_observed_holidays(spark):
    years = spark.createDataFrame([(2021,), (2022,)], "year int")
    days = {str(r["day"]) for r in calendar.holidays(years).collect()}
    # 2022-01-01 was a Saturday, 2021-07-04 a Sunday, 2021-06-19 and 2021-12-25 Saturdays
    assert {"2021-12-31", "2021-07-05", "2021-06-18", "2021-12-24", "2022-11-24", "2022-05-30"} <= days


def test_blank_and_infinite(spark):
    df = spark.createDataFrame([(" \t\n",), ("",), ("a ",), ("\u3000",)], "x string")
    assert [r[0] for r in df.select(s.is_blank(F.col("x"))).collect()] == [True, True, False, True]


def test_parts_of_legs_are_bounded_and_follow_the_time(spark, monkeypatch):
    monkeypatch.setattr(session, "LEAST_ROWS", 1)
    monkeypatch.setattr(session, "MOST_ROWS", 10)
    legs = views.raw_legs(spark, "/root/testdata/sf0.001").withColumn("part", F.spark_partition_id())
    parts = legs.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("FlightDate").alias("days")).collect()
    assert sum(r["n"] for r in parts) == 1000
    assert max(r["n"] for r in parts) <= 40 and max(r["days"] for r in parts) <= 3
