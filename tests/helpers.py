from datetime import datetime

from cabflow.schemas import FARE_SCHEMA, TRIP_SCHEMA

T0 = datetime(2013, 1, 7, 10, 0, 0)  # a Monday


def trip(medallion="M1", hack="H1", vendor="CMT", pickup=T0, dropoff=datetime(2013, 1, 7, 10, 10, 0),
         pax=1, secs=600, dist=2.0, rate=None, flag=None, plon=-73.98, plat=40.75, dlon=-73.97, dlat=40.76):
    return (medallion, hack, vendor, rate, flag, pickup, dropoff, pax, secs, dist, plon, plat, dlon, dlat)


def fare(medallion="M1", hack="H1", vendor="CMT", pickup=T0, payment="CRD", fare_amt=10.0, tip=1.0, total=12.0):
    return (medallion, hack, vendor, pickup, payment, fare_amt, 0.5, 0.5, tip, 0.0, total)


def trips_df(spark, rows):
    return spark.createDataFrame(rows, TRIP_SCHEMA)


def fares_df(spark, rows):
    return spark.createDataFrame(rows, FARE_SCHEMA)
