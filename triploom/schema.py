"""Table schemas: the raw trip record and the six star tables."""

from pyspark.sql import types as T

# Raw trip file: five text columns, header row, in this order.
RAW_TRIP = T.StructType([
    T.StructField("region", T.StringType(), True),
    T.StructField("origin_coord", T.StringType(), True),
    T.StructField("destination_coord", T.StringType(), True),
    T.StructField("datetime", T.StringType(), True),
    T.StructField("datasource", T.StringType(), True),
])

# Surrogate ids are BIGINT: coord_time has a member per point pair and range.
REGION = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("description", T.StringType(), True),
])

DATASOURCE = REGION

COORD = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("x", T.DoubleType(), True),
    T.StructField("y", T.DoubleType(), True),
])

TIME_RANGE = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("range", T.StringType(), True),
    T.StructField("time_from", T.IntegerType(), True),
    T.StructField("time_to", T.IntegerType(), True),
])

COORD_TIME = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("origin_coord_id", T.LongType(), True),
    T.StructField("dest_coord_id", T.LongType(), True),
    T.StructField("time_range_id", T.IntegerType(), True),
])

TRIP = T.StructType([
    T.StructField("region_id", T.LongType(), True),
    T.StructField("coord_time_id", T.LongType(), True),
    T.StructField("datasource_id", T.LongType(), True),
    T.StructField("datetime", T.TimestampNTZType(), True),
])

STAR_TABLES = {
    "region": REGION,
    "datasource": DATASOURCE,
    "coord": COORD,
    "time_range": TIME_RANGE,
    "coord_time": COORD_TIME,
    "trip": TRIP,
}

# Natural key of each dimension (the columns a new member is matched on).
DIM_KEYS = {
    "region": ["description"],
    "datasource": ["description"],
    "coord": ["x", "y"],
    "coord_time": ["origin_coord_id", "dest_coord_id", "time_range_id"],
}
