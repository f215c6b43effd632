"""Declared schemas. Nothing in this package infers CSV or JSON schemas."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_int, _long, _double, _text = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

_NAMED = {"int": _int, "long": _long, "double": _double, "string": _text}


def struct_of(**fields: str) -> T.StructType:
    """Schema from column=type pairs, e.g. ``struct_of(id="long", name="string")``."""
    return _struct(*[(name, _NAMED[dtype]) for name, dtype in fields.items()])


# External file and message layouts the jobs exchange with other systems.
TAXI_FACTS = _struct(
    ("VendorID", _int),
    ("tpep_pickup_datetime", T.TimestampType()),
    ("tpep_dropoff_datetime", T.TimestampType()),
    ("passenger_count", _int),
    ("trip_distance", _double),
    ("RatecodeID", _int),
    ("store_and_fwd_flag", _text),
    ("PULocationID", _int),
    ("DOLocationID", _int),
    ("payment_type", _int),
    ("fare_amount", _double),
    ("extra", _double),
    ("mta_tax", _double),
    ("tip_amount", _double),
    ("tolls_amount", _double),
    ("improvement_surcharge", _double),
    ("total_amount", _double),
)
TAXI_ZONES = _struct(
    ("LocationID", _int), ("Borough", _text), ("Zone", _text), ("service_zone", _text)
)
USERS = _struct(("user_id", _long), ("user_name", _text))

IRIS_MEASURES = _struct(
    ("sepal_length", _double),
    ("sepal_width", _double),
    ("petal_length", _double),
    ("petal_width", _double),
)
IRIS = T.StructType(IRIS_MEASURES.fields + [T.StructField("species", _text, True)])

OCCUPANCY_LINE = _struct(
    ("date", _text),
    ("Temperature", _double),
    ("Humidity", _double),
    ("Light", _double),
    ("CO2", _double),
    ("HumidityRatio", _double),
    ("Occupancy", _int),
)
OCCUPANCY_LAKE = T.StructType(
    OCCUPANCY_LINE.fields[1:]
    + _struct(("hour", _int), ("minute", _int), ("second", _int)).fields
)
OCCUPANCY_PREDICTION = _struct(("Timestamp", _text), ("Occupancy", _int), ("Prediction", _int))

BOOKS = _struct(
    ("Name", _text),
    ("Author", _text),
    ("UserRating", _double),
    ("Reviews", _int),
    ("Price", _double),
    ("Year", _int),
    ("Genre", _text),
)
COUNTRIES = _struct(
    ("name", _struct(("common", _text), ("official", _text))),
    ("region", _text),
    ("area", _double),
    ("capital", T.ArrayType(_text)),
)

# Row shape of Spark's own Kafka source; file-backed message stores use it too.
MESSAGES = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", _text),
    ("partition", _int),
    ("offset", _long),
    ("timestamp", T.TimestampType()),
)

DAY_PARTITIONS = _struct(("year", _int), ("month", _int), ("day", _int))
