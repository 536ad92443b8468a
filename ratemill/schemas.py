"""Fixed schemas of the data contract. Nothing is inferred."""

from pyspark.sql import types as T

EVENT = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("movie_id", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),  # Unix seconds
    ]
)

EVENT_COLUMNS = EVENT.fieldNames()

# One event per user, item and second; rating is not part of the key.
EVENT_KEY = ["user_id", "movie_id", "timestamp"]

FACT = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("movie_id", T.IntegerType()),
        T.StructField("date_id", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
    ]
)

RECOMMENDATIONS = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField(
            "recommendations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("movie_id", T.IntegerType()),
                        T.StructField("rating", T.FloatType()),
                    ]
                )
            ),
        ),
    ]
)
