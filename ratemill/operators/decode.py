"""Event messages to typed columns and back; batch and streaming alike."""

from pyspark.sql import DataFrame, functions as F

from ratemill.schemas import EVENT, EVENT_COLUMNS


def parse_events(messages: DataFrame) -> DataFrame:
    """Decode ``value`` as a JSON event.

    Permissive: a field of the wrong type is NULL, and text that is no object
    gives a row of NULLs. The raw table keeps such rows; cleaning drops them.

    ``inline`` flattens the struct as a generator: later filters stay above it,
    where a plain projection would let each of them decode the text again.
    """
    text = F.col("value").cast("string")
    return messages.select(F.inline(F.array(F.from_json(text, EVENT))))


def encode_events(ratings: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``, ready to publish."""
    return ratings.select(F.to_json(F.struct(*EVENT_COLUMNS)).alias("value"))
