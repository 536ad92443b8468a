"""Bulk validation of submitted ratings."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ratemill.functions.numbers import to_id, to_rating
from ratemill.schemas import EVENT_COLUMNS

# Checked in this order; the first field at fault gives the reason.
SUBMITTED = {"user_id": to_id, "movie_id": to_id, "rating": to_rating}


def parse_submissions(bodies: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """JSON bodies in ``value`` to text columns, plus the columns in ``keep``.

    A fractional JSON number given as an id loses its fraction; the same
    number given as a string does not, and is rejected by validation.
    """

    body = F.try_parse_json(F.col("value").cast("string")).alias("_body")
    # Each member is taken out of the body once, and its type and texts are columns of
    # their own, so that the tests below read them and not the body again.
    members = bodies.select(body, *keep).select(
        *[F.try_variant_get("_body", f"$.{name}", "variant").alias(f"_{name}") for name in SUBMITTED],
        *keep,
    )
    read = members.select(
        *[F.schema_of_variant(f"_{name}").alias(f"_kind_{name}") for name in SUBMITTED],
        *[F.try_variant_get(f"_{name}", "$", "string").alias(f"_text_{name}") for name in SUBMITTED],
        *[F.try_variant_get(f"_{name}", "$", "double").alias(f"_number_{name}") for name in SUBMITTED],
        *keep,
    )

    def field(name: str) -> Column:
        kind, text, number = (F.col(f"_{part}_{name}") for part in ("kind", "text", "number"))
        # A list or an object has no text; its type then stands for it.
        text = F.coalesce(text, F.nullif(kind, F.lit("VOID")))
        if name == "rating":
            return text
        fractional = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
        return F.when(fractional, number.try_cast("bigint").cast("string")).otherwise(text)

    return read.select(*[field(name).alias(name) for name in SUBMITTED], *keep)


def validate_submissions(
    submissions: DataFrame,
    time_column: str | None = None,
    rating_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Typed event columns and ``reason``, which is NULL for accepted rows.

    ``submissions`` has text columns ``user_id``, ``movie_id`` and ``rating``.
    Reasons are ``missing_<field>`` and ``invalid_<field>``. The event time is
    ``time_column``, or the current second. A ``rating_range`` is optional.
    """
    seconds = F.col(time_column).cast("bigint") if time_column else F.unix_timestamp()
    typed = {name: parse(F.col(name)) for name, parse in SUBMITTED.items()}
    if rating_range is not None:
        low, high = rating_range
        typed["rating"] = F.when(typed["rating"].between(low, high), typed["rating"])
    # Parsed once; the reasons below only look at the results.
    parsed = submissions.select(
        *[value.alias(name) for name, value in typed.items()],
        seconds.alias("timestamp"),
        *[F.col(name).isNull().alias(f"_missing_{name}") for name in typed],
    )
    reason = F.coalesce(
        *[
            F.when(F.col(f"_missing_{name}"), F.lit(f"missing_{name}")).when(
                F.col(name).isNull(), F.lit(f"invalid_{name}")
            )
            for name in typed
        ]
    )
    return parsed.select(*EVENT_COLUMNS, reason.alias("reason"))


def accepted(validated: DataFrame) -> DataFrame:
    """Events that may be published."""
    return validated.where("reason IS NULL").select(*EVENT_COLUMNS)


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where("reason IS NOT NULL")
