"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines of a text are a window. Windows that occur more than
once anywhere are found by their hashes, and all lines that a later occurrence covers
go. Occurrences are ordered by doc_id (null last), then row, then position. Of every
line text at least one copy stays: a removed line has an equal one earlier.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ratemill.llm.tables import unused, with_row_key, written

WINDOW = 3


def lines_of(text: Column) -> Column:
    """Lines of a text; none where it is null."""
    return F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))


def _line_hashes(lines: Column) -> dict[str, Column]:
    """Two independent 64-bit hashes of every line: with one alone, some of 10^11
    different windows would count as equal."""
    return {
        "line_one": F.transform(lines, lambda line: F.xxhash64(line)),
        "line_two": F.transform(lines, lambda line: F.xxhash64(F.lit("line"), line)),
    }


def _windows(window: int) -> Column:
    """Hashes of every window, from the columns of line hashes."""
    last = F.size("line_one") - window
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )

    def hashes(at: Column) -> Column:
        return F.struct(
            F.xxhash64(*[F.get("line_one", at + i) for i in range(window)]).alias("one"),
            F.xxhash64(*[F.get("line_two", at + i) for i in range(window)]).alias("two"),
        )

    return F.transform(starts, hashes)


def _covered(docs: DataFrame, text: str, doc_id: str, window: int) -> DataFrame:
    """(file, row, covered): numbers of lines inside later occurrences."""
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "file", "row", "at")
    windows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"), "file", "row", lines_of(F.col(text)).alias("lines")
        )
        .withColumns(_line_hashes(F.col("lines")))
        .select("doc_id", "file", "row", F.posexplode(_windows(window)).alias("at", "hash"))
        .select("doc_id", "file", "row", "at", "hash.one", "hash.two"),
        "windows",
    ).withColumn("place", place)
    repeated = (
        windows.groupBy("one", "two")
        .agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    later = windows.join(repeated, ["one", "two"]).where("place > first")
    inside = F.transform(F.collect_list("at"), lambda at: F.sequence(at, at + window - 1))
    return later.groupBy("file", "row").agg(
        F.array_sort(F.array_distinct(F.flatten(inside))).alias("covered")
    )


def deduplicate(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    covered: str | None = None,
) -> DataFrame:
    """``docs`` with the covered lines of each text removed.

    The columns are those of ``docs``, and ``covered`` where it is given: the sorted
    numbers (from 0) of removed lines. A text of fewer lines than a window stays as
    it is, so does a null; one whose lines are all covered becomes empty. Repeated
    rows are later occurrences of each other. An empty table gives no rows.
    """
    file, row, found, lines = unused(docs, "file", "row", "covered", "lines")
    keyed = with_row_key(docs, file, row)
    gone = _covered(
        keyed.select(
            F.col(doc_id).alias("doc_id"),
            F.col(text).alias("text"),
            F.col(file).alias("file"),
            F.col(row).alias("row"),
        ),
        "text",
        "doc_id",
        window,
    ).select(F.col("file").alias("f"), F.col("row").alias("r"), F.col("covered").alias(found))
    joined = keyed.alias("d").join(
        gone.alias("g"), (F.col(f"d.{file}") == F.col("g.f")) & (F.col(f"d.{row}") == F.col("g.r")), "left"
    )
    split = lines_of(F.col(f"d.{text}"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(f"g.{found}"))
    shorter = F.array_join(F.transform(kept, lambda at: F.get(split, at)), "\n")
    new = F.when(F.col(f"g.{found}").isNull(), F.col(f"d.{text}")).otherwise(shorter)
    columns = [new.alias(c) if c == text else F.col("d.`" + c.replace("`", "``") + "`") for c in docs.columns]
    if covered:
        none = F.array().cast("array<int>")
        columns.append(F.coalesce(F.col(f"g.{found}"), none).alias(covered))
    return joined.select(*columns)
