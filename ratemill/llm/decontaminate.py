"""Benchmark decontamination: windows of test words looked up in a hash set.

The test side is cut into windows of consecutive words (an item shorter than a window
is one window). Hashes of all distinct windows form a set that goes to every task with
the plan; every window of a training text is hashed and looked up, and a hit is
verified by the window's words themselves. It is one projection over the documents:
no shuffle of texts, no UDF.

The set is sent along only up to ``SET_WINDOWS`` windows. Beyond, the lookup is a join
of window hashes with the windows (distinct, so a frequent window is one row there)
that Spark may split, and only rows with a hit are verified; the results are the same.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ratemill.llm.tables import columns_of, lower_ascii, unused, with_row_key

WINDOW = 10
#: Distinct windows (hash and words) that are sent to every task at most.
SET_WINDOWS = 100_000
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case; none where it is null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_A_WORD), "")


def _hash_at(hashes: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + i) for i in range(length)])


def _words_at(words: Column, at: Column, length: int) -> Column:
    return F.array_join(F.slice(words, at + 1, F.lit(length)), " ")


def _starts(words: Column, length: int) -> Column:
    """First positions (from 0) of all windows of ``length`` words."""
    none = F.array().cast("array<int>")
    last = F.size(words) - length
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(none)


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


@dataclass(frozen=True)
class Windows:
    """The distinct windows of a benchmark: (length, hash, words, items)."""

    table: DataFrame
    lengths: list[int]
    count: int


def benchmark_windows(
    benchmark: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW
) -> Windows:
    words = benchmark.select(F.col(item_id).alias("item"), words_of(F.col(text)).alias("words"))
    length = F.least(F.size("words"), F.lit(window))
    cut = words.where(F.size("words") > 0).select(
        "item", "words", length.alias("length"),
        F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("at"),
    )
    table = (
        cut.select("item", "length", F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ").alias("window"))
        .groupBy("length", "window")
        .agg(F.collect_set("item").alias("items"))
    )
    sizes = table.groupBy("length").count().collect()  # one row per length, ``window`` at most
    return Windows(table, sorted(row["length"] for row in sizes), sum(row["count"] for row in sizes))


def _probe_at(hashes: Column, at: Column, length: int) -> Column:
    """Hash of the first, middle and last word only: a cheap test that lets few by."""
    return F.xxhash64(*[F.get(hashes, at + i) for i in sorted({0, length // 2, length - 1})])


def _in_set(windows: Windows, words: str, hashes: str) -> Column:
    """Verified windows of a text, by the hash sets sent with the plan.

    The sets are written into an IN list, which Spark turns into a hash set. Words
    hold no ASCII character but letters and digits, so that they need no quoting.
    """
    probes = _by_length(windows.lengths, _probe_at)
    full = _by_length(windows.lengths, _hash_at)
    rows = windows.table.select("length", "window", probes.alias("probe"), full.alias("hash"))
    known = rows.collect()  # SET_WINDOWS rows at most
    found = []
    for length in windows.lengths:
        own = [row for row in known if row["length"] == length]
        at = [f"get({hashes}, at + {i})" for i in range(length)]
        probe = ", ".join(at[i] for i in sorted({0, length // 2, length - 1}))
        window = f"array_join(slice({words}, at + 1, {length}), ' ')"
        starts = f"sequence(0, greatest(size({words}) - {length}, 0))"
        found.append(
            f"transform(filter(if(size({words}) < {length}, array(), {starts}), at ->"
            f" xxhash64({probe}) IN ({_listed({row['probe'] for row in own})})"
            f" AND xxhash64({', '.join(at)}) IN ({_listed({row['hash'] for row in own})})"
            f" AND array_contains(split('{'|'.join(row['window'] for row in own)}', '[|]'), {window})),"
            f" at -> named_struct('at', at, 'length', {length}, 'window', {window}))"
        )
    return F.expr(f"concat({', '.join(found)})")


def _listed(keys: set[int]) -> str:
    return ", ".join(f"bigint('{key}')" if key == -(2**63) else f"{key}L" for key in sorted(keys))


def _by_length(lengths: list[int], hash_at) -> Column:
    hashes = _hashed(F.split("window", " "))
    chosen = F.lit(None).cast("long")
    for length in lengths:
        chosen = F.when(F.col("length") == length, hash_at(hashes, F.lit(0), length)).otherwise(chosen)
    return chosen


def _hashed_places(words: Column, hashes: Column, length: int) -> Column:
    def place(at: Column) -> Column:
        return F.struct(
            at.alias("at"), F.lit(length).alias("length"), _hash_at(hashes, at, length).alias("hash")
        )

    return F.transform(_starts(words, length), place)


def _by_join(
    docs: DataFrame, windows: Windows, text: str, hits: str, key: tuple[str, str] | None
) -> DataFrame:
    """``docs`` with verified windows, looked up by a join that can be shuffled."""
    file, row, words, hashes = unused(docs, "file", "row", "words", "hashes")
    keyed = docs if key else with_row_key(docs, file, row)
    file, row = key or (file, row)
    cut = keyed.select(file, row, words_of(F.col(text)).alias(words)).withColumn(hashes, _hashed(F.col(words)))
    places = F.concat(*[_hashed_places(F.col(words), F.col(hashes), n) for n in windows.lengths])
    known = windows.table.select("length", _by_length(windows.lengths, _hash_at).alias("hash")).distinct()
    met = (
        cut.select(file, row, F.inline(places))
        .join(known, ["length", "hash"], "left_semi")
        .select(F.col(file).alias("f"), F.col(row).alias("r"), "at", "length")
    )
    seen = met.join(cut.select(F.col(file).alias("f"), F.col(row).alias("r"), F.col(words).alias("words")), ["f", "r"])
    named = seen.select("f", "r", "at", "length", F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ").alias("window"))
    verified = (
        named.join(windows.table.select("length", "window"), ["length", "window"], "left_semi")
        .groupBy("f", "r")
        .agg(F.sort_array(F.collect_list(F.struct("at", "length", "window"))).alias(hits))
    )
    return keyed.join(verified, (keyed[file] == F.col("f")) & (keyed[row] == F.col("r")), "left").select(
        *columns_of(docs),
        F.coalesce(hits, F.array().cast("array<struct<at:int,length:int,window:string>>")).alias(hits),
        F.size(words_of(F.col(text))).alias(f"{hits}_words"),
    )


def find_windows(
    docs: DataFrame,
    windows: Windows,
    text: str,
    hits: str,
    set_windows: int = SET_WINDOWS,
    key: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with the array ``hits`` of (at, length, window) and ``<hits>_words``;
    ``key`` names two columns that tell its rows apart, if it has them."""
    if not windows.count:
        none = F.array().cast("array<struct<at:int,length:int,window:string>>")
        return docs.withColumns({hits: none, f"{hits}_words": F.size(words_of(F.col(text)))})
    if windows.count > set_windows:
        return _by_join(docs, windows, text, hits, key)
    words, hashes, number = unused(docs, "words", "hashes", "number")
    with_words = docs.withColumn(words, words_of(F.col(text)))
    hashed = with_words.withColumns(
        {hashes: _hashed(F.col(words)), number: F.monotonically_increasing_id()}
    )
    # The number keeps filters above this step: below, they would cut and hash the
    # text again for every window.
    return hashed.where(F.col(number) >= 0).select(
        *columns_of(docs),
        _in_set(windows, words, hashes).alias(hits),
        F.size(words).alias(f"{hits}_words"),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    window: int = WINDOW,
    set_windows: int = SET_WINDOWS,
) -> DataFrame:
    """(doc_id, n_words, positions, items), one row per row of ``docs``.

    ``positions`` are the sorted numbers (from 0) of the words inside any benchmark
    window, ``items`` the sorted ids, as strings, of items with such a window. A null
    or empty text has no words on either side; an item of fewer than ``window``
    words, but not none, is one window. Repeated items and windows count once, items
    without an id are hit but not named, repeated documents stay, and an empty
    benchmark hits nothing. Other columns do not matter.
    """
    windows = benchmark_windows(benchmark, text, item_id, window)
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # Hits of a row meet again after a shuffle: by a key that a task which is run again,
    # maybe on rows in another order, gives to the same rows.
    key = ("file", "row")
    found = find_windows(with_row_key(chosen, *key), windows, "text", "hits", set_windows, key)
    hit = found.select(*key, "doc_id", "hits_words", F.explode_outer("hits").alias("hit")).select(
        *key, "doc_id", "hits_words", "hit.*"
    )
    named = hit.join(windows.table.select("window", "items"), "window", "left")
    inside = F.array_sort(
        F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1))))
    )
    items = F.array_distinct(F.flatten(F.collect_set("items")))
    return (
        named.groupBy(*key)
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("hits_words").alias("n_words"),
            inside.alias("positions"),
            F.array_sort(F.transform(items, lambda item: item.cast("string"))).alias("items"),
        )
        .drop(*key)
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **parameters) -> DataFrame:
    """Rows of ``docs`` without any benchmark window, in the columns of ``docs``.

    Null and empty texts hold none and stay, repeated rows are judged one by one, an
    empty benchmark removes nothing, and an empty table gives no rows.
    """
    (hits,) = unused(docs, "hits")
    set_windows = parameters.pop("set_windows", SET_WINDOWS)
    windows = benchmark_windows(benchmark, **parameters)
    found = find_windows(docs, windows, text, hits, set_windows)
    return found.where(F.size(hits) == 0).select(*columns_of(docs))
