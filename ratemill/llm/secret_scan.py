"""Secret scans with an incremental ledger of blobs.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger
holds a row for each pair of blob and rule version that was scanned, also where
nothing was found. A run scans only pairs that the ledger lacks, each blob once however
many paths hold it, appends them, and joins findings back to all paths and versions.
Everything is SQL functions; spans come from the lengths of matches and of the text
between them.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratemill.llm.tables import written
from ratemill.sources.storage import children


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches whose ``group`` has ``least`` characters."""

    name: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1


#: What counts as a secret, in the order in which spans are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=2,
    ),
    # A match of these two is what is left of a run of its characters, so the lengths
    # asked for (16 and 32 in all) can be in the pattern: a run that is too short has
    # no other match, and short runs, of which prose is full, are never listed.
    Rule("access", r"AKIA[A-Z0-9]{12,}", least=16),
    Rule("hex", r"[0-9a-f]{32,}", least=32),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", least=1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=1),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob_id binary, rule string, rule_version int, spans array<struct<start:int,end:int>>"


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _pieces(text: Column, rules: tuple[Rule, ...], missing: Column) -> Column:
    """Array of (rule, version, before, found, tested): matches in order, per rule."""
    found = []
    for rule in rules:
        may_match = F.array_contains(missing, rule.name) & text.rlike(rule.pattern)
        zipped = F.arrays_zip(
            F.split(text, rule.pattern, -1).alias("before"),
            F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("found"),
            F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("tested"),
        )

        found.append(F.when(may_match, F.struct(F.lit(rule.name).alias("rule"), zipped.alias("matches"))))
    return F.array_compact(F.array(*found))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for ``blobs`` of (blob_id, text, missing), missing: names of rules."""
    least = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.least)])
    versions = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.version)])
    pieces = _pieces(F.col("text"), rules, F.col("missing"))

    def lengths(match: Column) -> Column:
        return F.struct(*[F.char_length(match[name]).alias(name) for name in ("before", "found", "tested")])

    def measured(piece: Column) -> Column:
        return F.struct(piece["rule"].alias("rule"), F.transform(piece["matches"], lengths).alias("matches"))

    cut = written(
        blobs.select("blob_id", "missing", pieces.alias("pieces")).select(
            "blob_id", "missing", F.transform("pieces", measured).alias("pieces")
        ),
        "matches",
    )
    found_in = F.transform("pieces", lambda piece: piece["rule"])
    nothing = cut.select("blob_id", F.explode(F.array_except("missing", found_in)).alias("rule")).withColumn(
        "spans", F.array().cast("array<struct<start:int,end:int>>")
    )
    placed = (
        cut.select("blob_id", F.inline("pieces"))
        .select("blob_id", "rule", F.posexplode("matches").alias("number", "match"))
        .where("match.found is not null")
    )
    # The end of a match is the sum of all lengths up to it.
    end = F.expr("int(sum(match.before + match.found) over (partition by blob_id, rule order by number))")
    span = F.expr("struct(end - match.found as start, end)")
    spans = (
        placed.select("blob_id", "rule", "match", end.alias("end"))
        .groupBy("blob_id", "rule")
        .agg(
            F.sort_array(
                F.collect_list(F.when(F.col("match.tested") >= least[F.col("rule")], span))
            ).alias("spans")
        )
    )
    return nothing.union(spans).select(
        "blob_id", "rule", versions[F.col("rule")].alias("rule_version"), "spans"
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not any(name.startswith("part-") for name in children(spark, path)):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def scan_versions(
    versions: DataFrame,
    ledger: str,
    rules: tuple[Rule, ...] = RULES,
    keys: tuple[str, ...] = ("path", "version"),
    text: str = "text",
) -> DataFrame:
    """(*keys, blob_id, findings): one row per row of ``versions``; the ledger grows.

    ``findings`` are (start, rank, end, rule) by start, then by the rules' order;
    positions are code points, ``end`` is exclusive. Pairs of blob and rule version
    that the ledger at path ``ledger`` has are not scanned again; a rule with a new
    version is. A null text is the empty blob. Null or repeated keys stay as they
    are, an empty table gives no rows, other columns do not matter. A run that is
    cut off leaves the ledger without its pairs, and the next run scans them.
    """
    spark = versions.sparkSession
    listed = versions.select(*keys, blob_of(F.col(text)).alias("blob_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    paths = written(listed.drop("text"), "paths")
    current = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules])
    known = (
        read_ledger(spark, ledger)
        .groupBy("blob_id")
        .agg(F.collect_set(F.struct("rule", "rule_version")).alias("known"))
    )
    unseen = F.array_except(current, F.coalesce("known", F.array().cast("array<struct<rule:string,rule_version:int>>")))
    missing = (
        paths.select("blob_id").distinct().join(known, "blob_id", "left")
        .select("blob_id", unseen["rule"].alias("missing"))
        .where(F.size("missing") > 0)
    )
    # Copies of a blob are one row per task before the shuffle.
    texts = listed.groupBy("blob_id").agg(F.first("text").alias("text"))
    scan(texts.join(missing, "blob_id"), rules).write.mode("append").parquet(ledger)
    rank = F.create_map(*[F.lit(x) for at, rule in enumerate(rules) for x in (rule.name, at)])
    valid = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.version)])
    found = (
        read_ledger(spark, ledger)
        .where((F.size("spans") > 0) & (F.col("rule_version") == valid[F.col("rule")]))
        .select("blob_id", "rule", F.inline("spans"))
        .distinct()
        .groupBy("blob_id")
        .agg(F.sort_array(F.collect_list(F.struct("start", rank[F.col("rule")].alias("rank"), "end", "rule"))).alias("findings"))
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int,rule:string>>")
    return paths.join(found, "blob_id", "left").select(*keys, "blob_id", F.coalesce("findings", none).alias("findings"))
