"""Registered queries of the subpackage: thin digests of what the operators give."""

from itertools import permutations
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratemill.llm import (
    bpe,
    chat,
    decontaminate,
    filter_audit,
    kdtree,
    licences,
    lines,
    matrix_bpe,
    max_sketch,
    pii,
    quality,
    secret_scan,
    simhash,
)
from ratemill.llm.tables import digest_of, read
from ratemill.sources.storage import fresh_folder


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def _spans(findings, kinds: tuple[str, ...]):
    """Texts kind:start:end of the findings of some kinds, which are in order."""
    chosen = F.filter(findings, lambda f: f["rule"].isin(*kinds))
    return F.transform(chosen, lambda f: F.concat_ws(":", f["rule"], f["start"], f["end"]))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_versions(
        read(spark, sf_dir, "documents"), fresh_folder(spark, "llm-ledger"), keys=("doc_id",)
    )
    base = tuple(rule.name for rule in secret_scan.BASE_RULES)
    every = tuple(rule.name for rule in secret_scan.RULES)
    counts = [
        F.size(_spans(F.col("findings"), (kind,))).cast("long").alias(f"n_{kind}") for kind in base
    ]
    return found.select(
        "doc_id",
        *counts,
        digest_of(_spans(F.col("findings"), base)).alias("base_sha256"),
        F.array_join(_spans(F.col("findings"), every), ",").alias("spans"),
    )


def _ranked(rank: int):
    return lambda span: span["rank"] == rank


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, pii.KINDS))

    def listed(spans: str):
        return F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"]))

    counts = [
        F.size(F.filter("base", _ranked(at))).cast("long").alias(f"n_{kind}")
        for at, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        digest_of(listed("base")).alias("base_sha256"),
        F.array_join(listed("spans"), ",").alias("spans"),
    )


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.licences(read(spark, sf_dir, "documents"))
    confirmed = F.filter("found", lambda f: f["confirmed"])
    return found.select(
        "doc_id",
        F.col("n_paragraphs").cast("long").alias("n_paragraphs"),
        F.size("found").cast("long").alias("n_predicted"),
        F.size(confirmed).cast("long").alias("n_confirmed"),
        F.array_join(licences.confirmed_families(F.col("found")), ",").alias("families"),
        F.array_join(
            F.transform(confirmed, lambda f: F.concat_ws(":", f["family"], f["paragraph"])), ","
        ).alias("places"),
    )


def vocabulary(name: str = "byte_bpe_50k.json") -> bpe.Vocabulary:
    """A public vocabulary file, read by the driver and sent to the tasks."""
    import public_tokenizers

    content = Path(public_tokenizers.path(name)).read_text(encoding="utf-8")
    return bpe.Vocabulary.from_json(content, public_tokenizers.PATTERN)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read(spark, sf_dir, "documents"), vocabulary())


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("before"))
    return lines.deduplicate(docs, covered="covered").select(
        "doc_id",
        F.size(lines.lines_of(F.col("before"))).cast("long").alias("n_lines"),
        F.size("covered").cast("long").alias("n_removed"),
        F.char_length("text").cast("long").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10
    )
    n_hit = F.size("positions").cast("long")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        digest_of(F.col("items")).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(1).select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(-7).cast("long").alias("conv_id"),
                        F.lit(turn).cast("long").alias("turn"),
                        F.lit(role).alias("role"),
                        F.lit(said).alias("text"),
                    )
                    for turn, role in enumerate(("user", "assistant"))
                ]
            )
        ).alias("row")
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = chat.read_back(chat.format_examples(turns.union(extra.select("row.*"))))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    ).drop("filter")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = max_sketch.build_index(read(spark, sf_dir, "documents"))
    return max_sketch.search(index, read(spark, sf_dir, "benchmark"), k=10)


def ranks(name: str = "byte_bpe_50k.tiktoken") -> matrix_bpe.Ranks:
    """A public file of ranks, read by the driver and sent to the tasks."""
    import public_tokenizers

    content = Path(public_tokenizers.path(name)).read_bytes()
    return matrix_bpe.Ranks.from_tiktoken(content, public_tokenizers.PATTERN)


def op13_matrix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = ranks()
    found = matrix_bpe.decode(matrix_bpe.encode(read(spark, sf_dir, "documents"), vocab), vocab)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_secrets": op2_secrets,
    "op3_pii": op3_pii,
    "op4_licences": op4_licences,
    "op5_bpe": op5_bpe,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_exact_topk": op9_exact_topk,
    "op10_chat_format": op10_chat_format,
    "op11_filter_audit": op11_filter_audit,
    "op12_ranked_search": op12_ranked_search,
    "op13_matrix_bpe": op13_matrix_bpe,
}


#: The patterns whose short matches SQL drops after the fact.
SECRET_PATTERNS = {"access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}


def _secret_sql() -> str:
    parts = [
        f"""
        SELECT number, {at} AS rank, '{rule.name}' AS kind,
               (sum(length(before) + length(found)) OVER (PARTITION BY number ORDER BY place))::BIGINT AS stop,
               stop - length(found) AS start, length(tested) >= {rule.least} AS counts
        FROM (
            SELECT number, unnest(range(len(founds))) AS place, unnest(befores[: len(founds)]) AS before,
                   unnest(founds) AS found, unnest(testeds) AS tested
            FROM (
                SELECT number, string_split_regex(text, '{pattern}') AS befores,
                       regexp_extract_all(text, '{pattern}') AS founds,
                       regexp_extract_all(text, '{pattern}', {rule.group}) AS testeds
                FROM docs
            )
        )"""
        for at, rule in enumerate(secret_scan.RULES)
        for pattern in [SECRET_PATTERNS.get(rule.name, rule.pattern).replace("'", "''")]
    ]
    counts = ", ".join(
        f"count(*) FILTER (kind = '{rule.name}') AS n_{rule.name}" for rule in secret_scan.BASE_RULES
    )
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS number, doc_id, coalesce(text, '') AS text FROM documents),
        spans AS (SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE counts)
        SELECT doc_id, {counts},
               sha256(coalesce({listed} FILTER (rank < {len(secret_scan.BASE_RULES)}), '')) AS base_sha256,
               coalesce({listed}, '') AS spans
        FROM docs LEFT JOIN spans USING (number) GROUP BY number, doc_id
    """


def _audit_sql() -> str:
    names = "ABCDE"
    bits = {name: 1 << at for at, name in enumerate(names)}
    listed = ", ".join(f"('{''.join(order)}')" for order in permutations(names))
    flags = ", ".join(f"(CASE WHEN {name} THEN {bit} ELSE 0 END)" for name, bit in bits.items())
    return rf"""
        WITH texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), tested AS (
            SELECT doc_id, part,
                   len(words) < 100 AS A,
                   100 * len(list_distinct(words)) < 80 * len(words) AS B,
                   100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) AS C,
                   regexp_matches(text, '[#$%&*|]') AS D,
                   coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS E,
                   coalesce(doc_id IN (SELECT l.doc_id FROM labels l WHERE quality = 1), false) AS good,
                   coalesce(doc_id IN (SELECT l.doc_id FROM labels l WHERE toxic = 1), false) AS bad
            FROM texts
        ), masks AS (
            SELECT part, list_sum([{flags}])::INTEGER AS mask, count(*) AS n,
                   count(*) FILTER (good) AS n_good, count(*) FILTER (bad) AS n_bad
            FROM tested GROUP BY ALL
        ), steps AS (
            SELECT filter_order, step, ascii(filter_order[step]) - 65 AS bit,
                   list_sum([0] || list_transform(range(1, step), lambda s: 1 << (ascii(filter_order[s]) - 65)))
                       ::INTEGER AS prefix
            FROM (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step
                  FROM (VALUES {listed}) t(filter_order))
        ), counted AS (
            SELECT part, filter_order, step, bit,
                   sum(CASE WHEN mask & (prefix | (1 << bit)) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                   sum(CASE WHEN mask & prefix = 0 AND mask & (1 << bit) <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
                   sum(CASE WHEN mask & prefix <> 0 AND mask & (1 << bit) <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                   sum(CASE WHEN mask = (1 << bit) THEN n ELSE 0 END)::BIGINT AS unique_fails,
                   sum(CASE WHEN mask & prefix = 0 AND mask & (1 << bit) <> 0 THEN n_good ELSE 0 END)::BIGINT
                       AS good_lost,
                   sum(CASE WHEN mask & prefix = 0 AND mask & (1 << bit) <> 0 THEN n_bad ELSE 0 END)::BIGINT
                       AS toxic_lost
            FROM masks, steps GROUP BY ALL
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM counted
    """


_RANKED_SQL = r"""
    WITH terms AS (
        SELECT number, doc_id, unnest(words) AS term FROM (
            SELECT row_number() OVER () AS number, doc_id, list_transform(
                regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words
            FROM documents)
    ), asked AS (
        SELECT DISTINCT number, item_id, unnest(words) AS term FROM (
            SELECT row_number() OVER () AS number, item_id, list_transform(
                regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words
            FROM benchmark)
    ), lengths AS (
        SELECT number, count(*) AS n FROM terms GROUP BY number
    ), sums AS (
        SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths
    ), found AS (
        SELECT number, doc_id, term, count(*) AS tf FROM terms
        WHERE term IN (SELECT term FROM asked) GROUP BY ALL
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
        FROM (SELECT term, count(*) AS df FROM found GROUP BY term), sums
    ), norms AS (
        SELECT number, 100 - 90 + ((90 * n * docs) // words) AS m FROM lengths, sums
    ), scores AS (
        SELECT a.number, a.item_id, f.doc_id, f.number AS place,
               sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM asked a JOIN found f USING (term) JOIN weights USING (term) JOIN norms n ON n.number = f.number
        GROUP BY ALL
    )
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id NULLS LAST, place) AS rank
        FROM scores WHERE score > 0)
    WHERE rank <= 10
"""


ORACLES: dict[str, str] = {
    "op12_ranked_search": _RANKED_SQL,
    "op11_filter_audit": _audit_sql(),
    "op2_secrets": _secret_sql(),
    "op6_line_dedup": """
        WITH docs AS (
            SELECT doc_id, text, coalesce(string_split(text, chr(10)), []) AS lines,
                   row_number() OVER () AS number
            FROM documents
        ), windows AS (
            SELECT doc_id, number, pos, array_to_string(lines[pos + 1 : pos + 3], chr(10)) AS words
            FROM (SELECT *, unnest(range(len(lines) - 2)) AS pos FROM docs WHERE len(lines) >= 3)
        ), later AS (
            SELECT number, pos FROM windows
            QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, number, pos) > 1
        ), gone AS (
            SELECT number, list(DISTINCT line) AS covered
            FROM (SELECT number, unnest(range(pos, pos + 3)) AS line FROM later) GROUP BY number
        ), kept AS (
            SELECT doc_id, len(lines) AS n_lines, coalesce(len(covered), 0) AS n_removed,
                   CASE WHEN covered IS NULL THEN text ELSE array_to_string(
                       list_filter(lines, lambda line, i: NOT list_contains(covered, i - 1)), chr(10)) END AS kept
            FROM docs LEFT JOIN gone USING (number)
        )
        SELECT doc_id, n_lines, n_removed, length(kept) AS kept_chars, sha256(kept) AS kept_sha256 FROM kept
    """,
    "op8_decontaminate": r"""
        WITH doc_words AS (
            SELECT doc_id, row_number() OVER () AS number, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark
        ), cuts AS (
            SELECT item_id, words, least(len(words), 10) AS n,
                   unnest(range(len(words) - least(len(words), 10) + 1)) AS pos
            FROM items WHERE len(words) > 0
        ), windows AS (
            SELECT DISTINCT item_id, n, array_to_string(words[pos + 1 : pos + n], ' ') AS words FROM cuts
        ), places AS (
            SELECT number, words, n, unnest(range(len(words) - n + 1)) AS pos
            FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n
        ), hits AS (
            SELECT number, pos, p.n, item_id
            FROM places p JOIN windows w
              ON w.n = p.n AND w.words = array_to_string(p.words[pos + 1 : pos + p.n], ' ')
        ), covered AS (
            SELECT number, count(DISTINCT word) AS n_hit
            FROM (SELECT number, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY number
        ), named AS (
            SELECT number, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_list
            FROM (SELECT DISTINCT number, item_id::VARCHAR AS item FROM hits) GROUP BY number
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(item_list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN covered USING (number) LEFT JOIN named USING (number)
    """,
    "op9_exact_topk": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM scored
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op10_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL VALUES
                (-7, 0, 'user', '\### Assistant: </turn> ok'),
                (-7, 1, 'assistant', '\### Assistant: </turn> ok')
        ), pieces AS (
            SELECT *,
                   4 + length(replace(replace(replace(replace(
                       role, '\', '\b'), '### ', '\h'), '</turn>', '\e'), ':', '\c'))
                   + 2 + length(replace(replace(replace(
                       text, '\', '\b'), '### ', '\h'), '</turn>', '\e')) + 8 AS n_chars,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS number
            FROM turns
        ), sums AS (
            SELECT *,
                   sum(n_chars) OVER (PARTITION BY conv_id ORDER BY number) AS so_far,
                   max(number) OVER (PARTITION BY conv_id) AS last
            FROM pieces
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY number)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY number) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               (sum(so_far) FILTER (role = 'assistant' OR number = last))::BIGINT AS formatted_chars
        FROM sums GROUP BY conv_id
    """,
}
