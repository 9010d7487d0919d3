"""The queries that apply each operator here to its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from footfall.llm import (
    conversations,
    decontaminate,
    html_text,
    jaccard,
    language,
    lm,
    packing,
    pii,
    quality,
    resampling,
    secret_scan,
    spans,
    substrings,
    topk,
)
from footfall.plans.scratch import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder_is(divisor: int, remainder: int) -> Column:
    """Whether crc32 of the doc_id as text leaves ``remainder``; false for a null id."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    return F.coalesce(crc % divisor == remainder, F.lit(False))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = decontaminate.contamination(
        docs, _table(spark, sf_dir, "benchmark"), scratch=Scratch(spark, "op1")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    pieces = Scratch(spark, "op3").keep(packing.tokenised(docs), "pieces")
    return packing.pack(pieces)


def _with_digest(found: DataFrame, name: str, kinds: tuple[str, ...]) -> DataFrame:
    own = F.col(name)
    return found.select(
        "doc_id",
        *[spans.count_base(own, kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(spans.listed(spans.base_only(own)), 256).alias("base_sha256"),
        spans.listed(own).alias("spans"),
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return _with_digest(pii.find_personal_data(docs), "pii", pii.KINDS)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(docs, scratch=Scratch(spark, "op5"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder_is(7, 2)
    return lm.lm_scores(docs, F.col("doc_id").isNotNull() & ~held_out).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return _with_digest(secret_scan.find_secrets(docs), "secrets", secret_scan.KINDS[:3])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit_quality(docs, labels.where(~remainder_is(4, 2)))
    return quality.with_quality(docs, model).select(
        "doc_id",
        remainder_is(4, 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.GOOD).cast("int").alias("predicted"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    learned = docs.where(F.col("doc_id").isNotNull() & ~remainder_is(5, 0))
    found = language.identify(docs.select("doc_id", "text"), language.fit_languages(learned))
    return found.select(
        "doc_id",
        remainder_is(5, 0).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_ambiguous").alias("ambiguous"),
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = resampling.importance_ranks(
        _table(spark, sf_dir, "documents"),
        _table(spark, sf_dir, "benchmark"),
        Scratch(spark, "op11"),
        orders=(1, 1),
        buckets=10000,
        percent=10,
        least_words=20,
        seed=2024,
    )
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


def _damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given another role."""
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    damage = F.crc32(F.concat(conv_id, F.lit(":"), turn)) % 20
    copies = F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    new_text = F.when(damage == 1, "").when(damage == 2, F.regexp_replace(text, "[.!?]", ""))
    return rows.where(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(role).alias("role"),
        new_text.otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    found = conversations.repairs(_damaged(rows)).withColumnRenamed("conv_id", "_conv")
    every = rows.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.without_repeats(docs, Scratch(spark, "op13"), span=50).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_html_extraction": op2_html_extraction,
    "op3_packing": op3_packing,
    "op4_pii": op4_pii,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality": op8_quality,
    "op9_language_id": op9_language_id,
    "op10_topk": op10_topk,
    "op11_resampling": op11_resampling,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_substring_dedup": op13_substring_dedup,
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

# crc32 of a string ``s``, bit by bit for the 256 bytes and then by byte: a CTE "crc_bytes"
# and an expression over it.
_CRC_BYTES = """crc_bytes AS MATERIALIZED (
          SELECT list(list_reduce(range(8), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS crcs
          FROM range(256) AS bytes(i))"""


def _crc32(s: str) -> str:
    every = f"list_transform(range(strlen({s})), lambda i: ('0x' || hex({s})[2 * i + 1:2 * i + 2])::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({every}, {step}, 4294967295), 4294967295)"



def _edit(state: str, cost: int | str, letter: str, line: str = "''") -> str:
    """A state after one more edit, as (cost, audit, repaired lines)."""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"


def _inserted(state: str, role: str) -> str:
    return _edit(state, 2, "I", f"chr(10) || '{role}:'")


def _row_kept(state: str, role: str) -> str:
    """A row stays, or becomes one of ``role``; never where the row has to go."""
    keep = _edit(state, "extra", "K", "chr(10) || role || ':' || text")
    change = _edit(state, "2 + extra", "R", f"chr(10) || '{role}:' || text")
    return f"CASE WHEN initial = '{role[0]}' THEN least({keep}, {change}) ELSE {change} END"


# The cheapest states before a row, insertions included, and the row's own choices.
_BEFORE_ROW = f"""
          SELECT conv_id, p, s0, s1, least(x2, {_inserted("s3", "user")}) AS s2,
            least(s3, {_inserted("x2", "assistant")}) AS s3
          FROM (SELECT *, least(s2, {_inserted("s0", "user")}, {_inserted("s1", "user")}) AS x2
                FROM walk)"""
_ROW_CHOICES = f"""
          {_edit("s0", 3, "D")} AS s0,
          least({_edit("s1", 3, "D")}, CASE WHEN initial = 's'
            THEN {_edit("s0", "extra", "K", "chr(10) || role || ':' || text")} ELSE never END) AS s1,
          least({_edit("s2", 3, "D")}, {_row_kept("s0", "user")}, {_row_kept("s1", "user")},
            {_row_kept("s3", "user")}) AS s2,
          least({_edit("s3", 3, "D")}, {_row_kept("s2", "assistant")}) AS s3"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": f"""
        WITH texts AS MATERIALIZED (
          SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
        item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
        windows AS MATERIALIZED (
          SELECT DISTINCT item, w[p:p + least(10, len(w)) - 1] AS win
          FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p
                FROM item_words WHERE len(w) > 0)),
        places AS (
          SELECT row, p, n, w[p:p + n - 1] AS win
          FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS p
                FROM texts, (SELECT DISTINCT len(win) AS n FROM windows))),
        hits AS MATERIALIZED (SELECT row, p, n, item FROM places JOIN windows USING (win)),
        hit_words AS (
          SELECT row, count(DISTINCT q) AS n_hit
          FROM (SELECT row, unnest(range(p, p + n)) AS q FROM hits) GROUP BY row),
        hit_items AS (
          SELECT row, count(DISTINCT item) AS n_items,
            string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY row)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
          coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
          coalesce(n_hit, 0) > 0 AS contaminated
        FROM texts LEFT JOIN hit_words USING (row) LEFT JOIN hit_items USING (row)""",
    "op10_topk": """
        WITH vectors AS MATERIALIZED (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
            CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM pairs
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5""",
    "op11_resampling": f"""
        WITH {_CRC_BYTES},
        texts AS MATERIALIZED (
          SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
        items AS (SELECT {_WORDS} AS w FROM benchmark),
        feature AS (SELECT row, unnest(w) AS word FROM texts),
        wanted AS (SELECT unnest(w) AS word FROM items),
        vocabulary AS (SELECT word FROM feature UNION SELECT word FROM wanted),
        buckets AS MATERIALIZED (
          SELECT word, {_crc32("word")} % 10000 AS bucket FROM vocabulary, crc_bytes),
        have AS (SELECT bucket, count(*) AS s FROM feature JOIN buckets USING (word) GROUP BY bucket),
        want AS (SELECT bucket, count(*) AS t FROM wanted JOIN buckets USING (word) GROUP BY bucket),
        sums AS (SELECT (SELECT count(*) FROM feature) AS all_s, (SELECT count(*) FROM wanted) AS all_t),
        gains AS (
          SELECT bucket, floor(1000 * ln(
            (coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE
            / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
          FROM have LEFT JOIN want USING (bucket), sums),
        weights AS (
          SELECT row, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
          FROM feature JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY row),
        scored AS (
          SELECT row, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
            coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
              (('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
          FROM texts LEFT JOIN weights USING (row)),
        drawn AS (
          SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
          FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
        FROM scored LEFT JOIN drawn USING (row)""",
    "op13_substring_dedup": r"""
        WITH texts AS MATERIALIZED (
          SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS MATERIALIZED (
          SELECT row, doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS win
          FROM (SELECT row, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM texts)),
        firsts AS (SELECT win, min(doc_id) AS low FROM windows GROUP BY win),
        gone AS MATERIALIZED (
          SELECT DISTINCT row, unnest(range(p, p + 50)) AS q
          FROM windows JOIN firsts USING (win) WHERE doc_id > low),
        each AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM texts),
        kept AS (
          SELECT row, string_agg(word, ' ' ORDER BY q) AS words
          FROM each ANTI JOIN gone USING (row, q) GROUP BY row),
        counts AS (SELECT row, count(*) AS n FROM gone GROUP BY row)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
          sha256(coalesce(words, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (row) LEFT JOIN counts USING (row)""",
    "op12_conversation_repair": rf"""
        WITH RECURSIVE {_CRC_BYTES},
        known AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
          FROM conversations),
        dealt AS (SELECT known.*, {_crc32("key")} % 20 AS d FROM known, crc_bytes),
        damaged AS (
          SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
            CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE d WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
          FROM dealt WHERE d <> 0),
        placed AS MATERIALIZED (
          SELECT conv_id, turn, role, text, role[1:1] AS initial,
            row_number() OVER (PARTITION BY conv_id
              ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS p,
            regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
          FROM damaged),
        judged AS MATERIALIZED (
          SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY p) || initial AS pair,
            CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
            CASE WHEN last = '' OR nth > 1 THEN 1000000000
                 WHEN last NOT IN ('.', '!', '?') THEN 1 ELSE 0 END::BIGINT AS extra,
            {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS never
          FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) AS nth
                FROM placed)),
        counted AS (
          SELECT conv_id, count(*) AS n,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (WHERE fault = 'blank') AS blank,
            count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
            count(*) FILTER (WHERE fault = 'truncated') AS truncated,
            count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
          FROM judged GROUP BY conv_id),
        walk AS (
          SELECT conv_id, 0::BIGINT AS p, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0,
            {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS s1,
            {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS s2,
            {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS s3
          FROM counted
          UNION ALL
          SELECT b.conv_id, j.p, {_ROW_CHOICES}
          FROM ({_BEFORE_ROW}) b JOIN judged j
            ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.p = b.p + 1),
        ends AS (SELECT conv_id, p, least(s0, s3) AS best FROM ({_BEFORE_ROW}))
        SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
          coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
          coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
          coalesce(best.a, '') AS audit, sha256(coalesce(best.t[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) every
        LEFT JOIN counted ON every.conv_id IS NOT DISTINCT FROM counted.conv_id
        LEFT JOIN ends ON every.conv_id IS NOT DISTINCT FROM ends.conv_id AND ends.p = n""",
}
