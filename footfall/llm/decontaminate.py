"""Benchmark passages in documents, by a prefix-filtered set join.

An item's windows are its runs of ``window`` words; a shorter item is one window.
A window lies in a document only if all its shingles do. So it is enough to look
for one necessary shingle of each window, its rarest in the corpus: documents are
joined on that alone, the shingle's place says where the window would have to begin
and end, and there the words are compared.

Everything is DataFrame expressions. Document shingles are first held against a bit
table as large as their number asks for, so few others are ever turned into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.plans.scratch import Scratch

WINDOW = 10
SHINGLE = 3  # words; a window with fewer is one shingle
# Cells, of 64 bits each, of the table that document shingles are held against: one for
# each shingle sought, so at most one other in 64 passes. Between 64 kB and 64 MB; for more
# than 8 million shingles that rate grows, and no result changes.
_LEAST_CELLS, _MOST_CELLS = 1 << 13, 1 << 23

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and all non-ASCII characters; only A-Z is lower-cased."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )
    found = F.array_remove(F.split(lowered, _SEPARATORS), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _shingle(of: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(of, at + i) for i in range(size)])


def _positions(count: Column, size: int) -> Column:
    """0 to count - size, or nothing."""
    return F.when(count >= size, F.sequence(F.lit(0), count - size)).otherwise(
        F.array().cast("array<int>")
    )


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows: ``win`` (words) and ``items`` (ids as strings, without null)."""
    each = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    last = F.greatest(F.size("w") - window, F.lit(0))
    starts = each.where(F.size("w") > 0).select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    return (
        starts.select("item", F.slice("w", F.col("at") + 1, window).alias("win"))
        .groupBy("win")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def _window_shingles(windows: DataFrame, size: int) -> DataFrame:
    """(win, items, token, off) for every shingle of every window."""
    parts = []
    for k in range(1, size + 1):
        own = F.size("win") >= size if k == size else F.size("win") == k
        parts.append(
            windows.where(own)
            .withColumn("off", F.explode(_positions(F.size("win"), k)))
            .withColumn("token", _shingle(F.col("win"), F.col("off"), k))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def table_cells(tokens: int) -> int:
    """A power of two."""
    return min(max(1 << max(tokens - 1, 0).bit_length(), _LEAST_CELLS), _MOST_CELLS)


def _bit_table(tokens: DataFrame, cells: int) -> DataFrame:
    """One row, one array of ``cells`` numbers: the bits that the column ``token`` sets."""
    spark = tokens.sparkSession
    bit = F.expr(f"shiftleft(1L, cast(pmod(shiftright(token, 24), 64) as int))")
    hit = tokens.groupBy(F.pmod("token", F.lit(cells)).alias("id")).agg(F.bit_or(bit).alias("bits"))
    full = spark.range(cells).join(hit, "id", "left")
    pair = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return full.agg(F.transform(F.sort_array(F.collect_list(pair)), lambda x: x["bits"]).alias("table"))


def _in_table(token: Column, cells: int) -> Column:
    cell = F.get("bits", F.pmod(token, F.lit(cells)).cast("int"))
    return F.getbit(cell, F.pmod(F.shiftright(token, 24), F.lit(64)).cast("int")) == 1


def _with_words(docs: DataFrame, sought: DataFrame, cells: int) -> DataFrame:
    """doc_id, h, the words ``w``, and ``bits``, the bit table of the tokens that are sought."""
    return docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
        words(F.col("text")).alias("w"),
        _bit_table(sought, cells).scalar().alias("bits"),
    )


def _present(size: int, cells: int) -> Column:
    """Places of the words ``w`` where a shingle of ``size`` may be one that is sought."""
    return F.filter(
        _positions(F.size("w"), size), lambda at: _in_table(_shingle(F.col("w"), at, size), cells)
    )


def _tokens_at(size: int, cells: int) -> Column:
    return F.transform(_present(size, cells), lambda at: _shingle(F.col("w"), at, size))


def _candidates_at(size: int, window: int, cells: int) -> Column:
    """Where a sought shingle may be, and the words that a window around it can have."""

    def one(at: Column) -> Column:
        # The window begins at most window - size words before its shingle.
        first = F.greatest(at - (window - size), F.lit(0))
        return F.struct(
            at.alias("at"),
            _shingle(F.col("w"), at, size).alias("token"),
            first.alias("first"),
            F.slice("w", first + 1, at - first + window).alias("near"),
        )

    return F.transform(_present(size, cells), one)


def _necessary(docs: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """For each window its rarest shingle: token, off, win, items.

    Windows with a shingle that no document has are left out.
    """
    cells = table_cells(shingles.select("token").distinct().count())
    texts = _with_words(docs, shingles, cells)
    seen = texts.select(F.explode(F.concat(*[_tokens_at(k, cells) for k in sizes])).alias("token"))
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "off")
    return (
        shingles.join(counts, "token", "left")
        .groupBy("win")
        .agg(F.min(rarity).alias("rarest"), F.first("items").alias("items"))
        .where(F.col("rarest.n") > 0)
        .select("rarest.token", "rarest.off", "win", "items")
    )


def occurrences(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    size: int = SHINGLE,
    scratch: Scratch | None = None,
) -> DataFrame:
    """One row for each text and place where a window occurs, and one for each text.

    Columns doc_id, h (a hash of the text), n_words, start and stop (in words, stop
    exclusive), items, and rows (how many documents the row stands for). A text's
    own row has a null start and no items.
    """
    spark = docs.sparkSession
    size = min(size, window)
    kept = scratch or Scratch(spark, "decontaminate")
    windows = kept.keep(item_windows(items, window), "windows")
    sizes = sorted(r[0] for r in windows.select(F.least(F.size("win"), F.lit(size))).distinct().collect())
    shingles = _window_shingles(windows, size)
    if sizes:
        sought = kept.keep(_necessary(docs, shingles, sizes), "necessary")
    else:
        sought = shingles.select("token", "off", "win", "items")
    cells = table_cells(sought.count())
    n_words = F.size("w")
    # The text's own row; its token only spreads these rows over the join.
    own = F.array(
        F.struct(
            F.lit(None).cast("int").alias("at"),
            F.xxhash64("doc_id", "h").alias("token"),
            F.lit(None).cast("int").alias("first"),
            F.lit(None).cast("array<string>").alias("near"),
        )
    )
    found = (
        _with_words(docs, sought, cells)
        .select("doc_id", "h", n_words.alias("n_words"), F.explode(F.concat(own, *[_candidates_at(k, window, cells) for k in sizes])).alias("c"))
        .select("doc_id", "h", "n_words", "c.*")
    )
    start = F.col("at") - F.col("off")
    stop = start + F.size("win")
    holds = (
        (start >= 0)
        & (stop <= F.col("n_words"))
        & (F.slice("near", F.greatest(start - F.col("first"), F.lit(0)) + 1, F.size("win")) == F.col("win"))
    )
    matched = found.join(sought, "token", "left").where(
        F.col("at").isNull() | F.coalesce(holds, F.lit(False))
    )
    is_own = F.col("at").isNull()
    return matched.groupBy("doc_id", "h", F.when(~is_own, start).alias("start")).agg(
        F.max("n_words").alias("n_words"),
        F.max(F.when(~is_own, stop)).alias("stop"),
        F.flatten(F.collect_set(F.when(~is_own, F.col("items")))).alias("items"),
        F.sum(is_own.cast("long")).alias("rows"),
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    size: int = SHINGLE,
    scratch: Scratch | None = None,
) -> DataFrame:
    """For each document: doc_id, h, n_words, n_hit (words in windows) and item_ids, sorted.

    A null or empty text has no words and no hits; so has an item, which then has
    no windows. Items with the same words are all named; a null item_id counts for
    hits and is not named. Documents that share an id are told apart by their text;
    rows alike in both give as many rows alike. Other columns take no part.
    """
    found = occurrences(docs, items, window, size, scratch)
    before = (
        Window.partitionBy("doc_id", "h")
        .orderBy("start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = F.coalesce(F.max("stop").over(before), F.lit(0))
    fresh = F.greatest(F.col("stop") - F.greatest("start", reach), F.lit(0))
    return (
        found.withColumn("fresh", F.coalesce(F.when(F.col("start").isNotNull(), fresh), F.lit(0)))
        .groupBy("doc_id", "h")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.sum("fresh").cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
            F.sum("rows").cast("int").alias("rows"),
        )
        .withColumn("row", F.explode(F.array_repeat(F.lit(0), F.col("rows"))))
        .drop("row", "rows")
    )


def clean(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, scratch: Scratch | None = None
) -> DataFrame:
    """The documents without any hit, all columns kept."""
    hit = (
        occurrences(docs.select("doc_id", "text"), items, window, scratch=scratch)
        .where(F.col("start").isNotNull())
        .select(F.col("doc_id").alias("hit_id"), F.col("h").alias("hit_h"))
        .distinct()
    )
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(hit, hit["hit_id"].eqNullSafe(docs["doc_id"]) & (hit["hit_h"] == own), "left_anti")
