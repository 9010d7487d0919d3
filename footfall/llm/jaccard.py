"""Near-duplicate documents by an adaptive multi-match prefix join on word shingles.

Two sets of which one has n shingles can only be similar if they share at least
need(n) of them. In any order that all documents agree on, the first n - need(n) + l
shingles of either then hold l shared ones: a prefix that is longer by l - 1 must
show l matches.

First, all documents take their smallest hashes as a prefix, an eighth longer than
the least, and keep it if enough of it occurs in any other document. The few that
remain are ordered anew, rarest shingle first. Each gets its own l: of some lengths
the one with the smallest estimated cost, which is the postings read plus the
candidates to verify. A pair is verified if it shares the smaller l of its two
documents' in the prefixes that go with their two sizes.

Copies are one class from the start. Classes with a shingle in common are first
compared with the most common one among them, its anchor, and only pairs that this
has not connected yet are listed, so a group of n near copies costs n comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm import counting
from footfall.llm.textbytes import mix, shingle_hashes, word_hashes
from footfall.plans.scratch import Scratch

SHINGLE = 5
PERCENT = 80  # least similarity
CHUNK = 4 << 20  # bytes of text in a chunk, about
LONGER = 8  # the first prefix is longer by one shingle for so many
_LEVELS = (0, 1 / 32, 1 / 8, 1 / 2)  # shares of a set by which its prefix may be longer
_VERIFY = 50.0  # verifying a candidate costs as much as reading so many postings


def _need(n, percent: int):
    """Shared shingles that a set of ``n`` needs with any similar one."""
    return (percent * n + 99) // 100


def _overlap(n, m, percent: int):
    """Shared shingles that similar sets of ``n`` and ``m`` have at least."""
    return (percent * (n + m) + 99 + percent) // (100 + percent)


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Every row's distinct shingles, sorted."""
    words, bounds = word_hashes(column)
    shingles, bounds = shingle_hashes(words, bounds, size)
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        own = np.sort(shingles[a:b])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        yield own


def _class_of(own: np.ndarray) -> int:
    """One number for all documents with this set."""
    total = mix(own).sum(dtype=np.uint64) + np.uint64(len(own))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _first_prefix(own: np.ndarray, percent: int) -> np.ndarray:
    n = len(own)
    return own[: n - _need(n, percent) + 1 + n // LONGER]


def _ask_prefixes(table: pa.Table, chunks: int, size: int, percent: int) -> pa.Table:
    prefixes = [_first_prefix(own, percent) for own in _sets(table.column("text").combine_chunks(), size)]
    # A prefix has small hashes only; mixed once more, they go to all buckets alike.
    parts = [(1, *counting.counted(mix(np.concatenate(prefixes))))]
    return counting.ask(table.column("chunk")[0].as_py(), chunks, parts)


def _survivors(texts: pa.Table, counts: pa.Table, size: int, percent: int) -> pa.Table:
    """Every document's class; the set of those whose prefix others share enough of."""
    sets = list(_sets(texts.column("text").combine_chunks(), size))
    keys, _ = counting.counted(mix(np.concatenate([_first_prefix(own, percent) for own in sets])))
    found = counting.answered(counts, 1)
    kept: list[bytes | None] = []
    for own in sets:
        prefix = _first_prefix(own, percent)
        shared = int((found[np.searchsorted(keys, mix(prefix))] > 1).sum())
        # A similar set may be smaller, and its prefix then asks for less.
        enough = shared >= 1 + _need(len(own), percent) // LONGER
        kept.append(own.tobytes() if len(own) and enough else None)
    out = {
        "n_shingles": pa.array([len(own) for own in sets], pa.int64()),
        "cls": pa.array([_class_of(own) if len(own) else None for own in sets], pa.int64()),
        "shingles": pa.array(kept, pa.binary()),
    }
    rows = texts.drop_columns(["text", "chunk"])
    for name, values in out.items():
        rows = rows.append_column(name, values)
    return rows


def _members(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``docs`` with n_shingles, cls and shingles for its text; shingles only where a link is possible."""
    text = F.coalesce("text", F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text) + 20)).first()[0]
    chunks = 1 + int(total or 0) // CHUNK
    own = [f for f in docs.schema if f.name != "text"]
    dealt = docs.select(
        *[f.name for f in own],
        text.alias("text"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(chunks)).alias("chunk"),
    )
    back = counting.answers(
        dealt.groupBy("chunk").applyInArrow(
            lambda t: _ask_prefixes(t, chunks, size, percent), counting.ASKED
        )
    )
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in own]
    return (
        dealt.groupBy("chunk")
        .cogroup(back.groupBy("chunk"))
        .applyInArrow(
            lambda texts, own: _survivors(texts, own, size, percent),
            ", ".join([*fields, "n_shingles long, cls long, shingles binary"]),
        )
    )


def _ask_sets(table: pa.Table, chunks: int) -> pa.Table:
    own = np.frombuffer(b"".join(table.column("shingles").to_pylist()), np.uint64)
    return counting.ask(table.column("chunk")[0].as_py(), chunks, [(1, *counting.counted(own))])


def _adapted(classes: pa.Table, counts: pa.Table, percent: int) -> pa.Table:
    """Each class's chosen prefix, rarest shingle first; classes that cannot link go.

    Shingles of no other class stand first in the order, so they take up places of
    the prefix and are not listed. ``most`` is the size of the largest set that can
    be similar, as at most the other shingles are shared.
    """
    sets = [np.frombuffer(s, np.uint64) for s in classes.column("shingles").to_pylist()]
    keys, _ = counting.counted(np.concatenate(sets))
    found = counting.answered(counts, 1)
    out: dict[str, list] = {"cls": [], "n": [], "ell": [], "alone": [], "most": [], "common": [], "listed": [], "shingles": []}
    for cls, own in zip(classes.column("cls").to_pylist(), sets):
        n = len(own)
        need = _need(n, percent)
        often = found[np.searchsorted(keys, own)]
        alone = int((often == 1).sum())
        if n - alone < need:
            continue
        order = np.lexsort((own, often))[alone:]
        read = np.concatenate([[0], np.cumsum(often[order])])  # postings up to here
        best = None
        for share in _LEVELS:
            ell = min(1 + int(n * share), need)
            # Of a set of the same size, each candidate shows at least ell of the postings.
            length = n - _overlap(n, n, percent) + ell - alone
            cost = read[max(length, 0)] * (1 + _VERIFY / ell)
            if best is None or cost < best[0]:
                best = cost, ell, n - need + ell - alone
        out["cls"].append(cls)
        out["n"].append(n)
        out["ell"].append(best[1])
        out["alone"].append(alone)
        out["most"].append((100 + percent) * (n - alone) // percent - n)
        out["common"].append(float(often.mean()))
        out["listed"].append(own[order[: best[2]]].view(np.int64))
        out["shingles"].append(own.tobytes())
    kinds = (*[pa.int64()] * 5, pa.float64(), pa.list_(pa.int64()), pa.binary())
    return pa.table({name: pa.array(v, kind) for (name, v), kind in zip(out.items(), kinds)})


def _classes(members: DataFrame, percent: int) -> DataFrame:
    """(cls, n, ell, alone, most, common, listed, shingles) of every class that may be linked."""
    sets = members.where(F.col("shingles").isNotNull())
    total = sets.agg(F.sum(F.octet_length("shingles"))).first()[0]
    chunks = 1 + int(total or 0) // CHUNK
    distinct = (
        sets.groupBy("cls")
        .agg(F.first("shingles").alias("shingles"))
        .withColumn("chunk", F.pmod(F.xxhash64("cls"), F.lit(chunks)))
    )
    back = counting.answers(
        distinct.groupBy("chunk").applyInArrow(lambda t: _ask_sets(t, chunks), counting.ASKED)
    )
    return (
        distinct.groupBy("chunk")
        .cogroup(back.groupBy("chunk"))
        .applyInArrow(
            lambda classes, own: _adapted(classes, own, percent),
            "cls long, n long, ell long, alone long, most long, common double, listed array<bigint>, shingles binary",
        )
    )


def _verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            holds = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                holds.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(holds, pa.bool_()))

    sets = classes.select("cls", "shingles")
    return (
        pairs.select("a", "b")
        .join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(run, "a long, b long")
    )


def _fits(a: str, b: str) -> Column:
    """Whether neither set is larger than the other's largest partner."""
    return (F.col(f"{a}.n") <= F.col(f"{b}.most")) & (F.col(f"{b}.n") <= F.col(f"{a}.most"))


def _with_anchors(postings: DataFrame) -> DataFrame:
    """Each class with the most common class of every list that it is in."""
    anchor = postings.groupBy("token").agg(
        F.max(F.struct("common", "cls", "n", "most")).alias("top")
    )
    return (
        postings.alias("own")
        .join(anchor, "token")
        .where((F.col("cls") != F.col("top.cls")) & _fits("own", "top"))
        .select(F.col("cls").alias("a"), F.col("top.cls").alias("b"))
        .distinct()
    )


def _unconnected(postings: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components with enough matches in their prefixes.

    In every list, the component with the most classes is left to the others: only
    classes outside of it look for partners. A shingle counts if its places are
    within the prefixes that the two sizes ask for.
    """
    labelled = postings.join(labels, postings["cls"] == labels["node"], "left").select(
        "token", "cls", "n", "ell", "most", "place", F.coalesce("label", "cls").alias("label")
    )
    by_label = labelled.groupBy("token", "label").agg(F.count(F.lit(1)).alias("many"))
    mixed = (
        by_label.groupBy("token")
        .agg(F.max(F.struct("many", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
        .where(F.col("labels") > 1)
        .select("token", F.col("main.label").alias("main"))
    )
    lists = labelled.join(mixed, "token").withColumn("is_main", F.col("label") == F.col("main"))
    a, b = lists.where(~F.col("is_main")).alias("a"), lists.alias("b")
    ell = F.least("a.ell", "b.ell")
    both = F.expr(f"({percent} * (a.n + b.n) + {99 + percent}) div {100 + percent}")  # as _overlap
    in_prefixes = (F.col("a.place") <= F.col("a.n") - both + ell) & (
        F.col("b.place") <= F.col("b.n") - both + ell
    )
    return (
        a.join(b, F.col("a.token") == F.col("b.token"))
        .where(
            (F.col("a.label") != F.col("b.label"))
            & (F.col("b.is_main") | (F.col("a.cls") < F.col("b.cls")))
            & _fits("a", "b")
            & in_prefixes
        )
        .groupBy(
            F.least("a.cls", "b.cls").alias("a"),
            F.greatest("a.cls", "b.cls").alias("b"),
            ell.alias("ell"),
        )
        .agg(F.count(F.lit(1)).alias("matches"))
        .where(F.col("matches") >= F.col("ell"))
    )


def components(edges: DataFrame, kept: Scratch, name: str) -> DataFrame:
    """(node, label): the smallest node connected with each node of ``edges`` (a, b).

    Every round takes the smallest label among the neighbours, then the label of
    that label, so the number of rounds grows with the logarithm of a chain.
    """
    both = kept.keep(
        edges.select("a", "b").union(edges.select("b", "a")).where(F.col("a") != F.col("b")).distinct(),
        f"{name}-edges",
    )
    labels = kept.keep(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
        f"{name}-0",
    )
    step = 0
    while True:
        step += 1
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = lower.join(jump, "label", "left").select(
            "node", F.least("label", F.coalesce("far", "label")).alias("label"), "old"
        )
        new = kept.keep(moved, f"{name}-{step}")
        changed = new.where(F.col("label") != F.col("old")).limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def _grouped(docs: DataFrame, size: int, percent: int, scratch: Scratch | None) -> DataFrame:
    """``docs`` without text and with n_shingles, component_id and first.

    ``first`` is the first row of those that links lead to, by doc_id, null ids
    last, then by the other columns; a row without links has neither.
    """
    spark = docs.sparkSession
    kept = scratch or Scratch(spark, "jaccard")
    members = kept.keep(_members(docs, size, percent), "members")
    classes = kept.keep(_classes(members, percent), "classes")
    postings = classes.select(
        "cls", "n", "ell", "alone", "most", "common", F.posexplode("listed").alias("at", "token")
    ).withColumn("place", F.col("alone") + F.col("at") + 1)
    links = kept.keep(_verified(_with_anchors(postings), classes, percent), "anchored")
    labels = components(links, kept, "first")
    more = _verified(_unconnected(postings, labels, percent), classes, percent)
    links = links.unionByName(kept.keep(more, "found"))
    labels = components(links, kept, "all")
    own = ["doc_id", *[c for c in docs.columns if c not in ("doc_id", "text")]]
    ids = (
        members.where(F.col("cls").isNotNull())
        .groupBy("cls")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *own)).alias("first"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    ids = ids.join(labels, ids["cls"] == labels["node"], "left").withColumn(
        "label", F.coalesce("label", "cls")
    )
    groups = ids.groupBy("label").agg(
        F.min("first_id").alias("component_id"),
        F.min("first").alias("first"),
        F.sum("rows").alias("documents"),
    )
    named = (
        ids.select("cls", "label")
        .join(groups, "label")
        .where(F.col("documents") > 1)
        .select("cls", "component_id", "first")
    )
    return members.join(named, "cls", "left").select(*own, "n_shingles", "component_id", "first")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, scratch: Scratch | None = None
) -> DataFrame:
    """For each document: doc_id, n_shingles, and component_id.

    Two documents link if the similarity of their shingle sets is at least
    ``percent``; component_id is the smallest doc_id that links lead to. Copies are
    linked. A null or empty text, or one without words, has no shingle and no link;
    fewer words than a shingle has are one shingle. Documents may share an id, and
    rows may repeat: every row is a document. A null doc_id gets the id of others it
    is linked with, else null. Other columns take no part.
    """
    return _grouped(docs.select("doc_id", "text"), size, percent, scratch).select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, scratch: Scratch | None = None
) -> DataFrame:
    """One document of each component, and those without links; all columns kept.

    The one with the smallest doc_id stays; among those with the same id, or if all
    are null, the one with the smallest hash. Documents may share an id: each is
    judged by its own text. Rows alike in id and text stay once.
    """
    name = "row"
    while name in docs.columns:
        name += "_"
    own_id = F.col("doc_id").cast("string")
    # The id's length first, so that no other id and text give the same.
    row = F.md5(
        F.concat_ws(
            ":",
            F.coalesce(F.octet_length(own_id), F.lit(-1)).cast("string"),
            F.coalesce(own_id, F.lit("")),
            F.coalesce("text", F.lit("")),
        )
    )
    found = _grouped(docs.select("doc_id", "text", F.unhex(row).alias("row")), size, percent, scratch)
    others = found.where(F.col("row") != F.col("first.row")).select(F.col("row").alias(name)).distinct()
    return (
        docs.withColumn(name, F.unhex(row))
        .join(others, name, "left_anti")
        .dropDuplicates([name, "doc_id", "text"])  # by the hash, so as the join deals them out
        .select(docs.columns)
    )
