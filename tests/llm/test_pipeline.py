"""The stages of the pipeline, each on what the one before kept."""

from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import packing, pii, secret_scan
from test_decontaminate import words
from test_jaccard import brute as groups

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return out


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_columns(kept):
    columns = kept["documents"].columns
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert kept[name].columns == columns


def test_language_keeps_what_has_one(kept):
    assert kept["language"].count() >= 0.98 * kept["documents"].count()
    assert set(rows(kept["language"])) <= set(rows(kept["documents"]))


def test_one_of_each_group_stays(kept):
    before = rows(kept["language"].select("doc_id", "text"))
    first = {doc_id for doc_id, _, smallest in groups(before) if doc_id == smallest}
    assert {r.doc_id for r in kept["near_copies"].collect()} == first


def test_no_benchmark_passage_stays(spark, kept):
    windows = set()
    for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = words(row.text)
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()

    def hit(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    expected = [r for r in rows(kept["near_copies"]) if not hit(r[1])]
    assert rows(kept["benchmark"]) == expected


def test_personal_data_are_masked(kept):
    before = {r.doc_id: r for r in kept["benchmark"].collect()}
    personal, secret = pii.make_finder(), secret_scan.make_finder()()
    for row in kept["personal_data"].collect():
        old = before[row.doc_id]
        assert row.n_chars == len(row.text) and pii.plain_spans(row.text) == []
        assert secret_scan.plain_spans(row.text) == []
        if not personal(old.text) and not secret(old.text):
            assert row.text == old.text
        assert (row.lang, row.source) == (old.lang, old.source)
    assert kept["personal_data"].count() == len(before)


def test_packing_covers_every_document(kept):
    ends = kept["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert ends.where("n <> m").count() == 0
    assert ends.count() == kept["personal_data"].count()


def test_run_is_the_stages(spark, kept, tmp_path):
    folder = tmp_path / "corpus"
    before = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("footfall-*"))
    assert rows(corpus_pipeline.run(spark, SF_DIR, str(folder))) == rows(kept["packing"])
    # Nothing is left but the result and the documents that it consists of.
    assert {p.name for p in folder.iterdir()} == {"personal_data", "packing"}
    assert set(Path(spark.conf.get("spark.checkpoint.dir")).glob("footfall-*")) == before


def test_sequences_come_from_the_output_alone(spark, kept):
    """Token ids of every sequence, and from them every document's text."""
    found = packing.sequences(kept["personal_data"], kept["packing"]).collect()
    ids = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in found}
    assert all(len(ids[r.sequence_id]) == r.n_tokens <= 1024 for r in found)
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = {}
    for p in kept["packing"].collect():
        parts.setdefault(p.doc_id, []).append((p.start, ids[p.sequence_id][p.offset : p.offset + p.length]))
    for row in kept["personal_data"].collect():
        own = np.concatenate([part for _, part in sorted(parts[row.doc_id], key=lambda x: x[0])])
        assert own[-1] == 0 and tokenizer.decode(own[:-1].tolist(), skip_special_tokens=False) == row.text


def test_edges(spark, tmp_path):
    """Nulls everywhere, repeated rows, a clashing column, and no rows."""
    docs = spark.createDataFrame(
        [(1, "the cat and the dog sat", "en", "s", 23)] * 2
        + [(2, None, None, None, None), (None, "der Hund und die Katze", "de", None, 3), (3, "", "en", "", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF_DIR)
            out.collect()
            if name != "packing":
                assert out.columns == docs.columns


def test_no_access_key_survives(spark):
    key = "AKIA" + "Q3ZT7XW2K9P4M8RJ"
    docs = spark.createDataFrame(
        [(1, f"the key is {key} here", "en", "s", 0), (2, f"api_key: '{'x9' * 9}' and me@x.org", "en", "s", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    masked = {r.doc_id: r.text for r in corpus_pipeline.mask_personal_data(spark, docs, SF_DIR).collect()}
    assert masked == {1: "the key is <ACCESS> here", 2: "<ASSIGN>' and <EMAIL>"}
