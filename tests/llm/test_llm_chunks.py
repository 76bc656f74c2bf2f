"""Chunks of documents get their answers without being shuffled themselves."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from changeledger.llm import ngram_join, sorted_runs, suffix_dedup
from changeledger.llm.batches import id_and_text, small_batches


@pytest.fixture
def many_chunks(monkeypatch):
    """A text or two to a chunk, and nothing small enough to be broadcast."""
    for module, name, value in ((sorted_runs, "CHUNK_BYTES", 300), (sorted_runs, "BUCKET_BYTES", 1_000), (sorted_runs, "BROADCAST_BYTES", 0), (sorted_runs, "NAMES_AT_ONCE", 16), (suffix_dedup, "NAMES_PER_RANGE", 50), (ngram_join, "_BYTES_PER_RANGE", 500)):
        monkeypatch.setattr(module, name, value, raising=False)


def shuffled_columns(frame, capsys):
    capsys.readouterr()
    frame.explain("formatted")
    return [set(re.findall(r"(\w+)#", columns)) for columns in re.findall(r"\(\d+\) Exchange\nInput[^\[]*\[\d+\]: \[([^\]]*)\]", capsys.readouterr().out)]


def texts(spark, *own):
    small_batches(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    return id_and_text(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").repartition(3))


def test_repeats_are_found_without_a_shuffle_of_texts(spark, many_chunks, capsys):
    random_ = random.Random(4)
    make = lambda n: "".join(random_.choice("abcdefgh") for _ in range(n))
    passage = make(60)
    own = [make(100) + (passage if i % 3 == 0 else "") + make(90) for i in range(60)]
    found = suffix_dedup.remove_repeats(texts(spark, *own, None, ""), 50)
    shuffled = shuffled_columns(found, capsys)
    assert len(shuffled) == 2  # of each set of answers
    assert not any("data" in columns for columns in shuffled)
    removed = {row["doc_id"]: (row["n_bytes"], row["n_removed"]) for row in found.collect()}
    assert len(removed) == 62
    for i, text in enumerate(own):
        size, gone = removed[i]
        assert size == len(text) and (60 <= gone < 70 if i % 3 == 0 else gone == 0)
    assert removed[60] == removed[61] == (0, 0)


def test_chunks_leave_no_table_and_are_few_to_a_file(spark, many_chunks):
    chunks, total = sorted_runs.written_chunks(texts(spark, *["x" * 400] * 30))
    assert total == 12_000
    assert not [table for table in spark.catalog.listTables() if "chunks" in table.name]
    assert chunks.count() == 30
    assert len(chunks.inputFiles()) > 12
    assert sorted_runs.written_chunks(texts(spark, None))[1] == 0


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_names_in_blocks_are_the_names_at_once(monkeypatch, parts):
    names = np.random.default_rng(parts).integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)
    names[:4] = (0, (1 << 64) - 1, 1 << 63, 1 << 32)
    names = np.concatenate([names, names[::3]])
    at_once = sorted_runs.sorted_runs(5, names, parts)
    answers = [{"part": row["part"], "bits": zlib.compress(row["own"])} for row in at_once.to_pylist()]
    distinct, back, counts = np.unique(names, return_inverse=True, return_counts=True)
    for few in (1, 7, 1_000):
        monkeypatch.setattr(sorted_runs, "NAMES_AT_ONCE", few)
        assert sorted_runs.sorted_runs(5, names, parts).equals(at_once)
        assert (sorted_runs.repeated_names(answers, names, parts) == (counts > 1)[back]).all()
        assert not sorted_runs.repeated_names(None, names, parts).any()
    assert (np.concatenate([sorted_runs.unpack(row["names"]) for row in at_once.to_pylist()]) == distinct).all()


def test_ngram_sets_are_described_without_a_shuffle_of_texts(spark, many_chunks, capsys):
    own = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(30)]
    near = [f"{text} end" for text in own[:10]]
    similarity = ngram_join.Similarity(3, 90, 100)
    rows = texts(spark, *own, *near, None)
    described = ngram_join.describe(rows, similarity)
    shuffled = shuffled_columns(described, capsys)
    assert len(shuffled) == 1
    assert "data" not in shuffled[0]
    alone = {row["doc_id"]: (row["n_shingles"], row["own"]) for row in described.collect()}
    assert alone == {i: (38, 0) if i < 10 else (38, 38) if i < 30 else (39, 1) if i < 40 else (0, 0) for i in range(41)}
    found = {row["doc_id"]: row["component_id"] for row in ngram_join.similar_components(rows, similarity).collect()}
    assert found == {i: i - 30 if 30 <= i < 40 else i for i in range(41)}


def test_word_hashes_are_forgotten_and_found_again():
    shingler = ngram_join.Shingler(2)
    text = b"b a b a b c"
    before = shingler.grams(text).tolist()
    assert len(before) == 3 and before == sorted(set(before))
    shingler.grams(b" ".join(b"%d" % i for i in range(200_001)))
    assert shingler.grams(text).tolist() == before
    assert len(shingler._hash) == 3
    assert len(shingler.grams(b"a")) == 1 and not len(shingler.grams(b" ")) and not len(shingler.grams(None))
