"""Merkle manifest, bucket digests and ranked search against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from changeledger.llm import digests, merkle, order, ranked_search
from changeledger.llm.batches import id_and_text, small_batches

DOCUMENTS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.fixture(autouse=True)
def batches(spark):
    small_batches(spark)


# --- order -------------------------------------------------------------------------------------


def test_positions_within_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(1000)) for _ in range(500)]
    got = {(r.g, r.position): (r.k, r.size) for r in order.numbered(spark.createDataFrame(rows, "g string, k int"), "g", ["k"], "test").collect()}
    for group in ("a", "b", None):
        keys = sorted(k for g, k in rows if g == group)
        assert [got[group, at] for at in range(len(keys))] == [(k, len(keys)) for k in keys]
    assert order.numbered(spark.createDataFrame([], "g string, k int"), "g", ["k"], "test").count() == 0


# --- manifest ----------------------------------------------------------------------------------


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    built = [nodes]
    while len(built[-1]) > 1:
        built.append([hashed(*built[-1][at : at + 2]) for at in range(0, len(built[-1]), 2)])
    return built


def plain_manifest(rows):
    by_lang = {}
    for doc_id, source, lang, n_chars, text in rows:
        tampered = n_chars is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        leaf, checked = (hashed(*map(field, (doc_id, source, lang, n, text))) for n in (n_chars, n_chars + 1 if tampered else n_chars))
        by_lang.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, checked, doc_id))
    langs = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = [levels([leaf for _, _, leaf, _, _ in sorted(by_lang[lang])]) for lang in langs]
    top = levels([tree[-1][0] for tree in trees])
    found = []
    for number, lang in enumerate(langs):
        for place, (_, _, leaf, folded, doc_id) in enumerate(sorted(by_lang[lang])):
            proof = ""
            for tree, at in ((trees[number], place), (top, number)):
                for level in tree[:-1]:
                    sibling = level[at ^ 1] if at ^ 1 < len(level) else ""
                    proof += sibling
                    folded = hashed(sibling, folded) if at % 2 else hashed(folded, sibling)
                    at //= 2
            root = top[-1][0]
            found.append((doc_id, leaf, trees[number][-1][0], root, hashed(proof), folded, folded == root))
    return sorted(found, key=repr)


def random_documents(n, seed=5):
    rng = random.Random(seed)
    return [
        (rng.choice([None, k]) if k % 40 == 0 else k, rng.choice(["s", None, "é"]), rng.choice(["de", "en", "en", "en", "zh", None]), rng.choice([None, k]), rng.choice([None, "", "word " * k, "漢字"]))
        for k in range(n)
    ]


@pytest.mark.parametrize("span", [1, 3, 10])
def test_manifest_is_that_of_a_plain_tree(spark, rows, monkeypatch, span):
    monkeypatch.setattr(merkle, "SPAN", span)
    documents = random_documents(37)
    assert rows(merkle.manifest(spark.createDataFrame(documents, DOCUMENTS))) == plain_manifest(documents)


@pytest.mark.parametrize(
    "documents",
    [
        [(5, "s", "en", 4, "text")],
        [(1, None, None, None, None)] * 3,
        [(7, "s", lang, 1, "x" * 300_000) for lang in ("a", "b", "c", "d", "é")],
        [(3, "s", "", 9_223_372_036_854_775_807, "5:a"), (3, "s", None, 0, "")],
        [],
    ],
)
def test_manifest_of_odd_tables(spark, rows, documents):
    assert rows(merkle.manifest(spark.createDataFrame(documents, DOCUMENTS))) == plain_manifest(documents)


def test_tampering_is_found_and_the_limit_put_back(spark):
    documents = spark.createDataFrame([(k, "s", "en", 10, f"t{k}") for k in range(60)], DOCUMENTS)
    clashing = documents.select("*", *[F.lit(0).alias(name) for name in ("leaf", "position", "size", "tree", "_row", "a.b")])
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    found = {r.doc_id: r.verified for r in merkle.manifest(clashing).collect()}
    assert found == {k: zlib.crc32(str(k).encode()) % 7 != 0 for k in range(60)}
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


# --- digests -----------------------------------------------------------------------------------


def plain_digest(data):
    padded = bytes(2 * digests.STEP) + data
    counts = [0] * digests.BUCKETS
    for at in range(len(data)):
        key = (padded[at] | padded[at + digests.STEP] << 8 | padded[at + 2 * digests.STEP] << 16) * 2654435761 % 2**32
        key = (key ^ key >> 15) * 2246822519 % 2**32
        counts[key >> 32 - digests.BUCKET_BITS] += 1
    ordered = sorted(counts)
    bounds = [ordered[len(counts) * quarter // 4 - 1] for quarter in (1, 2, 3)]
    codes = [sum(count > bound for bound in bounds) for count in counts]
    packed = [codes[at] | codes[at + 1] << 2 | codes[at + 2] << 4 | codes[at + 3] << 6 for at in range(0, len(codes), 4)]
    return bytes([round(8 * math.log2(1 + len(data))), *packed]), codes


def plain_likeness(a, b):
    (left, x), (right, y) = plain_digest(a), plain_digest(b)
    worth = {0: 0, 1: 1, 2: 2, 3: 6}
    most = min(1.625 * len(x), sum(worth[c] for c in x + y))
    buckets = min(1.0, sum(worth[abs(p - q)] for p, q in zip(x, y, strict=True)) / most) if most else 0.0
    return 1 - (0.95 * buckets + 0.05 * min(1.0, abs(left[0] - right[0]) / 32))


TEXTS = [None, "", "a", "ab", "né漢字😀", "one two three " * 30, "one two three " * 29 + "four", "x" * 5000, "".join(chr(97 + k * k % 26) for k in range(3000))]


def test_digests_and_likeness(monkeypatch):
    monkeypatch.setattr(digests, "SLICE_BYTES", 64)
    encoded = [(text or "").encode() for text in TEXTS]
    for data in encoded:
        assert digests.digest(data) == plain_digest(data)[0]
        for other in encoded:
            score = digests.likeness(digests.digest(data), digests.digest(other))
            assert score == pytest.approx(plain_likeness(data, other)) and 0 <= score <= 1
    assert all(digests.likeness(digests.digest(d), digests.digest(d)) == 1 for d in encoded)
    assert digests.likeness(digests.digest(b"a" * 40), digests.digest(b"q" * 40)) < 0.3


def plain_edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    found = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, after = text or "", after or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        data, changed, following = (t.encode() for t in (text, edited, after))
        found.append((doc_id, len(text), hashlib.sha256(changed).hexdigest(), plain_digest(data)[0], plain_digest(changed)[0], round(plain_likeness(data, changed), 9), round(plain_likeness(data, following), 9)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 41])
def test_edited_texts_over_partitions(spark, n):
    documents = [(k * 3 if k else None, TEXTS[k * 7 % len(TEXTS)]) for k in range(n)]
    frame = spark.createDataFrame(documents, "doc_id bigint, text string").withColumn("part", F.lit("clash")).repartition(5)
    got = digests.edited_likeness(id_and_text(frame)).collect()
    as_rows = [(r.doc_id, r.n_chars, r.edited_sha256, bytes(r.fingerprint), bytes(r.edited_fingerprint), round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(as_rows, key=repr) == plain_edits(documents)


def test_texts_under_one_id(spark):
    frame = spark.createDataFrame([(1, "one"), (1, "two"), (1, "two"), (None, "x"), (None, None)], "doc_id bigint, text string")
    got = digests.edited_likeness(id_and_text(frame)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 0), (0, 1), (1, 3), (1, 3), (1, 3)]
    assert len({bytes(r.fingerprint) for r in got}) == 4


@pytest.mark.skipif(not Path(__spark_entry__.SMOKE_DIR).exists(), reason="needs the supplied tables")
def test_fingerprint_query(spark):
    got = __spark_entry__.queries()["op12_document_fingerprints"](spark, __spark_entry__.SMOKE_DIR)
    assert [got.schema[n].dataType.simpleString() for n in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")] == ["bigint", "bigint", "string", "string", "string", "double", "double"]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{__spark_entry__.SMOKE_DIR}/documents.parquet").collect()]
    found = sorted((r.doc_id, r.n_chars, r.edited_sha256, bytes.fromhex(r.fingerprint), bytes.fromhex(r.edited_fingerprint), round(r.near_edited, 9), round(r.near_next, 9)) for r in got.collect())
    assert found == sorted(plain_edits(rows))
    assert sum(r[-2] > r[-1] for r in found) > 0.98 * len(found)


# --- ranked search -----------------------------------------------------------------------------


def plain_terms(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            words += [word] * bool(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return words


def plain_ranking(documents, items, k=20):
    held = [(doc_id, Counter(terms), len(terms)) for doc_id, text in documents if (terms := plain_terms(text))]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    found = []
    for item_id, text in items:
        scores = []
        for doc_id, tf, n in held:
            measure = 75 + 25 * n * n_docs // n_terms
            score = 0
            for term in plain_terms(text):
                if tf[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(term in t for _, t, _ in held) + 1)))
                    score += weight * (1_000_000_000 * tf[term] // (1000 * tf[term] + 12 * measure))
            if score:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        found += [(item_id, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=repr)


def searched(spark, documents, items, k=20):
    frames = [id_and_text(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit(1))) for rows in (documents, items)]
    got = ranked_search.ranked(frames[0].repartition(3), frames[1].withColumnRenamed("doc_id", "item_id"), k)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def random_texts(rng, n, words, longest):
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_search_is_exact(spark, seed):
    """Copies in numbers (ties), repeated words, and terms from rare to common."""
    rng = random.Random(seed)
    words = [f"w{min(rng.randrange(1, 200), rng.randrange(1, 200))}" for _ in range(400)]
    texts = random_texts(rng, 350, words, 40) + ["w1 w2 w150 W150"] * 60
    documents = list(enumerate(texts))
    items = list(enumerate(random_texts(rng, 25, words, 12) + ["w150 w150 w1", "absent", "..."]))
    assert searched(spark, documents, items) == plain_ranking(documents, items)


def test_subtrees_are_skipped(spark):
    """Groups of like documents: a query for one of them does not look into the others."""
    import numpy as np

    rng = random.Random(4)
    n_terms, groups = 60, np.repeat(np.arange(20), 3)
    values = np.zeros((1280, n_terms), np.int32)
    for row in range(1280):
        values[row, [3 * (row % 20) + rng.randrange(3) for _ in range(2)]] = 400_000 + rng.randrange(1000)
    tree = ranked_search.BallTree(np.arange(1280), values, values.astype(float), groups)
    corpus = ranked_search.Corpus(1280, 5000, dict.fromkeys(range(n_terms), 40))
    item = ranked_search._weighted(0, [9, 10, 11], corpus, groups)
    best = ranked_search.Best(20)
    leaves = sum(1 for children in tree.children if not children)
    assert tree.search(item, best) <= leaves // 3
    scores = (values.astype(np.int64)[:, item.terms] @ item.weights)[tree.ids.argsort().argsort()]
    exact = sorted(((-int(tree.values[at, item.terms].astype(np.int64) @ item.weights), int(tree.ids[at])) for at in range(1280)))[:20]
    assert [(-s, i) for s, i in exact] == list(zip(best.scores.tolist(), best.ids.tolist(), strict=True)) and len(scores) == 1280


def test_bounds_hold_for_every_document():
    import numpy as np

    rng = np.random.default_rng(7)
    groups = rng.integers(0, 9, 40)
    values = (rng.random((300, 40)) * 1e6 * (rng.random((300, 40)) < 0.2)).astype(np.int32)
    tree = ranked_search.BallTree(np.arange(300), values, values[:, :8].astype(float), groups)
    corpus = ranked_search.Corpus(300, 3000, dict.fromkeys(range(40), 10))
    for _ in range(30):
        item = ranked_search._weighted(0, [int(t) for t in rng.integers(0, 40, 12)], corpus, groups)
        for node, (start, end) in enumerate(tree.bounds):
            bound = tree.upper_bounds(item, range(node, node + 1))[0]
            assert (tree.values[start:end][:, item.terms].astype(np.int64) @ item.weights).max() <= bound


def test_search_in_small_passes_and_trees(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "ITEMS_PER_PASS", 4)
    monkeypatch.setattr(ranked_search, "DOCS_PER_TASK", 50)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(50)]
    documents = list(enumerate(random_texts(rng, 120, words, 15)))
    items = list(enumerate(random_texts(rng, 10, words, 6)))
    assert searched(spark, documents, items, 5) == plain_ranking(documents, items, 5)


@pytest.mark.parametrize(
    "documents, items",
    [
        ([], [(1, "a")]),
        ([(1, "a b"), (2, None), (3, ""), (4, "!?")], []),
        ([(1, None)], [(1, "a")]),
        ([(None, "Straße ÉTÉ été 漢字"), (2, "straße été"), (2, "straße été"), (2, "x")], [(1, "STRAßE ÉTÉ"), (1, "été"), (None, "漢字"), (2, None)]),
        ([(k, "same") for k in range(50)] + [(99, "other " * 60_000 + "same")], [(1, "same"), (2, "same other " * 2000)]),
    ],
)
def test_search_of_odd_tables(spark, documents, items):
    assert searched(spark, documents, items) == plain_ranking(documents, items)
