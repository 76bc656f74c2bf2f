"""Tokenizing, token counts, language, lines and benchmark items, each against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from changeledger.llm import bpe, decontamination, language_id, line_dedup
from changeledger.llm.batches import id_and_text
from changeledger.llm.pieces import TRIE_BYTES
from changeledger.llm.queries import QUERIES
from changeledger.llm.token_counts import TokenCounter, counted_scores, learn_scores, piece_scores, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, token_ids string, score string"


def documents(spark, texts):
    """With columns whose names clash with those the operators make."""
    return spark.createDataFrame([(i, text, "x", "y") for i, text in enumerate(texts)], SCHEMA)


ODD = [
    None,
    "",
    " ",
    "plain words, 12 of them!",
    "tab\there\n\n  and   spaces \n",
    "ünïcödé 漢字かな 🙂🙂",
    "a" * 30_000,
    " " * 5_000 + "x",
    "y" + "\n" * 4_000,
    "word " * 40_000,
    "<|endoftext|> it's we'll",
    "\0nul\0",
    "plain words, 12 of them!",
]


def test_bpe_round_trip(spark):
    encoding = bpe.load_encoding(RANKS, PATTERN)
    encoded = bpe.with_token_ids(documents(spark, ODD), RANKS, PATTERN)
    assert encoded.columns == ["doc_id", "text", "score", "token_ids"]
    rows = {r.doc_id: r for r in bpe.with_decoded_bytes(encoded, RANKS).collect()}
    assert len(rows) == len(ODD)
    for i, text in enumerate(ODD):
        assert bytes(rows[i].decoded) == (text or "").encode()
        assert rows[i].token_ids == (encoding.encode_ordinary(text) if text else [])
    digest = {r.doc_id: r for r in bpe.digest(bpe.with_decoded_bytes(encoded, RANKS)).collect()}
    assert digest[0].n_tokens == 0 and digest[0].ids_sha256 == hashlib.sha256(b"").hexdigest()
    ids = ",".join(map(str, encoding.encode_ordinary(ODD[5])))
    assert digest[5].ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()


def test_long_white_space_is_encoded_as_the_pattern_splits_it():
    """Longer runs than the pattern engine can take, compared match by match."""
    encoder, single = bpe.Encoder(RANKS, PATTERN), bpe.load_encoding(RANKS, r"(?s:.+)")
    for text in ("a" + " " * 200_000 + "b", "\n" * 200_000, "x " + "\t\n" * 60_000 + "é"):
        want = [i for match in regex.findall(PATTERN, text) for i in single.encode_ordinary(match)]
        assert [int(i) for part in encoder.ids(text) for i in part] == want


def test_safe_parts_join_to_the_same_tokens():
    encoding, random_ = bpe.load_encoding(RANKS, PATTERN), random.Random(3)
    for _ in range(30):
        text = "".join(random_.choice(["ab", " ", "  ", "\n", "'s", "9", "é", "...", "漢", " ", "\x1c"]) for _ in range(400))
        parts = list(bpe.safe_parts(text, 20))
        assert "".join(parts) == text
        assert [i for part in parts for i in encoding.encode_ordinary(part)] == encoding.encode_ordinary(text)


def test_no_rows_at_all(spark):
    none = documents(spark, [])
    plain = id_and_text(none)
    assert bpe.with_decoded_bytes(bpe.with_token_ids(none, RANKS, PATTERN), RANKS).count() == 0
    assert token_counts(plain, RANKS, PATTERN).count() == 0
    assert len(set(learn_scores(plain, RANKS, PATTERN).tolist())) == 1
    model = language_id.fit(plain.withColumn("lang", F.lit(None).cast("string")), RANKS, PATTERN)
    assert language_id.predict(plain, model, RANKS).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(plain, items).count() == 0
    assert decontamination.without_contaminated(none, items).count() == 0
    assert line_dedup.drop_boilerplate(none.withColumn("source", F.lit("s"))).count() == 0


def best_segmentation(word: bytes, ranks, scores):
    """Highest score, then fewest pieces, by trying every last piece."""
    best = {0: (0, 0)}
    for end in range(1, len(word) + 1):
        options = [(best[s][0] + int(scores[ranks[word[s:end]]]), best[s][1] - 1) for s in range(end) if s in best and word[s:end] in ranks]
        if options:
            best[end] = max(options)
    return best[len(word)][0], -best[len(word)][1]


def test_token_counts_are_those_of_the_best_segmentation(spark):
    ranks = bpe.load_ranks(RANKS)
    scores = piece_scores(max(ranks.values()) + 1)
    texts = [*ODD, "counting tokens", "countering tokens", "the theatre thereof"]
    rows = {r.doc_id: r for r in token_counts(id_and_text(documents(spark, texts)), RANKS, PATTERN).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = regex.findall(PATTERN, text or "")
        cost = {w: best_segmentation(w.encode(), ranks, scores) for w in set(words) if len(w) < 3_000}
        if len(cost) < len(set(words)):
            continue  # too long for the plain version; covered below
        assert rows[i].n_pretokens == len(words)
        assert rows[i].score_units == sum(cost[w][0] for w in words)
        assert rows[i].n_tokens == sum(cost[w][1] for w in words)


def test_trie_equals_the_plain_program():
    ranks = bpe.load_ranks(RANKS)
    counter, random_ = TokenCounter(ranks), random.Random(5)
    alphabet = [b"a", b"b", b"th", b"ing", b" ", "é".encode(), b"\0", b"\xff"]
    words = [b"".join(random_.choice(alphabet) for _ in range(random_.randrange(0, 40))) for _ in range(400)] + [b"x" * TRIE_BYTES, b"x" * (TRIE_BYTES + 1)]
    got = counter.counts(words)
    for word, row in zip(words, got.tolist(), strict=True):
        assert tuple(row) == best_segmentation(word, ranks, counter.scores), word


def best_pieces(word: bytes, ranks, scores):
    """Pieces of the best segmentation: highest score, fewest pieces, shortest last piece."""
    best = {0: (0, 0, 0)}
    for end in range(1, len(word) + 1):
        options = [(best[s][0] + int(scores[ranks[word[s:end]]]), best[s][1] - 1, s) for s in range(end) if s in best and word[s:end] in ranks]
        if options:
            best[end] = max(options)
    pieces, end = [], len(word)
    while end in best and end:
        pieces.append(ranks[word[best[end][2] : end]])
        end = best[end][2]
    return pieces


def test_scores_are_counted_over_all_best_segmentations(spark):
    """Against a plain count, with repeated rows, words too long for the trie, and two rounds."""
    ranks = bpe.load_ranks(RANKS)
    size = max(ranks.values()) + 1
    texts = [None, "", "the theatre thereof", "the theatre thereof", "x" * (TRIE_BYTES + 9), "nul\0 within", "日本語" * 30, *(f"word{n} of the lot" for n in range(40))]
    words = [w.encode() for text in texts for w in regex.findall(PATTERN, text or "")]
    scores = piece_scores(size)
    for rounds in (1, 2):
        counts = np.zeros(size, np.int64)
        for word in words:
            for piece in best_pieces(word, ranks, scores):
                counts[piece] += 1
        scores = counted_scores(counts)
        got = learn_scores(id_and_text(documents(spark, texts)).repartition(1 + 2 * rounds), RANKS, PATTERN, rounds)
        assert got.tolist() == scores.tolist()


def test_token_count_query_counts_under_the_scores_of_its_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    ranks = bpe.load_ranks(RANKS)
    words = {r.doc_id: [w.encode() for w in regex.findall(PATTERN, r.text or "")] for r in texts}
    often = Counter(w for own in words.values() for w in own)
    counts, prior = np.zeros(max(ranks.values()) + 1, np.int64), piece_scores(max(ranks.values()) + 1)
    for word, times in often.items():
        np.add.at(counts, best_pieces(word, ranks, prior), times)
    scores = counted_scores(counts)
    cost = {word: best_segmentation(word, ranks, scores) for word in often}
    expected = {i: (len(own), sum(cost[w][1] for w in own), sum(cost[w][0] for w in own)) for i, own in words.items()}
    found = QUERIES["op2_token_counts"](spark, folder)
    assert {r.doc_id: (r.n_pretokens, r.n_tokens, r.score_units) for r in found.collect()} == expected


def all_segmentations(word: bytes, ranks, probability):
    if not word:
        return 1.0
    return sum(probability[ranks[word[:n]]] * all_segmentations(word[n:], ranks, probability) for n in range(1, len(word) + 1) if word[:n] in ranks)


def test_word_probability_is_the_sum_over_all_segmentations():
    ranks = bpe.load_ranks(RANKS)
    size = max(ranks.values()) + 1
    random_ = random.Random(7)
    probabilities = [[random_.random() + 0.01 for _ in range(2)] for _ in range(size)]
    import numpy as np

    model = language_id.LanguageModel(["a", "b"], np.array(probabilities) / 2)
    scorer = language_id.Scorer(model, ranks)
    words = ["the", "there", "an", "é", "x"]
    for word, row in zip(words, scorer.log_probabilities(words), strict=True):
        for language in (0, 1):
            want = all_segmentations(b" " + word.encode(), ranks, [max(p[language] / 2, 1e-6) for p in probabilities])
            assert row[language] == pytest.approx(math.log(want))


def forward_log_sum(word: bytes, pieces, row) -> float:
    """Log of the sum over all segmentations with exact fractions, one byte after the other."""
    forward = [Fraction(1)]
    for end in range(1, len(word) + 1):
        forward.append(sum((forward[start] * Fraction(float(row[number])) for start, number in pieces.ending_at(word, end)), Fraction(0)))
    return math.log(forward[-1].numerator) - math.log(forward[-1].denominator)


def test_long_words_are_summed_over_all_segmentations():
    import numpy as np

    ranks = bpe.load_ranks(RANKS)
    drawn = np.random.RandomState(3).rand(max(ranks.values()) + 1, 2) ** 4 / 1000
    scorer = language_id.Scorer(language_id.LanguageModel(["a", "b"], drawn), ranks)
    random_ = random.Random(4)
    words = ["".join(random_.choice("日本語学校私達行時間人大学生先東京都ありがとうございました") for _ in range(n)) for n in (15, 16, 17, 40, 200)]
    words += ["donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterbeamtengesellschaft", "x" * 47, "x" * 48, "ß" * 333, "the"]
    got = scorer.log_probabilities(words)
    for word, row in zip(words, got, strict=True):
        for language in (0, 1):
            assert row[language] == pytest.approx(forward_log_sum(b" " + word.encode(), scorer.pieces, scorer.probabilities[:, language]), abs=1e-6), word


def test_very_long_words_do_not_depend_on_how_they_are_grouped():
    import numpy as np

    ranks = bpe.load_ranks(RANKS)
    scorer = language_id.Scorer(language_id.LanguageModel(["a"], np.random.RandomState(5).rand(max(ranks.values()) + 1, 1) / 1000), ranks)
    words = ["語" * 30_000, "ab" * 5_000, "é" * 40] + ["y" * n for n in range(48, 648)]
    together = scorer.log_probabilities(words)
    for i in (0, 1, 2, 3, 400, 602):
        assert together[i] == pytest.approx(scorer.log_probabilities([words[i]])[0], rel=1e-12)


def test_more_languages_than_one_group(spark):
    """Scoring in groups gives what scoring all at once gives, whatever the group."""
    base = {"en": "the cat and the dog are on the mat", "de": "der hund und die katze sind auf der matte", "fr": "le chat et le chien sont sur le tapis", "ja": "私達は東京都の大学の学生です" * 3}
    rows = [(k, f"{text} own{chr(97 + i)}word", lang + suffix) for k, (lang, text) in enumerate(base.items()) for i, suffix in enumerate(["", "-x", "-y"])]
    labelled = spark.createDataFrame([(i, text, lang) for i, (_, text, lang) in enumerate(rows * 2)], "doc_id long, text string, lang string")
    labelled = labelled.select("doc_id", F.col("text").cast("binary").alias("text"), "lang")
    texts = [*base.values(), None, "", "12", "owna word", "zzz"]
    found = []
    for size in (400, 5, 1):
        model = language_id.fit(labelled, RANKS, PATTERN, per_group=size)
        assert sum(len(one.languages) for one, _ in model.models()) == 12
        found.append({r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(id_and_text(documents(spark, texts)), model, RANKS).collect()})
        kept = language_id.keep_clear(documents(spark, texts), model, RANKS, 0.2)
        assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (lang, score) in found[-1].items() if lang != "und" and score >= 0.2)
    for other in found[1:]:
        assert {i: lang for i, (lang, _) in other.items()} == {i: lang for i, (lang, _) in found[0].items()}
        assert all(other[i][1] == pytest.approx(found[0][i][1]) for i in other)
    assert [found[0][i][0][:2] for i in range(4)] == ["en", "de", "fr", "ja"] and found[0][4] == ("und", 0.0)


def test_more_than_400_languages_are_learned(spark):
    rows = [(i, f"word{'abcdefghijklmnopqrst'[i % 20] * (2 + i // 20)} common", f"l{i:03d}") for i in range(401)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string").select("doc_id", F.col("text").cast("binary").alias("text"), "lang")
    model = language_id.fit(labelled, RANKS, PATTERN)
    assert [(len(one.languages), last) for one, last in model.models()] == [(400, False), (1, True)]


def test_languages(spark):
    english, german = "the cat and the dog are on the mat", "der hund und die katze sind auf der matte"
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(english, "en"), (german, "de")] * 10)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = labelled.select("doc_id", F.col("text").cast("binary").alias("text"), "lang")
    model = language_id.fit(labelled.unionByName(labelled.limit(1).withColumn("lang", F.lit(None))), RANKS, PATTERN)
    assert [(one.languages, last) for one, last in model.models()] == [(["de", "en"], True)]
    texts = ["the dog and the mat", "die katze und der hund", None, "", "12 !? ²", "THE CAT " * 20_000, "und " * 3 + "z" * 5_000]
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(id_and_text(documents(spark, texts)), model, RANKS).collect()}
    assert [found[i][0] for i in range(7)] == ["en", "de", "und", "und", "und", "en", "de"]
    assert found[2][1] == 0.0 and all(0 <= score <= 1 for _, score in found.values()) and found[0][1] > 0.9
    kept = language_id.keep_clear(documents(spark, texts), model, RANKS, 0.5)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 5, 6] and kept.columns == ["doc_id", "text", "token_ids", "score"]


def plain_boilerplate(pages, ratio, least):
    out = []
    sites = Counter(site for _, site, _ in pages)
    has: Counter = Counter()
    for _, site, text in pages:
        for line in {line.strip(" ") for line in (text or "").split("\n")} - {""}:
            has[site, line] += 1
    for i, site, text in pages:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not (x.strip(" ") and has[site, x.strip(" ")] >= least and has[site, x.strip(" ")] > ratio * sites[site])]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_line_dedup_equals_the_plain_version(spark):
    random_ = random.Random(2)
    lines = ["menu", " menu ", "home", "", "body one", "body two", "footer"] + [f"own {i}" for i in range(40)]
    pages = [(i, random_.choice(["a", "a", "a", "b", None]), "\n".join(random_.choice(lines) for _ in range(random_.randrange(0, 9)))) for i in range(120)]
    pages += [(500, "a", None), (501, "b", ""), (502, "c", "menu\nmenu"), (503, "a", "menu\n" * 9_000), pages[0]]
    frame = spark.createDataFrame([(*p, "n", "k") for p in pages], "doc_id long, source string, text string, n_lines string, _total string")
    got = line_dedup.drop_boilerplate(frame, max_ratio=0.1, min_pages=3).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_boilerplate(pages, 0.1, 3)


def test_in_small_sites_the_ratio_alone_decides(spark):
    pages = [(0, "a", "menu\none"), (1, "a", "menu\ntwo"), (2, "a", "three"), (3, "b", "menu\nfour"), (4, "c", None), (5, "c", "menu"), (6, "c", "menu")]
    frame = spark.createDataFrame(pages, "doc_id long, source string, text string")
    for ratio, want in ((0.5, {0: "one", 1: "two"}), (0.7, {})):
        got = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(frame, max_ratio=ratio, distinct_texts=True).collect()}
        assert got == {i: want.get(i, text) for i, _, text in pages}


def copies_and_others(spark):
    """A third of a source are copies of one text, some with other blanks; every text has the same menu line."""
    copy = "\n".join(["menu", *(f"copied line {k} of the one text" for k in range(8))])
    rows = [(i, copy + "\n" * (i % 2)) for i in range(40)]
    rows += [(100 + i, "menu\n" + " ".join(f"own{i}word{k}" for k in range(12))) for i in range(80)]
    frame = spark.createDataFrame([(i, text, "en", "s", len(text)) for i, text in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return frame, copy


def test_copies_of_a_page_count_once(spark):
    frame, copy = copies_and_others(spark)
    kept = line_dedup.drop_boilerplate(frame, distinct_texts=True)
    texts = {r.doc_id: (r.text, r.n_dropped) for r in kept.collect()}
    assert texts[0] == (copy.removeprefix("menu\n"), 1) and texts[100][0].startswith("own0word0 ") and texts[100][1] == 1
    assert {r.n_dropped for r in line_dedup.drop_boilerplate(frame).filter("doc_id < 40").collect()} == {9}


def test_pipeline_keeps_one_of_many_copies(spark):
    frame, copy = copies_and_others(spark)
    kept = corpus_pipeline.keep_one_of_similar(spark, corpus_pipeline.drop_boilerplate_lines(spark, frame, ""), "")
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert sorted(rows) == [0, *range(100, 180)] and rows[0] == copy.removeprefix("menu\n")


def test_hosts(spark):
    urls = ["https://user:p@Example.org:80/a?b", "http://x.y", "mailto:a@b", None]
    frame = spark.createDataFrame([(u,) for u in urls], "url string").select(line_dedup.host_of(F.col("url")).alias("h"))
    assert [r.h for r in frame.collect()] == ["example.org", "x.y", None, None]


def plain_search(texts, items, thresholds):
    """Every passage against every item, BM25 from its definition."""
    parts = [(i, *decontamination.question_and_answer(t or "")) for i, t in items]
    parts = [p for p in parts if p[1]]
    frequency = Counter(w for _, q, a in parts for w in set(q + a))
    mean = sum(len(q + a) for _, q, a in parts) / len(parts)
    stride = max(len(q + a) for _, q, a in parts)
    found = set()
    for d, text in texts:
        words = decontamination.words_of(text)
        for at in range(0, len(words), stride):
            passage = words[at : at + 2 * stride]
            for i, q, a in parts:
                counts = Counter(q + a)
                norm = 1.2 * (0.25 + 0.75 * len(q + a) / mean)
                value = {w: math.log(1 + (len(parts) - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * 2.2 / (n + norm) for w, n in counts.items()}
                score = sum(v for w, v in value.items() if w in passage) / sum(value.values())
                enough = decontamination.contained(q, passage) >= thresholds.question and decontamination.contained(a, passage) >= thresholds.answer
                if score >= thresholds.score - 1e-9 and enough:
                    found.add((d, i))
    return found


def test_decontamination_equals_the_plain_version(spark):
    random_ = random.Random(4)
    words = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 40
    prose = lambda n: " ".join(random_.choice(words) for _ in range(n))
    items = [(i, prose(random_.randrange(8, 40)) + ". " + prose(random_.randrange(1, 7)) + ".") for i in range(60)]
    items += [(60, "the of and"), (61, ""), (62, None), (63, prose(12) + "\n" + prose(3)), (64, items[0][1])]
    texts = []
    for d in range(150):
        text = prose(random_.randrange(0, 200))
        if d % 3 == 0:
            item = random_.choice(items)[1] or ""
            if d % 2:
                own = item.split()
                del own[len(own) // 2 : len(own) // 2 + d % 5]
                item = " ".join(own)
            text = text + "\n" + item.upper() + "; " + prose(30)
        texts.append((d, text))
    texts += [(900, None), (901, ""), (902, items[1][1]), (903, prose(40_000) + " " + items[2][1])]
    frame = spark.createDataFrame([(*t, 1, "c") for t in texts], "doc_id long, text string, item_id int, _bytes string")
    item_frame = spark.createDataFrame(items, "item_id long, text string")
    thresholds = decontamination.Thresholds()
    want = plain_search(texts, items, thresholds)
    for per_pass in (1_000, 20):
        got = decontamination.contaminated(id_and_text(frame), item_frame, thresholds, per_pass).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want or per_pass == 20
        assert {r.doc_id for r in got} == {d for d, _ in want}
        assert all(r.question_overlap >= 0.8 and r.answer_overlap >= 0.8 for r in got)
    kept = decontamination.without_contaminated(frame, item_frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in texts} - {d for d, _ in want}
    assert (902, 1) in want and (903, 2) in want


def item_index(items):
    parts = [(i, *decontamination.question_and_answer(text)) for i, text in enumerate(items)]
    frequency = Counter(w for _, q, a in parts for w in set(q + a))
    return decontamination.ItemIndex(parts, frequency, len(parts), sum(len(q + a) for _, q, a in parts) / len(parts), decontamination.Thresholds())


def test_every_changed_word_of_a_part_of_five_or_more_is_borne():
    """Brute force: each word of each item replaced, dropped or followed by another, amid other words."""
    random_ = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    pick = lambda n, m: [" ".join(part) for part in (lambda w: (w[:n], w[n:]))(random_.sample(words, n + m)) if part]
    sizes = [(n, m) for n in (5, 6, 8, 10, 11, 16, 17, 22, 28, 29, 40) for m in (0, 1, 4, 5, 7, 11, 20)]
    items = [". ".join(pick(n, m)) + "." for n, m in sizes] + ["the same word and the same word and so on"]
    index = item_index(items)
    before, after = "over here now " * 20, " then some more" * 20
    for i, item in enumerate(items):
        question, answer = decontamination.question_and_answer(item)
        own = question + answer
        edits = {(at, how): own[:at] + new + own[at + 1 :] for at, word in enumerate(own) for how, new in (("replaced", ["zzz"]), ("dropped", []), ("followed", [word, "zzz"]))}
        edits["none", ""] = own
        found = index.search([before + " ".join(words) + after for words in edits.values()])
        for (at, how), hits in zip(edits, found, strict=True):
            short = at != "none" and len(answer) < 5 and at >= len(question)
            held = not short or (how == "followed" and at == len(own) - 1)
            assert (i in hits) == held, (item, at, how)


def test_short_parts_elsewhere_are_not_held():
    question, answer = "which of the two rivers is longer in this land", "the river of the north is the longer"
    index = item_index([question + ". " + answer + ".", "other words of another item"])
    scattered = " and then some ".join(answer.split())
    texts = [question + ". " + answer, question + ". we never knew that at all", question + ". " + scattered, " so ".join(question.split()) + ". " + answer]
    assert [0 in hits for hits in index.search(texts)] == [True, False, False, False]


def test_words_in_one_stretch():
    random_ = random.Random(9)
    for _ in range(300):
        part, words = ([random_.choice("abcde") for _ in range(random_.randrange(least, 14))] for least in (1, 0))
        want = max((sum((Counter(words[max(0, end - len(part)) : end]) & Counter(part)).values()) for end in range(len(words) + 1)), default=0)
        assert decontamination._in_one_stretch(part, words) == want / len(part)
