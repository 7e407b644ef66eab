"""The registered queries and the pipeline on a small folder of tables, against brute force."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tallywork.llm import packing, queries, simhash
from tallywork.llm.scratch import Scratch
from test_operators import SCHEMA, by_row, check_bins, hits, kept_words, linked, measures, rows_for_tests, split


WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


@pytest.fixture(scope="module")
def rows():
    """Rows with ids of their own, as the given tables have."""
    return [(n, *each[1:]) for n, each in enumerate(rows_for_tests())]


@pytest.fixture(scope="module")
def items(rows):
    passage = rows[36][1].split(" ")[12:40]
    return [(1, " ".join(passage)), (2, rows[7][1]), (3, None), (4, "")]


@pytest.fixture(scope="module")
def folder(spark, rows, items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    documents = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    documents.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    pages = [(1, "http://casino-win.example.net/en/1"), (2, None), (3, "http://a.example.org/en/15")]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{path}/pages.parquet")
    return path


def run(spark, folder, name, *columns):
    return by_row(queries.QUERIES[name](spark, folder), *columns)


def components_by_hand(rows):
    prints = {each[0]: simhash.fingerprint(simhash.shingle_hashes((each[1] or "").encode())) for each in rows}
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and ((prints[a] ^ prints[b]) % 2**64).bit_count() <= 2]
    return prints, linked(pairs, ids)


def near_by_hand(texts):
    """Least id of each group that fingerprints or sets of five-word shingles connect; every pair compared."""
    words = {n: split(text, lower=True) for n, text in texts}
    sets = {n: {tuple(w[at : at + 5]) for at in range(max(1, len(w) - 4))} if w else set() for n, w in words.items()}
    prints = {n: simhash.fingerprint(simhash.shingle_hashes((text or "").encode(), 5)) for n, text in texts}

    def linked_pair(a, b):
        close = ((prints[a] ^ prints[b]) % 2**64).bit_count() <= 2
        return close or (sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))

    ids = sorted(words)
    return linked([(a, b) for a in ids for b in ids if a < b and linked_pair(a, b)], ids)


def test_near_duplicates(spark, folder, rows):
    prints, groups = components_by_hand(rows)
    expected = sorted(((n, f"{prints[n] % 2**64:016x}", groups[n]) for n in prints), key=repr)
    assert run(spark, folder, "op2_simhash_near_dedup", "doc_id", "fingerprint", "component_id") == expected


def test_language(spark, folder, rows):
    found = run(spark, folder, "op3_language_id", "doc_id", "held_out", "lang_pred", "score")
    assert [each[:2] for each in found] == sorted(((n, zlib.crc32(str(n).encode()) % 5 == 0) for n in range(len(rows))), key=repr)
    for n, _, lang, score in found:
        assert (lang == "und") == (not any(map(str.isalpha, rows[n][1] or ""))) and 0 <= score <= 1


def test_held_out_is_never_null(spark, tmp_path):
    rows = [(None, "one two three", "en"), (4, "eins zwei", "de"), (None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("op3_language_id", "op9_lm_scoring"):
        found = queries.QUERIES[name](spark, str(tmp_path)).collect()
        assert [each["held_out"] for each in found if each["doc_id"] is None] == [False, False]
    assert {each["train_tokens"] for each in found} == {3 + 2 + 3}


def test_packing(spark, folder, rows):
    found = queries.QUERIES["op4_best_fit_packing"](spark, folder).collect()
    check_bins(found, packing.CAPACITY)
    assert sum(each["tokens"] for each in found) == sum(len(split(each[1])) + 1 for each in rows)


def test_urls(spark, folder):
    found = run(spark, folder, "op6_url_filters", "page_id", "host", "path", "rule", "verdict")
    assert found[0] == (1, "casino-win.example.net", "/en/1", None, "block")
    assert found[1][:4] == (2, "", "", None) and found[2] == (3, "a.example.org", "/en/15", "example.org/en/1", "block")


def test_tokens(spark, folder, rows):
    from tokenizers import Tokenizer

    tokenizer, at, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert run(spark, folder, "op7_token_output", "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_language_model(spark, folder, rows):
    words = [[*split(each[1], lower=True), "</s>"] for each in rows]
    held = [zlib.crc32(str(n).encode()) % 5 == 1 for n in range(len(rows))]
    training = [word for each, out in zip(words, held) if not out for word in each]
    total, known = len(training), {word: training.count(word) for word in set(training)}
    found = run(spark, folder, "op9_lm_scoring", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for n, out, tokens, n_known, train, base, score in found:
        assert (out, tokens, n_known, train) == (held[n], len(words[n]), sum(word in known for word in words[n]), total)
        assert base == pytest.approx(sum(math.log10((known.get(w, 0) + 0.5) / (total + 0.5 * (len(known) + 1))) for w in words[n]))
        assert score < 0


def test_pipeline_stage_by_stage(spark, folder, rows, items):
    scratch, docs = Scratch(spark), spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    def passes(text):
        n, chars, symbols, again, repeated = measures(text)
        lines = len([line for line in (text or "").split("\n") if line.split()])
        return not (n < 10 or 100 * repeated > 20 * n or 10 * symbols > n or 2 * again > lines or chars < 2 * n or chars > 20 * n)

    left = [each for each in rows if passes(each[1])]
    stages = dict(corpus_pipeline.STAGES)
    docs = scratch.save(stages["quality rules"](spark, docs, folder))
    assert docs.columns == columns and by_row(docs, "doc_id", "text") == sorted((each[:2] for each in left), key=repr)

    groups = near_by_hand([each[:2] for each in left])
    left = [each for each in left if groups[each[0]] == each[0]]
    docs = scratch.save(stages["SimHash near-dedup"](spark, docs, folder))
    assert docs.columns == columns and by_row(docs, "doc_id", "text") == sorted((each[:2] for each in left), key=repr)

    kept = {doc_id: (text, gone, n) for doc_id, n, gone, text in kept_words(left, 50)}
    left = [(each[0], kept[each[0]][0] if kept[each[0]][1] else each[1]) for each in left if kept[each[0]][1] < kept[each[0]][2]]
    docs = scratch.save(stages["substring dedup"](spark, docs, folder))
    assert docs.columns == columns and by_row(docs, "doc_id", "text") == sorted(left, key=repr)
    assert all(each["n_chars"] == len(each["text"]) for each in docs.collect())

    left = [each for each in left if not hits(each[1], items)[1]]
    docs = scratch.save(stages["benchmark decontamination"](spark, docs, folder))
    assert docs.columns == columns and by_row(docs, "doc_id", "text") == sorted(left, key=repr)

    found = stages["best-fit packing"](spark, docs, folder).collect()
    check_bins(found, packing.CAPACITY)
    assert {each["doc_id"] for each in found} == {each[0] for each in left}
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_pipeline_drops_near_copies_of_any_edits(spark, tmp_path):
    """Chains, copies with edits all over, many words in common, short and odd texts; every pair compared by hand."""
    rng = random.Random(11)
    common = [rng.choice(WORDS) for _ in range(12)]
    texts = [None, "", " \n", "one two", "One  two", "a b c d e f"]
    for _ in range(12):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(30, 400))] + common
        for _ in range(6):
            words = list(words)
            for at in rng.sample(range(len(words)), rng.randrange(1, 2 + len(words) // 45)):
                words[at] = rng.choice(WORDS)
            texts.append(" ".join(words))
    groups = near_by_hand(list(enumerate(texts)))
    expected = [n for n in range(len(texts)) if groups[n] == n]
    assert 20 < len(expected) < len(texts) - 20
    docs = spark.createDataFrame([(n, text, "en", "s", 1) for n, text in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, docs, str(tmp_path))
    assert found.columns == docs.columns and sorted(each["doc_id"] for each in found.collect()) == expected


def test_pipeline_of_nothing(spark, folder, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
