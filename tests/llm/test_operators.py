"""The training-data operators on small rows with every odd case, against brute force."""

from __future__ import annotations

import math
import random
import re
import textwrap
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tallywork.llm import decontam, language, licenses, lm, packing, quality, simhash, substrings, tokens, urls, wording
from tallywork.llm.components import components
from tallywork.llm.scratch import Scratch, shared_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row int, _words string, kept int, host int"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def row(doc_id, text, lang="en", source="s0"):
    return doc_id, text, lang, source, None if text is None else len(text), 1, "x", 2, 3


def rows_for_tests():
    """Nulls, empty, blank, long, equal and nearly equal texts, repeated rows, equal ids."""
    rng = random.Random(7)
    vocabulary = [f"{a}{b}" for a in ("ra", "mi", "to", "Se", "lù", "x9") for b in ("na", "ke", "PO", "zi", "é", ".")]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, long = text(70), text(900)
    found = [row(n, text(rng.randrange(1, 130)), rng.choice(["en", "fr"]), f"s{n % 3}") for n in range(30)]
    found += [row(30, None), row(31, ""), row(32, " \n\t "), row(None, text(60)), row(33, long), row(34, long)]
    found += [row(35, long.replace("rana", "rana", 1) + " end"), row(36, f"{text(9)} {passage}\n{text(20)}")]
    found += [row(37, f"{passage} {text(3)}"), row(38, f"{text(30)}\n\n{passage}"), row(38, text(80)), row(5, passage)]
    found += [row(39, "a b c d e f " * 300), row(40, "a b c d e f " * 200), row(41, "one"), row(42, "one two")]
    return found + [found[3], found[33], row(43, passage, None, None)]


@pytest.fixture(scope="module")
def rows():
    return rows_for_tests()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(frame, *columns):
    return sorted((tuple(each[name] for name in columns) for each in frame.collect()), key=repr)


def split(text, lower=False):
    data = (text or "").encode()
    return [word.decode() for word in (data.translate(LOWER) if lower else data).split()]


# words and hashes


@pytest.mark.parametrize("text", ["", " ", "a", " a  b\nc", "é ü\tß", "x" * 3_000_000 + " y z"])
def test_spans_are_words_and_hashes_follow_them(text):
    data = f"{text} {text}".encode()
    starts, ends = wording.word_spans(data)
    words = [data[a:b] for a, b in zip(starts, ends)]
    assert words == data.split()
    hashes = wording.span_hashes(data, starts, ends).tolist()
    assert len(set(hashes)) == len(set(words)) and hashes[: len(hashes) // 2] == hashes[len(hashes) // 2 :]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 43])
def test_sliding_min(size):
    values = np.random.default_rng(3).integers(0, 1000, 100).astype(np.uint64)
    assert wording.sliding_min(values, size).tolist() == [values[n : n + size].min() for n in range(101 - size)]


def test_window_hashes_follow_their_values():
    values = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    found = wording.window_hashes(values, 3)
    assert found[0] == found[3] and len(set(found.tolist())) == 4


# quality


def measures(text):
    words, lines = split(text), [line for line in (text or "").split("\n") if line.split()]
    windows = [tuple(words[n : n + 5]) for n in range(len(words) - 4)]
    twice = Counter(windows)
    covered = {n + k for n, window in enumerate(windows) if twice[window] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>") if text else 0,
            len(lines) - len(set(lines)), len(covered))


def test_quality_measures(docs, rows):
    found = by_row(quality.ledger(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert found == sorted(((each[0], *measures(each[1])) for each in rows), key=repr)


def test_quality_keeps_columns_and_rejects(docs, none):
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert not {39, 40, 30, 31, 32, 41} & {each["doc_id"] for each in kept.collect()}
    assert quality.keep(none).count() == 0 and quality.ledger(none).count() == 0


def test_summary_of_bits(docs):
    marked = quality.ledger(docs)
    rows = marked.select("source", "failed").collect()
    for each in quality.summary(marked, ["source"]).collect():
        bits = [one["failed"] for one in rows if one["source"] == each["source"]]
        every = anything = bits[0]
        for one in bits:
            every, anything = every & one, anything | one
        assert (each["any_failed"], each["all_failed"], each["n_docs"]) == (anything, every, len(bits))


def test_ablations_agree_with_policies(docs):
    marked = quality.ledger(docs).select("failed").collect()
    whole = quality.mask(quality.POLICIES["prose-1"])
    for each in quality.ablations(quality.ledger(docs)).collect():
        bit = quality.mask([each["rule"]])
        assert each["n_failed"] == sum(bool(one["failed"] & bit) for one in marked)
        assert each["n_kept_without"] == sum(not one["failed"] & whole & ~bit for one in marked)
        assert each["n_failed_alone"] == sum(one["failed"] & whole == bit for one in marked)


# licences


def test_licenses_in_any_spelling(spark):
    mit = licenses.MIT.replace("sublicense", "sub-licence").replace(". ", ".\n").upper()
    texts = [(1, f"Copyright (c) 2020 Some One\n\n{mit}"), (2, f"intro\n\n{mit}\n\nmore"), (3, "Released under the MIT Licence"),
             (4, "x\n  * licensed under cc-by-nc 4.0\ny"), (5, None), (6, ""), (7, "no licence"), (3, "Released under the MIT Licence"),
             (None, "Licensed under the Apache License, Version 2.0.")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = by_row(licenses.scan(docs, licenses.notices(spark)), "doc_id", "whole_license", "licenses")
    assert found == sorted([(1, "MIT", "MIT"), (2, None, "MIT"), (3, "MIT", "MIT"), (3, "MIT", "MIT"), (4, None, "CC-BY-NC-4.0"),
                            (5, None, ""), (6, None, ""), (7, None, ""), (None, "Apache-2.0", "Apache-2.0")], key=repr)
    assert licenses.scan(docs.limit(0), licenses.notices(spark)).count() == 0


@pytest.mark.parametrize("width", [40, 64, 90])
def test_published_licenses_at_any_width(spark, width):
    def wrapped(text):
        return "\n".join(textwrap.wrap(text, width))

    notice = "Copyright (c) 2020 Some One"
    mit = "\n\n".join(wrapped(part) for part in re.split(r"(?<=conditions:)\s|(?<=the Software\.)\s(?=THE)", licenses.MIT.replace("\n", " ")))
    isc = wrapped(licenses.ISC)
    texts = [(1, f"MIT License\n\n{notice}\n\n{mit}\n"), (2, f"ISC License\n\n{notice}\n\n{isc}"), (3, isc),
             (4, f"some code\n\n{isc}\n\nmore code"), (5, f"some code\n\n{mit}\n\nmore code"), (6, f"{notice}\nAll rights reserved.")]
    found = by_row(licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), licenses.notices(spark)),
                   "doc_id", "whole_license", "licenses")
    assert found == [(1, "MIT", "MIT"), (2, "ISC", "ISC"), (3, "ISC", "ISC"), (4, None, "ISC"), (5, None, "MIT"), (6, None, "")]


# near duplicates


def linked(pairs, nodes):
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for left, right in pairs:
        a, b = root(left), root(right)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}


def test_fingerprint_by_hand():
    for text in ("", "One", "one two", "A b c D", "x y z " * 50):
        words = split(text, lower=True)
        shingles = [" ".join(words[n : n + 3]) for n in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(one.encode(), 42) for one in shingles]
        value = sum(1 << bit for bit in range(64) if 2 * sum(one >> bit & 1 for one in hashes) > len(hashes))
        assert simhash.fingerprint(simhash.shingle_hashes(text.encode())) % 2**64 == value


@pytest.mark.parametrize("bucket", [0, 2, 1000])
def test_links_of_close_prints(spark, bucket):
    """Chains, hubs and far values, with every bucket, some or none over the bound."""
    rng = random.Random(5)
    prints = {0, 2**64 - 1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints |= {centre} | {centre ^ (1 << a) ^ (1 << b) for a, b in [rng.sample(range(64), 2) for _ in range(15)]}
        prints |= {centre ^ (0b111 << rng.randrange(60)) for _ in range(8)}
    signed = {one - 2**64 if one >= 2**63 else one for one in prints}
    scratch = Scratch(spark)
    frame = spark.createDataFrame([(one,) for one in signed], "print long")
    found = {each["node"]: each["least"] for each in components(simhash.links(frame, scratch, bucket), scratch).collect()}
    close = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 2]
    expected = linked(close, signed)
    assert {node: found.get(node, node) for node in signed} == expected


def test_components_of_paths_and_stars(spark):
    pairs = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 160)] + [(200, 200), (-5, 7)]
    found = components(spark.createDataFrame(pairs, "x long, y long"), Scratch(spark)).collect()
    expected = linked(pairs, {n for pair in pairs for n in pair})
    del expected[200]
    assert {each["node"]: each["least"] for each in found} == expected
    assert components(spark.createDataFrame([], "x long, y long"), Scratch(spark)).count() == 0


def test_groups_and_one_of_each(spark, docs, rows, none):
    found = simhash.groups(docs, Scratch(spark)).collect()
    assert len(found) == len(rows)
    groups = {each["doc_id"]: each["component_id"] for each in found}
    assert groups[30] == groups[31] == groups[32] == 30 and groups[34] == 33
    kept = simhash.one_of_each(docs, Scratch(spark))
    ids = [each["doc_id"] for each in kept.collect()]
    assert kept.columns == docs.columns and ids.count(30) == 1 and not {31, 32, 34} & set(ids)
    assert ids.count(3) == 1 and ids.count(None) == 1
    assert simhash.groups(none, Scratch(spark)).count() == 0 == simhash.one_of_each(none, Scratch(spark)).count()


# language


def test_language_learns_and_answers_for_odd_texts(spark):
    texts = [(n, text, lang) for n, (text, lang) in enumerate(
        [("the house and the garden of the man", "en"), ("la maison et le jardin de l'homme", "fr")] * 5)]
    docs = spark.createDataFrame([*texts, (90, None, "en"), (91, "x", None)], "doc_id long, text string, lang string")
    langs, matrix = language.train(docs)
    assert langs == ["en", "fr"] and matrix.shape == (language.BUCKETS, 2)
    asked = spark.createDataFrame(
        [(1, "the man", 0.5), (2, "le jardin", 0.5), (3, None, 0.5), (4, "12 + 3", 0.5), (5, "", 0.5), (6, "the man" * 9999, 0.5)],
        "doc_id long, text string, score double")
    found = by_row(language.predict(spark, asked, langs, matrix), "doc_id", "lang_pred")
    assert found == [(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (6, "en")]
    assert all(0 <= each["score"] <= 1 for each in language.predict(spark, asked, langs, matrix).collect())
    empty = language.train(docs.limit(0))
    assert {each["lang_pred"] for each in language.predict(spark, asked, *empty).collect()} == {"und"}


def test_language_scores_are_bayes():
    matrix = np.log(np.random.default_rng(1).random((64, 3))).astype(np.float32)
    names, odds = language.score(["abc"], ["a", "b", "c"], matrix)
    sums = matrix[language.ngrams("abc", 64)].astype(float).sum(axis=0)
    assert names == ["abc"[sums.argmax()]] and math.isclose(odds[0], np.exp(sums).max() / np.exp(sums).sum(), rel_tol=1e-6)


# packing


def check_bins(found, capacity):
    bins = defaultdict(list)
    for each in found:
        bins[each["bin_id"]].append(each)
    for pieces in bins.values():
        assert sum(each["tokens"] for each in pieces) <= capacity
        for name in ("source", "cluster"):
            held = [each[name] for each in pieces if each[name] is not None]
            assert len(held) == len(set(held))
    return bins


def test_best_fit_takes_the_tightest_bin_without_conflict():
    rng = random.Random(2)
    rows = [(rng.randrange(1, 60), 1 << rng.randrange(5), rng.choice([0, 1, 2, 4])) for _ in range(400)]
    bins, expected = [], []
    for length, source, cluster in rows:
        fits = [(b[0], n) for n, b in enumerate(bins) if b[0] >= length and not b[1] & source and not b[2] & cluster]
        chosen = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([100, 0, 0])
        bins[chosen] = [bins[chosen][0] - length, bins[chosen][1] | source, bins[chosen][2] | cluster]
        expected.append(chosen)
    assert packing.best_fit(rows, 100) == expected


def test_packing_places_all_tokens(spark, docs, rows, none):
    found = packing.pack(packing.lengths(docs), Scratch(spark), capacity=100, shard=10).collect()
    check_bins(found, 100)
    assert sum(each["tokens"] for each in found) == sum(len(split(each[1])) + 1 for each in rows)
    assert {each["doc_id"] for each in found} == {each[0] for each in rows}
    again = packing.pack(packing.lengths(docs.repartition(5)), Scratch(spark), capacity=100, shard=10).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again), key=repr)
    assert packing.pack(packing.lengths(none), Scratch(spark)).count() == 0


def test_equal_rows_are_packed_in_parts(spark):
    docs = spark.createDataFrame([(1, "a b", "s")] * 50, "doc_id long, text string, source string")
    bins = check_bins(packing.pack(packing.lengths(docs), Scratch(spark), shard=4).collect(), packing.CAPACITY)
    assert len(bins) == 50


# decontamination


def plain(text):
    data = (text or "").translate({n: n + 32 for n in range(65, 91)})
    return "".join(c if ord(c) > 127 or c.isdigit() or "a" <= c <= "z" else " " for c in data).split(" ")


def hits(text, items):
    words = [word for word in plain(text) if word]
    covered, ids = set(), set()
    for item_id, item in items:
        known = [word for word in plain(item) if word]
        size = min(10, len(known))
        windows = {tuple(known[n : n + size]) for n in range(len(known) - size + 1)} if known else set()
        for n in range(len(words) - size + 1):
            if tuple(words[n : n + size]) in windows:
                covered |= set(range(n, n + size))
                ids.add("" if item_id is None else str(item_id))
    return words, covered, ids


@pytest.fixture(scope="module")
def items(rows):
    passage = rows[36][1].split(" ")[12:40]
    return [(1, " ".join(passage)), (2, "one TWO"), (10, " ".join(passage[4:20])), (3, None), (4, " . "), (None, "x9é x9é"),
            (2, "one TWO"), (5, rows[7][1])]


@pytest.mark.parametrize("bound", [decontam.BROADCAST_BYTES, -1])
def test_decontamination(spark, docs, rows, items, bound, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", bound)
    known = spark.createDataFrame(items, "item_id long, text string")
    expected = []
    for each in rows:
        words, covered, ids = hits(each[1], items)
        expected.append((each[0], len(words), len(covered), len(ids), ",".join(sorted(ids)), bool(covered)))
    found = decontam.report(docs, known).withColumn("ids", F.array_join("item_ids", ","))
    assert by_row(found, "doc_id", "n_words", "n_hit", "n_items", "ids", "contaminated") == sorted(expected, key=repr)
    kept = decontam.clean_documents(docs, known)
    assert by_row(kept, *docs.columns) == sorted((each for each in rows if not hits(each[1], items)[1]), key=repr)
    cut = decontam.clean_spans(docs, known)
    left = [[word for n, word in enumerate(hits(each[1], items)[0]) if n not in hits(each[1], items)[1]] for each in rows]
    assert sorted([word for word in plain(each["text"]) if word] for each in cut.collect()) == sorted(left)


def test_decontamination_verifies_hits_by_text(spark, monkeypatch):
    known = spark.createDataFrame([(1, "one two"), (2, "two three"), (3, "nine")], "item_id long, text string")
    docs = spark.createDataFrame([row(1, "zero, One TWO four."), row(2, ".two"), row(3, "")], SCHEMA)
    monkeypatch.setattr(decontam, "_at", lambda words, pos, size: F.lit(7).cast("long"))
    found = decontam.report(docs, known)
    assert by_row(found, "doc_id", "n_words", "n_hit", "item_ids") == [(1, 4, 2, ["1"]), (2, 1, 0, []), (3, 0, 0, [])]


def test_decontamination_of_nothing(spark, docs, none, rows):
    known = spark.createDataFrame([], "item_id long, text string")
    assert decontam.clean_documents(docs, known).count() == len(rows)
    assert decontam.report(none, known).count() == 0


# URLs


def test_urls(spark):
    cases = [
        (1, "http://Example.ORG/es/x?y", "example.org", "/es/x", "example.org/es/", "block"),
        (2, "https://a.example.org/en/12", "a.example.org", "/en/12", "example.org/en/1", "block"),
        (3, "x://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        (4, "http://m.com/fr/1", "m.com", "/fr/1", "com/fr/", "allow"), (5, "http://m.com/de/#a", "m.com", "/de/", "com/de/", "block"),
        (6, "http://casino-bets.example.net?q", "casino-bets.example.net", "", None, "block"),
        (7, "http://www.gardening.example.net/en/5", "www.gardening.example.net", "/en/5", None, "allow"),
        (8, None, "", "", None, None), (9, "no scheme", "", "", None, None), (10, "http://org", "org", "", None, None),
        (11, "a://b://c/d", "b:", "//c/d", None, None),
    ]
    pages = spark.createDataFrame([(n, url, "old") for n, url, *_ in cases], "page_id long, url string, rule string")
    model = urls.train(urls.labelled(spark))
    found = {each["page_id"]: each for each in urls.judge(pages, model).collect()}
    for n, _, host, path, rule, verdict in cases:
        assert (found[n]["host"], found[n]["path"], found[n]["rule"]) == (host, path, rule)
        assert found[n]["verdict"] in ("allow", "block") and verdict in (None, found[n]["verdict"])
    assert urls.judge(pages.limit(0), model).count() == 0


def test_url_model_on_urls_that_it_was_not_trained_on(spark):
    """Of each pair one is to be blocked: by its host, with a path that both have, or by its path alone."""
    trained = " ".join(url for url, _ in urls.whole_urls())
    hosts = [("casino-win", "plum-valley"), ("ads-track", "fernhill"), ("adult-x", "riverbend"), ("spam-farm", "stonebridge")]
    paths = [("/casino/welcome-bonus", "/articles/77"), ("/shop/cheap-viagra-online", "/recipes/soup.html"),
             ("/adult/videos/9", "/science/moon"), ("/ads/click/4", "/news/2021/market")]
    assert not any(name in trained for pair in hosts for name in pair)
    assert not any(f"{path} " in f"{trained} " for pair in paths for path in (pair[0], pair[1]))
    cases = [(f"http://www.{name}.example.net/de/5", n == 0) for pair in hosts for n, name in enumerate(pair)]
    cases += [(f"http://www.plum-valley.example.com{path}", n == 0) for pair in paths for n, path in enumerate(pair)]
    frame = spark.createDataFrame(cases, "url string, block boolean")
    for each in urls.judge(frame, urls.train(urls.labelled(spark)), []).collect():
        assert (each["verdict"] == "block") == each["block"], each["url"]


# token files


def test_tokens_round_trip(spark, docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = [row(50, "<|endoftext|> <|ENDOFTEXT|>x \u0301a Ａ\u2028b 東京 Σας it's ..", "en"), row(51, "\x00 \x1c \xa0 é e\u0301")]
    every = spark.createDataFrame([*rows, *odd], SCHEMA).repartition(3)
    folder = shared_folder(spark)
    tokens.write_tokens(every, folder, path)
    read = tokens.read_tokens(spark, folder)
    ids = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    expected = sorted(((each[0], np.array(ids(each[1]), "<u4").tobytes()) for each in [*rows, *odd]), key=repr)
    assert sorted(((each["doc_id"], bytes(each["ids"])) for each in read.collect()), key=repr) == expected
    placed = tokens.starts(read.select("part", "shard", "place", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens")))
    ordered = sorted(placed.collect(), key=lambda each: each["start"])
    known = [each["doc_id"] for each in ordered if each["doc_id"] is not None]
    assert known == sorted(known)
    assert [each["start"] for each in ordered] == np.cumsum([0] + [each["n_tokens"] for each in ordered[:-1]]).tolist()
    assert tokens.document(spark, folder, 50) == [ids(odd[0][1])]
    assert sorted(tokens.document(spark, folder, 38)) == sorted(ids(each[1]) for each in rows if each[0] == 38)


def test_long_ids_beside_a_null_stay_exact(spark):
    large = [(2**60 + 1, "a b", "s"), (2**60 + 2, "a c", "s"), (None, None, None)]
    docs = spark.createDataFrame(large, "doc_id long, text string, source string").coalesce(1)
    folder = shared_folder(spark)
    tokens.write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    ids = {each[0] for each in large}
    assert {each["doc_id"] for each in tokens.read_tokens(spark, folder).collect()} == ids
    sizes = packing.lengths(docs)
    packed = packing.pack(sizes, Scratch(spark)).collect()
    assert {each["doc_id"] for each in packed} == ids
    assert {each["cluster"] for each in packed} == {each["cluster"] for each in sizes.collect()}
    assert {each["doc_id"] for each in simhash.groups(docs, Scratch(spark)).collect()} == ids
    assert {each["doc_id"] for each in substrings.deduplicated(docs, Scratch(spark)).collect()} == ids
    assert {each["doc_id"] for each in lm.score(docs, lm.train(docs, Scratch(spark))).collect()} == ids


def test_tokens_of_nothing_and_of_a_strange_dictionary(spark, none, docs):
    path, folder = public_tokenizers.path("word_bpe_49k.json"), shared_folder(spark)
    tokens.write_tokens(none, folder, path)
    assert tokens.read_tokens(spark, folder).count() == 0
    other = shared_folder(spark)
    tokens.write_tokens(docs.limit(3), other, path)
    shard = spark.read.parquet(f"{other}/shards").first()
    with pytest.raises(ValueError, match="another dictionary"):
        tokens.Shard(bytes(shard["index"]), bytes(shard["data"]), b"strange", None)


@pytest.mark.parametrize(("name", "by_words"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_encoder_gives_the_ids_of_any_tokenizer_file(name, by_words):
    encoder = tokens.Encoder(public_tokenizers.path(name))
    encoder.words.limit = encoder.pieces.limit = 40
    assert encoder.by_words == by_words
    letters, chance = "abZé ß'İıſΣσςÀ×÷·0٣²½Ⅷ \n\t\x0b\x1c\x85\xa0\u3000中文\u0301ñ.,!-_\u2019Ωж😀", random.Random(5)
    texts = ["".join(chance.choices(letters, k=chance.randint(0, 30))) for _ in range(3000)]
    texts += [f"{text}<|endoftext|>{text.upper()}" for text in texts[:500]]
    texts += ["Grün, wo's 12.5% sind... NICHT?" * 50, ""]
    wanted = [one.ids for one in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    found = [array("I", ids).tolist() for at in range(0, len(texts), 64) for ids in encoder.encode_all(texts[at : at + 64])]
    assert found == wanted
    assert encoder.encode(None) == b""
    assert len(encoder.pieces) + len(encoder.pieces.older) < 40 * 2 + 3000


def test_too_many_languages_are_refused_before_they_are_counted(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    monkeypatch.setattr(language, "counts", lambda *_: pytest.fail("counted"))
    with pytest.raises(ValueError, match="over 2 languages"):
        language.train(spark.createDataFrame([row(n, "text", f"l{n}") for n in range(3)], SCHEMA))


def test_broadcast_measure_counts_the_item_ids(spark, monkeypatch):
    items = spark.createDataFrame([(f"item{n}", "the same words") for n in range(500)], "item_id string, text string")
    docs = spark.createDataFrame([row(1, "here are the same words")], SCHEMA)
    seen, broadcast = [], F.broadcast
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 5000)
    monkeypatch.setattr(decontam.F, "broadcast", lambda df: seen.append(df) or broadcast(df))
    assert decontam.report(docs, items).first()["n_items"] == 500 and not seen


# repeated passages


def kept_words(rows, window):
    rank = lambda doc_id: math.inf if doc_id is None else doc_id
    least = {}
    for doc_id, text, *_ in rows:
        words = split(text)
        for n in range(len(words) - window + 1):
            key = tuple(words[n : n + window])
            least[key] = min(rank(doc_id), least.get(key, math.inf))
    found = []
    for doc_id, text, *_ in rows:
        words = split(text)
        gone = {n + k for n in range(len(words) - window + 1) if least[tuple(words[n : n + window])] < rank(doc_id)
                for k in range(window)}
        found.append((doc_id, len(words), len(gone), None if text is None else " ".join(w for n, w in enumerate(words) if n not in gone)))
    return sorted(found, key=repr)


@pytest.mark.parametrize(("window", "anchor", "group"), [(50, 8, 9999), (50, 8, 0), (50, 8, 90), (6, 3, 9999), (6, 6, 30), (6, 3, 0)])
def test_substrings(spark, docs, rows, window, anchor, group):
    found = substrings.deduplicated(docs, Scratch(spark), window, anchor, group)
    assert by_row(found, "doc_id", "n_words", "n_removed", "kept") == kept_words(rows, window)
    assert set(docs.columns) <= set(found.columns)


def brute_repeats(group, window):
    """For each window that a member with a smaller doc has: the member's name and the window's place."""
    least = {}
    words = [(doc, name, text.decode().split()) for doc, name, text in group]
    for doc, _, line in words:
        for k in range(len(line) - window + 1):
            key = tuple(line[k : k + window])
            least[key] = min(doc, least.get(key, doc))
    return {(name, k) for doc, name, line in words for k in range(len(line) - window + 1)
            if least[tuple(line[k : k + window])] < doc}


def test_repeats_of_a_group_are_those_of_brute_force_and_cannot_be_extended():
    chance = random.Random(3)
    for _ in range(200):
        lines = {" ".join(chance.choices("ab", k=chance.randint(4, 14))).encode() for _ in range(6)}
        group = [(chance.randint(1, 4), b"%d" % n, line) for n, line in enumerate(sorted(lines))]
        found = substrings.repeats(group, 4)
        assert {(name, k + n) for name, k, length in found for n in range(length - 3)} == brute_repeats(group, 4)
        by_name = defaultdict(list)
        for name, k, length in found:
            by_name[name].append((k, k + length))
        for spans in by_name.values():
            assert all(a < b and end < other for (a, end), (b, other) in zip(sorted(spans), sorted(spans)[1:]))


def test_longer_prefixes_hold_the_words_of_all_their_windows():
    chance = random.Random(4)
    words = [chance.choice("abcdefgh") * chance.randint(1, 3) for _ in range(30)]
    line, other = " ".join(words).encode(), " ".join(["new", *words[2:], "end"]).encode()
    for width in substrings._widths(12, 3):
        cuts = substrings.lengthened(line, width, 12, 3)
        assert sum(n for _, n, _, _ in cuts) == 30 - 12 + 1
        assert [first for first, *_ in cuts] == np.cumsum([0] + [n for _, n, _, _ in cuts[:-1]]).tolist()
        keys = lambda found: {tuple(part.split()[k : k + 12]): key for _, n, key, part in found for k in range(n)}
        here, there = keys(cuts), keys(substrings.lengthened(other, width, 12, 3))
        assert len(here.keys() & there.keys()) == 30 - 12 - 1
        assert all(here[window] == there[window] for window in here.keys() & there.keys())
    assert substrings._widths(12, 3)[-1] == 1


@pytest.mark.parametrize("group", [substrings.GROUP, 300, 0])
def test_substrings_of_a_group_of_near_copies_stay_linear(spark, group, monkeypatch):
    chance = random.Random(5)
    base = [f"w{n}" for n in range(300)]
    texts = []
    for n in range(200):
        words = list(base)
        words[chance.randrange(300)] = f"changed{n}"
        texts.append(row(n, " ".join(words)))
    saved, save = [], Scratch.save

    def counted(self, df):
        found = save(self, df)
        saved.append((found.columns, found.count()))
        return found

    monkeypatch.setattr(Scratch, "save", counted)
    docs = spark.createDataFrame(texts, SCHEMA)
    found = substrings.deduplicated(docs, Scratch(spark), 50, 8, group)
    assert by_row(found, "doc_id", "n_words", "n_removed", "kept") == kept_words(texts, 50)
    runs = [count for columns, count in saved if "words" in columns]
    # A changed word touches 50 windows, which lie in few runs; only a longer prefix cuts them.
    assert runs[0] < 200 * 12
    assert all(count <= 200 * 100 for count in runs)
    assert (len(runs) > 1) == (group < substrings.GROUP)


def test_substrings_of_a_very_long_text(spark):
    words = [f"w{n % 977}" for n in range(40_000)]
    texts = [row(1, " ".join(words)), row(2, "x " + "  ".join(words[10_000:30_000]) + " y"), row(3, "z" * 300_000)]
    found = substrings.deduplicated(spark.createDataFrame(texts, SCHEMA), Scratch(spark))
    assert by_row(found, "doc_id", "n_words", "n_removed", "kept") == kept_words(texts, 50)


def test_substrings_of_nothing(spark, none):
    assert substrings.deduplicated(none, Scratch(spark)).count() == 0


# language model


def kneser_ney(training):
    pairs, before, total, seen = Counter(), Counter(), Counter(), defaultdict(lambda: [0, 0, 0])
    for words in training:
        pairs.update(zip(["<s>", *words[:-1]], words))
    for (left, right), n in pairs.items():
        total[left] += n
        seen[left][min(n, 3) - 1] += 1
        before[right] += 1
    cuts = lambda values: lm.discounts(*(sum(value == n for value in values) for n in (1, 2, 3, 4)))
    high, low = cuts(pairs.values()), cuts(before.values())
    rest = sum(low[min(n, 3) - 1] for n in before.values()) / len(pairs)
    words = len(before)

    def lower(word):
        n = before.get(word, 0)
        return (n - low[min(n, 3) - 1] if n else 0) / len(pairs) + rest / (words + 1)

    def chance(left, word):
        if not total.get(left):
            return lower(word)
        n = pairs.get((left, word), 0)
        spare = sum(cut * count for cut, count in zip(high, seen[left])) / total[left]
        return (n - high[min(n, 3) - 1] if n else 0) / total[left] + spare * lower(word)

    return chance


@pytest.mark.parametrize("bucket", [lm.BUCKET_BYTES, 500])
def test_language_model(spark, docs, rows, bucket, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(lm, "CHUNK_BYTES", 1000)
    trains = lambda doc_id: doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1
    words = [[*split(each[1], lower=True), "</s>"] for each in rows]
    training = [each for each, one in zip(words, rows) if trains(one[0])]
    counts = Counter(word for each in training for word in each)
    total, chance = sum(counts.values()), kneser_ney(training)
    assert math.isclose(sum(chance("mina", word) for word in [*counts, "new"]), 1, rel_tol=1e-9)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    model = lm.train(docs.filter(~F.coalesce(fold, F.lit(False))), Scratch(spark))
    found = by_row(lm.score(docs, model), "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    expected = list(
        (one[0], len(each), sum(word in counts for word in each), total,
         sum(math.log10((counts[word] + 0.5) / (total + 0.5 * (len(counts) + 1))) for word in each),
         sum(math.log10(chance(*pair)) for pair in zip(["<s>", *each[:-1]], each)))
        for each, one in zip(words, rows))
    assert len(found) == len(expected)
    for left, right in zip(sorted(found, key=lambda e: (str(e[0]), e[1])), sorted(expected, key=lambda e: (str(e[0]), e[1]))):
        assert left[:4] == right[:4]
        assert left[4:] == pytest.approx(right[4:], rel=1e-9)


def test_language_model_of_nothing(spark, docs, none, rows):
    found = lm.score(docs, lm.train(none, Scratch(spark))).collect()
    assert len(found) == len(rows) and all(each["n_known"] == 0 and each["score"] == 0 for each in found)
    assert lm.score(none, lm.train(docs, Scratch(spark))).count() == 0


def test_mixing_can_be_undone():
    values = np.random.default_rng(4).integers(0, 2**63, 1000).astype(np.uint64)
    assert (lm.unmixed(wording.mixed(values)) == values).all()


def test_folder_must_be_mounted():
    assert lm.local_path("file:///a/b") == "/a/b" == lm.local_path("/a/b")
    with pytest.raises(ValueError, match="mounted"):
        lm.local_path("hdfs://a/b")


def test_scratch_tables_go_when_told(spark):
    from pathlib import Path

    scratch = Scratch(spark)
    first, second = scratch.save(spark.range(3)), scratch.save(spark.range(4))
    folder = Path(lm.local_path(scratch.folder))
    scratch.drop(first)
    assert second.count() == 4 and [each.name for each in folder.iterdir()] == ["2"]
    scratch.close()
    assert not folder.exists()
