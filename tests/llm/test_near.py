"""Near copies by bands and prefixes, against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from tallywork.llm import near, prefixes
from tallywork.llm.scratch import Scratch
from test_queries_llm import WORDS, near_by_hand


def written(spark, path, texts):
    docs = spark.createDataFrame([(n, text, "en", "s", 1) for n, text in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def drawn(rng, count):
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(count)]


def crowd(pairs):
    """Pairs at 0.83 whose texts are at 0.74 from all others: too much in common for bands to tell them apart."""
    rng = random.Random(3)
    common = drawn(rng, 340)
    texts = []
    for _ in range(pairs):
        both = common + drawn(rng, 25)
        texts += [" ".join(both + drawn(rng, 35)) for _ in range(2)]
    return texts


def test_no_pair_is_lost_among_many_that_share_a_passage(spark, tmp_path):
    texts = crowd(120)
    groups = near_by_hand(list(enumerate(texts)))
    expected = [n for n in range(len(texts)) if groups[n] == n]
    assert len(expected) > 110  # a few fingerprints are close by chance
    docs = written(spark, tmp_path, texts)
    found = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, docs, str(tmp_path))
    assert sorted(each["doc_id"] for each in found.collect()) == expected


@pytest.mark.parametrize("lane, listed", [(3, 1 << 15), (200, 0)])
def test_prefixes_alone_find_all_groups(spark, tmp_path, monkeypatch, lane, listed):
    """No bands, small lanes, no order by frequency: only the cost may change."""
    monkeypatch.setattr(prefixes, "LANE", lane)
    monkeypatch.setattr(prefixes, "LISTED", listed)
    monkeypatch.setattr(near, "ROUNDS", 0)
    rng = random.Random(5)
    texts = [None, "", "one two", "One  two", "a b c d e f", "a b c d e f g h i j", "a b c d e f g h i x", *crowd(10)]
    for size in (9, 30, 31, 200, 5000):
        words = drawn(rng, size)
        for _ in range(5):
            words = list(words)
            words[rng.randrange(size)] = rng.choice(WORDS)
            texts.append(" ".join(words))
    groups = near_by_hand(list(enumerate(texts)))
    expected = [n for n in range(len(texts)) if groups[n] == n]
    found = near.one_of_each(written(spark, tmp_path, texts), Scratch(spark))
    assert sorted(each["doc_id"] for each in found.collect()) == expected


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for size, other in ((1, 1), (15, 17), (16, 20), (300, 340), (5000, 4100)):
        one = np.unique(rng.integers(0, 2**64, size, np.uint64))
        both = np.unique(np.concatenate([one[: min(size, other) // 2], rng.integers(0, 2**64, other - min(size, other) // 2, np.uint64)]))
        bits = pd.Series([prefixes.parities(one)] * 2), pd.Series([prefixes.parities(both), prefixes.parities(one)])
        assert prefixes.differing(*bits)[0] <= len(np.setxor1d(one, both)) and prefixes.differing(*bits)[1] == 0


def test_texts_that_share_most_words_are_no_candidates(spark, tmp_path, monkeypatch):
    """Pairs grew with the square of the texts that share a passage, unless the passage was listed as frequent."""
    monkeypatch.setattr(prefixes, "LISTED", 0)
    rng = random.Random(7)
    common = drawn(rng, 60)
    texts = [" ".join(common + drawn(rng, 40)) for _ in range(60)]
    texts += [" ".join(common + drawn(rng, 5)) for _ in range(2)]
    compared, search = [], prefixes.candidates

    def counted(*given):
        found = search(*given)
        compared.append(found.count())
        return found

    monkeypatch.setattr(prefixes, "candidates", counted)
    monkeypatch.setattr(near, "ROUNDS", 0)
    found = near.one_of_each(written(spark, tmp_path, texts), Scratch(spark))
    assert sorted(each["doc_id"] for each in found.collect()) == list(range(61))
    assert compared == [1]
