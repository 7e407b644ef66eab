"""Fill-in-the-middle, conversation trie and document fingerprints on odd rows, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywork.llm import merkle, middle, queries, trie
from tallywork.llm.boundaries import ARRAY, BITMAP, RUN, BoundarySet
from tallywork.llm.scratch import Scratch
from test_operators import SCHEMA, by_row, row, rows_for_tests


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    """As the other operators', and markers, lone marker parts, wide characters, a very long text."""
    odd = ["a <P> b", "x<S>", "<M>", "<<P", "P>S>M>" * 9, "é" * 300, "😀á\n" * 50, "# head\n\nsome text. More!\n\n\n\nend", "\n\n", "\n"]
    odd += ["word " * 250_000 + "é" * 70_000]
    return rows_for_tests() + [row(100 + n, text) for n, text in enumerate(odd)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# --- boundary sets


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300_000), st.integers(1, 9000), st.integers(1, 3)), max_size=6))
def test_boundary_set_selects_and_ranks(parts):
    places = sorted({first + step * n for first, count, step in parts for n in range(count)})
    found = BoundarySet.of(np.array(places, np.int64))
    again = BoundarySet.from_bytes(found.to_bytes())
    assert len(found) == len(again) == len(places)
    for k in range(0, len(places), max(1, len(places) // 50)):
        assert found.select(k) == again.select(k) == places[k]
        assert found.rank(places[k]) == k and found.rank(places[k] + 1) == k + 1
    with pytest.raises(IndexError):
        found.select(len(places))


def test_containers_take_the_smallest_form():
    few, every, half = np.array([3, 9, 700]), np.arange(65536), np.flatnonzero(np.random.default_rng(1).random(65536) < 0.5)
    kinds = [BoundarySet.of(each).containers[0][1] for each in (few, every, half, half + 5 * 65536)]
    assert kinds == [ARRAY, RUN, BITMAP, BITMAP]
    assert BoundarySet.of(half + 5 * 65536).containers[0][0] == 5
    assert len(BoundarySet.of(np.arange(10 * 65536)).to_bytes()) < 200


# --- fill in the middle


def cut_by_hand(doc_id, text, unit=None):
    text = text or ""
    h = [int(sha(f"1:{'' if doc_id is None else doc_id}")[8 * n : 8 * n + 8], 16) for n in range(4)]
    units = list(text) if unit is None else re.findall(unit, text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, None, text
    parts = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", *parts, f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return len(units), "psm", *parts, f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


COLUMNS = ("doc_id", "n", "form", "prefix", "middle", "suffix", "output")


@pytest.mark.parametrize(("unit", "pattern"), [
    (middle.CODE_POINT, None), (middle.WORD, r"^[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"),
    (middle.LINE, r"[^\n]*\n|[^\n]+"),
])
def test_parts_and_output(docs, rows, unit, pattern):
    found = middle.transformed(docs, unit)
    blank = {each[0] for each in rows if not (each[1] or "").split()}  # a text of blanks has no word to cut at
    expected = [(each[0], *cut_by_hand(each[0], each[1], pattern)) for each in rows if pattern is None or each[0] not in blank]
    got = [each for each in by_row(found, *COLUMNS) if pattern is None or each[0] not in blank]
    assert got == sorted(expected, key=repr)
    assert {each[2] for each in got} == {"plain", "psm", "spm"}
    assert found.columns == [*docs.columns, *COLUMNS[1:]]
    whole = found.select("text", middle.restored(F.col("output"), F.col("form")).alias("again"))
    assert whole.filter(F.coalesce("text", F.lit("")) != F.col("again")).count() == 0


def test_stored_sets_give_the_same_cuts(docs):
    one, other = F.lit(12345), F.lit(777)
    found = docs.select(middle.cuts(F.col("text"), one, other).alias("a"), middle.stored_cuts(middle.boundary_sets(F.col("text")), one, other).alias("b"))
    assert all(each["a"] == each["b"] for each in found.collect())


def test_nothing_to_cut(spark):
    assert middle.transformed(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, "abc", "x", 7)], "doc_id long, text string, output string, _cut int")
    assert middle.transformed(clash, cut=0).select("text", "output", "_cut").collect() == [("abc", "abc", 7)]


# --- fingerprints


def tree_by_hand(text):
    pieces = []

    def paragraph(part):
        found = re.findall(r"[^.!?]{0,99}[.!?]+[ \t]*|[^.!?]{1,100}", part)
        pieces.extend((sha("W" + each), len(each)) for each in found)
        return sha("P" + "".join(sha("W" + each) for each in found))

    sections = [sha("S" + "".join(map(paragraph, each.split("\n")))) for each in text.split("\n\n")]
    return sha("R" + "".join(sections)), set(pieces)


def alike(one, other):
    whole = sum(n for _, n in one) + sum(n for _, n in other)
    return 2 * sum(n for _, n in one & other) / whole if whole else 1.0


def edited_by_hand(rows):
    """Rows of one id and text are interchangeable."""
    order = sorted(rows, key=lambda each: (each[0] is not None, each[0] or 0), reverse=True)
    for n, each in enumerate(order):
        text, after = each[1] or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        (root, pieces), (root2, pieces2) = tree_by_hand(text), tree_by_hand(edited)
        yield each[0], len(text), sha(edited), root, root2, alike(pieces, pieces2), alike(pieces, tree_by_hand(after)[1])


PAIR = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def test_fingerprints_of_documents_and_their_edits(spark, docs, rows):
    seen = {}
    once = [seen.setdefault(each[0], each) for each in rows if each[0] not in seen]
    for parts in ("2", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = merkle.edited_pairs(spark.createDataFrame(once, SCHEMA).repartition(3))
        assert by_row(found, *PAIR) == sorted(edited_by_hand(once), key=repr)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    # Equal ids and repeated rows: each row once, equal texts with equal fingerprints.
    again = merkle.edited_pairs(docs).collect()
    assert sorted((each["doc_id"], each["fingerprint"]) for each in again if each["doc_id"] is not None) == sorted(
        (each[0], tree_by_hand(each[1] or "")[0]) for each in rows if each[0] is not None
    )
    assert len(again) == len(rows)


def test_fingerprints_of_few_rows(spark):
    assert merkle.edited_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([row(1, "abcd. ef")], SCHEMA)
    assert by_row(merkle.edited_pairs(one), *PAIR) == list(edited_by_hand([row(1, "abcd. ef")]))
    same = spark.createDataFrame([row(None, "same text") for _ in range(5)], SCHEMA)
    found = merkle.edited_pairs(same).collect()
    assert len(found) == 5 and len({each["fingerprint"] for each in found}) == 1 and {each["near_next"] for each in found} == {1.0}
    kept = merkle.fingerprints(spark.createDataFrame([(1, "x", "y")], "doc_id long, text string, pieces string"))
    assert kept.columns == ["doc_id", "text", "fingerprint", "pieces"]


def test_edits_are_located(spark):
    one = "a one. a two.\nb one. b two. b three.\n\nc one.\nd one. d two."
    cases = [
        (one, one, None, None),
        (one, one.replace("b two", "B two"), (0, 1, 1), (0, 1, 1)),
        (one, one.replace("a one", "A one").replace("d two", "D two"), (0, 0, 0), (1, 1, 1)),
        (one, one + "\n\nmore", (2, None, None), (1, 1, 1)),
    ]
    found = spark.createDataFrame([(n, a, b) for n, (a, b, *_) in enumerate(cases)], "n int, a string, b string")
    found = found.select("n", merkle.edits(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("e")).orderBy("n").collect()
    for each, (_, _, first, last) in zip(found[:3], cases):
        assert (each["e"] and tuple(each["e"]["first"])) == first and (each["e"] and tuple(each["e"]["last"])) == last
    assert tuple(found[3]["e"]["first"]) == (2, None, None)


def test_unequal_texts_have_unequal_roots(spark):
    texts = ["", "\n", "\n\n", "\n\n\n", "a", "a\n", "\na", "a ", "a. b", "a.b", "a.\nb", "a.\n\nb", " a"]
    found = merkle.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert found.select("fingerprint").distinct().count() == len(texts)


# --- conversation trie


def trie_by_hand(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own[conv_id].append(((turn is not None, turn or 0, digest), (digest, len((text or "").split()))))
    own = {conv_id: [item for _, item in sorted(items)] for conv_id, items in own.items()}
    members, ends, words = defaultdict(set), defaultdict(list), {}
    for conv_id, items in own.items():
        h = zlib.crc32(str(conv_id).encode()) % 4
        whole = own.get(conv_id - conv_id % 20, [])[:h] + items[h:]
        path = tuple(digest for digest, _ in whole)
        for d in range(len(path) + 1):
            members[path[:d]].add(conv_id)
            words[path[:d]] = whole[d - 1][1] if d else 0
        ends[path].append(conv_id)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[each] for each in children[path]) or 1
        saved[path] = (len(members[path]) - 1) * words[path] + sum(saved[each] for each in children[path])
    return sorted((
        (min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]), len(children[path]),
         leaves[path], saved[path], sha(",".join(map(str, sorted(ends[path])))))
        for path in members
    ), key=repr)


TURNS = "conv_id long, turn int, role string, text string"


def talk(seed, many):
    """Shared beginnings, equal conversations (one very frequent), nulls, repeated rows, equal turns, a long one."""
    rng = random.Random(seed)
    said = ["hello there", "", None, "tell me more", "ok", "ok\tthen  ok", "éa b"]
    rows = []
    for conv_id in range(many):
        if conv_id % 3 == 0:
            rows += [(conv_id, n, role, text) for n, (role, text) in enumerate([("user", "hi you"), ("assistant", "what is it"), ("user", "bye")])]
        else:
            rows += [(conv_id, n, rng.choice(["user", "assistant", None]), rng.choice(said)) for n in range(rng.randrange(1, 7))]
    rows += [(3, 1, "assistant", "what is it"), (7, None, "system", "be kind"), (7, None, None, None), (None, 1, "user", "lost")]
    return rows + [(many + 5, n, "user", f"line {n % 2}") for n in range(700)] + [(many + 6, n, "user", f"line {n % 2}") for n in range(500)]


@pytest.mark.parametrize(("seed", "many", "shards"), [(1, 70, 1), (2, 300, 7), (3, 40, 60)])
def test_trie(spark, seed, many, shards):
    rows = talk(seed, many)
    found = trie.nodes(trie.rebuilt(spark.createDataFrame(rows, TURNS).repartition(5)), Scratch(spark), shards)
    assert by_row(found, *trie.COLUMNS) == trie_by_hand(rows)


def test_trie_with_pieces_of_ids_and_small_skeletons(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 3)
    rows = talk(4, 200)
    paths = trie.rebuilt(spark.createDataFrame(rows, TURNS))
    assert len(trie.splitters(paths, 16)) > 4 > len(trie.splitters(paths, 16, 100))
    for most in (0, 100, 1 << 20):
        assert by_row(trie.nodes(paths, Scratch(spark), 16, most), *trie.COLUMNS) == trie_by_hand(rows)


def test_trie_query(spark, tmp_path):
    rows = talk(5, 60)
    spark.createDataFrame([(*each, "x", 1) for each in rows], TURNS + ", path string, words int").write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op12_conversation_prefix_trie"](spark, str(tmp_path))
    assert found.columns == list(trie.COLUMNS) and by_row(found, *trie.COLUMNS) == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    assert trie.nodes(trie.rebuilt(spark.createDataFrame([], TURNS)), Scratch(spark)).count() == 0
    only = spark.createDataFrame([(19, 1, "user", "a"), (19, 2, "user", "b"), (19, 3, "user", "c")], TURNS)
    assert by_row(trie.nodes(trie.rebuilt(only), Scratch(spark)), *trie.COLUMNS) == trie_by_hand([tuple(each) for each in only.collect()])


def test_plain_conversations(spark):
    rows = [(1, 0, "u", "a b"), (1, 1, "u", "c"), (2, 0, "u", "a b"), (2, 1, "u", "d")]
    found = by_row(trie.nodes(trie.conversations(spark.createDataFrame(rows, TURNS)), Scratch(spark), 2), "conv_id", "depth", "n_convs", "saved_tokens")
    assert found == [(1, 0, 2, 2), (1, 1, 2, 2), (1, 2, 1, 0), (2, 2, 1, 0)]
