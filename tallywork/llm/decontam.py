"""Benchmark decontamination: windows of test items, looked up among the word windows of documents.

A window is 10 consecutive words of an item, or all words of a shorter one.
Words are runs of a-z, digits and characters beyond U+007F, after A-Z are
lower-cased. Each position of a document is looked up by the 64-bit hash of its
window in the set of the items' hashes; a hit is verified by the window's whole
text, which is built for hits only. The set is broadcast while it is measured to
be under `BROADCAST_BYTES`; beyond that the same lookup shuffles windows.

Null texts have no words and no hits. Documents with equal doc_id and text have
one verdict, and each of them gets a row. Items without words have no windows;
a null item_id counts as one item and is written as an empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.wording import ascii_lower, computed

WINDOW = 10
BROADCAST_BYTES = 64 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Words in order, by a split at the gaps, which takes a fifth of the time of extracting matches."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD.replace("[^", "[")), "")


def _windows(words: Column, size: int) -> Column:
    """Each `size` consecutive words: where they start, how many, and their text."""
    none = F.array().cast("array<struct<pos:int,size:int,key:string>>")
    each = F.transform(
        F.sequence(F.lit(0), F.size(words) - size),
        lambda pos: F.struct(
            pos.alias("pos"),
            F.lit(size).alias("size"),
            F.array_join(F.slice(words, pos + 1, size), " ").alias("key"),
        ),
    )
    return F.when(F.size(words) >= size, each).otherwise(none)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per distinct window: `key`, its `size` and the ids of the items that hold it."""
    items = computed(items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"),
                     "_words", plain_words(F.col("text")))
    short = F.array(F.struct(F.lit(0).alias("pos"), F.size("_words").alias("size"),
                             F.array_join("_words", " ").alias("key")))
    found = F.when(F.size("_words") >= window, _windows(F.col("_words"), window)).otherwise(short)
    rows = items.filter(F.size("_words") > 0).select("item", F.inline(found))
    return rows.groupBy("key", "size").agg(F.collect_set("item").alias("items"))


def _row_key() -> list[Column]:
    return [F.col("doc_id"), F.xxhash64("text").alias("_hash")]


def _at(words: Column, pos: Column, size: int) -> Column:
    """The hash of the `size` words from `pos` on, without a copy of them."""
    return F.xxhash64(*[F.get(words, pos + n) for n in range(size)])


def _looked_up(docs: DataFrame, known: DataFrame, sizes: list[int], whole: bool) -> DataFrame:
    """Windows of documents that items hold, and one row at position -1 per document.

    `whole`: the items' windows fit into every task. Otherwise windows travel, and with them their texts.
    """
    words, pos, size = F.col("_words"), F.col("pos"), F.col("size")
    # One row per document that is in no window carries its number of words.
    sizes = sizes or [1]
    last = F.greatest(F.lit(-1), F.size("_words") - sizes[0])
    rows = docs.select("*", F.explode(F.sequence(F.lit(-1), last)).alias("pos"))
    rows = rows.select("*", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("size"))
    rows = rows.filter(F.when(pos < 0, size == sizes[0]).otherwise(pos + size <= F.size("_words")))
    rows = rows.withColumn("_window", F.coalesce(*[F.when((pos >= 0) & (size == n), _at(words, pos, n)) for n in sizes]))
    text = F.array_join(F.slice("_words", F.greatest(pos, F.lit(0)) + 1, size), " ")
    if not whole:
        rows, text = rows.withColumn("_text", text).drop("_words"), F.col("_text")
    parts = F.split("key", " ")
    window = F.coalesce(*[F.when(size == n, _at(parts, F.lit(0), n)) for n in sizes])
    known = known.select(window.alias("_window"), size.alias("_size"), "key", "items")
    found = rows.join(F.broadcast(known) if whole else known, "_window", "left")
    return found.filter((pos < 0) | ((F.col("_size") == size) & (F.col("key") == text)))


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: words, hit words, the items found and the hit spans."""
    known = item_windows(items, window)
    # At most `window` sizes and one sum reach the driver.
    facts = known.agg(
        F.collect_set("size").alias("sizes"), F.sum(
            F.octet_length("key") + 64 + F.aggregate("items", F.lit(0), lambda n, item: n + F.octet_length(item) + 16)
        ).alias("bytes")
    ).first()
    docs = computed(docs.select(*_row_key(), "text"), "_words", plain_words(F.col("text"))).drop("text")
    docs = docs.withColumn("n_words", F.size("_words").cast("long"))
    rows = _looked_up(docs, known, sorted(facts["sizes"]), (facts["bytes"] or 0) <= BROADCAST_BYTES)
    hit = F.col("pos") >= 0
    per_doc = rows.groupBy("doc_id", "_hash").agg(
        F.max("n_words").alias("n_words"),
        F.count_if(~hit).alias("_copies"),
        F.sort_array(F.collect_set(F.when(hit, F.struct("pos", (F.col("pos") + F.col("size")).alias("end")))))
        .alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items")))))).alias("item_ids"),
    )
    # Spans come in order of their start; each adds what lies beyond the ones before it.
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda state, span: F.struct(
            F.greatest(state["end"], span["end"]).alias("end"),
            (state["n"] + F.greatest(F.lit(0), span["end"] - F.greatest(state["end"], span["pos"]))).alias("n"),
        ),
        lambda state: state["n"],
    )
    return per_doc.select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")
    ).select(
        "doc_id", "_hash", "n_words", covered.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"), "item_ids", "spans",
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, with all their columns."""
    bad = report(docs, items, window).filter("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("_hash").alias("_bad_hash")
    ).distinct()
    return _rows(docs).join(bad, _same_row(), "left_anti").select("_row.*")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("_row"), F.xxhash64("text").alias("_hash"))


def _same_row() -> Column:
    return F.col("_row.doc_id").eqNullSafe(F.col("_bad_id")) & (F.col("_hash") == F.col("_bad_hash"))


def clean_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents, with hit words and what follows each of them up to the next word taken out."""
    found = report(docs, items, window).filter("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("_hash").alias("_bad_hash"), F.col("spans").alias("_spans")
    ).dropDuplicates(["_bad_id", "_bad_hash"])
    # A piece is a word and the gap after it.
    word = WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    text = F.col("_row.text")
    pieces = F.regexp_extract_all(text, F.lit(f"{word}{gap}"), F.lit(0))
    head = F.regexp_extract(text, f"^{gap}", 0)
    kept = F.filter(
        pieces, lambda piece, n: ~F.exists("_spans", lambda span: (n >= span["pos"]) & (n < span["end"]))
    )
    cut = F.when(F.col("_spans").isNull(), text).otherwise(F.concat(head, F.array_join(kept, "")))
    return _rows(docs).join(found, _same_row(), "left").select(F.col("_row").withField("text", cut).alias("_row")).select(
        "_row.*"
    )
