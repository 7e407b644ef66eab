"""Document fingerprints: a Merkle tree of a text's sections, paragraphs and pieces.

Sections end at a blank line, paragraphs at a line end, and pieces at a sentence
end or after `PIECE` code points. Every cut can be undone, so the tree stands for
the exact text: equal roots are equal texts. A node's digest is the SHA-256 of
its kind and its children's digests. Where two digests are equal the branch below
needs no look; where they differ its children tell which paragraph, and which
piece of it, was edited.

The likeness of two trees is the share of code points in pieces that both have,
of both texts' distinct pieces; 1 for two texts without pieces. All is column
expressions. A null text is an empty one: a root over one empty paragraph.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.wording import computed, let

PIECE = 100
SECTION_END, PARAGRAPH_END = "\n\n", "\n"
#: Up to a sentence end and the blanks after it, if it is near; else a run of PIECE code points.
PIECES = rf"[^.!?]{{0,{PIECE - 1}}}+[.!?]+[ \t]*|[^.!?]{{1,{PIECE}}}"
PARTS = 16  # windows for each shuffle partition, so that they spread evenly


def _digest(kind: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), F.array_join(children, "")).cast("binary"), 256)


def tree(text: Column) -> Column:
    """A struct: `root`, and the `sections`, each with its digest and paragraphs, each with its digest and pieces.

    A piece is its digest and its number of code points.
    """
    def piece(part: Column) -> Column:
        return F.struct(F.sha2(F.concat(F.lit("W"), part).cast("binary"), 256).alias("digest"), F.char_length(part).cast("long").alias("n"))

    def node(kind: str, children: Column, name: str) -> Column:
        return F.struct(_digest(kind, children["digest"]).alias("digest"), children.alias(name))

    def paragraph(part: Column) -> Column:
        return let(F.transform(F.regexp_extract_all(part, F.lit(PIECES), F.lit(0)), piece), lambda found: node("P", found, "pieces"))

    def section(part: Column) -> Column:
        found = F.transform(F.split(part, PARAGRAPH_END, -1), paragraph)
        return let(found, lambda paragraphs: node("S", paragraphs, "paragraphs"))

    whole = F.transform(F.split(F.coalesce(text, F.lit("")), SECTION_END, -1), section)
    return let(whole, lambda sections: F.struct(_digest("R", sections["digest"]).alias("root"), sections.alias("sections")))


def pieces(found: Column) -> Column:
    """The distinct pieces of a tree, each as its digest and its number of code points in one string."""
    def keys(paragraph: Column) -> Column:
        return F.transform(paragraph["pieces"], lambda each: F.concat(each["digest"], F.lit(":"), each["n"].cast("string")))

    def section(each: Column) -> Column:
        return F.flatten(F.transform(each["paragraphs"], keys))

    return F.array_distinct(F.flatten(F.transform(found["sections"], section)))


def weight(keys: Column) -> Column:
    """The code points of pieces."""
    return F.aggregate(keys, F.lit(0).cast("long"), lambda total, key: total + F.substring(key, 66, 20).cast("long"))


def likeness(one: Column, other: Column) -> Column:
    """Of `pieces` of two trees."""
    whole = weight(one) + weight(other)
    return F.when(whole == 0, F.lit(1.0)).otherwise(2 * weight(F.array_intersect(one, other)).cast("double") / whole)


def _branch(one: Column, other: Column, last: bool) -> Column:
    """The first or last place where the children differ, and the child that either tree has there."""
    left, right = (F.reverse(one), F.reverse(other)) if last else (one, other)
    same = F.zip_with(left["digest"], right["digest"], lambda a, b: F.coalesce(a == b, F.lit(False)))

    def found(at: Column) -> Column:
        number = F.size(one) - 1 - at if last else at
        return F.struct(number.alias("number"), F.get(left, at).alias("one"), F.get(right, at).alias("other"))

    return let(F.nullif(F.array_position(same, F.lit(False)), F.lit(0).cast("long")).cast("int") - 1, found)


def _place(one: Column, other: Column, last: bool) -> Column:
    """From the root down the differing branches: numbers of section, paragraph and piece, from zero."""
    def in_section(section: Column) -> Column:
        found = _branch(section["one"]["paragraphs"], section["other"]["paragraphs"], last)
        return let(found, lambda paragraph: in_paragraph(section, paragraph))

    def in_paragraph(section: Column, paragraph: Column) -> Column:
        piece = _branch(paragraph["one"]["pieces"], paragraph["other"]["pieces"], last)
        return F.struct(section["number"].alias("section"), paragraph["number"].alias("paragraph"), piece["number"].alias("piece"))

    return let(_branch(one["sections"], other["sections"], last), in_section)


def edits(one: Column, other: Column) -> Column:
    """Where tree `one` has edits that make it unlike tree `other`: the `first` and `last` place that differ.

    Only branches with unequal digests are entered, from the front and from the
    back, so time is linear in the children along two paths. Null for equal roots.
    A number is null below a child that one tree lacks; where text was only left
    out, `last` may come before `first`.
    """
    found = F.struct(_place(one, other, False).alias("first"), _place(one, other, True).alias("last"))
    return F.when(one["root"] != other["root"], found)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with `fingerprint`, the root, and `pieces`."""
    own = [name for name in docs.columns if name not in ("fingerprint", "pieces")]
    rows = computed(docs.select(F.struct(*own, F.col(text).alias("_text")).alias("_row")), "_tree", tree(F.col("_row._text")))
    return rows.select(*[F.col(f"_row.{name}") for name in own], F.col("_tree.root").alias("fingerprint"), pieces(F.col("_tree")).alias("pieces"))


_KEY = "struct<known:boolean,id:bigint,hash:bigint>"


def with_next(docs: DataFrame, values: dict[str, Column]) -> DataFrame:
    """The documents, each with `values` of the next one in descending order of doc_id; after the last comes the first.

    Null ids come last; equal ids are ordered by a hash of the text, and rows
    equal in both in any order. Rows are dealt to windows by ranges of that key,
    found by a sort of the keys alone. The first row of a range is also put at
    the end of the range before, so that no window needs another one.
    """
    spark = docs.sparkSession
    key = F.struct(
        F.col("doc_id").isNotNull().alias("known"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"),
        F.xxhash64("text").alias("hash"),
    )
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = docs.select(key.alias("key")).repartitionByRange(parts, F.col("key").desc())
    found = ranges.groupBy(F.spark_partition_id()).agg(F.max("key").alias("head")).collect()
    heads = sorted({tuple(row["head"]) for row in found}, reverse=True)  # one for each range
    places = F.from_json(F.lit(json.dumps([dict(zip(("known", "id", "hash"), head)) for head in heads])), f"array<{_KEY}>")

    # Binary search for the last head that is not below the key.
    def step(at: Column, width: Column) -> Column:
        ahead = at + width
        return F.when((ahead < len(heads)) & (F.get(places, ahead) >= F.col("_key")), ahead).otherwise(at)

    widths = [1 << n for n in reversed(range(max(1, len(heads).bit_length())))]
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"))
    at = F.aggregate(F.array(*map(F.lit, widths)), F.lit(0), step)
    rows = rows.withColumn("_part", at if heads else F.lit(0))
    own = F.struct(F.col("_part").alias("part"), F.lit(False).alias("extra"))
    before = F.struct(F.pmod(F.col("_part") - 1, F.lit(max(1, len(heads)))).alias("part"), F.lit(True).alias("extra"))
    is_head = F.get(places, F.col("_part")) == F.col("_key") if heads else F.lit(False)
    rows = rows.select("_row", "_key", F.explode(F.when(is_head, F.array(own, before)).otherwise(F.array(own))).alias("_at"))
    window = Window.partitionBy("_at.part").orderBy(F.col("_at.extra"), F.col("_key").desc())
    following = F.lead(F.struct(*[value.alias(name) for name, value in values.items()])).over(window)
    return rows.withColumn("_next", following).filter("NOT _at.extra").select("_row.*", *[F.col(f"_next.{name}").alias(name) for name in values])


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Every document beside its edited text and the next document: both fingerprints, likenesses, and the place of the edits.

    The edited text has the last half of its code points replaced by the first
    as many of the next document, or by all that it has.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows, {"next_text": F.col("_row.text")})
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("next_text", F.lit(1), half))
    rows = computed(rows.select("doc_id", n.alias("n_chars"), "text", edited.alias("edited"), "next_text"), "_trees", F.transform(
        F.array("text", "edited", "next_text"), tree
    )).drop("text", "next_text")
    rows = computed(rows, "_pieces", F.transform("_trees", pieces))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("_trees")[0]["root"].alias("fingerprint"), F.col("_trees")[1]["root"].alias("edited_fingerprint"),
        likeness(F.col("_pieces")[0], F.col("_pieces")[1]).alias("near_edited"),
        likeness(F.col("_pieces")[0], F.col("_pieces")[2]).alias("near_next"),
        edits(F.col("_trees")[0], F.col("_trees")[1]).alias("edits"),
    )
