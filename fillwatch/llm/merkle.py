"""Fingerprints of documents by Merkle trees over sentences, paragraphs and sections.

A section ends at a blank line, a paragraph at a line's end, and a paragraph is cut after its
sentences, so that a text of one line has more than one leaf. A leaf is the hash of a sentence, a
paragraph that of its leaves, a section that of its paragraphs, the root that of all sections. The
cuts lose nothing, so equal roots mean equal texts, and where two trees differ an edit is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.llm import texts
from fillwatch.session import settled

SECTION, PARAGRAPH, SENTENCE = r"\n\n", r"\n", r"(?<=[.!?]) "


def tree(text: Column) -> Column:
    """Leaf hashes by section, paragraph and place; an empty text has one leaf."""
    return F.transform(
        F.split(text, SECTION, -1),
        lambda section: F.transform(
            F.split(section, PARAGRAPH, -1),
            lambda paragraph: F.transform(F.split(paragraph, SENTENCE, -1), F.md5),
        ),
    )


def paragraph_hash(leaves: Column) -> Column:
    return F.md5(F.array_join(leaves, ""))


def section_hash(section: Column) -> Column:
    return F.md5(F.array_join(F.transform(section, paragraph_hash), ""))


def root(of: Column) -> Column:
    return F.sha2(F.array_join(F.transform(of, section_hash), ""), 256)


def leaves(of: Column) -> Column:
    """The distinct leaves of a tree, as numbers."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(of)), lambda leaf: F.xxhash64(leaf)))


def likeness(a: Column, b: Column) -> Column:
    """Twice the leaves in common by all leaves of both: 1 for equal texts, 0 if none is shared."""
    return 2 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def located(a: Column, b: Column) -> Column:
    """Where tree ``a`` differs from ``b``: section and paragraph numbers in ``a``, from 0.

    Only sections whose hashes differ are gone into. What follows an insertion in a section counts
    as changed up to that section's end.
    """

    def place(section: Column, paragraph: Column) -> Column:
        return F.named_struct(F.lit("section"), section.cast("int"), F.lit("paragraph"), paragraph)

    def paragraphs(section: Column, other: Column, number: Column) -> Column:
        places = F.transform(
            section,
            lambda p, i: F.when(
                ~paragraph_hash(p).eqNullSafe(paragraph_hash(F.get(other, i))), place(number, i)
            ),
        )
        return F.filter(places, lambda found: found.isNotNull())

    none = F.array().cast("array<struct<section:int,paragraph:int>>")
    sections = F.transform(
        a,
        lambda s, i: F.when(
            section_hash(s).eqNullSafe(section_hash(F.get(b, i))), none
        ).otherwise(paragraphs(s, F.get(b, i), i)),
    )
    return F.flatten(sections)


def fingerprints(docs: DataFrame) -> DataFrame:
    """The tree and root of each row's whole text; null counts as empty.

    Columns: ``doc_id``, ``tree``, ``fingerprint``. Only ``doc_id`` and ``text`` are read.
    """
    return docs.select("doc_id", tree(texts.text_or_empty()).alias("tree")).withColumn(
        "fingerprint", root(F.col("tree"))
    )


_KEYS = ["doc_id", "hash"]


def _on(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (
        F.col(f"{left}.hash") == F.col(f"{right}.hash")
    )


def _followers(keys: DataFrame) -> DataFrame:
    """The key after each, in descending order; after the last comes the first.

    Keys are dealt out by range, each range is put in order, and the last of a range is followed
    by the first of the next range that has any: a table of one row for each partition.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]
    ranged = settled(
        keys.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges"
    )
    inside = Window.partitionBy("range").orderBy(*order)
    follower = ranged.withColumns(
        {
            "place": F.row_number().over(inside),
            "after": F.lead(F.struct(*_KEYS, "n_chars")).over(inside),
        }
    )
    firsts = follower.filter("place = 1").select("range", F.struct(*_KEYS, "n_chars").alias("first"))
    every = Window.partitionBy().orderBy("range")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    jumps = firsts.select(
        "range", F.coalesce(F.lead("first").over(every), F.first("first").over(whole)).alias("jump")
    )
    return follower.join(jumps, "range").select(
        *_KEYS, "n_chars", "copies", F.coalesce("after", "jump").alias("after")
    )


def edits(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text and beside the next document.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all) of
    the next document in descending ``doc_id``; after the last comes the first. Null texts count as
    empty; a null ``doc_id`` comes last; documents of one ``doc_id`` follow each other by a hash of
    their texts. Rows alike in ``doc_id`` and text are one document, whose row is returned as
    often. A table of one document is followed by itself; an empty one gives no rows. Only
    ``doc_id`` and ``text`` are read.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``, ``changed`` (the paragraphs in which the edit lies).
    """
    rows = docs.select("doc_id", texts.text_or_empty().alias("text")).withColumn(
        "hash", F.xxhash64("text")
    )
    keys = rows.groupBy("doc_id", "hash", F.length("text").alias("n_chars")).agg(
        F.count("*").alias("copies")
    )
    pairs = settled(_followers(keys), "pairs")
    if not pairs.filter("copies > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "hash", "text"])
    half = F.floor(F.col("n_chars") / 2).cast("int")

    wanted = pairs.select(
        F.col("after.doc_id").alias("doc_id"),
        F.col("after.hash").alias("hash"),
        F.struct(*_KEYS).alias("of"),
        half.alias("half"),
    )
    heads = (
        rows.alias("r")
        .join(wanted.alias("w"), _on("r", "w"))
        .select(
            "of.doc_id",
            "of.hash",
            F.substring("text", F.lit(1), F.col("half")).alias("head"),
            leaves(tree(F.col("text"))).alias("next_leaves"),
        )
    )
    return (
        rows.alias("r")
        .join(pairs.select(*_KEYS, "n_chars", "copies").alias("p"), _on("r", "p"))
        .select("r.doc_id", "r.hash", "text", "n_chars", "copies")
        .alias("c")
        .join(heads.alias("h"), _on("c", "h"))
        .select(
            "c.doc_id",
            F.col("n_chars").cast("long").alias("n_chars"),
            "copies",
            "next_leaves",
            tree(F.col("text")).alias("tree"),
            F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.col("head")).alias("edited"),
        )
        .select("*", tree(F.col("edited")).alias("edited_tree"), leaves(F.col("tree")).alias("leaves"))
        .select(
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            root(F.col("tree")).alias("fingerprint"),
            root(F.col("edited_tree")).alias("edited_fingerprint"),
            likeness(F.col("leaves"), leaves(F.col("edited_tree"))).alias("near_edited"),
            likeness(F.col("leaves"), F.col("next_leaves")).alias("near_next"),
            located(F.col("tree"), F.col("edited_tree")).alias("changed"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )
