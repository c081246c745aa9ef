"""Near-duplicates by a signature-coordinate inverted join.

1. A pass over the texts gives each its shingle set's size, digest and MinHash signature. Texts
   with one digest are one class; from here on a class is a row.
2. Classes are posted under their (coordinate, value) pairs. Two classes whose signatures agree in
   ``least`` of k places share one of the k - least + 1 rarest pairs of either (prefix merging), so
   only those are posted: pairs that come from a passage common to many documents are looked at
   only for documents that hold little else. Pairs that occur once are not posted at all.
3. Inside a posting list the signatures are compared, and members already known to belong together
   are skipped (skip merging). Lists and groups too long for one task are cut into blocks, a task
   for each two blocks. A list gives at most one edge for each member, never its pairs.
4. The groups so found, a superset of the linked ones, are looked at on full shingle sets in the
   same way, and what is confirmed makes the components.

The chance to miss a link at a similarity of exactly 0.8 is that of a binomial (64, 0.8) staying
below 34: under one in two million, and far less above 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.llm import components, shingles, texts
from fillwatch.session import settled

COORDINATES, LEAST = 64, 34
SALTS = 32
#: Members of a posting list, and shingles of a group, that one task holds.
LIST, GROUP = 1 << 14, 1 << 20

_SETS = "doc_id long, n_shingles long, digest binary, tokens array<long>, places binary"
_EDGES = "a long, b long"


def complete_runs(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches, cut so that each table holds whole runs of equal keys, and the runs' bounds."""
    held: pa.Table | None = None

    def bounds(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for key in keys:
            value = table.column(key).to_numpy()
            new[1:] |= value[1:] != value[:-1]
        return np.append(np.flatnonzero(new), table.num_rows)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        cut = bounds(table)
        if len(cut) > 2:
            yield table.slice(0, cut[-2]), cut[:-1]
        held = table.slice(cut[-2]) if len(cut) > 1 else None
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def signatures(docs: DataFrame, width: int, coordinates: int = COORDINATES) -> DataFrame:
    """Size, digest and signature of each text's shingle set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = shingles.factors(coordinates)
        place = np.arange(coordinates, dtype=np.int64) << 32
        for batch in batches:
            data, at = texts.utf8(batch.column("text"))
            n, digests, tokens, places = [], [], [], []
            for low, high in texts.slices(at, shingles.SLICE):
                part = data[at[low] : at[high]]
                for own in shingles.sets_of(part, at[low : high + 1] - at[low], width):
                    n.append(len(own))
                    value = shingles.signature(own, by)
                    digests.append(shingles.digest(own))
                    tokens.append(place | value.astype(np.int64))
                    places.append(value.astype(np.uint8).tobytes())
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array(n, pa.int64()),
                    "digest": pa.array(digests, pa.binary()),
                    "tokens": pa.ListArray.from_arrays(
                        pa.array(np.arange(len(n) + 1) * coordinates, pa.int32()), pa.array(flat)
                    ),
                    "places": pa.array(places, pa.binary()),
                }
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, _SETS)


def _cells(block: Column, blocks: Column) -> Column:
    """The cells of a member: one for each block that its own one is looked at with."""
    return F.explode(
        F.transform(
            F.sequence(F.lit(0), blocks - 1),
            lambda other: F.least(block, other) * blocks + F.greatest(block, other),
        )
    )


def _blocks(total: Column, most: int) -> Column:
    return F.ceil(total / F.lit(most)).cast("int")


def _rough_edges(classes: DataFrame, coordinates: int, least: int) -> DataFrame:
    """Edges between classes whose signatures agree in ``least`` places, enough to join all such."""
    tokens = classes.select("node", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    order = F.array_sort(F.collect_set(F.struct("n", "token")))
    # merge: both sides grow with the documents, so neither is ever sent to all tasks
    posted = (
        tokens.join(shared.hint("merge"), "token")
        .groupBy("node")
        .agg(order.alias("shared"))
        .filter(F.size("shared") >= least)
        .select("node", F.expr(f"slice(shared, 1, size(shared) - {least - 1})").alias("prefix"))
    )
    lists = (
        posted.join(classes.select("node", "places"), "node")
        .select("node", "places", F.explode("prefix").alias("p"))
        .select("node", "places", "p.token", _blocks(F.col("p.n"), LIST).alias("blocks"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("token", _cells(F.col("block"), F.col("blocks")).alias("cell"), "node", "places")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in complete_runs(batches, ["token", "cell"]):
            node = table.column("node").to_numpy()
            flat, _ = texts.bytes_of(table.column("places"))
            places = flat.reshape(len(node), coordinates)
            length = np.diff(cut)
            head = np.repeat(cut[:-1], length)
            linked = (places == places[head]).sum(axis=1) >= least
            whole = np.logical_and.reduceat(linked, cut[:-1])
            star = np.repeat(whole, length) & (np.arange(len(node)) != head)
            a, b = [node[head[star]]], [node[star]]
            for i in np.flatnonzero(~whole):
                low, high = cut[i], cut[i + 1]
                of = shingles.alike(places[low:high], least).of
                a.append(node[low + of])
                b.append(node[low:high])
            a, b = np.concatenate(a), np.concatenate(b)
            edge = np.unique(np.stack([a, b], 1)[a != b], axis=0)
            yield pa.record_batch({"a": pa.array(edge[:, 0]), "b": pa.array(edge[:, 1])})

    # in order of node, lists of the same members give the same edges: to their smallest node
    keys = ["token", "cell"]
    return lists.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(work, _EDGES)


def _confirmed_edges(docs: DataFrame, groups: DataFrame, width: int, part: int, whole: int) -> DataFrame:
    """Edges that join the members of each group which full shingle sets link."""
    total = groups.groupBy("component").agg(F.sum("n_shingles").alias("total"))
    cells = (
        groups.join(total, "component")
        .withColumn("blocks", _blocks(F.col("total"), GROUP))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("component", _cells(F.col("block"), F.col("blocks")).alias("cell"), "node")
    )
    members = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(
        cells.hint("merge"), "node"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in complete_runs(batches, ["component", "cell"]):
            node = table.column("node").to_numpy()
            data, at = texts.utf8(table.column("text"))
            sets: list[np.ndarray] = []
            for low, high in texts.slices(at, shingles.SLICE):
                sets += shingles.sets_of(data[at[low] : at[high]], at[low : high + 1] - at[low], width)
            of = np.arange(len(node))
            for low, high in zip(cut[:-1], cut[1:]):
                of[low:high] = low + shingles.cell_links(sets[low:high], part, whole).of
            linked = node[of] != node
            yield pa.record_batch({"a": pa.array(node[of[linked]]), "b": pa.array(node[linked])})

    return (
        members.repartition("component", "cell")
        .sortWithinPartitions("component", "cell", "node")
        .select("component", "cell", "node", "text")
        .mapInArrow(work, _EDGES)
    )


def find(
    docs: DataFrame,
    width: int = 5,
    part: int = 80,
    whole: int = 100,
    coordinates: int = COORDINATES,
    least: int = LEAST,
) -> DataFrame:
    """The component of near-duplicates of each row of ``docs``.

    Rows are linked if they share part/whole of their distinct shingles of ``width`` words or
    more; A-Z is lower-cased, words are ``texts.WORD_PATTERN``. A text with fewer words is one
    shingle. Null texts and texts without words have none and are linked with nothing. A component
    is named by its smallest ``doc_id``. Rows that share a ``doc_id`` count as one document; rows
    with a null ``doc_id`` are left out of links and get a null component, but never hide another
    row. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` (is it the one that names it).
    """
    rows = settled(signatures(docs, width, coordinates), "signatures").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    )
    filled = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # copies: the smallest doc_id by digest and salt first, so a large group is never in one task
    classes = settled(
        filled.groupBy("digest", "salt")
        .agg(F.min("doc_id").alias("low"))
        .withColumn("node", F.min("low").over(Window.partitionBy("digest")))
        .select("digest", "salt", "node"),
        "classes",
    )
    each = settled(
        filled.join(classes, ["digest", "salt"])
        .filter("doc_id = node")
        .select("node", "digest", "n_shingles", "tokens", "places"),
        "classes",
    )
    rough = components.label(_rough_edges(each, coordinates, least))
    groups = settled(
        rough.join(each.select("node", "n_shingles"), "node").select("node", "component", "n_shingles"),
        "groups",
    )
    linked = components.label(_confirmed_edges(docs, groups, width, part, whole))
    named = classes.join(linked, "node", "left").select(
        "digest", "salt", F.coalesce("component", "node").alias("component_id")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        rows.join(named, ["digest", "salt"], "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_copies(docs: DataFrame, width: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """The rows of ``docs``, with all their columns, that name their component by ``find``.

    Null and empty texts are linked with nothing and stay, and so do rows with a null ``doc_id``.
    Rows that share the ``doc_id`` that stays all stay. An empty table gives no rows. A row is carried
    as one value, so further columns may have any name and type.
    """
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("key")
    kept = find(docs.select("doc_id", "text"), width, part, whole).filter("kept")
    kept = kept.select(key).distinct().hint("merge")
    rows = docs.select(F.struct("*").alias("row"), key)
    return rows.join(kept, "key", "left_semi").select("row.*")
