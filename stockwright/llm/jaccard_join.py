"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Rows are distinct n-gram sets (equal sets are one row, named by its smallest document id); columns are n-grams. Two rows
link when their Jaccard similarity reaches ``at_least`` percent. The product is kept sparse by bounds on sizes:

* Columns have one order over the corpus, rare before frequent. With ``n`` columns, a row that links shares one of its
  first ``n - ceil(s n) + 1``, so only these prefixes enter the product.
* Rows lie in blocks by size; sizes further apart than the similarity allows never meet.
* A pair whose first common column leaves too few columns for the needed overlap is dropped.
* So is a pair whose accumulated overlap in the prefixes, with all columns after them, stays below the needed overlap.

Frequencies for the order come from a count sketch of fixed size (any one order gives the same links). Columns held by
one row only are dropped while streaming the sorted incidence. First every row is held against two rows of its column
and block, those with the largest accumulated overlap; what links is merged to components. After this round all
remaining pairs of different components are made, so no link is lost, while rows that are already connected, such as
thousands of near copies of one text, make no further pairs. Every pair is verified on the whole sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwright.llm.common import slices, strings, table, text_of, white_table
from stockwright.llm.components import components
from stockwright.llm.hashing import mix, shingles, word_hashes
from stockwright.llm.idfilter import chosen, id_filter
from stockwright.sources.tables import stage

WIDTH = 4  # words of an n-gram
AT_LEAST = 85  # percent
SKETCH = 1 << 20  # counters of the frequency sketch
CHUNK = 1 << 14  # counters that travel together


def gram_sets(texts: list[str], width: int):
    """The sorted n-gram hashes of each text."""
    to_words = white_table()
    for text in texts:
        yield shingles(word_hashes(text.encode("utf-8", "surrogatepass").translate(to_words)), width)


def _signature(grams: np.ndarray) -> int:
    """A hash of the set."""
    return int(np.bitwise_xor.reduce(mix(grams + np.uint64(7))).astype(np.int64)) if len(grams) else 0


def sizes(docs: DataFrame, width: int) -> DataFrame:
    """``kind = 0``: ``doc_id, signature, n`` of every row; ``kind = 1``: sketch counters (``chunk, counts``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        sketch = np.zeros(SKETCH, np.uint32)
        id_type = None
        for batch in slices(batches):
            id_type = batch.schema.field(0).type
            signatures, counts = [], []
            for grams in gram_sets(strings(batch.column(1)), width):
                _count(sketch, grams)
                signatures.append(_signature(grams))
                counts.append(len(grams))
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(n, np.int32)),
                    batch.column(0),
                    pa.array(signatures, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ],
                names=["kind", "doc_id", "signature", "n", "chunk", "counts"],
            )
        if id_type is not None:
            for chunk in range(SKETCH // CHUNK):
                part = sketch[chunk * CHUNK : (chunk + 1) * CHUNK]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([1], pa.int32()),
                            pa.nulls(1, id_type),
                            pa.nulls(1, pa.int64()),
                            pa.nulls(1, pa.int64()),
                            pa.array([chunk], pa.int32()),
                            pa.array([part.tobytes()], pa.binary()),
                        ],
                        names=["kind", "doc_id", "signature", "n", "chunk", "counts"],
                    )

    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(
        scan, f"kind int, doc_id {kind}, signature long, n long, chunk int, counts binary"
    )


def _count(sketch: np.ndarray, grams: np.ndarray) -> None:
    at, n = np.unique(grams & np.uint64(SKETCH - 1), return_counts=True)
    sketch[at] += n.astype(np.uint32)


def summed_sketch(scanned: DataFrame) -> np.ndarray:
    """The tasks' sketches summed by chunk in Spark; its fixed size (8 MB) is what the driver gets."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(counts, np.uint32).astype(np.uint64)
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                names=["chunk", "counts"],
            )

    chunks = scanned.where("kind = 1").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    out = np.zeros(SKETCH, np.uint64)
    for row in chunks.collect():
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], np.uint64)
    return out


def incidence(docs: DataFrame, sketch: np.ndarray, width: int, at_least: int) -> DataFrame:
    """``gram, signature, n, place``: the prefix columns of every distinct row, several times at most once a batch."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(sketch, np.uint64(2**32 - 1)).astype(np.uint32))

    def emit(batches):
        frequency = shared.value
        for batch in slices(batches, 4096):
            seen, columns = set(), [[], [], [], []]
            for grams in gram_sets(strings(batch.column(0)), width):
                n = len(grams)
                signature = _signature(grams)
                if n == 0 or (signature, n) in seen:
                    continue
                seen.add((signature, n))
                count = n - -(-at_least * n // 100) + 1
                rare = frequency[grams & np.uint64(SKETCH - 1)]
                if count < n:
                    first = np.lexsort((grams, rare))[:count]
                else:
                    first = np.lexsort((grams, rare))
                columns[0].append(grams[first].view(np.int64))
                columns[1].append(np.full(len(first), signature, np.int64))
                columns[2].append(np.full(len(first), n, np.int32))
                columns[3].append(np.arange(len(first), dtype=np.int32))
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in columns], names=["gram", "signature", "n", "place"]
                )

    return docs.select(text_of(docs).alias("text")).mapInArrow(emit, "gram long, signature long, n int, place int")


def shared_columns(rows: DataFrame) -> DataFrame:
    """Incidence of the columns that two rows or more hold, streamed from the rows sorted by column."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, "gram").sortWithinPartitions("gram", "n", "signature")

    def keep(batches):
        held, held_shared, names = None, False, None  # the last row so far; whether the row before it has its column
        for batch in batches:
            names = batch.schema.names
            part = [c.to_numpy() for c in batch.columns]
            if held is not None:
                part = [np.concatenate((h, c)) for h, c in zip(held, part)]
            if not len(part[0]):
                continue
            new = np.ones(len(part[0]), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in part[:3]], axis=0)
            part = [c[new] for c in part]
            with_last = np.concatenate(([held_shared], part[0][1:] == part[0][:-1]))
            shared = with_last.copy()
            shared[:-1] |= with_last[1:]
            yield pa.RecordBatch.from_arrays([pa.array(c[:-1][shared[:-1]]) for c in part], names=names)
            held, held_shared = [c[-1:] for c in part], bool(with_last[-1])
        if held is not None and held_shared:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=names)

    return ordered.mapInArrow(keep, "gram long, signature long, n int, place int")


def _links_possible(at_least: int) -> Column:
    """Whether two rows whose first common column has these places can overlap enough: of ``x`` and ``y`` rows,
    100 i >= p (x + y - i)."""
    room = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    return (100 + at_least) * room.cast("long") >= at_least * (F.col("n") + F.col("n2")).cast("long")


def hub_pairs(rows: DataFrame, at_least: int) -> DataFrame:
    """``a, b``: every row and the row of its columns and size block with which it shares the most prefix columns,
    of the rows that are first and last in their column and block."""
    picked = rows.groupBy("gram", "block").agg(
        F.min(F.struct("row", "n", "place")).alias("low"), F.max(F.struct("row", "n", "place")).alias("high")
    )
    met = rows.join(picked, ["gram", "block"])
    hubs = met.select("row", "n", "place", F.explode(F.array("low", "high")).alias("hub")).select(
        "row", "n", "place", F.col("hub.row").alias("row2"), F.col("hub.n").alias("n2"), F.col("hub.place").alias("place2"),
        (F.col("hub.row") < F.col("row")).alias("down"),
    )
    hubs = hubs.where((F.col("row") != F.col("row2")) & _links_possible(at_least))
    overlap = hubs.groupBy("row", "row2", "down").agg(F.count("*").alias("common"))
    best = overlap.groupBy("row", "down").agg(F.max_by("row2", F.struct("common", "row2")).alias("row2"))
    return best.select(F.greatest("row", "row2").alias("a"), F.least("row", "row2").alias("b")).distinct()


def open_pairs(rows: DataFrame, at_least: int) -> DataFrame:
    """``a, b``: all pairs of rows with a common column, of different ``label`` and possible by their bounds.

    Columns whose rows all have one label make none. A row of a block meets its own block and the next one.
    """
    mixed = rows.groupBy("gram").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1")
    rows = rows.join(mixed.select("gram"), "gram", "left_semi")
    left = rows.select("gram", "block", "row", "n", "place", "label")
    right = rows.select(
        "gram",
        F.explode(F.array(F.col("block"), F.col("block") - 1)).alias("block"),
        F.col("row").alias("row2"),
        F.col("n").alias("n2"),
        F.col("place").alias("place2"),
        F.col("label").alias("label2"),
    )
    ordered = (F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("row") < F.col("row2")))
    met = left.join(right, ["gram", "block"]).where(
        ordered & (F.col("label") != F.col("label2")) & _links_possible(at_least)
    )
    return met.select(F.greatest("row", "row2").alias("a"), F.least("row", "row2").alias("b")).distinct()


def promising(pairs: DataFrame, rows: DataFrame, at_least: int) -> DataFrame:
    """The pairs whose accumulated overlap can still reach the similarity.

    Of two rows, let that be the first whose prefix ends first in the order of the columns: all common columns up to
    there lie in both prefixes and are counted, the first row has ``ceil(s n) - 1`` columns after it. The larger of both
    rests bounds the overlap whichever it is.
    """
    mine = rows.select(F.col("row").alias("a"), "gram", F.col("n").alias("n1"))
    other = rows.select(F.col("row").alias("b"), "gram", F.col("n").alias("n2"))
    common = pairs.join(mine, "a").join(other, ["b", "gram"]).groupBy("a", "b").agg(
        F.count("*").alias("common"), F.first("n1").alias("n1"), F.first("n2").alias("n2")
    )
    longer = F.greatest("n1", "n2").cast("long")
    rest = F.floor((at_least * longer + 99) / 100) - 1
    total = (F.col("n1") + F.col("n2")).cast("long")
    return common.where((100 + at_least) * (F.col("common") + rest) >= at_least * total).select("a", "b")


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, width: int, at_least: int) -> DataFrame:
    """``a, b`` of the pairs whose whole sets link.

    The texts of the rows in question meet, as they are smaller than their sets, and the sets are made anew. Of several
    rows of an id only one with the class's set counts.
    """
    pairs = stage(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(ids))

    def pick(batches):
        for batch in batches:
            yield batch.take(pa.array(chosen(batch.column(0).to_numpy(), shared.value)))

    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("row"), text_of(docs).alias("text"))
    texts = stage(source.mapInArrow(pick, "row long, text string"), "texts")

    def overlap(batches):
        for batch in slices(batches):
            x, y = (gram_sets(strings(batch.column(i)), width) for i in (4, 5))
            keep = []
            for g, h, s, t in zip(x, y, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                both = len(np.intersect1d(g, h, assume_unique=True))
                enough = 100 * both >= at_least * (len(g) + len(h) - both)
                keep.append(enough and _signature(g) == s and _signature(h) == t)
            linked = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([c.take(linked) for c in batch.columns[:2]], names=["a", "b"])

    signed = classes.select("row", "signature")
    for side, sign, text in (("a", "s", "x"), ("b", "t", "y")):
        pairs = pairs.join(signed.withColumnsRenamed({"row": side, "signature": sign}), side)
        pairs = pairs.join(texts.withColumnsRenamed({"row": side, "text": text}), side)
    met = pairs.select("a", "b", "s", "t", "x", "y").mapInArrow(overlap, "a long, b long")
    return stage(met.distinct(), "linked")


def link_components(docs: DataFrame, width: int = WIDTH, at_least: int = AT_LEAST) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id, text``)."""
    scanned = stage(sizes(docs, width), "sets")
    rows = scanned.where("kind = 0").select("doc_id", "signature", "n")
    classes = stage(
        rows.where("n > 0 and doc_id is not null")
        .groupBy("signature", "n")
        .agg(F.min(F.col("doc_id").cast("long")).alias("row")),
        "classes",
    )
    held = stage(shared_columns(incidence(docs, summed_sketch(scanned), width, at_least)), "columns")
    block = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / at_least) + 1e-9).cast("int")
    held = held.join(classes.withColumn("n", F.col("n").cast("int")), ["signature", "n"]).select(
        "gram", "row", "n", "place", block.alias("block")
    )
    held = stage(held, "columns")
    links = verified(docs, promising(hub_pairs(held, at_least), held, at_least), classes, width, at_least)
    found = components(links)
    labelled = held.join(found.withColumnRenamed("node", "row"), "row", "left").withColumn(
        "label", F.coalesce("component", "row")
    )
    left = open_pairs(stage(labelled, "columns"), at_least)
    rest = verified(docs, promising(left, held, at_least), classes, width, at_least)
    found = stage(components(links.unionByName(rest)), "components")
    named = classes.join(found.withColumnRenamed("node", "row"), "row", "left").select(
        "signature", "n", F.coalesce("component", "row").alias("component_id")
    )
    own = F.col("doc_id").cast("long")
    return rows.join(named, ["signature", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", own).alias("component_id")
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document.

    A null or empty text has an empty set and links with nothing. Repeated rows come back each; rows of one id with
    different texts are judged by their texts. A null id takes the component of an equal set, else null. No documents
    give no rows.
    """
    return link_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with one row of each component, one of the smallest id (a row without an id only where there is none).

    Links are those of five-word shingles with a similarity of 0.8 or more. Rows are judged by their own texts: of rows that
    share an id those with other texts stay, repeated rows are copies. Rows without a word link with nothing and stay, of
    repeated ones one. No documents give no rows.
    """
    rows = docs.select(F.struct("*").alias("doc")).withColumn("id", F.col("doc.doc_id").cast("long"))
    repeated = rows.where("id IS NOT NULL").groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("again"))
    repeated = stage(repeated, "repeated")
    # A row goes by its id, unless others share it; such rows get numbers above all ids by a hash of id and text, and so do
    # all where there is no room above. Nothing of the texts is written for that.
    most = rows.agg(F.max("id")).first()[0] or 0
    alone = F.col("id").isNotNull() & F.col("again").isNull() & F.lit(most < 1 << 61)
    above = F.xxhash64("id", "doc.text").bitwiseAND((1 << 61) - 1) + F.lit(max(most, 0) + 1 if most < 1 << 61 else 0)
    keyed = rows.join(repeated, "id", "left").withColumn("alone", alone)
    keyed = keyed.select("doc", "alone", F.when(F.col("alone"), F.col("id")).otherwise(above).alias("key"))
    texts = keyed.select(F.col("key").alias("doc_id"), F.col("doc.text").cast("string").alias("text"))
    found = link_components(texts, width=5, at_least=80).select(F.col("doc_id").alias("key"), "component_id")
    found = stage(found.distinct(), "found")
    order = F.struct(F.col("doc.doc_id").isNull(), "doc.doc_id", "key")
    placed = keyed.select("key", order.alias("order")).distinct().join(found, "key")
    stays = placed.groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first.key").alias("key"))
    gone = stage(found.select("key").join(stays, "key", "left_anti"), "copies")
    left = keyed.join(gone, "key", "left_anti")
    once = left.where(~F.col("alone")).dropDuplicates(["key"])
    return left.where("alone").unionByName(once).select("doc.*")
