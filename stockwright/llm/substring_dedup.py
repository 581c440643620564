"""Exact substring dedup: removes every byte of a string of ``LENGTH`` bytes that also starts earlier in the corpus.

Of every string of ``LENGTH`` bytes the anchor is the least hash among its ``ROUND_TOP`` strings of ``ANCHOR`` bytes, the
leftmost of equals; equal strings have equal anchors at the same place. Neighbouring starts with one anchor form a
stretch: the bytes from its first start to the end of its last string. About one start in 32 begins a stretch.

1. Stretches with equal anchors meet in Spark, sorted by anchor, content, document and start. All but the first of equal
   stretches are repeats as a whole.
2. Where one anchor has stretches of different content, single strings may still be equal. The first stretch of each
   content is cut by where the anchor stands in a string (``PARTS`` parts); the strings of a part have a core in common,
   and stretches with equal cores meet. There the collection is refined column by column: each round takes one more
   symbol of every member, to the right and to the left of the core, and updates the classes of members with equal
   columns so far. A string's class is that of its left and right columns together; all but its first member are repeats.
3. Removed ranges go back to their documents.

Stretches that occur several times in one piece of a task's input are settled there, so text that a third of all
documents share comes to the shuffle once a piece and not once a document. A core with more than ``CORE_ROWS`` members is
not refined in one task: its strings are hashed and meet in Spark, sorted like the stretches. Anchors and contents are
64-bit hashes each, equal together only for equal strings (chance of a mix-up: pairs / 2**128).

Column-wise construction over whole documents would need as many sequential rounds as the longest document has bytes,
each rewriting files as large as the collection; see the README. Here columns are at most ``LENGTH / PARTS``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwright.llm.common import strings, table, text_of
from stockwright.llm.hashing import inverse, mix, powers
from stockwright.llm.idfilter import chosen, id_filter
from stockwright.sources.tables import stage

LENGTH = 100
ROUND_TOP = 64  # a power of two; anchors have LENGTH - ROUND_TOP + 1 bytes
PIECE = 2_000_000  # bytes looked at together
PARTS = 4  # of the anchor's places in a string
CORE_ROWS = 2_000_000  # members of a core that one task refines
REFINED = 100_000  # members refined together, of whole cores
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = inverse(_BASE)

# ``shape`` is the size times ``SHAPE`` plus the anchor's place in the stretch.
SHAPE = 1 << 12
NAMES = ["anchor", "content", "doc", "start", "shape"]
ROW = "kind int, anchor long, content long, doc long, start int, shape int, n_bytes long, sha256 string"
TYPES = [
    ("anchor", pa.int64()),
    ("content", pa.int64()),
    ("doc", pa.int64()),
    ("start", pa.int32()),
    ("shape", pa.int32()),
    ("n_bytes", pa.int64()),
    ("sha256", pa.string()),
]


class _Hashes:
    """Hashes of all byte ranges of a buffer."""

    def __init__(self, buffer: np.ndarray, up: np.ndarray, down: np.ndarray):
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[: len(buffer)], out=self.sums[1:])
        self.down = down

    def of(self, starts, ends) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(_BASE, size + 1), powers(_INVERSE, size + 1)


def _pieces(batches, most: int = PIECE):
    """``ids, texts`` of some million bytes each; a longer text is a piece of its own."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for doc, text in zip(part.column(0).to_pylist(), strings(part.column(1))):
                raw = text.encode("utf-8", "surrogatepass")
                if size + len(raw) > most and ids:
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(raw)
                size += len(raw)
    if ids:
        yield ids, texts


def stretches(ids: list[int], texts: list[bytes], tables, length: int, top: int) -> list[np.ndarray]:
    """Anchor, content, document, start and shape of all stretches of some texts."""
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    long = ends - begins >= length
    if not long.any():
        return [np.empty(0, np.int64)] * 5
    hashes = _Hashes(buffer, *tables)
    width = length - top + 1
    last = len(buffer) - width + 1
    grams = mix((hashes.sums[width:] - hashes.sums[:last]) * hashes.down[:last])
    least, where = grams, np.arange(last, dtype=np.int32)
    shift = 1
    while shift < top:
        right = least[shift:] < least[:-shift]
        where = np.where(right, where[shift:], where[:-shift])
        least = np.minimum(least[shift:], least[:-shift])
        shift *= 2
    # Starts whose whole string lies in one text, and the text.
    sizes = (ends - begins - length + 1)[long]
    doc = np.repeat(np.flatnonzero(long), sizes)
    starts = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[doc]
    place = where[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    until = np.append(first[1:], len(starts)) - 1
    begin, end = starts[first], starts[until] + length
    anchor_at = place[first].astype(np.int64)
    content = hashes.of(begin, end) + mix(((anchor_at - begin) * 1024 + (end - begin)).astype(np.uint64))
    return [
        grams[anchor_at].view(np.int64),
        content.view(np.int64),
        np.array(ids, np.int64)[doc[first]],
        (begin - begins[doc[first]]).astype(np.int32),
        ((end - begin) * SHAPE + anchor_at - begin).astype(np.int32),
    ]


def _firsts(rows: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows sorted by anchor, content, document and start, and for each whether an equal one comes before."""
    order = np.lexsort((rows[3], rows[2], rows[1], rows[0]))
    rows = [c[order] for c in rows]
    later = np.zeros(len(order), bool)
    later[1:] = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
    return rows, later


def _same(rows: list[np.ndarray], later: np.ndarray) -> np.ndarray:
    """Rows equal to the one before also in document and start: a repeated row of a document starts no earlier."""
    same = np.zeros(len(later), bool)
    same[1:] = later[1:] & (rows[2][1:] == rows[2][:-1]) & (rows[3][1:] == rows[3][:-1])
    return same


def _ranges(doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Ranges of documents, merged where they touch."""
    if not len(doc):
        return [doc, start, size]
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order].astype(np.int64), (start + size)[order].astype(np.int64)
    _, group = np.unique(doc, return_inverse=True)
    lift = group.astype(np.int64) << 33
    reach = np.maximum.accumulate(end + lift)
    new = np.ones(len(doc), bool)
    new[1:] = (start + lift)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    until = np.append(first[1:], len(doc)) - 1
    ends = reach[until] - lift[until]
    return [doc[first], start[first].astype(np.int32), (ends - start[first]).astype(np.int32)]


def _rows(kind: int, columns: list, names: list[str]) -> pa.RecordBatch:
    """A batch of one kind of row; columns it has not are null."""
    given = dict(zip(names, columns))
    n = len(columns[0])
    arrays = [pa.array(np.full(n, kind, np.int32))]
    arrays += [pa.array(given[name], t) if name in given else pa.nulls(n, t) for name, t in TYPES]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", *[name for name, _ in TYPES]])


def scan(docs: DataFrame, length: int, top: int) -> DataFrame:
    """``kind`` 0: documents (``doc, n_bytes, sha256`` of the whole text); 1: stretches; 2: removed ranges."""

    def read(batches):
        tables = _tables(PIECE)
        for ids, texts in _pieces(batches):
            total = sum(map(len, texts))
            if total >= len(tables[0]):
                tables = _tables(total)
            whole = [hashlib.sha256(t).hexdigest() for t in texts]
            yield _rows(0, [ids, [len(t) for t in texts], whole], ["doc", "n_bytes", "sha256"])
            rows, later = _firsts(stretches(ids, texts, tables, length, top))
            yield _rows(1, [c[~later] for c in rows], NAMES)
            gone = later & ~_same(rows, later)
            doc, start, size = _ranges(rows[2][gone], rows[3][gone], rows[4][gone] // SHAPE)
            yield _rows(2, [doc, start, size * SHAPE], NAMES[2:])

    return docs.mapInArrow(read, ROW)


def settle(rows: DataFrame) -> DataFrame:
    """Streams stretches (``kind`` 1) by anchor, content, document and start; other rows pass.

    ``kind`` 2: those that an equal one precedes; 3: the first of each content where an anchor has several contents.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, F.coalesce("anchor", "doc")).sortWithinPartitions(*NAMES[:4])

    def read(batches):
        # The first row of the content that the last batch ended in, and whether its anchor has several contents.
        held, known = None, False
        for batch in batches:
            kind = batch.column(0).to_numpy()
            if (kind != 1).any():
                yield batch.take(pa.array(np.flatnonzero(kind != 1)))
                batch = batch.take(pa.array(np.flatnonzero(kind == 1)))
            rows = [batch.column(i).to_numpy() for i in range(1, 6)]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate((np.array([h], c.dtype), c)) for h, c in zip(held, rows)]
            anchor, content, doc, start, _ = rows
            later = np.zeros(len(anchor), bool)
            later[1:] = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
            first = np.flatnonzero(~later)
            group = np.cumsum(~later) - 1
            repeat = later & ((doc != doc[first][group]) | (start != start[first][group]))
            yield _rows(2, [c[repeat] for c in rows], NAMES)
            # Contents of one anchor follow each other; the last one waits for the next batch.
            with_last = np.concatenate(([known], anchor[first][1:] == anchor[first][:-1]))
            several = with_last.copy()
            several[:-1] |= with_last[1:]
            done = first[:-1][several[:-1]]
            yield _rows(3, [c[done] for c in rows], NAMES)
            held, known = [c[first[-1]] for c in rows], bool(with_last[-1])
        if held is not None and known:
            yield _rows(3, [np.array([h]) for h in held], NAMES)

    return ordered.mapInArrow(read, ROW)


def texts_of(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """``doc, text, ranges`` of the documents with ranges; texts that cannot match are not shuffled."""
    spark = docs.sparkSession
    by_doc = stage(ranges.groupBy("doc").agg(F.collect_list(F.struct(*[c for c in ranges.columns if c != "doc"])).alias("ranges")), "ranges")
    shared = spark.sparkContext.broadcast(id_filter(by_doc.select(F.col("doc").alias("id"))))

    def pick(batches):
        for batch in batches:
            yield batch.take(pa.array(chosen(batch.column(0).to_numpy(), shared.value)))

    return docs.mapInArrow(pick, "doc long, text string").join(by_doc, "doc")


def cores(docs: DataFrame, some: DataFrame, length: int, top: int) -> DataFrame:
    """``core, doc, place, low, high, sides``: the parts of stretches that may hold equal strings.

    A part are the strings in which the anchor stands at the places ``p w .. p w + w - 1`` (``w = top / PARTS``). They
    share ``length - w + 1`` bytes from ``place`` on, the core; ``low .. high`` are the numbers of bytes that its strings
    have before the core, ``sides`` the ``w - 1`` bytes before it, nearest first, and the ``w - 1`` after it.
    """
    width = top // PARTS
    held = texts_of(docs, some.select("doc", "start", "shape"))

    def read(batches):
        tables = _tables(PIECE)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = [[] for _ in range(6)]
                for doc, text, ranges in zip(*[batch.slice(at, 64).column(i).to_pylist() for i in range(3)]):
                    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                    if len(raw) >= len(tables[0]):
                        tables = _tables(len(raw))
                    hashes = _Hashes(raw, *tables)
                    start = np.array([r["start"] for r in ranges], np.int64)
                    shape = np.array([r["shape"] for r in ranges], np.int64)
                    inside = start + shape // SHAPE <= len(raw)  # rows of one id may have texts of different length
                    start, shape = start[inside], shape[inside]
                    anchor = start + shape % SHAPE
                    first, last = anchor - start - (shape // SHAPE - length), anchor - start  # places of the anchor
                    framed = np.concatenate((np.zeros(width, np.uint8), raw, np.zeros(width, np.uint8)))
                    for part in range(PARTS):
                        low, high = np.maximum(first - part * width, 0), np.minimum(last - part * width, width - 1)
                        mine = low <= high
                        if not mine.any():
                            continue
                        place = (anchor - part * width)[mine]
                        end = place + length - width + 1
                        before = (place + width - 1)[:, None] - np.arange(width - 1)
                        after = (end + width)[:, None] + np.arange(width - 1)
                        out[0].append((hashes.of(place, end) + np.uint64(part)).view(np.int64))
                        out[1].append(np.full(len(place), doc, np.int64))
                        out[2].append(place.astype(np.int32))
                        out[3].append(low[mine].astype(np.int32))
                        out[4].append(high[mine].astype(np.int32))
                        out[5] += [x.tobytes() for x in framed[np.minimum(np.hstack((before, after)), len(framed) - 1)]]
                if out[0]:
                    columns = [pa.array(np.concatenate(c)) for c in out[:5]]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(out[5], pa.binary())], names=["core", "doc", "place", "low", "high", "sides"]
                    )

    return held.select("doc", "text", "ranges").mapInArrow(
        read, "core long, doc long, place int, low int, high int, sides binary"
    )


def _classes(before: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Numbers of the classes of members that were of one class and have one symbol."""
    return np.unique(before * 256 + symbol, return_inverse=True)[1].astype(np.int64)


def _refined(core, doc, place, low, high, sides, length: int) -> list[np.ndarray]:
    """Document, start and size of the strings that an equal one precedes; members by core, document and place."""
    width = sides.shape[1] // 2 + 1
    left, right = [np.unique(core, return_inverse=True)[1].astype(np.int64)], []
    right.append(left[0])
    for column in range(width - 1):
        left.append(_classes(left[-1], sides[:, column]))
        right.append(_classes(right[-1], sides[:, width - 1 + column]))
    found = [[], [], []]
    for n in range(width):
        valid = np.flatnonzero((low <= n) & (n <= high))
        if len(valid) < 2:
            continue
        both = left[n][valid] * (len(core) + 1) + right[width - 1 - n][valid]
        _, first, of = np.unique(both, return_index=True, return_inverse=True)
        first = valid[first][of]
        gone = valid[(doc[first] != doc[valid]) | (place[first] != place[valid])]
        found[0].append(doc[gone])
        found[1].append((place[gone] - n).astype(np.int32))
        found[2].append(np.full(len(gone), length, np.int32))
    return _ranges(*[np.concatenate(c) if c else np.empty(0, np.int64) for c in found])


def _hashed(core, doc, place, low, high, sides, length: int):
    """The members' strings as stretches of one string each."""
    width = sides.shape[1] // 2 + 1
    for n in range(width):
        valid = (low <= n) & (n <= high)
        used = np.concatenate((np.arange(n), width - 1 + np.arange(width - 1 - n)))
        code = np.full(int(valid.sum()), n + 1, np.uint64)
        for column in used:
            code = mix(code * _BASE + sides[valid, column])
        yield [core[valid], code.view(np.int64), doc[valid], (place[valid] - n).astype(np.int32),
               np.full(int(valid.sum()), length * SHAPE, np.int32)]


def refine(parts: DataFrame, length: int, most: int = CORE_ROWS) -> DataFrame:
    """``kind`` 2: ranges of strings that an equal one precedes; 1: single strings of cores with more than ``most``
    members, to be settled like stretches."""
    count = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = parts.repartition(count, "core").sortWithinPartitions("core", "doc", "place")

    def read(batches):
        held, size, overflow = [], 0, None  # members not yet refined; a core too large, whose members pass

        def matrix(rows):
            sides = np.frombuffer(b"".join(rows[5]), np.uint8)
            return [*rows[:5], sides.reshape(len(rows[0]), -1)]

        def done(rows):
            """Refine whole cores; a core of one member has no equal strings."""
            core = rows[0]
            if not len(core):
                return
            alone = np.ones(len(core), bool)
            alone[1:] &= core[1:] != core[:-1]
            alone[:-1] &= core[1:] != core[:-1]
            rows = [c[~alone] for c in rows]
            if len(rows[0]):
                doc, start, n = _refined(*rows, length)
                yield _rows(2, [doc, start, n * SHAPE], NAMES[2:])

        def joined():
            return [np.concatenate(c) for c in zip(*held)]

        for batch in batches:
            rows = matrix([*[batch.column(i).to_numpy() for i in range(5)], batch.column(5).to_pylist()])
            if overflow is not None:
                over = rows[0] == overflow
                for strings_ in _hashed(*[c[over] for c in rows], length):
                    yield _rows(1, strings_, NAMES)
                rows = [c[~over] for c in rows]
                if not len(rows[0]):
                    continue
                overflow = None
            held.append(rows)
            size += len(rows[0])
            if size < REFINED:
                continue
            rows = joined()
            whole = rows[0] != rows[0][-1]
            yield from done([c[whole] for c in rows])
            rest = [c[~whole] for c in rows]
            held, size = [rest], len(rest[0])
            if size > most:
                overflow = int(rest[0][0])
                for strings_ in _hashed(*rest, length):
                    yield _rows(1, strings_, NAMES)
                held, size = [], 0
        if held:
            yield from done(joined())

    return ordered.mapInArrow(read, ROW)


def settled_ranges(docs: DataFrame, length: int, top: int, most: int = CORE_ROWS) -> tuple[DataFrame, DataFrame]:
    """``doc, n_bytes, sha256`` of all rows, and byte ranges ``doc, start, size`` covered by strings that start earlier;
    ranges may overlap."""
    settled = stage(settle(scan(docs, length, top)), "settled")
    refined = stage(refine(cores(docs, settled.where("kind = 3"), length, top), length, most), "refined")
    again = settle(refined.where("kind = 1")).where("kind = 2")
    size: Column = F.floor(F.col("shape") / SHAPE).cast("int").alias("size")
    ranges = settled.unionByName(refined).unionByName(again).where("kind = 2").select("doc", "start", size)
    return settled.where("kind = 0").select("doc", "n_bytes", "sha256"), ranges


def deduplicated(
    docs: DataFrame, length: int = LENGTH, top: int = ROUND_TOP, with_text: bool = True, most: int = CORE_ROWS
) -> DataFrame:
    """``doc, n_bytes, removed`` (ranges), ``sha256`` of what stays and, on demand, ``kept`` (bytes, null where the whole
    text stays), for every row of ``docs`` (``doc_id, text``)."""
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), text_of(docs).alias("text")
    )
    rows, ranges = settled_ranges(source, length, top, most)
    held = texts_of(source, ranges)
    ranges_type = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))
    names = ["doc", "n_bytes", "removed", "sha256", "kept"][: 4 + with_text]
    types = [pa.int64(), pa.int64(), ranges_type, pa.string(), pa.binary()]

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = [[] for _ in names]
                for doc, text, ranges in zip(*[batch.slice(at, 64).column(i).to_pylist() for i in range(3)]):
                    raw = text.encode("utf-8", "surrogatepass")
                    start = np.array([r["start"] for r in ranges], np.int64)
                    size = np.array([r["size"] for r in ranges], np.int64)
                    inside = start < len(raw)
                    start, size = start[inside], np.minimum(start + size, len(raw))[inside] - start[inside]
                    _, start, size = _ranges(np.zeros(len(start), np.int64), start, size)
                    gone = [{"start": int(a), "size": int(n)} for a, n in zip(start, size)]
                    parts, last = [], 0
                    for r in gone:
                        parts.append(raw[last : r["start"]])
                        last = r["start"] + r["size"]
                    kept = b"".join([*parts, raw[last:]])
                    for column, value in zip(out, (doc, len(raw), gone, hashlib.sha256(kept).hexdigest(), kept)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    span = "array<struct<start:int,size:int>>"
    changed = stage(
        held.select("doc", "text", "ranges").mapInArrow(
            cut, f"doc long, n_bytes long, removed {span}, sha256 string" + ", kept binary" * with_text
        ),
        "changed",
    )
    whole = rows.join(changed.select("doc"), "doc", "left_anti")
    none = [F.array().cast(span).alias("removed"), "sha256", F.lit(None).cast("binary").alias("kept")]
    return changed.unionByName(whole.select("doc", "n_bytes", *none[: 2 + with_text]))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed and kept bytes of every document.

    A null text is empty. Repeated rows of an id start at the same places, so they do not remove each other; removed
    ranges hold for all rows of an id. Null ids are one id before all others (given back as null). No documents give no
    rows.
    """
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda total, r: total + r["size"])
    return out.select(
        F.when(F.col("doc") != -(2**63), F.col("doc")).alias("doc_id"),
        "n_bytes",
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.col("sha256").alias("kept_sha256"),
    )
