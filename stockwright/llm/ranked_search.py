"""Ranked lexical search: Block-Max MaxScore over a sharded inverted index.

Index. A task cuts its documents into shards of bounded size. A shard has a row of its own with ids and lengths of its
documents, and a row per term: its postings in blocks of 128, delta-coded and packed in bytes, with each block's last document,
greatest frequency and least length kept apart. The index holds every term of every document and knows nothing of
corpus statistics; those are sums over its rows.

Search. Only the lists of asked terms go to the tasks, in packed form, a shard to one task. For each item the task
takes the lists by falling upper bound. While the lists that are left could still lift an unseen document to the item's threshold,
the next list is essential: it is read as a whole. After that the remaining lists only complete candidates: the bound of
the block that a candidate would lie in is added to its partial score, and a candidate that cannot reach the threshold
goes before the block is unpacked. Thresholds rise with the heaps of earlier shards of the task; at the end the heaps
of all tasks are merged per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockwright.llm.common import share, slices, strings, table, text_of, word_table
from stockwright.llm.hashing import placed_words
from stockwright.sources.tables import new_folder, stage

BLOCK = 128  # postings of a block
SHARD_WORDS = 1_500_000  # a shard is closed when it has more
SHARD_DOCS = 65_536
CHUNK = 1 << 20  # bytes of text hashed at once
TOP = 10
MOST_TERMS = 500_000  # terms of the items that are searched together; more items are searched group by group

INDEX = (
    "shard long, term long, n_docs long, n_words long, ids binary, lengths binary, "
    "last binary, most_tf binary, least_n binary, ends binary, packed binary"
)


def hashed_terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and 64-bit hash of every word occurrence of ``texts``."""
    table_ = word_table()
    owners, hashes = [], []
    flat, ends, first, size = [], [], 0, 0

    def flush():
        starts, words = placed_words(b" ".join(flat))
        owners.append(np.searchsorted(np.array(ends), starts, side="right") + first)
        hashes.append(words)

    for k, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass").translate(table_)
        flat.append(raw)
        size += len(raw) + 1
        ends.append(size)
        if size >= CHUNK:
            flush()
            flat, ends, first, size = [], [], k + 1, 0
    if flat:
        flush()
    if not owners:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(owners), np.concatenate(hashes).view(np.int64)


# Packed numbers: seven bits a byte, the highest bit of a byte says that more follow.


def pack(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bytes of all ``values`` (not negative) and the end of each one's bytes."""
    sizes = np.ones(len(values), np.int64)
    rest = values >> 7
    while rest.any():
        sizes += rest > 0
        rest >>= 7
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - sizes
    for i in range(int(sizes.max(initial=0))):
        has = sizes > i
        part = (values[has] >> (7 * i)) & 127
        out[starts[has] + i] = part | np.where(sizes[has] > i + 1, 128, 0)
    return out.tobytes(), ends


def unpack(data: np.ndarray) -> np.ndarray:
    """The numbers of packed bytes."""
    last = np.flatnonzero(data < 128)
    if not len(last):
        return np.empty(0, np.int64)
    starts = np.concatenate(([0], last[:-1] + 1))
    place = np.arange(len(data)) - np.repeat(starts, last - starts + 1)
    parts = (data & 127).astype(np.int64) << (7 * place)
    return np.add.reduceat(parts, starts)


def index_shard(shard: int, ids: list[int], texts: list[str]) -> Iterator[dict]:
    """Rows of one shard: first the one of its documents, then one per term."""
    owners, terms = hashed_terms(texts)
    lengths = np.bincount(owners, minlength=len(ids)).astype(np.int64)
    empty = {name: None for name in ("ids", "lengths", "last", "most_tf", "least_n", "ends", "packed")}
    yield empty | {
        "shard": shard,
        "term": None,
        "n_docs": int((lengths > 0).sum()),
        "n_words": len(terms),
        "ids": np.array(ids, np.int64).tobytes(),
        "lengths": lengths.tobytes(),
    }
    if not len(terms):
        return
    # Postings by term and document, with the number of equal occurrences.
    order = np.lexsort((owners, terms))
    terms, owners = terms[order], owners[order]
    change = np.concatenate(([True], (terms[1:] != terms[:-1]) | (owners[1:] != owners[:-1])))
    at = np.flatnonzero(change)
    tf = np.diff(np.concatenate((at, [len(terms)])))
    terms, docs = terms[at], owners[at]
    list_start = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
    list_size = np.diff(np.concatenate((list_start, [len(terms)])))
    # Blocks: every 128th posting of a list starts one. Documents are stored as steps from the one before in the list.
    place = np.arange(len(terms)) - np.repeat(list_start, list_size)
    steps = np.where(place == 0, docs + 1, docs - np.concatenate(([0], docs[:-1])))
    pairs = np.empty(2 * len(terms), np.int64)
    pairs[::2], pairs[1::2] = steps, tf
    packed, ends = pack(pairs)
    block_start = np.flatnonzero(place % BLOCK == 0)
    block_end = np.concatenate((block_start[1:], [len(terms)]))
    block_last = docs[block_end - 1]
    block_tf = np.maximum.reduceat(tf, block_start)
    block_n = np.minimum.reduceat(lengths[docs], block_start)
    byte_end = ends[2 * block_end - 1]
    first_block = np.searchsorted(block_start, list_start)
    last_block = np.concatenate((first_block[1:], [len(block_start)]))
    for k, (start, size) in enumerate(zip(list_start, list_size)):
        a, b = first_block[k], last_block[k]
        begin = int(byte_end[a - 1]) if a else 0
        yield empty | {
            "shard": shard,
            "term": int(terms[start]),
            "n_docs": int(size),
            "n_words": None,
            "last": block_last[a:b].astype(np.int32).tobytes(),
            "most_tf": block_tf[a:b].astype(np.int64).tobytes(),
            "least_n": block_n[a:b].astype(np.int64).tobytes(),
            "ends": (byte_end[a:b] - begin).astype(np.int32).tobytes(),
            "packed": packed[begin : int(byte_end[b - 1])],
        }


def index(docs: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """The index of all rows, written to the shared folder. A null id is kept as the smallest long."""
    schema = pa.schema(
        [("shard", pa.int64()), ("term", pa.int64()), ("n_docs", pa.int64()), ("n_words", pa.int64())]
        + [(c, pa.binary()) for c in ("ids", "lengths", "last", "most_tf", "least_n", "ends", "packed")]
    )

    def build(batches):
        base = TaskContext.get().partitionId() << 32
        count, ids, texts, size = 0, [], [], 0

        def rows():
            pending = []
            for row in index_shard(base + count, ids, texts):
                pending.append(row)
                if len(pending) == 4096:
                    yield pa.RecordBatch.from_pylist(pending, schema)
                    pending = []
            if pending:
                yield pa.RecordBatch.from_pylist(pending, schema)

        for batch in slices(batches):
            for doc, body in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                ids.append(doc)
                texts.append(body)
                size += len(body) // 5 + 1
                if size >= SHARD_WORDS or len(ids) >= SHARD_DOCS:
                    yield from rows()
                    count, ids, texts, size = count + 1, [], [], 0
        if ids:
            yield from rows()

    named = docs.select(F.coalesce(doc_id.cast("long"), F.lit(NULL_ID)).alias("doc_id"), text.alias("text"))
    return stage(named.mapInArrow(build, INDEX), "index")


NULL_ID = -(2**63)


def asked_terms(items: DataFrame) -> DataFrame:
    """``item, term`` of all items, each term once; ``items`` has ``item`` (a row number) and ``text``."""

    def read(batches):
        for batch in slices(batches):
            owners, terms = hashed_terms(strings(batch.column(1)))
            pairs = np.unique(np.stack((owners, terms), 1), axis=0) if len(owners) else np.empty((0, 2), np.int64)
            numbers = np.array(batch.column(0).to_pylist(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[pairs[:, 0]], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["item", "term"]
            )

    return items.select("item", "text").mapInArrow(read, "item long, term long")


class Scorer:
    """Items with weighted terms, and the length measure of the corpus."""

    def __init__(self, rows: list[tuple[int, int, int]], n_docs: int, n_words: int):
        self.n_docs, self.n_words = n_docs, max(n_words, 1)
        self.items: dict[int, list[tuple[int, int]]] = {}
        for item, term, weight in rows:
            if weight > 0:
                self.items.setdefault(item, []).append((term, weight))

    def impact(self, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What one point of weight earns: grows with the frequency, falls with the length of the document."""
        m = 10 + (90 * lengths * self.n_docs) // self.n_words
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Shard:
    """The documents of a shard and the lists that are asked for."""

    def __init__(self, scorer: Scorer, ids: bytes, lengths: bytes):
        self.scorer = scorer
        self.ids, self.lengths = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64)
        self.lists: dict[int, tuple] = {}
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, term: int, last: bytes, most_tf: bytes, least_n: bytes, ends: bytes, packed: bytes) -> None:
        bound = self.scorer.impact(np.frombuffer(most_tf, np.int64), np.frombuffer(least_n, np.int64))
        self.lists[term] = (
            np.frombuffer(last, np.int32),
            bound,
            int(bound.max()),
            np.frombuffer(ends, np.int32),
            np.frombuffer(packed, np.uint8),
        )

    def whole(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a list; kept, as many items ask for the same essential lists."""
        if term not in self.read:
            pairs = unpack(self.lists[term][4])
            docs = np.cumsum(pairs[::2]) - 1
            self.read[term] = docs, self.scorer.impact(pairs[1::2], self.lengths[docs])
        return self.read[term]

    def blocks(self, term: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of the blocks with the numbers ``wanted`` (sorted)."""
        if term in self.read:
            return self.read[term]
        last, _, _, ends, packed = self.lists[term]
        if 4 * len(wanted) >= len(last):
            return self.whole(term)
        docs, impacts = [], []
        for b in wanted.tolist():
            pairs = unpack(packed[ends[b - 1] if b else 0 : ends[b]])
            found = np.cumsum(pairs[::2]) + (int(last[b - 1]) if b else -1)
            docs.append(found)
            impacts.append(self.scorer.impact(pairs[1::2], self.lengths[found]))
        return np.concatenate(docs), np.concatenate(impacts)

    def best(self, terms: list[tuple[int, int]], threshold: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the ``top`` of an item, whose last one so far has ``threshold`` (0: fewer found).

        A document that ties with the threshold may still win by its id, so only lower bounds are refused.
        """
        lists = [(weight * self.lists[term][2], weight, term) for term, weight in terms if term in self.lists]
        lists.sort(reverse=True)
        left = sum(bound for bound, _, _ in lists)
        score = np.zeros(len(self.ids), np.int64)
        seen = None
        k = 0
        while k < len(lists) and (left >= threshold or k == 0):
            # Essential: a document that no list before held could still get there.
            bound, weight, term = lists[k]
            docs, impacts = self.whole(term)
            score[docs] += weight * impacts
            left -= bound
            k += 1
            if left < threshold or k == len(lists) or k % 4 == 0:
                seen = np.flatnonzero(score)
                threshold = max(threshold, _last_of(score[seen], top))
        seen = np.flatnonzero(score) if seen is None else seen
        scores = score[seen]
        for bound, weight, term in lists[k:]:
            keep = scores + left >= threshold
            seen, scores = seen[keep], scores[keep]
            left -= bound
            if not len(seen):
                break
            # The block a candidate would lie in, and what it could add at most.
            last, block_bound = self.lists[term][0], self.lists[term][1]
            block = np.searchsorted(last, seen)
            inside = block < len(last)
            gain = np.zeros(len(seen), np.int64)
            gain[inside] = weight * block_bound[block[inside]]
            keep = scores + gain + left >= threshold
            seen, scores, block, inside = seen[keep], scores[keep], block[keep], inside[keep]
            if inside.any():
                docs, impacts = self.blocks(term, np.unique(block[inside]))
                at = np.minimum(np.searchsorted(docs, seen), len(docs) - 1)
                scores = scores + np.where(docs[at] == seen, weight * impacts[at], 0)
            threshold = max(threshold, _last_of(scores, top))
        keep = (scores >= threshold) & (scores > 0)
        return seen[keep], scores[keep]


def _last_of(scores: np.ndarray, top: int) -> int:
    """The ``top``-th greatest score; 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - top)[len(scores) - top]) if len(scores) >= top else 0


def merged(heap: list[tuple[int, int]], found: list[tuple[int, int]], top: int) -> list[tuple[int, int]]:
    """The ``top`` of two lists of (-score, id)."""
    return sorted(heap + found)[:top]


def _searched(lists: DataFrame, scorer, top: int) -> DataFrame:
    """Heaps of the tasks: ``item, doc_id, score``."""
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        asked = scorer()
        heaps: dict[int, list[tuple[int, int]]] = {}
        shard = number = None

        def search(shard):
            for item, terms in asked.items.items():
                heap = heaps.get(item, [])
                threshold = -heap[-1][0] if len(heap) == top else 0
                docs, scores = shard.best(terms, threshold, top)
                if len(docs):
                    # Whole rows are ranked, as equal scores go by the id.
                    order = np.lexsort((shard.ids[docs], -scores))[:top]
                    found = list(zip((-scores[order]).tolist(), shard.ids[docs[order]].tolist()))
                    heaps[item] = merged(heap, found, top)

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != number:
                    if shard is not None:
                        search(shard)
                    shard, number = Shard(asked, row["ids"], row["lengths"]), row["shard"]
                else:
                    shard.add(*[row[c] for c in ("term", "last", "most_tf", "least_n", "ends", "packed")])
        if shard is not None:
            search(shard)
        rows = [(item, doc, -score) for item, heap in heaps.items() for score, doc in heap]
        for at in range(0, len(rows), 4096):
            columns = list(zip(*rows[at : at + 4096]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    # A shard's own row has no term and comes first.
    ordered = lists.repartition("shard").sortWithinPartitions("shard", F.col("term").asc_nulls_first())
    return ordered.mapInArrow(run, "item long, doc_id long, score long")


def search(index: DataFrame, items: DataFrame, top: int = TOP, most_terms: int = MOST_TERMS) -> DataFrame:
    """``item, rank, doc_id, score`` of the ``top`` documents of every item (``item`` a distinct row number, ``text``).

    Items are dealt by hash to groups of about ``most_terms`` terms, above it by one bucket (an eighth, or its longest
    item) at most; a group is sent to every task and searched in a pass over its own lists.
    """
    spark = index.sparkSession
    total = index.where("term IS NULL").agg(F.sum("n_docs"), F.sum("n_words")).first()
    n_docs, n_words = total[0] or 0, total[1] or 0
    asked = stage(asked_terms(items), "asked")
    frequency = index.where("term IS NOT NULL").join(asked.select("term").distinct(), "term", "left_semi")
    frequency = frequency.groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(F.lit(1000) * F.log((F.lit(2.0 * n_docs) + 2) / (F.col("df") * 2 + 1)))
    # Items go to buckets of a fraction of the bound each, and runs of buckets are the groups.
    n_buckets = 8 * (asked.count() // most_terms) + 1
    bucket = F.pmod(F.xxhash64("item"), F.lit(n_buckets)).alias("bucket")
    sizes = asked.groupBy(bucket).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("bucket")) - F.col("n")  # a row a bucket
    groups = sizes.select("bucket", F.floor(before / most_terms).alias("group"))
    weighted = asked.withColumn("bucket", bucket).join(groups, "bucket").join(frequency, "term")
    weighted = stage(weighted.select("group", "item", "term", weight.cast("long").alias("weight")), "weighted")
    most = weighted.agg(F.max("group")).first()[0]
    path = new_folder(spark, "heaps")
    for group in range(0 if most is None else most + 1):
        own = weighted.where(F.col("group") == group)
        rows = own.select("item", "term", "weight").toArrow()
        scorer = Scorer(list(zip(*(c.to_pylist() for c in rows.columns))), n_docs, n_words)
        sent = share(spark, scorer)
        lists = index.where("term IS NOT NULL").join(own.select("term").distinct(), "term", "left_semi")
        lists = lists.select(index.columns).unionByName(index.where("term IS NULL"))
        _searched(lists, sent, top).write.mode("append").parquet(path)
    heaps = spark.createDataFrame([], "item long, doc_id long, score long")
    heaps = heaps if most is None else spark.read.schema(heaps.schema).parquet(path)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    return heaps.withColumn("rank", rank).where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item.

    Null texts have no terms and are never found; items without text find nothing; repeated rows are documents, or
    items, each; equal scores go by id (null first). Without documents or items there are no rows.
    """
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    items = items.select("item_id", text_of(items).alias("text"))
    items = stage(items.withColumn("item", F.monotonically_increasing_id()), "items")
    found = search(index(docs, docs["doc_id"], text_of(docs)), items)
    return found.join(items.select("item", "item_id"), "item").select(
        "item_id", "rank", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "score"
    )
