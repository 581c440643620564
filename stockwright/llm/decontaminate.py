"""Benchmark decontamination: a generalised suffix automaton of the normalised items, read over every document.

The automaton is over word numbers; its size is at most twice the words of all items. It is built on the driver from
the benchmark table and sent to the tasks once. A task streams a document's words, follows the automaton and holds the
longest matching length at each word. Where that length reaches the window, the last words lie in an item. A benchmark
of more than ``MOST_ITEM_WORDS`` words is dealt into groups with an automaton each; every document is read against each
group, and what the groups find in it is merged.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwright.llm.common import share, slices, strings, table, text_of, word_table
from stockwright.sources.tables import stage

WINDOW = 10
# An automaton goes to every task; a larger benchmark takes several.
MOST_ITEM_WORDS = 500_000


class ItemAutomaton:
    """Suffix automaton of several word sequences with the items behind its states.

    ``windows_at`` maps a state to the window lengths that end there: a state stands for several lengths of one
    ending; a window of ``n`` words ends in the state on the suffix path whose lengths include ``n``.
    """

    def __init__(self, items: list[tuple[str, list[str]]], window: int = WINDOW):
        self.window = window
        self.numbers: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for item, words in items:
            if words:
                sequences.append((item, [self.numbers.setdefault(w, len(self.numbers)) for w in words]))
        for _, sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        # Items whose window of n words ends in a state, by (state, n).
        self.items: dict[tuple[int, int], set[str]] = defaultdict(set)
        self.shorter: set[int] = set()  # lengths of items shorter than the window
        for item, sequence in sequences:
            n = min(window, len(sequence))
            if n < window:
                self.shorter.add(n)
            for at, state in enumerate(self.states(sequence), 1):
                if at >= n:
                    self.items[self.ending(state, n), n].add(item)
        self.items = dict(self.items)
        self.least = min([window, *self.shorter])

    def _extend(self, last: int, word: int) -> int:
        follow, link, length = self.next, self.link, self.length
        if word in follow[last]:
            known = follow[last][word]
            return known if length[known] == length[last] + 1 else self._split(last, word, known)
        state = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and word not in follow[at]:
            follow[at][word] = state
            at = link[at]
        if at >= 0:
            known = follow[at][word]
            link[state] = known if length[known] == length[at] + 1 else self._split(at, word, known)
        return state

    def _split(self, at: int, word: int, known: int) -> int:
        """A state of its own for the shorter endings of ``known``."""
        follow, link, length = self.next, self.link, self.length
        copy = len(follow)
        follow.append(dict(follow[known]))
        link.append(link[known])
        length.append(length[at] + 1)
        link[known] = copy
        while at >= 0 and follow[at].get(word) == known:
            follow[at][word] = copy
            at = link[at]
        return copy

    def states(self, sequence: list[int]):
        state = 0
        for word in sequence:
            state = self.next[state][word]
            yield state

    def ending(self, state: int, n: int) -> int:
        """The state of the last ``n`` words."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def matches(self, words: list[bytes], numbers: dict[bytes, int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges inside occurring windows (sorted, may overlap) and the items that own them."""
        get = numbers.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        known = ids >= 0
        # Only runs of item words can match; a run shorter than the shortest window cannot.
        edges = np.flatnonzero(np.diff(np.concatenate(([False], known, [False])).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.least
        found, owners = [], set()
        follow, link, length = self.next, self.link, self.length
        sizes = sorted([*self.shorter, self.window], reverse=True)
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            state = matched = 0
            for at, word in enumerate(ids[a:b].tolist(), a + 1):
                while state and word not in follow[state]:
                    state = link[state]
                    matched = length[state]
                if word in follow[state]:
                    state, matched = follow[state][word], matched + 1
                if matched < self.least:
                    continue
                for n in sizes:
                    if n <= matched:
                        items = self.items.get((self.ending(state, n), n))
                        if items:
                            found.append((at - n, at))
                            owners |= items
        return found, owners


def item_groups(items: DataFrame, window: int = WINDOW) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Normalised words of all items, in groups of at most ``MOST_ITEM_WORDS`` words; at least one group.

    A null id is the empty name, a null text has no words. The driver holds one group at a time. An item that is longer
    than a group is cut into parts that share ``window - 1`` words, so each of its windows lies in one part.
    """
    rows = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_of(items).alias("text")
    )
    most = max(MOST_ITEM_WORDS, window)
    to_words = word_table()
    group, held = [], 0
    for row in rows.toLocalIterator():
        words = row["text"].encode().translate(to_words).split()
        for at in range(0, max(1, len(words) - window + 1), most - window + 1):
            part = words[at : at + most]
            if group and held + len(part) > most:
                yield sorted(group)
                group, held = [], 0
            group.append((row["item"], part))
            held += len(part)
    yield sorted(group)


PAIRS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPANS = "array<struct<start:int,end:int>>"


def overlaps(docs: DataFrame, items: DataFrame, window: int = WINDOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """``n_words``, the hit word ranges ``spans`` (start, end; merged where they overlap), the same in UTF-8 bytes of
    the text as ``byte_spans``, and the sorted ``items``, for every row of ``docs``; columns named in ``keep`` stay."""
    groups = item_groups(items, window)
    first, second = next(groups), next(groups, None)
    if second is None:
        return _found(docs.select(*[docs[c] for c in keep], text_of(docs).alias("_text")), first, window)
    # Numbered rows are written, as a recomputation could number them differently.
    kept = stage(
        docs.select(F.monotonically_increasing_id().alias("_id"), *[docs[c] for c in keep], text_of(docs).alias("_text")),
        "documents",
    )
    numbered = kept.select("_id", "_text")
    counts, hits = None, None
    for group in chain((first, second), groups):
        each = _found(numbered, group, window)
        if counts is None:
            each = stage(each, "hits")
            counts = each.select("_id", "n_words")
        own = each.where(F.size("spans") > 0).drop("n_words")
        own = own if hits is None else stage(own, "hits")
        hits = own if hits is None else hits.unionAll(own)
    merged = _merge_groups(hits)
    none = F.array().cast(SPANS)
    return (
        kept.drop("_text")
        .join(counts, "_id")
        .join(merged, "_id", "left")
        .select(
            *keep,
            "n_words",
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("byte_spans", none).alias("byte_spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def _merge_groups(hits: DataFrame) -> DataFrame:
    """One row for each ``_id``: the ranges and items of all its rows. Word and byte ranges of a row go in pairs."""
    met = hits.groupBy("_id").agg(
        F.flatten(F.collect_list(F.arrays_zip("spans", "byte_spans"))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def merge(batches):
        for batch in batches:
            spans, places = [], []
            for ranges in batch.column(1).to_pylist():
                # Byte places rise with word places, so the same ranges merge.
                words = _merged([(r["spans"]["start"], r["spans"]["end"]) for r in ranges])
                begin = {r["spans"]["start"]: r["byte_spans"]["start"] for r in ranges}
                end = {r["spans"]["end"]: r["byte_spans"]["end"] for r in ranges}
                spans.append([{"start": a, "end": b} for a, b in words])
                places.append([{"start": begin[a], "end": end[b]} for a, b in words])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, PAIRS), pa.array(places, PAIRS), batch.column(2)],
                names=["_id", "spans", "byte_spans", "items"],
            )

    return met.mapInArrow(merge, f"_id long, spans {SPANS}, byte_spans {SPANS}, items array<string>")


def _found(kept: DataFrame, items: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """What one group's automaton finds in ``_text``, the last column; the columns before it stay."""
    shared = share(kept.sparkSession, ItemAutomaton(items, window))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "_text")
    schema = f"{fields}{', ' * bool(fields)}n_words long, spans {SPANS}, byte_spans {SPANS}, items array<string>"

    def read(batches):
        automaton = shared()
        numbers = automaton.numbers
        to_words = word_table()
        for batch in slices(batches):
            counts, spans, places, owners = [], [], [], []
            for text in strings(batch.column(batch.num_columns - 1)):
                flat = text.encode("utf-8", "surrogatepass").translate(to_words)
                words = flat.split()
                found, items = automaton.matches(words, numbers) if words else ([], set())
                merged = _merged(found)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged])
                places.append(_bytes(flat, words, merged))
                owners.append(sorted(items))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(counts, pa.int64()),
                    pa.array(spans, PAIRS),
                    pa.array(places, PAIRS),
                    pa.array(owners, pa.list_(pa.string())),
                ],
                names=[*batch.schema.names[:-1], "n_words", "spans", "byte_spans", "items"],
            )

    return kept.mapInArrow(read, schema)


def _merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _bytes(flat: bytes, words: list[bytes], merged: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Byte ranges of word ranges."""
    if not merged:
        return []
    sizes = np.array([len(w) for w in words])
    filled = np.frombuffer(flat, np.uint8) != 32
    starts = np.flatnonzero(filled & ~np.concatenate(([False], filled[:-1])))
    return [{"start": int(starts[a]), "end": int(starts[b - 1] + sizes[b - 1])} for a, b in merged]


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document.

    Nulls: a null text has no words, a null item id is the empty name. Items of one id are one item; equal items each
    count. Items without words match nothing. An empty benchmark hits nothing, no documents give no rows.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = overlaps(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), keep=("doc_id",))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_coverage: float = 0.5) -> DataFrame:
    """``docs`` without what they share with the benchmark, same columns.

    A row in which more than ``most_coverage`` of the words are hit goes. From other rows the hit spans are cut out and
    ``n_chars``, where there is such a column, is counted anew; rows without a hit stay as they are.
    """
    columns = docs.columns
    whole = docs.select(F.struct("*").alias("_row"), text_of(docs).alias("text"))
    found = overlaps(whole, items, window, keep=("_row", "text"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    raw = F.encode("text", "UTF-8")
    last = F.size("byte_spans") - 1
    pieces = F.transform(
        F.sequence(F.lit(0), last + 1),
        lambda i: F.substr(
            F.col("_raw"),
            F.when(i == 0, 0).otherwise(F.get(F.col("byte_spans"), i - 1)["end"]) + 1,
            F.when(i > last, F.length("_raw")).otherwise(F.get(F.col("byte_spans"), i)["start"])
            - F.when(i == 0, 0).otherwise(F.get(F.col("byte_spans"), i - 1)["end"]),
        ),
    )
    cut = F.when(
        F.size("spans") > 0, F.decode(F.aggregate(pieces, F.lit(b""), lambda a, p: F.concat(a, p)), "UTF-8")
    ).otherwise(F.col("_row.text"))
    out = found.where(hit <= most_coverage * F.col("n_words")).withColumn("_raw", raw).withColumn("_cut", cut)
    changed = {"text": F.col("_cut")}
    if "n_chars" in columns:
        n_chars = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("_cut").cast(n_chars)).otherwise(F.col("_row.n_chars"))
    return out.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def plain_overlap(text: str, items: list[tuple[str, str]], window: int = WINDOW) -> tuple[int, int, set[str]]:
    """The definition of a hit, word by word; for tests."""
    split = word_table()
    words = text.encode().translate(split).split()
    hit, owners = set(), set()
    for item, item_text in items:
        own = item_text.encode().translate(split).split()
        n = min(window, len(own))
        if n:
            grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    owners.add(item)
    return len(words), len(hit), owners


def items_digest(owners: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest()
