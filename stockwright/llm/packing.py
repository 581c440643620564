"""Packing: shortest-pack-first over the histogram of piece lengths.

Documents are tokenized in Arrow batches and cut into pieces of ``size`` tokens and a rest. Only the histogram of piece
lengths (at most ``size`` numbers) comes to the driver. There lengths are placed longest first, each into the open
packs with the least room that still takes it; packs of like content are one pattern with a count. The patterns give,
for each length, ranges of ranks with a sequence and an offset. Pieces get their rank within their length from a window
over (length, salt) and the counts of the salts before, so a length that a third of all pieces share is ranked by many
tasks.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockwright.llm.common import slices, strings, table, text_of
from stockwright.sources.tables import stage

SEQUENCE = 2048
END_OF_TEXT = 1
CACHED_WORDS = 200_000  # words whose ids a task remembers

# Fixed value: how byte-level BPE cuts a text before merging.
BYTE_BPE_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_bpe(vocabulary: dict[str, int]):
    """A byte-level BPE vocabulary as a tiktoken encoding: same ids, several times faster.

    The vocabulary spells bytes as printable characters: those that print stand for themselves, the others are
    numbered from 256 on.
    """
    import tiktoken

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in vocabulary.items() if all(c in byte_of for c in word)}
    return tiktoken.Encoding("byte_bpe", pat_str=BYTE_BPE_SPLIT, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str) -> Callable[[str], bytes]:
    """Text to its ids as little-endian 32-bit numbers, as the tokenizer file at ``path`` says.

    Added tokens inside a text are tokens of their own, as the tokenizer has it.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    before = described.get("pre_tokenizer") or {}
    added = {t["content"]: t for t in described.get("added_tokens", ())}
    plain = not any(t[flag] for t in added.values() for flag in ("single_word", "lstrip", "rstrip", "normalized"))
    if (
        described["model"]["type"] != "BPE"
        or before.get("type") != "ByteLevel"
        or before.get("add_prefix_space")
        or not plain
        or described.get("normalizer")
    ):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda text: array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    bpe = byte_bpe({w: i for w, i in described["model"]["vocab"].items() if w not in added})
    encode = bpe.encode_ordinary
    known: dict[str, bytes] = {}

    def ids(text: str) -> bytes:
        """A blank between two characters that are no white space always begins a token, so a text can be cut there
        and words met before need no second look. Texts with other white space beside a blank go through whole."""
        words = text.split(" ")
        found = list(map(known.get, words))
        found[0] = array("I", encode(words[0])).tobytes()
        if words[0] and words[0][-1].isspace():
            return array("I", encode(text)).tobytes()
        at = 1
        while True:
            try:
                at = found.index(None, at)
            except ValueError:
                break
            word = words[at]
            if not word or word[0].isspace() or word[-1].isspace():
                return array("I", encode(text)).tobytes()
            found[at] = array("I", encode(" " + word)).tobytes()
            if len(known) < CACHED_WORDS:
                known[word] = found[at]
        return b"".join(found)

    if not added:
        return ids
    # Longer contents first, so that of two that start at one place the longer is taken.
    contents = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))))
    own = {content: array("I", [token["id"]]).tobytes() for content, token in added.items()}

    def all_ids(text: str) -> bytes:
        parts, at = [], 0
        for match in contents.finditer(text):
            parts += [ids(text[at : match.start()]), own[match[0]]]
            at = match.end()
        return ids(text) if not at else b"".join([*parts, ids(text[at:])])

    return all_ids


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, with_ids: bool = True) -> DataFrame:
    """The pieces of every row of ``docs``: ``doc_id, start, length, ids_crc32, doc_tokens`` and, on demand, ``ids``.

    ``ids`` are little-endian 32-bit numbers. A null or empty text is the end token alone.
    """
    schema = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    end = array("I", [END_OF_TEXT]).tobytes()

    def cut(batches):
        encode = encoder(tokenizer)
        for batch in slices(batches):
            columns = [[] for _ in range(5 + with_ids)]
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                ids = encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, size):
                    part = ids[4 * start : 4 * (start + size)]
                    row = (doc_id, start, len(part) // 4, zlib.crc32(part), total, part)
                    for column, value in zip(columns, row):
                        column.append(value)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names[: len(columns)]
            )

    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(cut, schema)


def patterns(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int]]:
    """Where each rank of each length goes: ``(length, first rank, first sequence, offset)``.

    From its first rank on, a length's ranks take consecutive sequences at that offset, up to the next entry's first
    rank. Lengths come longest first; a length goes to the open packs with the least room that takes it, and where
    there are none, into new packs that hold as many of it as fit.
    """
    open_packs: dict[int, list[tuple[int, list]]] = {}  # room: [(count, [(length, first rank, offset)])]
    rooms: list[int] = []  # heap of rooms that may have packs

    def put(room: int, count: int, content: list) -> None:
        if count:
            if room not in open_packs or not open_packs[room]:
                heapq.heappush(rooms, room)
            open_packs.setdefault(room, []).append((count, content))

    def least_room(length: int) -> int | None:
        while rooms and (rooms[0] < length or not open_packs.get(rooms[0])):
            room = heapq.heappop(rooms)
            if open_packs.get(room):  # too small for this and all later lengths that are as long
                too_small.append(room)
        return rooms[0] if rooms else None

    too_small: list[int] = []
    for length in sorted(histogram, reverse=True):
        for room in too_small:
            heapq.heappush(rooms, room)
        too_small.clear()
        left, rank = histogram[length], 0
        while left:
            room = least_room(length)
            if room is None:
                fit = size // length
                for copies, packs in ((fit, left // fit), (left % fit, 1)):
                    if copies and packs:
                        put(
                            size - copies * length,
                            packs,
                            [(length, rank + k * packs, k * length) for k in range(copies)],
                        )
                        rank += copies * packs
                left = 0
                break
            count, content = open_packs[room].pop()
            used = min(count, left)
            if used < count:
                open_packs[room].append((count - used, [(n, first + used, at) for n, first, at in content]))
            put(room - length, used, [*content, (length, rank, size - room)])
            left, rank = left - used, rank + used
    out, sequence = [], 0
    for packs in open_packs.values():
        for count, content in packs:
            out += [(length, first, sequence, at) for length, first, at in content]
            sequence += count
    return sorted(out)


def pack(cut: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Pieces (any columns with ``doc_id, start, length, ids_crc32``) with ``sequence_id`` and ``offset``.

    Equal rows are pieces of their own. No pieces give no rows.
    """
    spark = cut.sparkSession
    cut = stage(cut, "pieces")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    counts = stage(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        salted.withColumn("_rank", F.row_number().over(within).cast("long") - 1)
        .join(first, ["length", "_salt"])
        .withColumn("_rank", F.col("_rank") + F.col("_first"))
    )
    places = patterns(histogram, size)
    # Ordered by (length, rank): as one number, lengths in the upper bits.
    keys = np.array([(n << 44) + first for n, first, _, _ in places], np.int64)
    ranks = np.array([p[1] for p in places], np.int64)
    sequences = np.array([p[2] for p in places], np.int64)
    offsets = np.array([p[3] for p in places], np.int64)
    shared = spark.sparkContext.broadcast((keys, ranks, sequences, offsets))

    def place(batches):
        keys, ranks, sequences, offsets = shared.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy().astype(np.int64)
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
            at = np.searchsorted(keys, (length << 44) + rank, "right") - 1
            kept = [n for n in batch.schema.names if n != "_rank"]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])],
                names=[*kept, "sequence_id", "offset"],
            )

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.select(*cut.columns, "_rank").mapInArrow(place, f"{names}, sequence_id long, offset long")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence.

    A null text is an empty one (the end token alone); repeated rows are packed each; no documents give no rows.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(pieces(docs, tokenizer_path(), with_ids=False)).select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of ``docs`` with their ids."""
    return pack(pieces(docs, tokenizer_path()))
