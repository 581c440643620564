"""LM scoring with a probabilistic suffix tree over words, grown in rounds by length of context.

Texts are kept in chunks of some million tokens, laid out by chunk so that they never move again. What a chunk has to know
of the whole corpus it asks for: it sends its distinct codes with their counts, in blocks by range of code, and every block
comes back with the sums over all chunks. A block is one packed, sorted row, not a row a code; a frequent code is one number
in a chunk's block, however often it occurs, and ranges of hashes are equally full. An answer is as small as its counts.

Counts of words come first. Then in each round k the chunks ask how often their grams of a context of k words and the word
after it occur in the training texts, and add up, per context, the log-likelihood ratio of the tokens seen after it against
its longest proper suffix, each token judged without its own occurrence. A context whose ratio is above ``GAIN`` over the
corpus is a state of the tree: it pays for itself. A context of k + 1 words is only looked at where its suffix is a state
and it occurs ``LEAST`` times (and so do the contexts that its own count came from), so rounds end by themselves: where a
word is certain, no longer context can gain. There is no greatest length, no list of kept codes and no share of the corpus.

The first rounds look at most places and go through the chunks again. Once a round has sent fewer than a ``FEW``-th as many
grams as there are tokens, the chunks write down the grams of the next, and where they are, next to the blocks they send.
From then on a round reads what the last one wrote and the answers to it, so it costs what is still looked at.

A token's probability is that of the longest suffix of its history that is a state: its count after the state and ``PRIOR``
times the probability after the next shorter suffix; at the root it is the count plus one.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from stockwright.llm.common import slices, strings, table, text_of, white_table
from stockwright.llm.hashing import mix, placed_words
from stockwright.sources.tables import _delete, delete_stages, new_folder, recorded_stages, stage

LEAST = 2  # occurrences of a context
PRIOR = 20.0  # weight of the shorter context, in tokens
GAIN = 2.0  # what a context must gain over its suffix to be a state, in natural logarithms
END = np.uint64(0x5EED0FE11D0FF117)  # hash of the end of a text; also what stands before the first word
_CONTEXT = np.uint64(0xA0761D6478BD642F)  # odd random multiplier
CHUNK = 2_000_000  # tokens of a chunk, about; a longer text is a chunk of its own
RANGE = 2_000_000  # codes of a range that meet in a task, about
FEW = 2  # grams are written down after a round with fewer than this part of the tokens
_GAINS = 1e6  # gains are summed as whole numbers, in any order


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text closed by ``END``, and the places of the ends."""
    to_words = white_table()
    flats = [t.encode("utf-8", "surrogatepass").translate(to_words) for t in texts]
    starts, words = placed_words(b" ".join(flats))
    ends = np.cumsum([len(f) + 1 for f in flats])
    last = np.searchsorted(starts, ends)  # words up to the end of each text
    return np.insert(words, last, END), last + np.arange(len(texts))


def _joined(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Codes of grams from those without the last and without the first word."""
    return mix(context * _CONTEXT + suffix)


def _sorted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts the codes, and where in it a code differs from the one before. Leading bits and place are
    sorted as one number, which is several times as fast; codes that only differ in the bits left out, seldom met, are
    noticed and sorted as they are."""
    bits = np.uint64(len(codes).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    placed = (codes & ~low) | np.arange(len(codes), dtype=np.uint64)
    placed.sort()
    order = (placed & low).astype(np.int64)
    found = codes[order]
    if np.any(found[1:] < found[:-1]):
        order = np.argsort(codes)
        found = codes[order]
    new = np.ones(len(codes), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return order, new


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct codes, which of them each code is, and a place of each."""
    order, new = _sorted(codes)
    slots = np.empty(len(codes), np.int64)
    slots[order] = np.cumsum(new) - 1
    places = order[new]
    return codes[places], slots, places


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of their places, compressed."""
    planes = np.ascontiguousarray(numbers.astype(np.int64).view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def _unpack(packed: bytes, size: int) -> np.ndarray:
    """The numbers, in memory of their own: of a single number the planes already lie in order and are read-only."""
    planes = pa.Codec("zstd").decompress(packed, size * 8, asbytes=True)
    return np.array(np.frombuffer(planes, np.uint8).reshape(8, size).T, order="C").view(np.int64).ravel()


def _pack_codes(codes: np.ndarray) -> bytes:
    """Sorted codes as steps of as many bytes as the longest needs."""
    steps = np.diff(codes)
    width = (int(steps.max()).bit_length() + 7) // 8 if len(steps) else 0
    return bytes([width]) + codes[:1].tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack_codes(packed: bytes, size: int) -> np.ndarray:
    steps = np.zeros((size, 8), np.uint8)
    steps[0] = np.frombuffer(packed, np.uint8, 8, 1)
    width = packed[0]
    steps[1:, :width] = np.frombuffer(packed, np.uint8, (size - 1) * width, 9).reshape(size - 1, width)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


_CHUNK = "chunk long, tokens long, taught long, texts long, distinct long, words binary, ids binary, ends binary, train binary"


def chunks(docs: DataFrame, trains: Column, keep: tuple[str, ...], folder: str, name: str) -> DataFrame:
    """Rows of some million tokens: word numbers by frequency, the words' hashes, and the kept columns as lists
    ``_0, _1, ...``; a table laid out by ``chunk``."""
    spark = docs.sparkSession
    rows = docs.select(
        *[docs[c].alias(f"_{i}") for i, c in enumerate(keep)],
        F.coalesce(trains, F.lit(False)).alias("_train"),
        text_of(docs).alias("_text"),
    )
    kept = "".join(f", _{i} array<{docs.schema[c].dataType.simpleString()}>" for i, c in enumerate(keep))

    def fill(batches) -> Iterator[pa.RecordBatch]:
        first, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            hashes = np.concatenate([h[0] for h in held])
            lengths = np.concatenate([np.diff(np.concatenate(([-1], h[1]))) for h in held])
            columns = [pa.concat_arrays([h[2].column(i) for h in held]) for i in range(held[0][2].num_columns - 1)]
            train = columns.pop().to_numpy(zero_copy_only=False)
            words, ids, _ = _distinct(hashes)
            by = np.argsort(-np.bincount(ids), kind="stable")
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by))
            ends = np.cumsum(lengths) - 1
            values = [
                first + number,
                len(ids),
                int(lengths[train].sum()),
                len(ends),
                len(words),
                words[by].tobytes(),
                _pack(rank[ids]),
                _pack(ends),
                train.tobytes(),
            ]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
            names = [f.split()[0] for f in _CHUNK.split(", ")] + [f"_{i}" for i in range(len(columns))]
            return pa.RecordBatch.from_arrays([*[pa.array([v]) for v in values], *lists], names=names)

        for batch in slices(batches):
            hashes, ends = token_hashes(strings(batch.column(batch.num_columns - 1)))
            held.append((hashes, ends, batch))
            size += len(hashes)
            if size >= CHUNK:
                yield flush()
                held, size, number = [], 0, number + 1
        if held:
            yield flush()

    made = rows.mapInArrow(fill, _CHUNK + kept)
    return _laid_out(made, folder, name)


def _laid_out(rows: DataFrame, folder: str, name: str) -> DataFrame:
    """Rows written as a table laid out by ``chunk``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(parts, "chunk").option("path", folder).format("parquet").saveAsTable(name)
    return rows.sparkSession.table(name)


def _told(answers: pa.Table) -> dict[int, np.ndarray]:
    """What the corpus has answered a chunk: by step, numbers in the order of the codes it sent."""
    found = sorted(zip(*[answers.column(c).to_pylist() for c in ("step", "range", "size", "data")]))
    return {step: np.concatenate([_unpack(d, n) for s, _, n, d in found if s == step]) for step in {f[0] for f in found}}


class Grams:
    """The grams of one length that a chunk looks at. By place, in order: whether it trains, whether the place before it
    is the one before it in the text, and its gram. By gram: its code, its number in the chunk's training texts, its
    context and its last word's probability after the context's suffix. A gram fixes all that led to it, so nothing of
    this has to be held by place."""

    def __init__(self, at, train, follows, keys, n, p, context, last):
        """``context`` and ``last``: by place, which of the one word shorter grams ends before it and which with it."""
        self.at, self.train, self.follows = at, train, follows
        self.keys, self.slot, held = _distinct(_joined(keys[context], keys[last]))
        self.taught = np.bincount(self.slot[train], minlength=len(self.keys))
        self.p = p[last[held]]
        context = context[held]
        present = np.zeros(len(keys), bool)
        present[context] = True
        self.context = (np.cumsum(present) - 1)[context]
        self.contexts, self.seen = keys[present], n[present]

    def gains(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The contexts and what they gain here, where the grams occur ``n`` times."""
        taught = np.flatnonzero(self.taught)
        p, context = self.p[taught], self.context[taught]
        without = (n[taught] - 1 + PRIOR * p) / (self.seen[context] - 1 + PRIOR)
        gains = np.bincount(context, self.taught[taught] * np.log(without / p), len(self.contexts))
        return self.contexts, np.rint(gains * _GAINS).astype(np.int64)

    def longer(self, n: np.ndarray, states: np.ndarray) -> Grams | None:
        """Takes in which contexts are states. Then the grams of one more word, if any is to be looked at."""
        grown = states[self.context] > 0
        self.p[grown] = (n[grown] + PRIOR * self.p[grown]) / (self.seen[self.context[grown]] + PRIOR)
        on = self.follows & grown[self.slot]
        on[1:] &= (n >= LEAST)[self.slot[:-1]]
        on = np.flatnonzero(on)
        if not len(on):
            return None
        follows = np.diff(on, prepend=-2) == 1
        at = None if self.at is None else self.at[on]
        return Grams(at, self.train[on], follows, self.keys, n, self.p, self.slot[on - 1], self.slot[on])

    def next(self, told: dict[int, np.ndarray], step: int, steps: int) -> tuple[Grams, np.ndarray, np.ndarray] | None:
        """Goes through the answers from ``step``, the grams' counts, up to ``steps``. Then the grams reached, and the
        codes to send next, sorted, with their numbers; None when no context is left."""
        if step == steps:
            return self, self.keys, self.taught
        if step + 1 == steps:
            return self, *self.gains(told[step])
        longer = self.longer(told[step], told[step + 1])
        return longer and longer.next(told, step + 2, steps)

    def packed(self) -> list[bytes]:
        """All but the places, and but the codes and their numbers, which stand in the blocks."""
        bits = [np.packbits(x).tobytes() for x in (self.train, self.follows)]
        numbers = [_pack(x) for x in (self.slot, self.context, self.p.view(np.int64), self.seen)]
        return [np.array([len(self.slot), len(self.contexts)]).tobytes(), *bits, *numbers, _pack_codes(self.contexts)]

    @classmethod
    def unpacked(cls, rows: pa.Table) -> Grams:
        """Of the rows that a chunk has written: its blocks and, with the range -1, the rest."""
        found = sorted(zip(*[rows.column(c).to_pylist() for c in ("range", "size", "codes", "numbers", "grams")]))
        (*_, packed), *blocks = found
        made = cls.__new__(cls)
        made.at = None
        made.keys = np.concatenate([_unpack_codes(codes, size) for _, size, codes, _, _ in blocks])
        made.taught = np.concatenate([_unpack(numbers, size) for _, size, _, numbers, _ in blocks])
        places, contexts = np.frombuffer(packed[0], np.int64).tolist()
        made.train, made.follows = [np.unpackbits(np.frombuffer(x, np.uint8), count=places).astype(bool) for x in packed[1:3]]
        made.slot = _unpack(packed[3], places)
        made.context = _unpack(packed[4], len(made.keys))
        made.p = _unpack(packed[5], len(made.keys)).view(np.float64)
        made.seen = _unpack(packed[6], contexts)
        made.contexts = _unpack_codes(packed[7], contexts)
        return made


class Chunk:
    """A chunk's tokens."""

    def __init__(self, row: pa.Table):
        def value(name):
            return row.column(name)[0].as_py()

        self.words = np.frombuffer(value("words"), np.uint64)
        self.ids = _unpack(value("ids"), value("tokens"))
        self.ends = _unpack(value("ends"), value("texts"))
        lengths = np.diff(np.concatenate(([-1], self.ends)))
        self.begins = self.ends + 1 - lengths
        self.train = np.repeat(np.frombuffer(value("train"), bool), lengths)
        self.by = np.argsort(self.words)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """The words' codes, sorted, and their numbers in the training texts."""
        return self.words[self.by], np.bincount(self.ids[self.train], minlength=len(self.by))[self.by]

    def first(self, n: np.ndarray, floor: float) -> Grams | None:
        """The grams of two words, where the words occur ``n`` times."""
        keys = self.words[self.by]
        slots = np.empty(len(keys), np.int64)
        slots[self.by] = np.arange(len(keys))
        last = slots[self.ids]
        # The context of the first word is the end of a text before it.
        context = np.roll(last, 1)
        context[self.begins] = np.searchsorted(keys, END)
        looked = (n >= LEAST)[context]
        at = np.flatnonzero(looked)
        if not len(at):
            return None
        follows = np.roll(looked, 1)
        follows[self.begins] = False
        return Grams(at, self.train[at], follows[at], keys, n, (n + 1) / floor, context[at], last[at])

    def scores(self, told: dict[int, np.ndarray], floor: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the tokens' words and the tokens' probabilities, after all answers."""
        by_word = np.empty(len(self.by), np.int64)
        by_word[self.by] = told[0]
        known = by_word[self.ids]
        p = (known + 1) / floor
        grams = self.first(told[0], floor) if steps > 1 else None
        for step in range(1, steps, 2):
            if grams is None:
                break
            longer = grams.longer(told[step], told[step + 1])
            p[grams.at] = grams.p[grams.slot]
            grams = longer
        return known, p


def _blocks(keys: np.ndarray, numbers: np.ndarray, chunk: int, bits: int) -> pa.Table:
    """A row for each range of codes that a chunk has."""
    ranges = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(ranges, prepend=-1))
    stops = np.append(starts[1:], len(keys))
    return pa.table(
        {
            "range": pa.array(ranges[starts]),
            "chunk": pa.array(np.full(len(starts), chunk)),
            "size": pa.array(stops - starts),
            "codes": pa.array([_pack_codes(keys[a:b]) for a, b in zip(starts, stops)], pa.binary()),
            "numbers": pa.array([_pack(numbers[a:b]) for a, b in zip(starts, stops)], pa.binary()),
        }
    )


_BLOCK = "range long, chunk long, size long, codes binary, numbers binary"
_KEPT = f"{_BLOCK}, grams array<binary>"
_ANSWER = "step int, range long, chunk long, size long, data binary, distinct long"


def _summed(blocks: DataFrame, step: int) -> DataFrame:
    """To each block the sums over all blocks; for contexts (even steps), whether the sum is a sufficient gain.
    ``distinct``: how many codes have a sum above zero, in one row of each range."""

    def add(rows: pa.Table) -> pa.Table:
        sizes = rows.column("size").to_pylist()
        codes = np.concatenate([_unpack_codes(c.as_py(), n) for c, n in zip(rows.column("codes"), sizes)])
        order, new = _sorted(codes)
        del codes
        numbers = np.concatenate([_unpack(c.as_py(), n) for c, n in zip(rows.column("numbers"), sizes)])
        sums = np.add.reduceat(numbers[order], np.flatnonzero(new))
        if step and step % 2 == 0:
            sums = (sums > GAIN * _GAINS).astype(np.int64)
        each = np.empty(len(order), np.int64)
        each[order] = sums[np.cumsum(new) - 1]
        cuts = np.cumsum(sizes)
        data = [_pack(each[b - n : b]) for b, n in zip(cuts, sizes)]
        distinct = np.zeros(len(sizes), np.int64)
        distinct[0] = np.count_nonzero(sums > 0)
        return pa.table(
            {
                "step": pa.array(np.full(len(sizes), step, np.int32)),
                "range": rows.column("range"),
                "chunk": rows.column("chunk"),
                "size": rows.column("size"),
                "data": pa.array(data, pa.binary()),
                "distinct": pa.array(distinct),
            }
        )

    return blocks.groupBy("range").applyInArrow(add, _ANSWER)


def scored(docs: DataFrame, trains: Column, keep: tuple[str, ...], tokens: bool = False) -> DataFrame:
    """Learns from the rows for which ``trains`` holds (null: not) and scores all. Kept columns, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10) of every row; with ``tokens`` also ``token_scores``, the log10
    probabilities of its tokens in order.

    A null text is an empty one: its end is its only token. Repeated rows train and are scored each. Without training
    texts all tokens have the probability 1. No documents give no rows. Words and grams are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    folder, name = new_folder(spark, "chunks"), f"chunks_{uuid.uuid4().hex}"
    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    written: list[tuple[str, str]] = []  # tables of the grams looked at, the last of which is read
    try:
        with _swept(spark), recorded_stages() as answered:
            held = chunks(docs, trains, keep, folder, name)
            taught, size = held.agg(F.coalesce(F.sum("taught"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
            bits = max(3, (int(size) // RANGE).bit_length())
            plain = held.select(*[f.split()[0] for f in _CHUNK.split(", ")])
            answers: list[DataFrame] = []
            floor = 1.0
            few = False
            while True:
                steps = len(answers)
                writes = few and steps % 2 == 1
                if written:
                    blocks = _asked_on(spark.table(written[-1][1]), answers, steps, bits)
                else:
                    blocks = _asked(plain, answers, floor, steps, bits, writes)
                if writes:
                    written.append((new_folder(spark, "grams"), f"grams_{uuid.uuid4().hex}"))
                    blocks = _laid_out(blocks, *written[-1]).where("range >= 0").drop("grams")
                    for path, old in written[:-1]:
                        _drop(spark, path, old)
                    del written[:-1]
                found = stage(_summed(blocks, steps), "answers")
                sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("distinct", "size")]
                distinct, sent, rows = found.agg(*sums, F.count("*")).first()
                if not rows or steps and steps % 2 == 0 and not distinct:  # no grams to count, or no states among them
                    break
                if steps == 0:
                    floor = float(taught + distinct + 1)
                answers.append(found)
                few = few or steps % 2 == 1 and sent * FEW < size
            while written:
                _drop(spark, *written.pop())
            # Grams whose contexts turned out to be no states change nothing.
            steps -= steps > 0 and steps % 2 == 0

            def finish(row: pa.Table, told: pa.Table) -> pa.Table:
                if not row.num_rows:
                    return empty.slice(0, 0)
                chunk = Chunk(row)
                known, p = chunk.scores(_told(told), floor, steps)
                model = np.log10(p)
                root = np.log10((known + 1) / floor)
                parts = [chunk.ends + 1 - chunk.begins]
                parts += [np.add.reduceat(x, chunk.begins) for x in ((known > 0).astype(np.int64), root, model)]
                columns = [row.column(f"_{i}").combine_chunks().flatten() for i in range(len(keep))]
                columns += [pa.array(x) for x in (*parts[:2], np.full(len(chunk.ends), int(taught)), *parts[2:])]
                if tokens:
                    offsets = np.append(chunk.begins, len(model)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(model)))
                return pa.Table.from_arrays(columns, names=names)

            names = [*keep, "n_tokens", "n_known", "train_tokens", "base_score", "score"]
            fields = kept + "n_tokens long, n_known long, train_tokens long, base_score double, score double"
            if tokens:
                names, fields = [*names, "token_scores"], fields + ", token_scores array<double>"
            empty = pa.table({n: pa.nulls(0) for n in names})
            out = held.groupBy("chunk").cogroup(_all(spark, answers[:steps])).applyInArrow(finish, fields)
        scores = stage(out, "scores")
        delete_stages(spark, answered)
    finally:
        for path, table_name in [(folder, name), *written]:
            _drop(spark, path, table_name)
    return scores


@contextlib.contextmanager
def _swept(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go with the job that made them, not when the driver's memory happens to be cleared."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _drop(spark: SparkSession, folder: str, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _delete(spark, folder)


def _all(spark: SparkSession, answers: list[DataFrame]) -> GroupedData:
    """The answers by chunk."""
    union = spark.createDataFrame([], _ANSWER)
    for found in answers:
        union = union.unionAll(found)
    return union.groupBy("chunk")


def _kept(grams: Grams, blocks: pa.Table, chunk: int) -> pa.Table:
    """Blocks and one row with what else is to know of the grams in them."""
    rest = {"range": [-1], "chunk": [chunk], "size": [0], "codes": [None], "numbers": [None], "grams": [grams.packed()]}
    grams_type = pa.list_(pa.binary())
    blocks = blocks.append_column("grams", pa.nulls(blocks.num_rows, grams_type))
    return pa.concat_tables([blocks, pa.table(rest, schema=blocks.schema)])


def _asked(held: DataFrame, answers: list[DataFrame], floor: float, steps: int, bits: int, keep: bool) -> DataFrame:
    """The blocks that the chunks send after ``steps`` answers; to ``keep``, with the grams that they go on from."""

    def ask(row: pa.Table, told: pa.Table) -> pa.Table:
        chunk = Chunk(row)
        number = row.column("chunk")[0].as_py()
        if steps == 0:
            return _blocks(*chunk.counts(), number, bits)
        answered = _told(told)
        grams = chunk.first(answered[0], floor)
        del chunk
        return _sent(grams and grams.next(answered, 1, steps), number, bits, keep)

    out = _KEPT if keep else _BLOCK
    return held.groupBy("chunk").cogroup(_all(held.sparkSession, answers)).applyInArrow(ask, out)


def _asked_on(kept: DataFrame, answers: list[DataFrame], steps: int, bits: int) -> DataFrame:
    """The blocks that the chunks send after ``steps`` answers, from the grams written with the last odd step; an odd step
    writes the next ones."""
    begun, keep = (steps - 2, True) if steps % 2 else (steps - 1, False)

    def ask(rows: pa.Table, told: pa.Table) -> pa.Table:
        number = rows.column("chunk")[0].as_py()
        return _sent(Grams.unpacked(rows).next(_told(told), begun, steps), number, bits, keep)

    out = _KEPT if keep else _BLOCK
    return kept.groupBy("chunk").cogroup(_all(kept.sparkSession, answers[begun:])).applyInArrow(ask, out)


def _sent(reached: tuple[Grams, np.ndarray, np.ndarray] | None, chunk: int, bits: int, keep: bool) -> pa.Table:
    if reached is None:
        none = np.empty(0, np.int64)
        blocks = _blocks(none.view(np.uint64), none, chunk, bits)
        return blocks.append_column("grams", pa.nulls(0, pa.list_(pa.binary()))) if keep else blocks
    grams, keys, numbers = reached
    blocks = _blocks(keys, numbers, chunk, bits)
    return _kept(grams, blocks, chunk) if keep else blocks


def op4_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; held-out documents teach nothing.

    A null text is an empty one: its end is its only token. Repeated rows train and are scored each; a null id is not
    held out. Without training texts all tokens have the probability 1. No documents give no rows. Words are told
    apart by 64-bit hashes.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held_out)
    out = scored(docs, ~F.col("held_out"), ("doc_id", "held_out"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
