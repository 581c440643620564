"""Quality classifier: similarity-weighted votes of the nearest labelled texts in a latent-semantic space.

Terms of a text are hashed pairs of bytes and a few terms that tell its shape (share of distinct words, repeated lines,
symbols and so on, in steps). Document frequencies are counted over the whole corpus. The labelled vectors (at most
``SAMPLE``, a documented bound) span the latent space; they and the projection are sent to every task (a few MB, whatever
the corpus). Each task computes exact cosines of its texts with all labelled vectors, block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwright.llm.common import share, slices, strings, table, text_of

SAMPLE = 4096  # labelled rows that vote; half of each label where there are enough
PAIRS = 1024  # dimensions of hashed byte pairs
STEPS = 16  # steps of a shape measure
SHAPES = 8
TERMS = PAIRS + STEPS * SHAPES
SHAPE_WEIGHT = 6.0
LATENT = 64
NEIGHBOURS = 32
SHARPNESS = 12.0  # power of a cosine as a vote's weight
THRESHOLD = 0.3
BLOCK = 256


def _shape(text: str, raw: bytes) -> list[float]:
    """Shares between 0 and 1 that tell prose from junk."""
    words = text.split()
    n = max(len(words), 1)
    chars = max(len(raw), 1)
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        np.log(len(set(words)) + 1) / np.log(n + 1.01),
        1 - len(set(lines)) / max(len(lines), 1),
        sum(raw.count(c) for c in b"#*$%&<>") / n,
        raw.count(b"|") / n,
        raw.count(b"!") / n,
        (chars - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / chars * 2,
        min(len(words) / max(len(lines), 1) / 200, 1.0),
        min(np.log(chars) / 12, 1.0),
    ]


def terms(texts: list[str]) -> np.ndarray:
    """Term counts of texts, one row each."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for row, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass")
        b = np.frombuffer(raw, np.uint8).astype(np.uint32)
        if len(b) > 1:
            pair = ((b[:-1] * 256 + b[1:]) * np.uint32(2654435761)) >> np.uint32(22)
            out[row, :PAIRS] = np.bincount(pair, minlength=PAIRS)
        for i, share in enumerate(_shape(text, raw)):
            # Two neighbouring steps share the weight, so near values have near vectors.
            at = min(max(share, 0.0), 1.0) * (STEPS - 1)
            low = min(int(at), STEPS - 2)
            first = PAIRS + i * STEPS + low
            out[row, first] += SHAPE_WEIGHT * (low + 1 - at)
            out[row, first + 1] += SHAPE_WEIGHT * (at - low)
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of damped counts by inverse document frequency; byte pairs and shapes weigh the same in all."""
    x = counts.copy()
    x[:, :PAIRS] = np.log1p(x[:, :PAIRS]) * idf[:PAIRS]
    for part in (slice(0, PAIRS), slice(PAIRS, TERMS)):
        x[:, part] /= np.maximum(np.linalg.norm(x[:, part], axis=1, keepdims=True), 1e-12)
    return x


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of ``docs`` and, per term, those that hold it; a vector per task is summed by Spark."""

    def count(batches):
        total, frequency = 0, np.zeros(TERMS, np.int64)
        for batch in slices(batches, BLOCK):
            x = terms(strings(batch.column(0)))
            total += len(x)
            frequency += (x > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS + 1, dtype=np.int32)), pa.array(np.append(frequency, total))], names=["term", "n"]
        )

    each = docs.select(text_of(docs).alias("text")).mapInArrow(count, "term int, n long")
    found = {r["term"]: r["n"] for r in each.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    frequency = np.array([found.get(i, 0) for i in range(TERMS)], np.float64)
    return found.get(TERMS, 0), frequency


def labelled_vectors(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term counts and labels of at most ``sample`` labelled rows, and the label counts ``[n0, n1]`` of all.

    Of each label the ids with the smallest hashes are taken, half of the sample at most; of several rows of an id,
    one.
    """
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    totals = np.array([sizes.get(0, 0), sizes.get(1, 0)], np.float64)
    halves = [
        known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for q in (0, 1)
    ]
    chosen = halves[0].unionByName(halves[1])
    picked = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", text_of(docs).alias("text"))

    def vectors(batches):
        for batch in slices(batches, BLOCK):
            x = terms(strings(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([row.tobytes() for row in x], pa.binary())],
                names=["doc_id", "quality", "x"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in picked.schema}
    found = picked.mapInArrow(vectors, f"doc_id {kinds['doc_id']}, quality {kinds['quality']}, x binary")
    # One vector an id in each task, and then in all: what comes to the driver is bounded by the sample.
    one = found.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect()
    rows = sorted(one, key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float32).reshape(len(rows), TERMS)
    return x, np.array([r["quality"] for r in rows], np.float64), totals


class Neighbours:
    """Projection and labelled latent vectors; votes of the nearest ones."""

    def __init__(self, counts: np.ndarray, quality: np.ndarray, totals: np.ndarray, n: int, frequency: np.ndarray):
        self.idf = (np.log((n + 1) / (frequency + 1)) + 0.1).astype(np.float32)
        x = weighted(counts, self.idf)
        _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
        self.projection = np.ascontiguousarray(vectors[:, ::-1][:, :LATENT]).astype(np.float32)
        self.latent = self._unit(x @ self.projection)
        self.quality = quality.astype(np.float32)
        # Each label has the same vote in all, however many rows it has.
        held = np.array([(quality == 0).sum(), (quality == 1).sum()], np.float64)
        self.weight = (1 / np.maximum(np.where(quality == 1, held[1], held[0]), 1) * len(quality)).astype(np.float32)
        self.prior = float(totals[1] / totals.sum()) if totals.sum() else 0.5
        self.cut = self._best_cut()

    def _best_cut(self) -> float:
        """Where to cut the labelled rows' shares of good votes, each without its own, for the fewest errors of both
        labels (weighed alike); 0.5 without both labels."""
        if len(np.unique(self.quality)) < 2:
            return 0.5
        shares = np.concatenate(
            [self._shares(self.latent[i : i + BLOCK], np.arange(i, min(i + BLOCK, len(self.latent))))
             for i in range(0, len(self.latent), BLOCK)]
        )
        order = np.argsort(shares, kind="stable")
        good = self.quality[order] == 1
        missed = np.cumsum(good) / good.sum()  # good rows below the cut
        passed = 1 - np.cumsum(~good) / (~good).sum()  # bad rows above it
        at = shares[order]
        error = np.where(np.append(at[1:] > at[:-1], False), missed + passed, 9)
        best = np.flatnonzero(error <= error.min() + 1e-12)
        cuts = (at[best] + at[np.minimum(best + 1, len(at) - 1)]) / 2
        return float(np.clip(np.median(cuts), 0.02, 0.98))

    def _shares(self, z: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Share of good votes among the nearest labelled vectors; ``own`` are the rows' own places among them."""
        cosine = z @ self.latent.T
        if own is not None:
            cosine[np.arange(len(own)), own] = -1
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        vote = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** SHARPNESS * self.weight[near]
        total = vote.sum(axis=1)
        good = (vote * self.quality[near]).sum(axis=1)
        return np.clip(np.where(total > 1e-9, good / np.maximum(total, 1e-9), self.prior), 0, 1)

    @staticmethod
    def _unit(z: np.ndarray) -> np.ndarray:
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Shares of good votes, stretched so that the cut lies at ``THRESHOLD``."""
        if not len(self.latent):
            return np.full(len(texts), self.prior)
        share = self._shares(self._unit(weighted(terms(texts), self.idf) @ self.projection))
        below = share / self.cut * THRESHOLD
        above = THRESHOLD + (share - self.cut) / (1 - self.cut) * (1 - THRESHOLD)
        return np.clip(np.where(share < self.cut, below, above), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Neighbours:
    """A classifier from the rows of ``docs`` (``doc_id, text``) with ``labels`` (``doc_id, quality``)."""
    n, frequency = document_frequencies(docs)
    return Neighbours(*labelled_vectors(docs, labels, sample), n, frequency)


def score(docs: DataFrame, model: Neighbours) -> DataFrame:
    """``doc_id, score`` of every row."""
    shared = share(docs.sparkSession, model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def vote(batches):
        voters = shared()
        for batch in slices(batches, BLOCK):
            found = voters.scores(strings(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.astype(np.float64))], names=["doc_id", "score"]
            )

    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(vote, f"doc_id {kind}, score double")


def op5_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document; labels of held-out ids are not looked at.

    A null text is an empty one; repeated rows are scored each; of contradicting labels the smallest counts; without
    labels every score is 0.5; no documents give no rows. A null id has no label and is not held out.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
