"""Personal data by patterns and a skip-chain conditional random field.

A task scans texts once. Patterns give the base spans (mail and network addresses, card and phone numbers); every token with
a digit or ``@`` becomes a variable with the labels none, email, ip, card, phone. Tokens without either are fixed to none.
Factors tie a variable to its shape and its neighbour words, to the variable before it in the text, and to the next
occurrence of the same or a similar token (equal letters and digits, or equal digits, five at least) anywhere in the text:
one skip edge per occurrence, so a token that is repeated a thousand times adds a thousand edges, not a million.

The factors are learned in pieces: each is a saturated table whose likelihood is greatest at the counts, and the counts, over all
documents, take the base spans as labels. They are a bounded number of sums (hashed features times labels). Loopy belief
propagation with a fixed number of rounds then labels each document on its own. Runs of labelled tokens that touch no
base span are added spans, such as parts of numbers that no pattern covers but whose repetition elsewhere is known.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwright.llm.common import share, slices, strings, table, text_of
from stockwright.sources.tables import stage

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0 is none
SHAPES, WORDS = 1 << 14, 1 << 12  # hashed features
ROUNDS, DAMPING = 20, 0.5
NEAR = 48  # characters around a token in which its neighbour word is looked for

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only start where a run of digits does; said so, it is found without trying every digit.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_EDGE = ".,;:!?\"'|*&%$#<>[]{}"
_SHAPE = re.compile(r"[0-9]+|[^\W\d_]+")
_PLAIN = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W\d_]+")


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        total += d if place % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)``, by start and kind; leftmost and non-overlapping per kind."""
    if not _SIGN.search(text):
        return []
    found = [(start, 0, end) for start, end in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() and 12 <= len(digits := _digits(m[0])) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _run(match: re.Match) -> str:
    n = len(match[0])
    return (f"9{n if n < 5 else 5 if n < 7 else 7 if n < 10 else 10 if n < 12 else 12 if n < 20 else 20}"
            if match[0][0].isdigit() else "a")


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


# Columns of a token row.
START, END, SHAPE, BEFORE, AFTER, JOINED, LABEL, KEY = range(8)


def tokens_of(text: str, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """A row per variable: span in code points, feature buckets, whether it follows the row before directly, the label
    by the base spans, and a hash of what makes two tokens alike (0: too little to tell)."""
    rows = []
    if _SIGN.search(text):
        last = -1
        ahead = iter(spans)
        open_spans: list[tuple[int, int, int]] = []
        waiting = next(ahead, None)
        for m in _TOKEN.finditer(text):
            token = m[0]
            start = m.start() + len(token) - len(token.lstrip(_EDGE))
            token = token.strip(_EDGE)
            end = start + len(token)
            while waiting and waiting[0] < end:
                open_spans.append(waiting)
                waiting = next(ahead, None)
            open_spans = [s for s in open_spans if s[2] > start]
            label = 1 + min((s[1] for s in open_spans), default=-1)
            before = _WORD.findall(text, max(0, m.start() - NEAR), m.start())
            after = _WORD.search(text, m.end(), m.end() + NEAR)
            digits = _digits(token)
            key = digits if len(digits) >= 5 and "@" not in token else _PLAIN.sub("", token).lower()
            rows.append(
                (
                    start,
                    end,
                    _hash(_SHAPE.sub(_run, token)) % SHAPES,
                    _hash(before[-1].lower()) % WORDS if before else 0,
                    _hash(after[0].lower()) % WORDS if after else 0,
                    int(last >= 0 and (last == m.start() or text[last : m.start()].isspace())),
                    label,
                    0 if len(key) < 3 else _hash(key) | 1 << 32,
                )
            )
            last = m.end()
    return np.array(rows, np.int64).reshape(-1, 8)


@dataclass
class Graph:
    """Variables of several documents with their chain and skip edges."""

    rows: np.ndarray
    chain: np.ndarray  # places of the later variable of each chain edge
    skip: np.ndarray  # pairs of places
    first: np.ndarray  # variables whose left, or right, neighbour is fixed to none
    last: np.ndarray


def graph(parts: list[np.ndarray]) -> Graph:
    rows = np.concatenate(parts) if parts else np.empty((0, 8), np.int64)
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    joined = rows[:, JOINED] == 1
    # Every occurrence of a key in a document to the next one, unless the chain holds the pair already.
    keyed = np.flatnonzero(rows[:, KEY])
    order = keyed[np.lexsort((keyed, rows[keyed, KEY], doc[keyed]))]
    a, b = order[:-1], order[1:]
    alike = (doc[a] == doc[b]) & (rows[a, KEY] == rows[b, KEY]) & ~((b == a + 1) & joined[b])
    ends = np.ones(len(rows), bool)
    ends[np.flatnonzero(joined) - 1] = False
    return Graph(rows, np.flatnonzero(joined), np.stack((a[alike], b[alike]), 1), ~joined, ends)


# Places of the tables in one vector of counts.
_SIZES = {
    "prior": LABELS, "shape": SHAPES * LABELS, "before": WORDS * LABELS, "after": WORDS * LABELS, "first": LABELS,
    "last": LABELS, "chain": LABELS * LABELS, "skip": LABELS * LABELS,
}
_AT = dict(zip(_SIZES, np.cumsum([0, *_SIZES.values()])))
COUNTERS = sum(_SIZES.values())


def counts(g: Graph) -> np.ndarray:
    """Counts of all factor tables under the base labels."""
    label = g.rows[:, LABEL]
    seen = [
        _AT["prior"] + label,
        _AT["shape"] + g.rows[:, SHAPE] * LABELS + label,
        _AT["before"] + g.rows[:, BEFORE] * LABELS + label,
        _AT["after"] + g.rows[:, AFTER] * LABELS + label,
        _AT["first"] + label[g.first],
        _AT["last"] + label[g.last],
        _AT["chain"] + label[g.chain - 1] * LABELS + label[g.chain],
        _AT["skip"] + label[g.skip[:, 0]] * LABELS + label[g.skip[:, 1]],
        _AT["skip"] + label[g.skip[:, 1]] * LABELS + label[g.skip[:, 0]],
    ]
    return np.bincount(np.concatenate(seen), minlength=COUNTERS)


class Field:
    """Log potentials of the factors, from summed counts."""

    def __init__(self, total: np.ndarray):
        def piece(name: str, columns: int) -> np.ndarray:
            return total[_AT[name] : _AT[name] + _SIZES[name]].reshape(-1, columns).astype(float)

        prior = piece("prior", LABELS)[0] + 1
        prior /= prior.sum()

        def given(table: np.ndarray, weight: float) -> np.ndarray:
            return (table + weight * prior) / (table.sum(1, keepdims=True) + weight)

        def tied(name: str) -> np.ndarray:
            pairs = piece(name, LABELS)
            left, right = pairs.sum(1) + 5 * prior, pairs.sum(0) + 5 * prior
            left, right = left / left.sum(), right / right.sum()
            both = (pairs + 5 * np.outer(left, right)) / (pairs.sum() + 5)
            return np.log(both / np.outer(left, right))

        self.shape = np.log(given(piece("shape", LABELS), 1))
        self.before, self.after = (np.log(given(piece(n, LABELS), 20) / prior) for n in ("before", "after"))
        self.first, self.last = (np.log(given(piece(n, LABELS), 5) / prior)[0] for n in ("first", "last"))
        self.chain, self.skip = tied("chain"), tied("skip")

    def own(self, g: Graph) -> np.ndarray:
        """Sum of the log factors of each variable alone."""
        out = self.shape[g.rows[:, SHAPE]] + self.before[g.rows[:, BEFORE]] + self.after[g.rows[:, AFTER]]
        return out + np.where(g.first[:, None], self.first, 0) + np.where(g.last[:, None], self.last, 0)

    def labels(self, g: Graph, rounds: int = ROUNDS) -> np.ndarray:
        """Most probable label of every variable after ``rounds`` of damped message passing.

        All messages of a round are sent from those of the round before, so a document's result does not depend on the
        documents beside it.
        """
        own = self.own(g)
        source = np.concatenate((g.chain - 1, g.chain, g.skip[:, 0], g.skip[:, 1]))
        target = np.concatenate((g.chain, g.chain - 1, g.skip[:, 1], g.skip[:, 0]))
        n, m = len(g.chain), len(g.skip)
        back = np.concatenate((np.arange(n) + n, np.arange(n), np.arange(m) + 2 * n + m, np.arange(m) + 2 * n))
        factors = np.stack((self.chain, self.chain.T, self.skip))
        kind = np.concatenate((np.zeros(n, int), np.ones(n, int), np.full(2 * m, 2)))
        message = np.zeros((len(source), LABELS))

        def belief() -> np.ndarray:
            out = own.copy()
            for label in range(LABELS):
                out[:, label] += np.bincount(target, weights=message[:, label], minlength=len(own))
            return out

        for _ in range(rounds if len(source) else 0):
            rest = belief()[source] - message[back]
            sent = _log_sum(rest[:, :, None] + factors[kind])
            sent -= sent.max(1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * sent
        # Scores that are equal but for rounding count as ties, which the first label wins.
        return np.argmax(np.round(belief(), 9), axis=1)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1)
    return top + np.log(np.exp(x - top[:, None, :]).sum(1))


def added_spans(rows: np.ndarray, labels: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of equally labelled neighbours of one document that overlap no base span, as ``(start, kind, end)``."""
    runs: list[list[int]] = []
    for row, label, before in zip(rows.tolist(), labels.tolist(), [0, *labels.tolist()]):
        if label and row[JOINED] and label == before and runs:
            runs[-1][2] = row[END]
        elif label:
            runs.append([row[START], label - 1, row[END]])
    out, k = [], 0
    covers = _union(base)
    for start, kind, end in runs:
        while k < len(covers) and covers[k][1] <= start:
            k += 1
        if k == len(covers) or covers[k][0] >= end:
            out.append((start, kind, end))
    return out


def _union(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, _, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def scan(docs: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """Kept columns, ``base`` and ``tokens`` of every row, as packed numbers: spans by (start, kind, end), token rows."""
    kept = docs.select(*keep, text.alias("_text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema if f.name != "_text")

    def read(batches):
        for batch in slices(batches):
            base, tokens = [], []
            for text in strings(batch.column(batch.num_columns - 1)):
                spans = base_spans(text)
                base.append(np.array(spans, np.int64).tobytes())
                tokens.append(tokens_of(text, spans).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(base, pa.binary()), pa.array(tokens, pa.binary())],
                names=[*batch.schema.names[:-1], "base", "tokens"],
            )

    return kept.mapInArrow(read, f"{fields}base binary, tokens binary")


def _matrix(packed: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(packed, np.int64).reshape(-1, columns)


def learn(scanned: DataFrame) -> Field:
    """The field of all rows of ``scan``. At most ``COUNTERS`` sums come to the driver."""

    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches):
            total += counts(graph([_matrix(t, 8) for t in batch.column(0).to_pylist()]))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["k", "n"])

    held = scanned.where(F.length("tokens") > 0).select("tokens").mapInArrow(count, "k long, n long")
    sums = held.groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(COUNTERS, np.int64)
    total[sums.column("k").to_numpy()] = sums.column("n").to_numpy()
    return Field(total)


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def labelled(scanned: DataFrame, model: Field) -> DataFrame:
    """Kept columns of ``scan`` with counts and lists of the base spans, all spans, and the number of added ones."""
    kept = [f for f in scanned.schema if f.name not in ("base", "tokens")]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    sent = share(scanned.sparkSession, model)

    def label(batches):
        field = sent()
        for batch in slices(batches):
            parts = [_matrix(t, 8) for t in batch.column(batch.num_columns - 1).to_pylist()]
            labels = field.labels(graph(parts))
            out, at = [], 0
            for packed, rows in zip(batch.column(batch.num_columns - 2).to_pylist(), parts):
                base = list(map(tuple, _matrix(packed, 3).tolist()))
                more = added_spans(rows, labels[at : at + len(rows)], base)
                at += len(rows)
                number = [sum(s[1] == k for s in base) for k in range(len(KINDS))]
                digest = hashlib.sha256(_listed(base).encode()).hexdigest()
                out.append((*number, digest, _listed(sorted(base + more)), len(more)))
            columns = list(zip(*out)) if out else [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], *(pa.array(c, t) for c, t in zip(columns, types))],
                names=[*batch.schema.names[:-2], "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    return scanned.mapInArrow(label, fields + FOUND)


def masked_text(text: str, model: Field) -> str:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the first counts."""
    base = base_spans(text)
    rows = tokens_of(text, base)
    out, at = [], 0
    for start, kind, end in sorted(base + added_spans(rows, model.labels(graph([rows])), base)):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document.

    A null text is empty and has none; repeated rows are scanned, and count for learning, each; without documents there are
    no rows.
    """
    docs = table(spark, sf_dir, "documents")
    scanned = stage(scan(docs, text_of(docs), [docs["doc_id"]]), "personal")
    return labelled(scanned, learn(scanned))
