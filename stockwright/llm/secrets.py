"""Secret scans: candidates of every text, judged by who else owns them in the whole corpus.

A task scans texts and emits spans with a hash of the secret value. Distinct (hash, owner, repository) rows are counted
over the corpus: a value that many owners or many distinct texts hold is an example somebody copied, another one looks live. The
verdict goes back to the spans. Distinct rows and their counts are partial sums before each shuffle, so a value that a
third of all texts hold is no heavy key; the join of spans with the counts has one row per value on the other side, and
Spark splits its large partitions (AQE skew join).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwright.llm.common import slices, strings, table, text_of
from stockwright.sources.tables import stage

# Base kinds, in the order in which spans of one start are listed.
BASE = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
        ),
        2,
        12,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
# Kinds added to them: formats of issued keys.
ADDED = {
    "issued": (
        re.compile(
            r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
        ),
        0,
        1,
    ),
    "jwt": (re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 1),
    "private_key": (
        re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----"),
        0,
        1,
    ),
}
KINDS = [*BASE, *ADDED]

# A text without any of these (lower-cased) bytes holds no span of the kind.
SIGNS = {
    "assign": (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
    "access": (b"akia",),
    "issued": (b"gh", b"xox", b"sk_live_", b"aiza"),
    "jwt": (b"eyj",),
    "private_key": (b"-----begin",),
}
_HEX = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))

MOST_OWNERS = 2  # a value of more owners is an example,
MOST_REPOSITORIES = 5  # and so is one of more distinct texts,
MOST_HOLDERS = 4  # or one that more owners hold, though all in copies of one text
LEAST_ENTROPY = 2.5  # bits per character; below, a value is a placeholder


def spans_of(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, value)`` in code points, by start and then kind; leftmost and non-overlapping per kind."""
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    found = []
    for number, kind in enumerate(KINDS):
        if kind == "hex":
            if b"x" * 16 not in raw.translate(_HEX):
                continue
        elif not any(sign in low for sign in SIGNS[kind]):
            continue
        pattern, group, least = BASE.get(kind) or ADDED[kind]
        for match in pattern.finditer(text):
            if len(match[group]) >= least:
                found.append((match.start(), number, match.end(), kind, match[group]))
    return [(start, end, kind, value) for start, _, end, kind, value in sorted(found)]


def entropy(value: str) -> float:
    """Bits per character by the value's own character counts."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


SPAN = "struct<start:int,end:int,kind:string,value:string,random:boolean>"


def scan(docs: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """Kept columns and ``spans`` of every row: start, end, kind, hash of the value, whether it looks random."""
    kept = docs.select(*keep, text.alias("_text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema if f.name != "_text")
    item = pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string()),
         ("random", pa.bool_())]
    )

    def read(batches):
        for batch in slices(batches):
            out = []
            for text in strings(batch.column(batch.num_columns - 1)):
                out.append(
                    [
                        {
                            "start": start,
                            "end": end,
                            "kind": kind,
                            "value": hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()[:32],
                            "random": entropy(value) >= LEAST_ENTROPY,
                        }
                        for start, end, kind, value in spans_of(text)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.list_(item))], names=[*batch.schema.names[:-1], "spans"]
            )

    return kept.mapInArrow(read, f"{fields}spans array<{SPAN}>")


def ownership(scanned: DataFrame) -> DataFrame:
    """``value, n_owners, n_repositories, n_holders`` over all rows ``(spans, owner, repository)``.

    A repository is a distinct text; equal texts under several owners are copies of the least owner's (a null owner is one
    like others, the least). So a few copies of one document do not make an example. Holders are all owners, copies or not.
    """
    held = scanned.select("owner", "repository", F.explode("spans").alias("span"))
    held = held.select("repository", F.col("span.value").alias("value"), F.struct("owner").alias("owner"))
    first = held.groupBy("value", "repository").agg(F.min("owner").alias("owner"))
    by_owner = first.groupBy("value", "owner").agg(F.count("*").alias("n"))
    owned = by_owner.groupBy("value").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))
    holders = held.select("value", "owner").distinct().groupBy("value").agg(F.count("*").alias("n_holders"))
    return owned.join(holders, "value")


def judged_spans(
    scanned: DataFrame, most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES
) -> DataFrame:
    """One row per row id that has spans: ``_id`` and ``judged``, its spans with owners, repositories and ``live``."""
    order = F.create_map(*[x for n, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(n))])
    each = scanned.where(F.size("spans") > 0).select("_id", F.explode("spans").alias("span"))
    each = each.select("_id", "span", F.col("span.value").alias("value")).join(ownership(scanned), "value")
    few = (F.col("n_owners") <= most_owners) & (F.col("n_repositories") <= most_repositories)
    few &= F.col("n_holders") <= MOST_HOLDERS
    return each.groupBy("_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("span.start").alias("start"),
                    order[F.col("span.kind")].alias("order"),
                    F.col("span.end").alias("end"),
                    F.col("span.kind").alias("kind"),
                    "n_owners",
                    "n_repositories",
                    (few & F.col("span.random")).alias("live"),
                )
            )
        ).alias("judged")
    )


def listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans and verdicts of every document; owners are sources, repositories distinct texts.

    A null text is empty, null sources are one owner, repeated rows are scanned each (one repository together), no
    documents give no rows. A span covers the whole match.
    """
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "source", text_of(docs).alias("text"))
    kept = [
        F.monotonically_increasing_id().alias("_id"),
        F.col("doc_id"),
        F.col("source").alias("owner"),
        F.xxhash64("text").alias("repository"),
    ]
    scanned = stage(scan(docs, F.col("text"), kept), "spans")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    verdict = judged_spans(scanned).select(
        "_id",
        F.size(F.filter("judged", lambda s: s["live"])).cast("long").alias("n_live"),
        F.array_max(F.transform("judged", lambda s: s["n_owners"])).alias("most_owners"),
        F.array_max(F.transform("judged", lambda s: s["n_repositories"])).alias("most_repositories"),
        listed(F.col("judged")).alias("spans"),
    )
    own = scanned.select("_id", "doc_id", *map(count, BASE), F.sha2(listed(base), 256).alias("base_sha256"))
    return own.join(verdict, "_id", "left").select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0).cast("long")).alias("n_live"),
        "most_owners",
        "most_repositories",
    )


MASK = "[secret]"


def redacted(docs: DataFrame, owner: str = "source") -> DataFrame:
    """``docs`` with every live-looking secret value's span replaced by ``MASK``; same rows and columns.

    Spans that overlap become one. ``n_chars``, where there is such a column, is counted anew in changed rows. Copied
    examples stay.
    """
    columns = docs.columns
    row = docs.select(F.struct("*").alias("_row"))
    kept = [
        F.monotonically_increasing_id().alias("_id"),
        F.col("_row"),
        F.col(f"_row.`{owner}`").cast("string").alias("owner"),
        F.xxhash64("_row.text").alias("repository"),
    ]
    scanned = stage(scan(row, F.coalesce(F.col("_row.text"), F.lit("")), kept), "spans")
    live = judged_spans(scanned).select(
        "_id", F.transform(F.filter("judged", lambda s: s["live"]), lambda s: F.struct(s["start"], s["end"])).alias("cut")
    )
    touched = scanned.where(F.size("spans") > 0).join(live, "_id", "left")
    masked = touched.select("_row", F.col("_row.text").alias("_text"), F.to_json("cut").alias("_cut"))
    row_type = masked.schema["_row"].dataType.simpleString()

    def mask(batches):
        import json

        for batch in slices(batches):
            texts = []
            for text, cut in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts, at = [], 0
                for span in json.loads(cut or "[]"):
                    start, end = list(span.values())
                    if start >= at:
                        parts += [text[at:start], MASK]
                    at = max(at, end)
                texts.append("".join([*parts, text[at:]]) if text is not None else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["_row", "_text"]
            )

    done = masked.mapInArrow(mask, f"_row {row_type}, _text string")
    changed = {"text": F.col("_text")}
    if "n_chars" in columns:
        n_chars = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("_text") == F.col("_row.text"), F.col("_row.n_chars")).otherwise(
            F.length("_text").cast(n_chars)
        )
    done = done.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns])
    clean = scanned.where(F.size("spans") == 0).select("_row.*")
    return clean.unionByName(done)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with live-looking secrets masked; owners are sources.

    Null texts stay null, null sources are one owner, repeated rows are masked alike, no documents give no rows.
    """
    return redacted(docs)
