"""Merkle manifest, personal data and ranked search against plain Python, on hostile tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockwright.llm import merkle_manifest, personal_data, ranked_search
from stockwright.llm.queries import QUERIES
from tests.llm import data

PERSONAL = [
    "write to ann.b+c@mail.example.co.uk, or a@b, a@@b.c, x@y.z@w.v and .@-.-",
    "hosts 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.02.255.0 1.2.3 and 999999999999.1.1.1 9.9.9.9999999999999999999999",
    "cards 4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111 0000000000000000000 00000000000000000000 5",
    "call +1 (974) 555-3436 or +49 30 1234567. +1 +12 +123 (974) 555-3436 then +1234567890123456 or +1...........2",
    "again (974) 555-3436, 9745553436 andé 4111 1111 1111 1111x😀 +1 (974) 555-3436",
    "1" * 30_000,
    "+1" * 5_000 + "@" * 5_000 + "a" * 20_000,
    "1 " * 20_000,
]


def documents():
    rows = data.documents()
    extra = [(1000 + i, t, "en" if i % 2 else None, f"src{i % 3}", len(t), *data.CLASHES) for i, t in enumerate(PERSONAL)]
    langs = [(2000 + i, f"Row {i} of MANY", f"l{i % 23:02d}é", None, i, *data.CLASHES) for i in range(150)]
    return rows + extra + langs


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(documents(), data.DOCUMENTS)
    docs.repartition(5).write.parquet(f"{folder}/documents.parquet")
    items = spark.createDataFrame(data.benchmark(data.documents()), data.BENCHMARK)
    items.repartition(2).write.parquet(f"{folder}/benchmark.parquet")
    return folder


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text)


# Merkle manifest


def manifest(rows):
    """The contract, word by word, over (doc_id, source, lang, n_chars, text)."""

    def leaf(values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def path(levels, i):
        sides = []
        for level in levels[:-1]:
            start = i // 8 * 8
            sides.append(("".join(level[start:i]), "".join(level[i + 1 : start + 8])))
            i //= 8
        return sides

    groups = {}
    for r in rows:
        groups.setdefault((r[2] is not None, (r[2] or "").encode()), []).append(r)
    trees = []
    for name in sorted(groups):
        held = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((held, tree([leaf(r) for r in held])))
    top = tree([levels[-1][0] for _, levels in trees])
    out = Counter()
    for q, (held, levels) in enumerate(trees):
        for i, r in enumerate(held):
            sides = path(levels, i) + path(top, q)
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf((*r[:4], lower(r[4])))
            for left, right in sides:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in sides))
            out[r[0], leaf(r), levels[-1][0], top[-1][0], proof, node, node == top[-1][0]] += 1
    return out


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest(spark, tables):
    want = manifest([(r[0], r[3], r[2], r[4], r[1]) for r in documents()])
    got = Counter(tuple(r[c] for c in MANIFEST) for r in QUERIES["op11_merkle_manifest"](spark, tables).collect())
    assert got == want
    assert {True, False} == {k[-1] for k in want}


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_manifest_of_small_blocks(spark, tables, levels):
    """Many blocks in ragged trees of very different widths: the exchange gives what one task would."""
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in documents()] + [(i, "s", "zz", 1, "x") for i in range(700)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    own = merkle_manifest.leaf([F.col(c) for c in merkle_manifest.FIELDS])
    found = merkle_manifest.manifest(frame, F.col("lang"), F.col("doc_id"), own, own, levels=levels).collect()
    want = Counter()
    for k, n in manifest(rows).items():
        want[k[:5]] += n
    assert Counter((r.row_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in found) == want
    assert all(r.folded_root == r.root for r in found)


# Personal data

_PATTERNS = [
    re.compile(p)
    for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def base(text):
    out = []
    for kind, pattern in enumerate(_PATTERNS):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if kind == 1 and any(len(p) > 9 and p.strip("0") or int(p[-9:]) > 255 for p in m[0].split(".")):
                continue
            if kind == 2:
                luhn = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
                if not 12 <= len(digits) <= 19 or luhn % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_personal_base(spark, tables):
    rows = QUERIES["op12_personal_data"](spark, tables).collect()
    names = ("n_email", "n_ip", "n_card", "n_phone")
    want = Counter()
    for r in documents():
        # The patterns as they stand are quadratic on the long texts made to be so.
        spans = base(r[1] or "") if len(r[1] or "") < 20_000 else personal_data.base_spans(r[1])
        want[r[0], *[sum(s[1] == k for s in spans) for k in range(4)], sha(listed(spans))] += 1
    assert Counter((r.doc_id, *[r[n] for n in names], r.base_sha256) for r in rows) == want
    texts = {r[0]: r[1] or "" for r in documents()}
    for r in rows:
        if r.doc_id is not None and len(texts[r.doc_id]) < 20_000:
            assert set(listed(base(texts[r.doc_id])).split(",")) <= {*r.spans.split(","), ""}
            assert len([s for s in r.spans.split(",") if s]) == sum(r[n] for n in names) + r.n_added


def test_personal_base_on_random_texts():
    rng = random.Random(11)
    for _ in range(20_000):
        text = "".join(rng.choice("012 3.@+-()a") for _ in range(rng.randint(0, 40)))
        assert personal_data.base_spans(text) == base(text)


def _corpus(spark):
    phones = [f"call +1 ({i % 900 + 100}) 555-{i * 37 % 9000 + 1000} now" for i in range(300)]
    mails = [f"mail user{i}@mail{i % 7}.example.com now" for i in range(100)]
    plain = [f"in {1900 + i % 99} there were {i} of them, part 555-{i}" for i in range(200)]
    rows = [(i, t) for i, t in enumerate([*phones, *mails, *plain])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def _learned(frame):
    return personal_data.learn(personal_data.scan(frame, F.col("text"), [F.col("doc_id")]))


def test_repeated_numbers_are_labelled_alike(spark):
    """The second occurrence lacks what the pattern asks for; its own shape and the first one give it away."""
    model = _learned(_corpus(spark).repartition(3))
    text = "call +1 (974) 555-3436 now. later (974) 555-3436 was asked for 12 of them"
    assert personal_data.masked_text(text, model) == "call [phone] now. later [phone] was asked for 12 of them"
    assert personal_data.masked_text("in 1912 there were 7", model) == "in 1912 there were 7"
    assert personal_data.masked_text("", model) == ""


def test_counts_of_the_pieces(spark):
    """Sums over tasks are the plain counts of labels, neighbours and repeats."""
    frame = _corpus(spark)
    texts = [r.text for r in frame.collect()]
    total = np.zeros(personal_data.COUNTERS, int)
    for t in texts:
        total += personal_data.counts(personal_data.graph([personal_data.tokens_of(t, base(t))]))
    got, want = _learned(frame.repartition(7)), personal_data.Field(total)
    for name in ("shape", "before", "after", "first", "last", "chain", "skip"):
        assert np.array_equal(getattr(got, name), getattr(want, name))
    rows = [r for t in texts for r in personal_data.tokens_of(t, base(t)).tolist()]
    labels = Counter(r[personal_data.LABEL] for r in rows)
    at = personal_data._AT["prior"]
    assert total[at : at + personal_data.LABELS].tolist() == [labels[i] for i in range(personal_data.LABELS)]


def test_messages_give_the_most_probable_labels(spark):
    """On documents whose graph has no cycle, the marginals by enumeration have the same maxima."""
    model = _learned(_corpus(spark))
    texts = [
        "call +1 (974) 555-3436 now", "555-3436 and 12 user1@mail1.example.com 7", "x 555-3436 y z 555-3436 w", "1 2 3 4",
    ]
    for text in texts:
        g = personal_data.graph([personal_data.tokens_of(text, base(text))])
        own, n = model.own(g), len(g.rows)
        marginal = np.full((n, personal_data.LABELS), -np.inf)
        for labels in itertools.product(range(personal_data.LABELS), repeat=n):
            p = sum(own[i, x] for i, x in enumerate(labels))
            p += sum(model.chain[labels[i - 1], labels[i]] for i in g.chain)
            p += sum(model.skip[labels[a], labels[b]] for a, b in g.skip)
            for i, x in enumerate(labels):
                marginal[i, x] = np.logaddexp(marginal[i, x], p)
        assert model.labels(g, 200).tolist() == marginal.argmax(1).tolist()


def test_labels_do_not_depend_on_neighbours(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    model = _learned(docs)
    together, alone = [], []
    for parts, out in ((1, together), (9, alone)):
        scanned = personal_data.scan(docs.repartition(parts), F.coalesce("text", F.lit("")), [F.col("doc_id")])
        out += [tuple(r) for r in personal_data.labelled(scanned, model).collect()]
    assert Counter(together) == Counter(alone)


# Ranked search

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, top=10):
    held = [(d, Counter(lower(w) for w in _TERM.findall(t or ""))) for d, t in docs]
    n_docs, n_words = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = Counter()
    for item, text in items:
        scored = []
        for doc, c in held:
            m = 10 + (90 * sum(c.values()) * n_docs) // max(n_words, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                for w in {lower(w) for w in _TERM.findall(text or "")}
                if w in c
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        for k, (score, known, doc) in enumerate(sorted(scored)[:top]):
            out[item, k + 1, doc if known else None, -score] += 1
    return out


SIZES = [(128, 1_500_000, 65_536, 500_000), (2, 300, 7, 500_000), (3, 2_000, 50, 9)]


@pytest.mark.parametrize("block, words, docs, terms", SIZES)
def test_ranked(spark, tables, monkeypatch, block, words, docs, terms):
    """Also with tiny blocks and shards, so that bounds refuse candidates, and with items in several groups."""
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    monkeypatch.setattr(ranked_search, "SHARD_WORDS", words)
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", docs)
    frame = ranked_search.search
    monkeypatch.setattr(ranked_search, "search", lambda i, q: frame(i, q, most_terms=terms))
    rows = QUERIES["op13_ranked_search"](spark, tables).collect()
    want = ranked([(r[0], r[1]) for r in documents()], [(r[0], r[1]) for r in data.benchmark(data.documents())])
    assert Counter((r.item_id, r.rank, r.doc_id, r.score) for r in rows) == want


@pytest.mark.parametrize("block", [2, 16])
def test_ranked_refuses_blocks(monkeypatch, block):
    """One shard in one process: the same best documents, and blocks that stay packed."""
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    rng = random.Random(5)
    texts = [" ".join(f"w{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    ids = list(range(len(texts)))
    rows = list(ranked_search.index_shard(0, ids, texts))
    df = {r["term"]: r["n_docs"] for r in rows[1:]}
    term = {f"w{k}": int(ranked_search.hashed_terms([f"w{k}"])[1][0]) for k in range(1, 401)}
    n_docs, n_words = rows[0]["n_docs"], rows[0]["n_words"]
    unpacked = 0
    for asked in (["w1", "w2", "w300"], ["w1", "w2", "w3", "w150", "w399", "w90"], ["w400"], ["w7", "w1"], ["none"]):
        found = [(0, h, math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[h] + 1)))) for w in asked if (h := term.get(w)) in df]
        scorer = ranked_search.Scorer(found, n_docs, n_words)
        shard = ranked_search.Shard(scorer, rows[0]["ids"], rows[0]["lengths"])
        for r in rows[1:]:
            if r["term"] in {h for _, h, _ in found}:
                shard.add(*[r[c] for c in ("term", "last", "most_tf", "least_n", "ends", "packed")])
        docs, scores = shard.best(scorer.items.get(0, []), 0, 10) if found else ([], [])
        best = sorted((-int(s), int(d)) for d, s in zip(docs, scores))[:10]
        want = sorted((-s, d) for _, _, d, s in ranked(list(zip(ids, texts)), [(0, " ".join(asked))]))
        assert best == want
        unpacked += len(shard.lists) - len(shard.read)
    assert unpacked > 0


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 300, 2**20, 2**31, 2**40, 5], np.int64)
    packed, ends = ranked_search.pack(values)
    assert ranked_search.unpack(np.frombuffer(packed, np.uint8)).tolist() == values.tolist()
    assert ends[-1] == len(packed)
    assert ranked_search.pack(np.empty(0, np.int64))[0] == b"" and len(ranked_search.unpack(np.empty(0, np.uint8))) == 0
