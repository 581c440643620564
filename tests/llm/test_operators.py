"""Every operator's query on hostile tables, against plain Python; and on empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockwright.llm import chat_format, decontaminate, jaccard_join, license_scan, packing, substring_dedup
from stockwright.llm.queries import ORACLES, QUERIES
from tests.llm import brute, data


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = data.documents()
    for name, rows, schema in (
        ("documents", docs, data.DOCUMENTS),
        ("benchmark", data.benchmark(docs), data.BENCHMARK),
        ("labels", data.labels(docs), data.LABELS),
        ("conversations", data.conversations(), data.CONVERSATIONS),
    ):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
        spark.createDataFrame([], schema).write.parquet(f"{folder}/empty/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def docs():
    return [(r[0], r[1]) for r in data.documents()]


@pytest.fixture(scope="module")
def results(spark, tables):
    """Rows of a query, run once."""
    done = {}

    def rows(name):
        if name not in done:
            done[name] = QUERIES[name](spark, tables).collect()
        return done[name]

    return rows


def bag(rows, *names):
    return Counter(tuple(r[n] for n in names) for r in rows)


def test_one_query_of_each_number():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tables, name):
    rows = QUERIES[name](spark, f"{tables}/empty").collect()
    assert len(rows) == (1 if name.startswith("op10") else 0)


def test_license_base(results, docs):
    want = Counter((d, *brute.licenses(t, license_scan.PHRASES)) for d, t in docs)
    assert bag(results("op1_license_scan"), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want


def test_license_notices(results):
    labels = {r.doc_id: (r.labels, r.score) for r in results("op1_license_scan")}
    notices = {r[0]: r[1] for r in data.documents() if r[1] and data.LICENSE[:20] in r[1]}
    assert notices and all("mit" in labels[d][0].split(",") and labels[d][1] > 0.7 for d in notices)
    assert all(set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} for r in results("op1_license_scan"))


def test_secrets_base(results, docs):
    want = Counter((d, *brute.secrets(t)) for d, t in docs)
    assert bag(results("op2_secrets"), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want


def test_secret_added_kinds(results):
    found = {k for r in results("op2_secrets") for s in r.spans.split(",") if s for k in [s.split(":")[0]]}
    assert {"assign", "access", "hex", "issued", "jwt"} <= found


def test_secret_ownership(spark):
    from stockwright.llm import secrets

    copied, own = "password=hunter2hunter2", "password=q9X2mLp07sTz"
    rows = [(i, copied, f"s{i % 5}") for i in range(10)] + [(20, own, "s1"), (21, own, "s1"), (22, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r.text for r in secrets.redacted(frame).collect()}
    assert all(out[i] == copied for i in range(10))
    assert out[20] == out[21] == secrets.MASK and out[22] is None


def test_secret_verdicts_by_distinct_texts(spark):
    """An example copied through one source, and a secret in copies of one text under several sources."""
    from stockwright.llm import secrets

    example, own = "password=q9X2mLp07sTz", "token: Zk41vB8wQx77aa"
    rows = [(i, f"page {i} says {example}", "s0") for i in range(200)] + [(300 + i, f"deploy {own}", f"s{i}") for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = {r.doc_id: r.text for r in secrets.redacted(frame).collect()}
    assert all(out[i] == f"page {i} says {example}" for i in range(200))
    assert all(out[300 + i] == f"deploy {secrets.MASK}" for i in range(3))


def test_secret_counts_by_hand(results):
    from stockwright.llm import secrets

    held, spans, holders = {}, {}, {}
    for k, r in enumerate(data.documents()):
        spans[k] = secrets.spans_of(r[1] or "")
        for value in {s[3] for s in spans[k]}:
            owner = (r[3] is not None, r[3] or "")
            texts = held.setdefault(value, {})
            texts[r[1]] = min(owner, texts.get(r[1], owner))
            holders.setdefault(value, set()).add(owner)
    want = Counter()
    for k, r in enumerate(data.documents()):
        live = [
            len(set(held[v].values())) <= 2 and len(held[v]) <= 5 and len(holders[v]) <= 4 and secrets.entropy(v) >= 2.5
            for *_, v in spans[k]
        ]
        want[r[0], sum(live), ",".join(f"{kind}:{a}:{b}" for a, b, kind, _ in spans[k])] += 1
    assert bag(results("op2_secrets"), "doc_id", "n_live", "spans") == want


def test_substrings(results, docs):
    unique = dict(docs)
    want = brute.substrings([(-(2**63) if d is None else d, t) for d, t in unique.items()], 100)
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in results("op3_substring_dedup")}
    assert got == {(None if d == -(2**63) else d, *v) for d, v in want.items()}
    assert len(results("op3_substring_dedup")) == len(docs)


def test_substrings_of_a_large_core(spark, monkeypatch):
    """A core with more members than one task may refine takes the other way to the same result."""
    line = "".join(chr(97 + (i * i * 7 + i) % 26) for i in range(95))
    rows = []
    for i in range(300):
        rows.append((i, f"{i % 9}{'ab'[i % 2]}{i:07d}" + line + f"{i:07d}" if i % 3 else f"{i % 4}tail{line}{i % 4}tail"))
    want = brute.substrings(rows, 100)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for most, refined in ((2_000_000, 100_000), (5, 8)):
        monkeypatch.setattr(substring_dedup, "REFINED", refined)
        out = substring_dedup.deduplicated(frame, most=most).collect()
        got = {r.doc: (r.n_bytes, sum(x["size"] for x in r.removed), len(r.removed), r.sha256) for r in out}
        assert got == want


def test_language_model_base(results, docs):
    want = Counter(brute.base_scores(docs))
    got = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in results("op4_suffix_tree_lm")
    )
    assert got == want


def test_language_model_scores(results, docs):
    """The same scores from a tree of plain dictionaries; rows of one id may differ."""
    want = Counter()
    trains = [not brute.held_out(d, 7, 2) for d, _ in docs]
    for (doc, _), tokens in zip(docs, brute.suffix_tree_scores([t for _, t in docs], trains)):
        want[doc, round(sum(tokens), 6)] += 1
    assert Counter((r.doc_id, round(r.score, 6)) for r in results("op4_suffix_tree_lm")) == want


def test_language_model_of_many_chunks(spark, monkeypatch):
    """Small chunks and ranges give the scores of the plain tree, with contexts of more than two words."""
    import random

    from stockwright.llm import suffix_tree_lm as lm

    rng = random.Random(3)
    texts = [" ".join("abcd"[rng.randrange(4)] for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["x a b c d y"] * 40 + ["z a b c d w"] * 40 + ["", None] + [" ".join("pqr"[i % 3] for i in range(500))] * 3
    monkeypatch.setattr(lm, "CHUNK", 300)
    monkeypatch.setattr(lm, "RANGE", 200)
    trains = [i % 5 != 0 for i in range(len(texts))]
    frame = spark.createDataFrame(list(zip(range(len(texts)), texts, trains)), "i long, text string, t boolean")
    out = {r.i: r for r in lm.scored(frame.repartition(3), F.col("t"), ("i",), tokens=True).collect()}
    want = brute.suffix_tree_scores(texts, trains)
    assert len(out) == len(texts)
    for i, tokens in enumerate(want):
        assert out[i].n_tokens == len(tokens)
        assert max(abs(x - y) for x, y in zip(out[i].token_scores, tokens)) < 1e-9
        assert abs(out[i].score - sum(tokens)) < 1e-6
    # What follows "d" is only known from the word four places before it.
    assert out[61].token_scores[5] > -0.2 and out[101].token_scores[5] > -0.2


def test_language_model_reads_its_chunks_a_few_times(spark, monkeypatch):
    """Long contexts take many rounds; those that look at few places go on from what the last one wrote."""
    import random

    from stockwright.llm import suffix_tree_lm as lm

    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(2000)}" for _ in range(100)) for _ in range(40)]
    texts += [f"x{i % 2} " + "a " * 12 + f"y{i % 2}" for i in range(60)]
    trains = [i % 5 != 0 for i in range(len(texts))]
    frame = spark.createDataFrame(list(zip(range(len(texts)), texts, trains)), "i long, text string, t boolean")
    staged, stage = [], lm.stage

    def noting(rows, purpose):
        staged.append(any("/chunks-" in f for f in rows.inputFiles()))
        return stage(rows, purpose)

    monkeypatch.setattr(lm, "stage", noting)
    out = {r.i: r for r in lm.scored(frame.repartition(3), F.col("t"), ("i",), tokens=True).collect()}
    assert len(staged) > 8 and sum(staged) <= 6
    for i, tokens in enumerate(brute.suffix_tree_scores(texts, trains)):
        assert max(abs(x - y) for x, y in zip(out[i].token_scores, tokens, strict=True)) < 1e-9
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("chunks_", "grams_"))]


def test_language_model_of_chunks_with_a_single_gram(spark):
    """A chunk may write down one gram only, and goes on from it like any other."""
    import random

    from stockwright.llm import suffix_tree_lm as lm

    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(2000)}" for _ in range(100)) for _ in range(40)]
    texts += [f"x{i % 2} " + "a " * 12 + f"y{i % 2}" for i in range(60)]
    many = len(texts)
    texts += [f"q{n}" + " a" * n for n in range(2, 7)]  # one place at contexts of n words
    rows = [(i, t, i % 5 != 0) for i, t in enumerate(texts)]
    parts = [rows[:many], *([r] for r in rows[many:])]
    split = spark.sparkContext.parallelize(parts, len(parts)).flatMap(list)
    frame = spark.createDataFrame(split, "i long, text string, t boolean")
    out = {r.i: r for r in lm.scored(frame, F.col("t"), ("i",), tokens=True).collect()}
    for i, tokens in enumerate(brute.suffix_tree_scores(texts, [t for *_, t in rows])):
        assert max(abs(x - y) for x, y in zip(out[i].token_scores, tokens, strict=True)) < 1e-9


def test_packed_numbers_can_be_changed():
    """Whatever their number, the unpacked ones are no view of the packed bytes."""
    import numpy as np

    from stockwright.llm import suffix_tree_lm as lm

    for numbers in ([], [7], [-1, 1 << 40], list(range(300))):
        got = lm._unpack(lm._pack(np.array(numbers, np.int64)), len(numbers))
        assert got.tolist() == numbers and got.flags.writeable


def test_language_model_is_a_distribution(spark):
    """The probabilities of all words after each history sum to at most one, and training texts gain."""
    from stockwright.llm import suffix_tree_lm as lm

    rows = [(i, " ".join("ab"[(i + j) % 2] + str(j % 3) for j in range(40)), True) for i in range(200)]
    words = ["a0", "a1", "a2", "b0", "b1", "b2"]
    histories = ["", "a0 ", "a0 b1 ", "a0 b1 a2 b0 ", "zz "]
    asked = [(-1 - i, h + w, False) for i, (h, w) in enumerate((h, w) for h in histories for w in words)]
    asked += [(-1000 - i, h, False) for i, h in enumerate(histories)]  # ends after each history
    frame = spark.createDataFrame(rows + asked, "i long, text string, t boolean")
    out = {r.i: r for r in lm.scored(frame, F.col("t"), ("i",), tokens=True).collect()}
    for i, history in enumerate(histories):
        at = len(history.split())
        alone = [10 ** out[-1 - i * len(words) - j].token_scores[at] for j in range(len(words))]
        assert 0 < sum(alone) + 10 ** out[-1000 - i].token_scores[at] <= 1.0001
    assert out[0].score > out[0].base_score + 0.2 * out[0].n_tokens


def test_language_model_keeps_what_it_learned(spark):
    """A phrase seen three times stays learned when other text is added."""
    import random

    from stockwright.llm import suffix_tree_lm as lm

    rng = random.Random(5)
    phrase = "osprey glides over quiet water"
    noise = [" ".join(f"w{int(rng.paretovariate(0.4)) % 3000}" for _ in range(1000)) for _ in range(150)]
    asked = [(-1, phrase, False), (-2, "zz osprey w1", None)]
    for texts in ([phrase] * 3 + noise[:2], [phrase] * 3 + noise):
        rows = [(i, t, True) for i, t in enumerate(texts)] + asked
        frame = spark.createDataFrame(rows, "i long, text string, t boolean").repartition(4)
        out = {r.i: r for r in lm.scored(frame, F.col("t"), ("i",)).collect()}
        assert out[-1].score > out[-1].base_score + 2


def test_quality_scores(results, docs):
    rows = results("op5_neighbour_quality")
    assert bag(rows, "doc_id", "held_out") == Counter((d, brute.held_out(d, 5, 0)) for d, _ in docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    label = {d: q for d, q, _ in data.labels(data.documents()) if q is not None}
    seen = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert len(seen) > 10 and sum(p == q for p, q in seen) >= 0.85 * len(seen)


def test_quality_votes_by_hand(spark, docs):
    """Each score from all cosines, sorted, in plain loops; an id with many rows is one labelled vector."""
    import numpy as np

    from stockwright.llm import neighbour_quality as nq

    rows = [*docs, *[(6, docs[6][1])] * 50, *[(6, docs[7][1])] * 50]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([r for r in data.labels(data.documents()) if r[0] is not None], data.LABELS)
    model = nq.fit(frame, labels)
    known = {d: q for d, q, _ in data.labels(data.documents()) if d is not None and q is not None and d in dict(docs)}
    assert len(model.quality) == len(known)
    weight = {q: len(model.quality) / max((model.quality == q).sum(), 1) for q in (0, 1)}
    got = {}
    for r in nq.score(frame, model).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    for doc, text in docs[:40]:
        z = nq.weighted(nq.terms([text or ""]), model.idf)[0] @ model.projection
        z = z / max(np.linalg.norm(z), 1e-12)
        near = sorted(((float(v @ z), q) for v, q in zip(model.latent, model.quality)), reverse=True)[: nq.NEIGHBOURS]
        votes = [(max(c, 0) ** nq.SHARPNESS * weight[int(q)], q) for c, q in near]
        total = sum(v for v, _ in votes)
        share = sum(v * q for v, q in votes) / total if total > 1e-9 else model.prior
        low = share < model.cut
        want = share / model.cut * nq.THRESHOLD if low else nq.THRESHOLD + (share - model.cut) / (1 - model.cut) * (1 - nq.THRESHOLD)
        assert min(abs(s - want) for s in got[doc]) < 1e-4


def test_overlaps(results, docs):
    split = [("" if i is None else str(i), t or "") for i, t, _ in data.benchmark(data.documents())]
    want = Counter()
    for doc, text in docs:
        n, hit, owners = decontaminate.plain_overlap(text or "", split)
        want[doc, n, hit, len(owners), decontaminate.items_digest(owners), hit > 0] += 1
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert bag(results("op6_decontaminate"), *names) == want


def test_overlaps_of_a_benchmark_in_groups(spark, tables, monkeypatch):
    """A benchmark above the bound of one automaton finds what one automaton for all of it finds."""
    docs, items = (spark.read.parquet(f"{tables}/{n}.parquet") for n in ("documents", "benchmark"))

    def found():
        names = ("doc_id", "n_words", "spans", "byte_spans", "items")
        rows = decontaminate.overlaps(docs, items, keep=("doc_id",)).collect()
        return Counter(tuple(str(r[n]) for n in names) for r in rows), decontaminate.decontaminated(docs, items)

    want, kept = found()
    longest = max(len((r.text or "").split()) for r in items.collect())
    for most in (12, longest - 1):
        monkeypatch.setattr(decontaminate, "MOST_ITEM_WORDS", most)
        assert len(list(decontaminate.item_groups(items))) > 1
        got, rest = found()
        assert got == want
        assert Counter(map(str, rest.collect())) == Counter(map(str, kept.collect()))
    assert sum(bool(k[4] != "[]") for k in want) > 3


def test_quality_counts(results, docs):
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert bag(results("op7_quality_rules"), *names) == Counter((d, *brute.quality(t)) for d, t in docs)
    assert not any(r.kept and r.base_failed for r in results("op7_quality_rules"))


def test_quality_rules_learned(spark):
    from stockwright.llm import quality_rules as rules

    rows = [(float(i % 10) / 10, 0.1 * (i % 7), i % 10 >= 7 and i % 7 < 3, i % 3 != 0) for i in range(2100)]
    frame = spark.createDataFrame(rows, "symbols_per_word double, capitals double, bad boolean, grow boolean")
    for m in rules.MEASURES:
        if m not in frame.columns:
            frame = frame.selectExpr("*", f"0.5D AS {m}")
    found = rules.learn(frame)
    assert [{c.measure for c in rule} for rule in found] == [{"symbols_per_word", "capitals"}]
    verdict = rules.verdict(found, {m: frame[m] for m in rules.MEASURES})
    assert frame.where(verdict.isNotNull() != frame["bad"]).count() == 0
    assert rules.learn(frame.where("bad")) == [] == rules.learn(frame.limit(0))


def test_links(results, docs):
    unique = {d: t for d, t in docs if d is not None}
    want = brute.linked(unique.items(), 4, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in results("op8_jaccard_join") if r.doc_id is not None}
    assert got == want and len(results("op8_jaccard_join")) == len(docs)
    assert len({c for _, c in want.values()}) < len(want)


@pytest.mark.parametrize("width, percent", [(5, 80), (2, 50), (1, 34)])
def test_links_at_other_bounds(spark, docs, width, percent):
    few = [(d, t) for d, t in {d: t for d, t in docs if d is not None}.items() if not t or len(t) < 5000]
    frame = spark.createDataFrame(few, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(frame, width, percent).collect()}
    assert got == brute.linked(few, width, percent)


def test_components_of_a_chain(spark):
    from stockwright.llm.components import components

    links = [(i + 1, i) for i in range(60)] + [(100, 101), (102, 101), (101, 100), (7, 7)]
    out = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}


def test_packing(results, docs):
    import zlib

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = results("op9_packing")
    want = Counter()
    for doc, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_OF_TEXT]
        for start in range(0, len(ids), packing.SEQUENCE):
            part = ids[start : start + packing.SEQUENCE]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            want[doc, start, len(part), crc, len(ids)] += 1
    assert bag(rows, "doc_id", "start", "length", "ids_crc32", "doc_tokens") == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    assert sorted(sequences) == list(range(len(sequences)))


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_added_tokens(file):
    import os

    from tokenizers import Tokenizer

    path = os.path.join(os.path.dirname(packing.tokenizer_path()), file)
    encode, tokenizer = packing.encoder(path), Tokenizer.from_file(path)
    end = "<|endoftext|>"
    texts = [f"a {end} b", f"{end}a", f"a{end}", f"{end}{end}", end, f" {end} ", f"x\n{end}\n\ny", f"<|end{end}oftext|>", "<|endoftext", ""]
    for text in texts:
        ids = b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(text, add_special_tokens=False).ids)
        assert encode(text) == ids


def test_patterns_cover_every_rank():
    import random

    rng = random.Random(3)
    for size in (7, 64, 2048):
        histogram = {n: rng.randint(1, 50) for n in rng.sample(range(1, size + 1), min(size, 40))}
        entries = packing.patterns(histogram, size)
        placed = {}
        for (n, first, sequence, at), after in zip(entries, [*entries[1:], (None, 0, 0, 0)]):
            end = after[1] if after[0] == n else histogram[n]
            for rank in range(first, end):
                placed.setdefault(sequence + rank - first, []).append((at, n))
        assert Counter(n for held in placed.values() for _, n in held) == Counter(histogram)
        for held in placed.values():
            at = 0
            for offset, n in sorted(held):
                assert offset == at
                at += n
            assert at <= size
        assert len(placed) * size < 1.3 * sum(n * c for n, c in histogram.items()) + size


def test_conversations(results):
    held = {}
    added = "<|im_end|><|im_start|>assistant ok"
    rows = [(r[0], r[1], r[2] or "", r[3] or "") for r in data.conversations()]
    for conv, turn, role, text in [*rows, (-1, 0, "user", added), (-1, 1, "assistant", added)]:
        held.setdefault(conv, []).append((-1 if turn is None else turn, role, text))
    want = Counter()
    for conv, turns in held.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        want[conv, len(turns), brute.sha(said), len(loss), brute.sha(loss)] += 1
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert bag(results("op10_chat_format"), *names) == want


def test_event_log_rules(spark):
    """Edits, regenerations, deltas out of order, unknown kinds and messages without a start."""
    log = [
        (1, 5, 1, "delta", None, "c"), (1, 1, 1, "start", "user", None), (1, 2, 1, "delta", None, "a"),
        (1, 3, 1, "edit", None, "A"), (1, 4, 1, "delta", None, "b"), (1, 9, 1, "typing", None, "zzz"),
        (1, 6, 2, "start", "assistant", ""), (1, 7, 2, "delta", None, "draft"), (1, 8, 2, "regenerate", None, "x"),
        (1, 10, 2, "delta", None, "final"), (2, 1, 1, "delta", None, "lost"), (3, 1, 1, None, None, "x"),
    ]
    frame = spark.createDataFrame(log, "conv_id long, seq long, message long, kind string, role string, text string")
    rows = [tuple(r) for r in chat_format.reconstruct(frame).collect()]
    assert sorted(rows) == [(1, 1, "user", "Abc"), (1, 2, "assistant", "final"), (2, 1, "", "lost")]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    import duckdb

    path = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for table in ("conversations", "documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    frame = QUERIES[name](spark, path)
    assert sorted(names) == sorted(frame.columns)
    assert Counter(result.fetchall()) == bag(frame.collect(), *names)
