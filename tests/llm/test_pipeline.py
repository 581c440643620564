"""The pipeline's stages on hostile tables."""

import pytest

import corpus_pipeline
from stockwright.llm import decontaminate
from tests.llm import brute, data


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first and after each stage."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = data.documents()
    for name, rows, schema in (
        ("documents", docs, data.DOCUMENTS),
        ("benchmark", data.benchmark(docs), data.BENCHMARK),
        ("labels", data.labels(docs), data.LABELS),
    ):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    out = [(frame.collect(), frame.dtypes)]
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, frame, folder).write.parquet(f"{folder}/stage{k}.parquet")
        frame = spark.read.parquet(f"{folder}/stage{k}.parquet")
        out.append((frame.collect(), frame.dtypes))
    return out


def test_columns_stay(stages):
    assert all(kinds == stages[0][1] for _, kinds in stages[:-1])


def test_quality(stages):
    before, after = stages[0][0], stages[1][0]
    kept = {r.doc_id for r in after}
    for r in before:
        failed = brute.quality(r.text)[-1]
        junk = any(x in (r.text or "") for x in ("spam spam", "###", "LOUD"))
        assert not (failed and r.doc_id in kept and r.doc_id is not None)
        if junk:
            assert r.doc_id not in kept


def test_near_duplicates(stages):
    before, after = stages[1][0], stages[2][0]
    found = brute.linked({r.doc_id: r.text for r in before if r.doc_id is not None}.items(), 5, 80)
    want = {d for d, (_, component) in found.items() if component == d}
    assert {r.doc_id for r in after if r.doc_id is not None} == want
    assert len(after) == len({tuple(r) for r in after})


def test_decontamination(stages):
    items = [("" if i is None else str(i), t or "") for i, t, _ in data.benchmark(data.documents())]
    before, after = {r.doc_id: r for r in stages[2][0]}, {r.doc_id: r for r in stages[3][0]}
    changed = 0
    for doc, r in before.items():
        n, hit, _ = decontaminate.plain_overlap(r.text or "", items)
        if hit == 0:
            assert after[doc] == r
        elif 2 * hit > n:
            assert doc not in after
        else:
            left = after[doc]
            assert len(brute.words(left.text)) == n - hit and left.n_chars == len(left.text)
            changed += 1
    assert changed


def test_secrets(stages):
    before, after = {r.doc_id: r for r in stages[3][0]}, {r.doc_id: r for r in stages[4][0]}
    assert before.keys() == after.keys()
    touched = {d for d in before if sum(brute.secrets(before[d].text)[:3])}
    assert touched and any("[secret]" in after[d].text for d in touched)
    assert all(before[d] == after[d] for d in before if "[secret]" not in (after[d].text or ""))


def test_packed(stages):
    """The pieces rejoin to the ids of each document, and lie gapless in their sequences."""
    from collections import Counter

    from tokenizers import Tokenizer

    from stockwright.llm import packing

    docs, pieces = stages[4][0], stages[5][0]
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for r in docs:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, packing.END_OF_TEXT]
        want[r.doc_id, b"".join(i.to_bytes(4, "little") for i in ids)] += 1
    by_doc = {}
    for r in pieces:
        assert len(r.ids) == 4 * r.length
        by_doc.setdefault(r.doc_id, []).append((r.start, r.ids))
    once = {doc for doc, _ in want if sum(n for (d, _), n in want.items() if d == doc) == 1}
    for doc, _ in want:
        if doc in once:
            held = sorted(by_doc[doc])
            assert [s for s, _ in held] == [sum(len(x) // 4 for _, x in held[:k]) for k in range(len(held))]
            assert want[doc, b"".join(x for _, x in held)] == 1
    assert by_doc.keys() == {doc for doc, _ in want}
    sequences = {}
    for r in pieces:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        ends = [a + n for a, n in sorted(held)]
        assert [a for a, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= packing.SEQUENCE


def test_two_texts_of_one_id(spark):
    """A text that is like nothing else stays, though another row of its id is a copy."""
    from stockwright.llm.jaccard_join import near_duplicates_stage

    words = data.vocabulary(9, 400)
    a, b = " ".join(words[:60]), " ".join(words[100:160])
    rows = [(1, a), (2, a), (2, b), (3, ""), (3, None), (None, a), (None, b + " x"), (4, b), (4, b)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = near_duplicates_stage(spark, frame, "").collect()
    assert sorted((r.doc_id, r.text or "") for r in left) == [(1, a), (2, b), (3, ""), (3, "")]
    most = 2**63 - 1
    frame = spark.createDataFrame([(most, a), (most, b), (-most, a), (most - 1, "x")], frame.schema)
    left = near_duplicates_stage(spark, frame, "").collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(-most, a), (most - 1, "x"), (most, b)]


def test_two_results_at_once(spark, tmp_path):
    """A second run, and a report between two runs, leave the first run's rows readable."""
    from stockwright.sources.tables import stage

    docs = [r for r in data.documents() if r[1] and len(r[1]) < 2000][:40]
    for name, rows, schema in (
        ("documents", docs, data.DOCUMENTS),
        ("benchmark", data.benchmark(data.documents()), data.BENCHMARK),
        ("labels", data.labels(docs), data.LABELS),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    first = corpus_pipeline.run(spark, str(tmp_path))
    report = stage(spark.range(7), "report")
    second = corpus_pipeline.run(spark, str(tmp_path))
    assert report.count() == 7
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect())) != []


def test_run_on_empty_tables(spark, tmp_path):
    for name, schema in (("documents", data.DOCUMENTS), ("benchmark", data.BENCHMARK), ("labels", data.LABELS)):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
