"""The pipeline stage by stage against brute force, and the registered queries."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import connect, differences
from tests.llm import brute
from tidespan.llm import packing, quality


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "best_fit_packing"]


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_oracle(spark, tiny, name):
    assert differences(entry.queries()[name](spark, tiny), connect(tiny), entry.oracle_sql()[name]) == []


def test_stages(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    (_, rules), (_, near), (_, passages), (_, packing) = corpus_pipeline.STAGES
    first = rules(spark, docs, tiny)
    assert first.schema == docs.schema
    model = quality.fit(docs, spark.read.parquet(f"{tiny}/labels.parquet"))
    chance = {r.doc_id: r.probability for r in quality.judged(docs, model).collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    good = {d for d, r in rows.items() if (c := brute.counts(r.text))[0] >= 20 and 100 * c[4] <= 30 * c[0] and chance[d] >= quality.THRESHOLD}
    assert Counter(map(tuple, first.collect())) == Counter(tuple(rows[d]) for d in good)

    second = near(spark, first, tiny)
    left = sorted(good)
    want = {d for d, _, c in brute.components([(d, rows[d].text) for d in left], 5, 8, 10) if d == c}
    assert Counter(map(tuple, second.collect())) == Counter(tuple(rows[d]) for d in want)

    third = passages(spark, second, tiny)
    assert third.schema == docs.schema
    cut = {r.doc_id: r for r in third.collect()}
    for d, words, kept in brute.repeats([(d, rows[d].text) for d in sorted(want)], 20):
        assert brute.WORD.findall(cut[d].text) == kept and cut[d].n_chars == len(cut[d].text)
        assert len(words) > len(kept) or cut[d].text == rows[d].text
        assert (cut[d].lang, cut[d].source) == (rows[d].lang, rows[d].source)

    packed = packing(spark, third, tiny).collect()
    assert {r.doc_id for r in packed} == want
    whole = corpus_pipeline.run(spark, tiny).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in whole)


def odd_documents(spark, odd):
    """The odd rows beside columns of other types and of names that the stages use themselves."""
    return odd.selectExpr("*", "array(n_chars, null) AS unit", "named_struct('rest', lang) AS slot", "cast(null AS string) AS ids", "source AS kept")


def test_stages_on_odd_rows(spark, tiny, odd, odd_rows):
    """Nulls, repeated rows and ids, rows without id, empty and very long texts, ties, clashing columns."""
    docs = odd_documents(spark, odd)
    rules, near, passages, packed = (stage for _, stage in corpus_pipeline.STAGES)
    first = rules(spark, docs, tiny)
    assert first.schema == docs.schema
    good = Counter((r.doc_id, r.text) for r in first.collect())
    every = Counter(odd_rows)
    assert all(every[k] == n and brute.counts(k[1])[0] >= 20 for k, n in good.items())

    second = near(spark, docs, tiny)  # all rows, so that the stages behind meet them too
    assert second.schema == docs.schema
    stay = Counter((d, t) for d, t, c in ((d, t, c) for (d, t), (_, _, c) in zip(odd_rows, brute.components(odd_rows, 5, 8, 10))) if d == c)
    assert Counter((r.doc_id, r.text) for r in second.collect()) == stay

    third = passages(spark, docs, tiny)
    assert third.dtypes == docs.dtypes
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    left = Counter((d, tuple(kept)) for d, _, kept in brute.repeats(order, 20) if kept)
    got = third.collect()
    assert Counter((r.doc_id, tuple(brute.WORD.findall(r.text))) for r in got) == left
    assert all(r.n_chars == len(r.text) and r.unit is not None and r.slot.rest == "en" and r.ids is None and r.kept == "src0" for r in got)

    pieces = packed(spark, docs, tiny)
    rows = pieces.collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(d for d, _ in odd_rows)
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces).collect()}
    assert sum(map(len, joined.values())) == 4 * sum(r.length for r in rows) and max(map(len, joined.values())) <= 4 * 2048
    assert all(joined[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids) for r in rows)


def test_stages_on_an_empty_table(spark, tiny, odd):
    docs = odd_documents(spark, odd).limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tiny)
        assert out.dtypes == docs.dtypes and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, tiny).count() == 0


def test_emptied_rows_go(spark, tiny):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "a " + text), (2, None), (3, " \n"), (4, text + " and an end")], "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in corpus_pipeline.repeated_passages(spark, docs, tiny).collect()}
    assert {(d, tuple(t.split())) for d, t in got} == {(None, tuple(("a " + text).split())), (4, ("and", "an", "end"))}
