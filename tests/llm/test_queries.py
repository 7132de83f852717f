"""The registered queries against their SQL twins, and the pipeline stage by stage."""

import hashlib
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from eventide.llm import queries
from eventide.plans.compare import compare, duck, type_diffs

from ..conftest import SF001, SF01
from .conftest import make
from .test_operators import brute_groups, brute_hits, brute_lines


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duck(SF001)
    df = queries.QUERIES[name](spark, SF001)
    assert type_diffs(df, con, queries.ORACLE[name]) == {}
    ok, why = compare(df, con, queries.ORACLE[name])
    assert ok, why


def test_registered():
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))


def test_held_out_accuracy(spark):
    con = duck(SF01)
    want = dict(con.execute("select doc_id, toxic from labels where toxic is not null").fetchall())
    rows = [r for r in queries.op6_toxicity(spark, SF01).collect() if r.held_out and r.doc_id in want]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sum(r.predicted == want[r.doc_id] for r in rows) >= 0.93 * len(rows)


def test_pipeline_stages(spark):
    """Each stage against a brute-force version on what the one before it kept."""
    docs = queries.table(spark, SF001, "documents")
    items = [tuple(r) for r in queries.table(spark, SF001, "benchmark").collect()]
    first = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, SF001)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == first.columns
            out = corpus_pipeline.materialize(out, "test")
            after = {r.doc_id: r.text for r in out.collect()}
        if name == "line_dedup":
            want = {k[0]: k[3] for k in brute_lines(before)}
            assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in after.items()} == want
        elif name == "near_dedup":
            assert set(after) == {i for i, _, c in brute_groups(before) if i == c}
        elif name == "decontamination":
            assert set(after) == {r[0] for r in brute_hits(before, items) if not r[5]}
        elif name == "subword_encoding":
            got = {r.doc_id: (r.decoded_sha256, r.n_tokens, len(r.ids)) for r in out.collect()}
            assert set(got) == {i for i, _ in before}
            assert all(got[i][0] == hashlib.sha256(t.encode()).hexdigest() and got[i][1] == got[i][2] for i, t in before)
        docs = out
    assert corpus_pipeline.run(spark, SF001).count() == docs.count()


def test_stages_on_odd_rows(spark, docs, nothing):
    for table in (docs, nothing, make(spark, [(1, None)])):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF001)
            assert now.columns == table.columns
        rows = corpus_pipeline.STAGES[-1][1](spark, now, SF001).collect()
        assert len(rows) <= table.count() and all(np.all(np.asarray(r.ids) >= 0) for r in rows)
