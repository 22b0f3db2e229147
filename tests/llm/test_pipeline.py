"""The stages one after the other, each against its operator and plain Python."""

import random

import corpus_pipeline
import numpy as np
import pytest
from llm.helpers import no_documents, odd_documents, prose, with_clashes
from llm.test_line_rules import base
from llm.test_packing import check
from llm.test_simhash import plain_fingerprint, plain_groups

import __spark_entry__ as entry_point
from quayside.llm import mixing, queries, secret_scan


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What goes into and comes out of every stage."""
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (_, work) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        work(spark, docs, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
        found.append((docs, out))
        docs = out
    return found


def test_columns(stages):
    for docs, out in stages[:-1]:
        assert out.columns == docs.columns


def test_quality(stages):
    docs, out = stages[0]
    kept = {r.doc_id for r in out.collect()}
    failed = {r.doc_id for r in docs.collect() if base(r.text)[-1]}
    assert kept and not kept & failed and kept <= {r.doc_id for r in docs.collect()}


def test_one_of_each_group(stages):
    docs, out = stages[1]
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    groups = plain_groups([plain_fingerprint(t) for _, t in rows])
    assert sorted(r.doc_id for r in out.collect()) == sorted({rows[g][0] for g in groups})


def test_no_base_secret_is_left(stages):
    docs, out = stages[2]
    before, after = ({r.doc_id: r for r in df.collect()} for df in (docs, out))
    assert before.keys() == after.keys()
    for k, r in after.items():
        if secret_scan.base_spans(before[k].text):
            assert r.text != before[k].text and not secret_scan.base_spans(r.text)
        assert r.n_chars == len(r.text)


def test_mixture(stages):
    docs, out = stages[3]
    size = {r.doc_id: (r.source, len(r.text.split())) for r in docs.collect()}
    sizes, taken = {}, {}
    for source, n in size.values():
        sizes[source] = sizes.get(source, 0) + n
    for r in out.collect():
        taken[r.source] = taken.get(r.source, 0) + size[r.doc_id][1]
    wanted = mixing.targets(sizes, sum(sizes.values()))
    longest = max(n for _, n in size.values())
    assert all(abs(taken.get(s, 0) - t) <= longest for s, t in wanted.items())


def test_packed(stages):
    check(*stages[4], 2048)


def test_run(spark, sf_dir, stages):
    found = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert found.select(*key).exceptAll(stages[-1][1].select(*key)).isEmpty() and found.count() == stages[-1][1].count()


def test_odd_inputs(spark, sf_dir):
    docs = with_clashes(odd_documents(spark))
    for _, work in corpus_pipeline.STAGES[:-1]:
        out = work(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() <= 2 * docs.count()
        assert work(spark, with_clashes(no_documents(spark)), sf_dir).count() == 0
    rng = random.Random(1)
    rows = [(None if k % 3 else k, prose(rng, 60), None, None, None) for k in range(6)]
    null_docs = spark.createDataFrame(rows + rows[:2], no_documents(spark).schema)
    for _, work in corpus_pipeline.STAGES:
        null_docs = work(spark, null_docs, sf_dir)
    assert null_docs.count() >= 6 and np.all([r.length <= 2048 for r in null_docs.collect()])


def test_registered():
    found = entry_point.queries()
    assert set(queries.queries()) | {"pipeline"} <= set(found) and len(queries.queries()) == 13
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
