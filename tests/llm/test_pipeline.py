"""The pipeline, stage by stage, against brute force over what each stage was given."""

import pytest

import corpus_pipeline
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute as brute_groups
from tests.llm.test_simhash import plain_print
from tidegrid.llm.common import written

import numpy as np


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), name))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_counts(stages):
    columns = stages[0].columns
    assert all(df.columns == columns for df in stages[1:-1])
    counts = [df.count() for df in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    assert 1 < len(corpus_pipeline.STAGES) <= 5


def test_toxic_documents_go_and_others_stay_whole(spark, sf_dir, stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    assert all(after[k] == before[k] for k in after)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = [k for k, v in labels.items() if v == 0 and k in before]
    assert sum(k in after for k in clean) > 0.95 * len(clean)


def test_quality(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    assert all(after[k] == before[k] for k in after)
    assert not any(len((r.text or "").split()) < 25 for r in after.values())


def test_lines(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    keys = list(before)
    for k, (text, _, _) in zip(keys, brute_lines([before[k].text for k in keys], 10)):
        assert after[k].text == text and after[k].n_chars == len(text)
        assert (after[k].lang, after[k].source) == (before[k].lang, before[k].source)


def test_one_of_each_group(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    rows = [(k, np.uint64(plain_print(r.text)).view(np.int64)) for k, r in before.items()]
    assert set(after) == set(brute_groups(rows))
    assert all(after[k] == before[k] for k in after)


def test_packing(stages):
    texts = {k: r.text for k, r in by_id(stages[4]).items()}
    assert check(stages[5].collect(), texts) < 0.05


def test_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = docs.where("length(text) > 600").limit(3)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, None, 0),
                                 (-2, " \n", "en", "s", 2), (-3, "long words go on " * 9000, "en", "s", 9)],
                                docs.schema)
    for df in (good.union(odd).union(good), good.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            df = written(stage(spark, df, sf_dir), name)
        df.count()
