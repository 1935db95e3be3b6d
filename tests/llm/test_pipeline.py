import pytest

import corpus_pipeline
from partwise.llm.decontaminate import find_contamination
from partwise.llm.near_dedup import near_duplicates
from partwise.llm.tables import materialise, read


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, made = read(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        made.append((name, docs, docs := materialise(stage(spark, docs, sf_dir), "stage")))
    return made


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, sf_dir, stages):
    columns = read(spark, sf_dir, "documents").columns
    assert [n for n, _, _ in stages] == ["language ID", "near-duplicates", "decontamination", "personal data", "packing"]
    assert all(after.columns == columns for _, _, after in stages[:-1])
    language, near, bench, private, packed = stages
    assert ids(language[2]) == ids(language[1])  # all have a language
    judged = near_duplicates(near[1]).collect()
    assert ids(near[2]) == sorted(r["doc_id"] for r in judged if r["kept"]) and len(judged) > near[2].count()
    assert all(r["kept"] for r in near_duplicates(near[2]).collect())
    found = {r["doc_id"] for r in find_contamination(bench[1], read(spark, sf_dir, "benchmark")).collect()}
    assert found and ids(bench[2]) == sorted(set(ids(bench[1])) - found)
    assert ids(private[2]) == ids(private[1])
    assert set(ids(packed[2])) == set(ids(packed[1]))


def test_run(spark, sf_dir, stages):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == stages[-1][2].columns and found.count() == stages[-1][2].count()


def test_odd_rows(spark, sf_dir):
    schema = read(spark, sf_dir, "documents").schema
    rows = read(spark, sf_dir, "documents").limit(50).collect()
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "123", None, None, None), (None, rows[0]["text"], "en", None, 5), rows[3], rows[3]]
    docs = spark.createDataFrame([*rows, *map(tuple, odd)], schema)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty, docs = materialise(stage(spark, empty, sf_dir), "empty"), materialise(stage(spark, docs, sf_dir), "odd")
        assert empty.count() == 0 and docs.count() > 0


def test_clashing_columns(spark, sf_dir):
    """Columns named as what stages add inside keep their values through all stages but the last."""
    odd = ["score", "_hash", "_hash_", "_id", "_counts", "_found", "_new", "_said", "row", "hash", "lang_pred", "kept", "pii_counts", "a.b", "ambiguous"]
    docs = read(spark, sf_dir, "documents").selectExpr("*", *[f"concat('{c}', doc_id) as `{c}`" for c in odd])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), "clash")
        assert docs.columns == before.columns
    rows = docs.collect()
    assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in odd)
    assert corpus_pipeline.packed(spark, docs, sf_dir).count() > 0
