"""The pipeline's stages, each against what its operator is to decide, and the whole against its stages."""

import pytest

import corpus_pipeline
from marketlens.llm import mixing
from marketlens.llm.common import written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).selectExpr("cast(null as bigint) as doc_id", "text", "lang", "source", "n_chars")
    twice = docs.filter("doc_id < 5")
    out = [written(docs.unionByName(extra).unionByName(twice), "start")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), "step"))
    return out


def test_stages_keep_columns_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination",
                                                      "mixing sources to target weights", "sharding"]


def test_filters(spark, steps):
    start, good, unique, clean, mix, shards = steps
    for step in (good, unique, clean, mix):
        assert step.columns == start.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert good.join(labels, "doc_id").filter("quality = 0").count() <= 1
    kept = good.join(labels.filter("quality = 1"), "doc_id").count() / start.join(labels.filter("quality = 1"), "doc_id").count()
    assert kept >= 0.97

    from test_llm_text_ops import slow_contamination, slow_fingerprint
    fps = [slow_fingerprint(r.text) for r in unique.collect()]
    before = {slow_fingerprint(r.text) for r in good.collect()}
    assert len(fps) == len(set(fps)) and set(fps) <= before
    assert all(bin(a ^ b).count("1") > 4 for i, a in enumerate(fps) for b in fps[:i])

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = [r[5] for r in slow_contamination([(r.doc_id, r.text) for r in unique.collect()], items)]
    assert clean.count() == hit.count(False)

    total = clean.select(mixing.words(clean.text).alias("n")).groupBy().sum("n").first()[0]
    taken = mix.select(mixing.words(mix.text).alias("n")).groupBy().sum("n").first()[0]
    assert abs(taken - 1.5 * total) <= 0.05 * total
    assert shards.count() == mix.count() and shards.select("shard", "slot").distinct().count() == mix.count()


ODD = "doc_id long, text string, lang string, source string, n_chars long, row_key string, score string, key int, h int, n int, d int"


@pytest.fixture(scope="module")
def odd_rows(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and clashing names, among ordinary documents."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows = [(*d, "k", "s", 1, 2, 3, 4) for d in docs]
    long = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    rows += [(None, None, None, None, None, None, None, None, None, None, None)] * 3
    rows += [(None, "", "en", "web", 0, "a", "b", 1, 1, 1, 1), (10 ** 6, "", None, None, 0, "a", "b", 1, 1, 1, 1),
             (10 ** 6 + 1, long, "en", "web", len(long), "a", "b", 1, 1, 1, 1), (None, long, "fr", None, len(long), "z", "b", 1, 1, 1, 1)]
    rows += [(*docs[0], "other", "s", 1, 2, 3, 4), (*docs[1], "k", "s", 1, 2, 3, 4), (*docs[1], "k", "s", 1, 2, 3, 4)]
    return spark.createDataFrame(rows, ODD)


@pytest.mark.parametrize("i", range(5))
def test_each_stage_on_odd_rows(spark, odd_rows, i):
    stage = corpus_pipeline.STAGES[i][1]
    out = stage(spark, odd_rows.repartition(3), SF)
    got = sorted(map(str, out.collect()))
    assert sorted(map(str, stage(spark, odd_rows.repartition(5), SF).collect())) == got  # reruns agree
    given = [str(r) for r in odd_rows.collect()]
    if i == 4:
        assert len(got) == len(given) and set(out.columns) >= {"doc_id", "shard", "slot"}
    else:
        assert out.columns == odd_rows.columns and set(got) <= set(given)
    if i == 1:  # of null and empty texts one, and of rows with equal id and text one
        assert len({(r.doc_id, r.text) for r in out.collect()}) == len(got) and sum(not r.text for r in out.collect()) == 1
    if i == 2:
        assert sum(not r.text for r in out.collect()) == 5


@pytest.mark.parametrize("i", range(5))
def test_each_stage_on_an_empty_table(spark, i):
    out = corpus_pipeline.STAGES[i][1](spark, spark.createDataFrame([], ODD), SF)
    assert out.count() == 0 and (i == 4 or out.columns == ODD.replace(",", "").split()[::2])


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.filter("slot < 0 or shard not between 0 and 39").count() == 0
