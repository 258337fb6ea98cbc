"""The chain of stages on small tables, odd rows among them."""

import numpy as np

import corpus_pipeline

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, seed):
    draw = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in draw.integers(0, 5000, n))


def folder(spark, tmp_path, docs):
    place = str(tmp_path / "sf")
    spark.createDataFrame(docs, DOC).write.parquet(f"{place}/documents.parquet")
    marks = [(k, int(k % 3 != 0), int(k % 4 == 1)) for k in range(120)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


def test_stages_keep_clean_documents_and_one_of_each_copy(spark, tmp_path):
    bad, foul = " ".join(["$$$ ###"] * 30), " rotten filthy"
    docs = [(k, prose(60, k) + (bad if k % 3 == 0 else "") + (foul if k % 4 == 1 else ""), "en", f"s{k % 3}", None) for k in range(120)]
    clean = {k for k in range(120) if k % 3 and k % 4 != 1}
    docs += [(1000 + k, docs[k][1], "en", "s0", None) for k in sorted(clean)[:10]]  # copies of clean ones
    docs += [(2000, None, "en", "s1", None), (2001, "", None, None, None), (None, prose(60, 999), "de", None, None)]
    place = folder(spark, tmp_path, docs)
    made = spark.read.parquet(f"{place}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(number))
        stage(spark, made, place).write.parquet(out)
        made = spark.read.parquet(out)
        ids = [r.doc_id for r in made.select("doc_id").collect()]
        if name in ("toxicity", "near copies"):
            kept = {k for k in ids if k is not None and k < 120}
            assert len(kept & clean) >= 0.95 * len(clean) and len(kept - clean) <= 3
        if name == "near copies":
            assert not [k for k in ids if k is not None and 1000 <= k < 2000]
    assert {r.doc_id for r in made.collect()} <= {None, *range(120)} and made.count() > 30
    again = corpus_pipeline.run(spark, place)
    assert again.count() == made.count() and sorted(again.columns) == sorted(made.columns)


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, [])).count() == 0
