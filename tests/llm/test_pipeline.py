import corpus_pipeline as pipeline

from casewatch.llm import bpe, mixing, queries

from .helpers import documents, prose


def junk(seed, n):
    return " ".join(w + "###" for w in prose(seed, n).split())


def tables(spark, folder):
    rows = [(i, prose(i, 60 + i % 90) if i % 3 else junk(i, 60 + i % 90), "en", f"s{i % 3}", 1) for i in range(300)]
    rows += [(1000 + i, prose(i, 60 + i % 90), "de", "s1", 1) for i in range(1, 40, 3)]  # exact copies
    rows += [(2000, prose(1, 20), "en", "s0", 1), (2001, None, None, None, None), (None, prose(4, 64), "en", None, 1)]
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 3 > 0), 0) for i in range(300)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return {r[0]: r[1] for r in rows}


def test_stages_in_order(spark, tmp_path):
    texts = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        assert docs.columns == columns or name == pipeline.STAGES[-1][0]
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash", "mixing", "bpe"]
    good = {i for i in range(300) if i % 3}
    assert good <= set(kept["quality_classifier"]) and not {i for i in range(300) if i % 3 == 0} & set(kept["quality_classifier"])
    assert good <= set(kept["quality_rules"]) and not {2000, 2001} & set(kept["quality_rules"])
    assert sorted(kept["simhash"]) == sorted(good)
    assert set(kept["mixing"]) <= good and len(kept["mixing"]) > 0 and sorted(kept["bpe"]) == sorted(kept["mixing"])
    mixed = spark.read.parquet(f"{tmp_path}/out/mixing").collect()
    encoder = bpe.encoder(queries.vocabulary_file())
    expected = sorted((r.doc_id, len(encoder.encode(r.text)) // 4) for r in mixed)
    assert sorted((r.doc_id, r.n_tokens) for r in docs.collect()) == expected
    words = {i: len(texts[i].split()) for i in good}
    taken = {}
    for r in mixed:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    assert all(n <= mixing.MAX_PASSES * words[i] for i, n in taken.items())


def test_run_equals_the_stages(spark, tmp_path):
    tables(spark, tmp_path)
    one, two = (pipeline.run(spark, str(tmp_path)) for _ in range(2))
    assert one.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
