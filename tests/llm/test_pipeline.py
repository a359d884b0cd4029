"""The pipeline stage by stage, against plain Python."""

import collections

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from strandline.llm import mixing, surrogates

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    n = docs.count()
    clean = corpus_pipeline.drop_toxic(spark, docs, SF).cache()
    assert clean.columns == list(corpus_pipeline.COLUMNS) and 0.8 * n <= clean.count() <= n
    single = corpus_pipeline.drop_near_duplicates(spark, clean, SF).cache()
    rows = single.collect()
    assert len({r["text"] for r in rows}) == len(rows)  # no exact copies stay
    by_text = collections.defaultdict(list)
    for r in clean.collect():
        by_text[r["text"]].append(r["doc_id"])
    assert all(r["doc_id"] == min(by_text[r["text"]]) for r in rows)
    safe = corpus_pipeline.replace_personal_data(spark, single, SF).cache()
    assert safe.count() == len(rows) and safe.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in safe.collect()} == {r["doc_id"]: r["text"] for r in surrogates.replace_pii(single, surrogates.TRIAL_KEY).collect()}
    mixed = corpus_pipeline.mix(spark, safe, SF).cache()
    assert mixed.count() == mixing.mix_sources(safe).count()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) for r in safe.collect()}
    out = corpus_pipeline.tokenise(spark, mixed, SF).collect()
    assert len(out) == mixed.count() and all(r["n_tokens"] == sizes[r["doc_id"]] for r in out)


def test_run_and_empty(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 0
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
