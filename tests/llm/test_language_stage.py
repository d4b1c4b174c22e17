"""The language stage of the pipeline: what it drops, and tables to learn nothing from."""

from __future__ import annotations

import corpus_pipeline
from logframe.llm import langid
from tests.llm.test_operators import docs

SF_DIR = "/root/testdata/sf0.01"
NOISE = ["#$% x 123 !!", "@@@@ 44 {} a ----", "=+=+= 9 9 9 q ;;;;", "|||| ---- |||| Z"]
CLEAN = ["x", "hello", "日本語のテキスト", "हिन्दी में लिखा हुआ"]


def test_noise_with_a_letter_goes_and_clean_texts_stay(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.train(table)
    assert [langid.to_keep(model, t) for t in NOISE] == [False] * 4
    assert [langid.to_keep(model, t) for t in CLEAN] == [True] * 4
    kept = langid.keep_identified(table, model).count()
    assert kept == sum(langid.has_letter(r.text) for r in table.collect())


def test_nothing_to_learn_from_drops_no_clean_text(spark):
    texts = [*CLEAN, "12 !!", "", None]
    for lang, ids in ((None, None), (["en"] * 7, [k for k in range(200) if langid.zlib.crc32(str(k).encode()) % 4 == 2][:7])):
        got = corpus_pipeline.with_language(spark, docs(spark, texts, ids, lang), "").collect()
        assert sorted(r.text for r in got) == sorted(CLEAN)
