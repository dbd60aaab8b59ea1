"""The pipeline's stages on a small corpus with planted cases."""

import corpus_pipeline
from rolewise.llm.stage import staged

SF = "/root/testdata/sf0.001"


def test_stages(spark, rng):
    words = [f"{a}{b}" for a in ("ba", "ko", "ti", "ru") for b in ("na", "le", "so", "mi", "du")]
    texts = [" ".join(rng.choice(words, 80)) for _ in range(40)]
    passage = " ".join(f"p{x}" for x in rng.integers(0, 999, 80))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[3]), (101, texts[4] + " tail"), (102, None), (103, "12 34"),
                                                    (104, texts[0][:60] + passage + texts[1][:300]), (105, texts[2][:200] + passage + texts[5][:60]), (106, item)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    names, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF))
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == names
    clean = set(range(6, 40))
    assert not {102, 103} & set(kept["language_id"]) and clean | {100, 101, 104, 105, 106} <= set(kept["language_id"])
    assert not {100, 101} & set(kept["near_duplicates"]) and clean | {3, 4} <= set(kept["near_duplicates"])
    assert passage not in kept["repeated_passages"][104]["text"] and kept["repeated_passages"][7]["text"] == texts[7]
    assert 106 not in kept["benchmark_decontamination"] and clean <= set(kept["benchmark_decontamination"])
    assert set(kept["source_mix"]) == set(kept["benchmark_decontamination"])


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF))
        assert docs.count() == 0


def test_further_columns_pass(spark, rng):
    """Names that the stages use for themselves, one of each; values go through unchanged."""
    names = ("score", "bits", "lang_pred", "letters", "_letters", "z", "id", "key", "_0", "_1", "cls", "label", "row", "kept", "n_removed", "_extra5", "_text", "order")
    words = [f"{a}{b}" for a in ("ba", "ko", "ti", "ru") for b in ("na", "le", "so", "mi", "du")]
    rows = [(i, " ".join(rng.choice(words, 60)), "en", "s", 3, *[f"{c}{i}" for c in names]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF))
        assert {r["doc_id"]: tuple(r)[5:] for r in docs.collect()} == {r[0]: r[5:] for r in rows}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 20
