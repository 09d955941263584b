"""The outlier limit against planted and labelled documents."""

import brute
import numpy as np

from ontime.llm import quality


def test_moderate_junk_goes_and_few_symbols_stay(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(3000)]
    texts = [list(rng.choice(vocabulary, rng.integers(80, 900))) for _ in range(176)]
    for words in texts[160:168]:  # 33 symbols to 100 words: within the former limit
        words[::3] = [f"{w}#" for w in words[::3]]
    for words in texts[168:]:  # one to 100
        words[::100] = [f"{w}$" for w in words[::100]]
    rows = [(i, " ".join(words), "en", "s", 0, None) for i, words in enumerate(texts)]
    kept = {r.doc_id for r in quality.keep_good(brute.odd_docs(spark, rows)).collect()}
    assert kept == set(range(176)) - set(range(160, 168))


def test_labelled_documents(spark, folder):
    folder = folder.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "source", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.judged_statistics(docs).where("NOT base_failed").join(labels, "doc_id").collect()
    bad, clean = [r.kept for r in found if not r.quality], [r.kept for r in found if r.quality]
    assert bad and sum(bad) <= 0.01 * len(bad)
    assert sum(clean) >= 0.99 * len(clean)
