"""Held-out accuracy, steadiness under swaps, and odd inputs of the classifier."""

import random

import numpy as np
from pyspark.sql import functions as F

from saldero.llm import toxicity
from saldero.llm.queries import all_queries

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_documents_are_told_apart(spark):
    found = all_queries()["op6_toxicity"](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    assert sum(clean) <= 0.02 * len(clean)
    assert sum(toxic) >= 0.6 * len(toxic)
    assert found.count() == 1000
    assert found.where("score < 0 OR score > 1").count() == 0


def biased(n=600):
    """Insults decide; one group is mentioned mostly where there are insults."""
    draw = random.Random(2)
    texts, labels = [], []
    for _ in range(n):
        toxic = draw.random() < 0.4
        words = [f"word{draw.randrange(200)}" for _ in range(20)]
        if toxic and draw.random() < 0.7:
            words.append("nasty")
        if draw.random() < (0.8 if toxic else 0.05):
            words.append("muslim")
        texts.append(toxicity.words_of(" ".join(words)))
        labels.append(int(toxic))
    return texts, np.array(labels)


def chance(weights, text):
    total = weights[""] + sum(weights.get(w, 0) for w in toxicity.words_of(text))
    return 1 / (1 + np.exp(-total))


def test_swapped_groups_score_alike():
    texts, labels = biased()
    plain = toxicity.fit(texts, labels, toxicity.Settings(swap_penalty=0))
    steady = toxicity.fit(texts, labels, toxicity.Settings(swap_penalty=10))
    neutral = "word1 word2 muslim word3"
    apart = [abs(chance(m, neutral) - chance(m, neutral.replace("muslim", "christian"))) for m in (plain, steady)]
    assert chance(plain, neutral) > 0.5 > chance(steady, neutral)
    assert apart[1] < 0.1 < apart[0]
    assert chance(steady, "word1 nasty word2") > 0.5


def test_vocabulary_is_bounded():
    texts, labels = biased()
    settings = toxicity.Settings(least_z=0, most_words=10)
    chosen = toxicity.telling_words(texts, labels, settings)
    assert len([w for w in chosen if w not in toxicity.KIND and not w.endswith("*")]) <= 10


def test_odd_rows_and_no_labels(spark):
    rows = [(1, None), (2, ""), (None, "idiot"), (2, ""), (3, "idiot " * 60_000), (4, "calm")]
    df = spark.createDataFrame([(*r, 7.0) for r in rows], "doc_id long, text string, score double")
    none = spark.createDataFrame([(None, 1), (1, None), (9, 1)], "doc_id long, toxic int")
    weights = toxicity.learn(df, none, F.lit(True))
    assert weights == {}
    found = toxicity.score(df, weights, keep=["doc_id", "score"], score_col="rated").collect()
    assert len(found) == 6 and all(0.4 < r["rated"] < 0.5 and r["score"] == 7.0 for r in found)
    given = toxicity.score(df, {"idiot": 5.0, "": -2.0}, keep=["doc_id"]).collect()
    assert sorted((r["doc_id"] or 0, r["score"] > 0.5) for r in given) == [
        (0, True), (1, False), (2, False), (2, False), (3, True), (4, False),
    ]
    assert toxicity.score(df.where("false"), weights, keep=["doc_id"]).count() == 0
