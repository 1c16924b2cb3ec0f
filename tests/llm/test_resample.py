"""Importance resampling on what single words, in-sample documents and short texts do not show."""

import random

import numpy as np

from firmloom.llm import resample


def corpus(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def sentence(n, order):
    """Words in pairs: a pair has one order in good text and the other in bad text."""
    pairs = [(f"left{chr(97 + i)}", f"right{chr(97 + i)}") for i in range(20)]
    return [w for _ in range(n // 2) for w in random.choice(pairs)[::order]]


def test_word_pairs_and_held_out_lengths(spark):
    random.seed(5)
    rows, labels, held = [], [], {}
    for i in range(600):
        bad, length = i % 3 == 0, random.choice([40, 200, 3000])
        words = sentence(length, -1 if bad else 1)
        if not bad:
            words += [f"name{i}"] * (length // 50)  # a name of its own, the more often the longer
        rows.append((i, " ".join(words)))
        if i % 4:
            labels.append((i, 0 if bad else 1, 0))
        else:
            held[i] = (bad, length)
    docs, given = corpus(spark, rows, labels)
    kept = {r.doc_id: r.kept for r in resample.resample(docs, given).collect()}
    assert np.mean([kept[i] for i, (bad, _) in held.items() if bad]) < 0.1
    for length in (40, 200, 3000):
        assert np.mean([kept[i] for i, (bad, n) in held.items() if not bad and n == length]) > 0.9
    selected = {r.doc_id for r in resample.select_rows(docs, given).collect()}
    assert selected == {i for i, k in kept.items() if k}


def test_features_once_a_text():
    buckets, owners = resample.features([b"night watch night watch", b"", b"night watch night"])
    assert len(set(zip(buckets, owners))) == len(buckets)
    assert set(buckets[owners == 0]) == set(buckets[owners == 2]) and not (owners == 1).any()
