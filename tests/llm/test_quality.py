import math
import re

import numpy as np
import pytest

from bibspark.llm import quality
from bibspark.llm.quality import best_cut, kth_largest, resample, weights
from tests.llm.conftest import sentence


def made(spark, documents, rng):
    rows = [(None, "no id"), (1, None), (2, ""), (3, "one"), (3, "one"), (4, "pad " * 400_000)]
    labels = []
    for i in range(10, 410):
        good = i % 4 > 0
        text = sentence(rng, rng.choice([20, 60, 200]))
        rows.append((i, text if good else text.replace(" ", "%%% ")))
        labels.append((i, int(good), 0))
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def scramble(x):
    return int(quality.mix(np.array([x % 2**64], np.uint64))[0])


def buckets(text):
    """Of every token and pair, a token at a time."""
    tokens = []
    for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", (text or "").encode()):
        h = scramble(sum(int(quality._VALUE[b]) * pow(quality._BASE, j, 2**64) for j, b in enumerate(w)))
        tokens.append(int(quality._CAPITALS) if len(re.findall(rb"[A-Z]", w)) > 1 else h)
    tokens = [int(quality._REPEAT) if k and t == tokens[k - 1] else t for k, t in enumerate(tokens)]
    pairs = [a * 0x9FB21C651E98DF25 + b for a, b in zip(tokens, tokens[1:])]
    return [scramble(t) % quality.BUCKETS for t in tokens + pairs]


def test_weights_match_brute_force(spark, documents, rng):
    rows = [(None, "No id HERE"), (1, None), (2, ""), (3, "one"), (3, "one"), (4, "ha ha ha!! \u00e9t\u00e9")]
    rows += [(i, sentence(rng, rng.choice([1, 9, 60])) + rng.choice(["", "%%% end", "\nNEW a1"])) for i in range(10, 90)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 70)]
    got = weights(documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    raw, target = [1] * quality.BUCKETS, [1] * quality.BUCKETS
    good = {i for i, q, _ in labels if q == 1}
    for i, t in rows:
        for b in buckets(t):
            raw[b] += 1
            target[b] += i in good
    both = math.log(sum(target) / sum(raw))
    ratio = {b: math.log(target[b] / raw[b]) - both for _, t in rows for b in buckets(t)}
    want = []
    for i, t in rows:
        own = buckets(t)
        want.append((str(i), len(own), 100 * sum(ratio[b] for b in own) / max(len(own), 1)))
    found = sorted((str(r.doc_id), r.n_grams, r.log_weight) for r in got)
    for a, b in zip(found, sorted(want), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-9)


def test_held_out_rows_are_told_apart(spark, documents, rng):
    docs, labels = made(spark, documents, rng)
    got = {r.doc_id: r.kept for r in weights(docs, labels.filter("doc_id < 200")).collect()}
    held = [i for i in range(200, 410)]
    assert np.mean([got[i] == (i % 4 > 0) for i in held]) > 0.97
    assert got[3] and got[None] is not None


def test_exactly_k_rows_and_stable(spark, documents, rng):
    docs, labels = made(spark, documents, rng)
    docs = docs.filter("doc_id <> 3")
    one = weights(docs, labels, keep=57).filter("kept").collect()
    two = weights(docs.repartition(5), labels, keep=57).filter("kept").collect()
    assert len(one) == 57 and {r.doc_id for r in one} == {r.doc_id for r in two}
    best = sorted(weights(docs, labels).collect(), key=lambda r: -r.gumbel_key)[:57]
    assert {r.doc_id for r in best} == {r.doc_id for r in one}


def test_keeps_columns_and_empty_tables(spark, documents, rng):
    docs, labels = made(spark, documents, rng)
    frame = docs.selectExpr("*", "1 as kept", "2 as bucket", "3 as quality")
    kept = resample(frame, labels)
    assert kept.columns == frame.columns and 280 < kept.count() < 320
    assert resample(docs, labels.limit(0)).count() == docs.count()
    assert weights(documents([]), labels).count() == 0
    assert weights(docs, labels, keep=0).filter("kept").count() == 0


def test_kth_largest(spark, rng):
    values = [rng.gauss(0, 1) for _ in range(3000)] + [0.25] * 50
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 1500, 3050):
        assert kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]
    assert 1 < best_cut(np.array([2.0, 3.0]), np.array([1.0, 0.5])) < 2
