import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from bibspark.llm.periodic_runs import LEAST, kept_words, periodic_runs, surviving, word_runs
from bibspark.llm.queries import op13_periodic_runs


def brute_runs(words, least=LEAST):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((a, b - a, q) for (a, b), q in found.items())


def some_words(rng):
    n, letters = rng.randint(0, 70), rng.choice([1, 2, 3, 5, 20])
    words = [b"%d" % rng.randrange(letters) for _ in range(n)]
    if n > 20 and rng.random() < 0.6:
        a, p = rng.randrange(n - 12), rng.randint(1, n // 3)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        words = some_words(rng)
        assert [tuple(r) for r in word_runs(words).tolist()] == brute_runs(words), words


def test_runs_of_structured_words():
    low, high = b"a", b"b"
    fibonacci = [[low], [low, high]]
    while len(fibonacci[-1]) < 200:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    thue = [low if bin(i).count("1") % 2 else high for i in range(256)]
    for words in (fibonacci[-1], thue, [low] * 300, [low, high] * 80 + [low] * 40, thue[:60] * 4):
        assert [tuple(r) for r in word_runs(words).tolist()] == brute_runs(words)


def test_splitting_loses_no_run_and_ends_stable():
    rng = random.Random(2)
    for _ in range(500):
        words = some_words(rng)
        if len(words) < LEAST:
            continue
        ids = np.unique(np.array(words), return_inverse=True)[1]
        parts = surviving(ids)
        for a, b in parts:
            assert b - a >= LEAST and np.unique(ids[a:b], return_counts=True)[1].min() >= 2
        for start, length, _ in brute_runs(words):
            assert any(a <= start and start + length <= b for a, b in parts)


def test_long_text_in_bounded_steps():
    rng = random.Random(3)
    block = [b"%d" % rng.randrange(9000) for _ in range(70_000)]
    assert word_runs(block * 3).tolist() == [[0, 210_000, 70_000]]  # over a megabyte of text
    assert word_runs([b"x"] * 50_000).tolist() == [[0, 50_000, 1]]


def test_kept_words():
    runs = word_runs([b"p"] + [b"a", b"b"] * 6 + [b"q"])
    assert runs.tolist() == [[1, 12, 2]]
    assert kept_words(14, runs).tolist() == [True] * 3 + [False] * 10 + [True]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(w.decode() for w in some_words(rng)), "en") for i in range(150)]
    rows += [(500, None, None), (501, "", "x"), (502, " \t\n", "x"), (None, "a " * 30, "x"), (None, None, None)]
    rows += [(503, "  é\x0bé\x0cé\r" * 20, "x"), (504, "w " * 40, "x"), (504, "w " * 40, "x")]
    spark.createDataFrame(rows, "doc_id bigint, text string, start string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted((expected(i, t) for i, t, _ in rows), key=key)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert periodic_runs(docs).collect() == []


def test_runs_and_text(spark):
    docs = spark.createDataFrame([(1, "x " + "go on  " * 9 + "end")], "doc_id bigint, text string")
    row = periodic_runs(docs).first()
    assert row.n_words == 20 and row.text == "x go on end"
    assert [tuple(r) for r in row.runs] == [(1, 18, 2)]
    assert periodic_runs(docs, least=30).select(F.size("runs")).first()[0] == 0
