import re
from collections import Counter

import numpy as np
import pytest

from bibspark.llm import collocations as co
from bibspark.llm.collocations import collocations, frequent_phrases, phrase_counts, suffixes


def plain_counts(rows, depth=5):
    """All phrases of (text, lang) rows, and the words of each language."""
    found, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, depth + 1):
                found.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return found, sizes


def plain_collocations(rows, least, top, depth=5):
    found, sizes = plain_counts(rows, depth)
    candidates = {key: a for key, a in found.items() if len(key[1]) > 1 and a >= least}
    covered = {
        (lang, p[i : i + k]) for (lang, p), f in candidates.items() for k in range(2, len(p))
        for i in range(len(p) - k + 1) if 100 * f >= 100 * candidates[lang, p[i : i + k]]
    }
    best = {}
    for (lang, p), a in candidates.items():
        if (lang, p) in covered:
            continue
        n = sizes[lang]
        score, _, l, r = min((1000 * a * n // (found[lang, p[:k]] * found[lang, p[k:]]), k, found[lang, p[:k]], found[lang, p[k:]])
                             for k in range(1, len(p)))
        best.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r, n))
    return {
        (lang, rank, p.decode(), -a, l, r, n, -score)
        for lang, many in best.items() for rank, (score, a, p, l, r, n) in enumerate(sorted(many)[:top], 1)
    }


def made(rng, docs=120):
    vocabulary = [f"W{k}" for k in range(30)] + ["été", "a", "\x00", "x-y"]
    rows = []
    for i in range(docs):
        words = rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(len(vocabulary))], k=rng.randint(1, 120))
        words[len(words) // 2 : len(words) // 2] = ["In", "the", "hot", "pair"] * rng.randint(0, 6)
        marks = rng.choices([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ; "], weights=[30, 2, 1, 2, 2, 1, 1, 1], k=len(words))
        rows.append(("".join(w + m for w, m in zip(words, marks, strict=True)), rng.choice(["en", "en", "de", None])))
    return [*rows, (rows[0][0], "en"), *[("one two three four five six " * 3, "fr")] * 9, (None, "en"), ("", None), (" .,", "zz")]


@pytest.mark.parametrize("step,hot,cut", [(1 << 19, 1 / 8192, 1 << 22), (200, 1 / 50, 64), (64, 0.9, 7)])
def test_equals_brute_force(spark, rng, monkeypatch, step, hot, cut):
    monkeypatch.setattr(co, "_STEP", step)
    monkeypatch.setattr(co, "_SLICE", cut)
    monkeypatch.setattr(co, "_PER_BUCKET", 500)
    rows = made(rng)
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "text string, lang string, n bigint").repartition(3)
    got = {tuple(r) for r in collocations(docs, least=6, top=40, hot=hot).collect()}
    assert got == plain_collocations(rows, 6, 40)
    phrases, sizes = frequent_phrases(docs, least=4, hot=hot)
    found, words = plain_counts(rows)
    assert {(r.lang, r.phrase): r.n for r in phrases.collect()} == {(g, " ".join(p)): a for (g, p), a in found.items() if a >= 4}
    assert {r.lang: r.n for r in sizes.collect()} == {g: n for g, n in words.items() if n}


def test_quicksort_counts_weighted_suffixes():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 4, (3000, 5)).astype(np.int32)
    rows[:, 0] += 1
    for k in range(1, 5):
        rows[:, k] *= rows[:, k - 1] > 0
    weights = rng.integers(1, 4, 3000)
    want = Counter()
    for row, w in zip(rows.tolist(), weights.tolist(), strict=True):
        for k in range(1, 6):
            if row[k - 1] == 0:
                break
            want[tuple(row[:k])] += w
    got = dict(phrase_counts(rows, weights, np.ones(3000, np.int64), 40))
    assert got == {p: n for p, n in want.items() if n >= 40}


def test_words_are_carried_over():
    words = [b"a", b"b", b"c", b"\n", b"a", b"b"]
    first, rest = suffixes(words[:4], 3, ended=False)
    second, none = suffixes(rest + words[4:], 3, ended=True)
    assert first.n + second.n == 5 and none == [] and rest == [b"c", b"\n"]


def test_text_over_a_megabyte(spark):
    text = "to be or not " * 100_000 + "\n" + "z" * 5_000_000
    docs = spark.createDataFrame([(text, "en")], "text string, lang string")
    got = {r.phrase: r.a for r in collocations(docs).collect()}
    assert got["be or not to be"] == 99_999 and got["to be or not"] == 100_000 and len(got) == 5


def test_no_rows(spark):
    assert collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_products_beyond_64_bits(spark):
    # exact in decimals: 1000 * a * n
    row = spark.sql("select cast(1000 as decimal(4,0)) * (cast(99999999999999 as decimal(17,0)) * cast(88888888888888 as decimal(17,0)))"
                    " div (cast(77777777777 as decimal(17,0)) * cast(66666666666 as decimal(17,0))) as x").first()
    assert row.x == 1000 * 99999999999999 * 88888888888888 // (77777777777 * 66666666666)
