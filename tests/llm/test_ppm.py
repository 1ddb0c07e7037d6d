import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bibspark.llm import ppm, words
from tests.llm.conftest import sentence


def words_of(text):
    return [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]


def brute(rows):
    """Base and model scores by direct counting, a byte at a time."""
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for t in train for w in [*words_of(t), None])
    total, scale = sum(count.values()), sum(count.values()) + len(count) + 1

    def coded(text):
        return b"\xff" * 6 + b" ".join(words_of(text)) + b"\xff"

    seen = defaultdict(Counter)
    for t in train:
        s = coded(t)
        for i in range(6, len(s)):
            for k in range(7):
                seen[s[i - k : i]][s[i]] += 1
    memory = {}

    def spread(context):
        if context not in memory:
            lower = spread(context[1:]) if context else np.full(256, 1 / 256)
            own = np.array([seen[context][s] for s in range(256)], float) if context in seen else np.zeros(256)
            n, q = own.sum(), (own > 0).sum()
            left = lower[own == 0].sum()
            memory[context] = lower
            if n >= (2 if context else 1):
                memory[context] = np.where(own > 0, (2 * own - 1) / (2 * n), q / (2 * n) * lower / left) if left else own / n
        return memory[context]

    out = []
    for i, t in rows:
        s = coded(t)
        score = sum(math.log10(spread(s[k - 6 : k])[s[k]]) for k in range(6, len(s)))
        w = [*words_of(t), None]
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        out.append((i, held, len(w), sum(count[x] > 0 for x in w), total,
                    sum(math.log10((count[x] + 1) / scale) for x in w), score))
    assert all(abs(p.sum() - 1) < 1e-9 for p in memory.values())
    return out


def made(rng):
    rows = [(None, "no id"), (1, None), (2, ""), (3, "One"), (3, "One"), (4, " \n\t é ß 日本語 \U0001f600"), (5, "x" * 300)]
    return rows + [(10 + i, sentence(rng, rng.choice([1, 30, 200])) + rng.choice(["", ".", "\n"])) for i in range(80)]


@pytest.mark.parametrize("sent", [1 << 21, 200, 0])
def test_matches_brute_force(spark, documents, rng, monkeypatch, sent):
    monkeypatch.setattr(ppm, "_SENT", sent)
    rows = made(rng)
    got = ppm.score(documents(rows).selectExpr("*", "1 as row", "2 as word", "3 as times").repartition(4)).collect()
    assert len(got) == len(rows)
    for a, b in zip(sorted(map(tuple, got), key=str), sorted(brute(rows), key=str), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_text_over_a_megabyte(spark, documents, rng):
    rows = [(1, " ".join(sentence(rng, 2000) for _ in range(130))), (2, "a b"), (10, sentence(rng, 50))]
    assert len(rows[0][1]) > 1 << 20
    got = ppm.score(documents(rows)).collect()
    for a, b in zip(sorted(map(tuple, got)), sorted(brute(rows)), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_held_out_texts_cost_less_than_even_odds(spark, documents, rng):
    rows = [(i, " ".join(rng.choice(("the", "ring", "tion", "and")) + rng.choice(("ed", "ly", "")) for _ in range(60)))
            for i in range(300)]
    got = [r for r in ppm.score(documents(rows)).collect() if r.held_out]
    size = sum(len(b" ".join(words_of(dict(rows)[r.doc_id]))) + 1 for r in got)
    assert len(got) > 20 and sum(r.score for r in got) > -0.4 * size


def test_nothing_to_learn_from(spark, documents):
    assert ppm.score(documents([])).count() == 0
    held = next(i for i in range(100) if not ppm.is_training(i))
    row = ppm.score(documents([(held, "a b")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)


def test_pieces_of_a_long_text_are_coded_as_the_whole(monkeypatch, rng):
    texts = [sentence(rng, 200).encode(), b"", b" ", b"  lead " + sentence(rng, 90).encode() + b"  \n ", b" " * 300,
             b"a" + b" " * 200 + b"b", b"short one", b"x" * 500, " ".join("\u00e9t\u00e9" for _ in range(60)).encode()]

    def steps():
        out = {k: [] for k in range(len(texts))}
        for first, low, where, owner in ppm.coded(texts):
            for code, k in zip(ppm.grams(low, where).tolist(), owner.tolist(), strict=True):
                out[first + k].append(code)
        return out

    whole = steps()
    for size in (16, 64, 150):
        monkeypatch.setattr(words, "_SLICE", size)
        assert steps() == whole
    assert [len(whole[k]) for k in (1, 2, 4, 5)] == [1, 1, 1, 4]


@pytest.mark.parametrize("word", [True, False])
def test_counts_that_are_given_out_in_parts_add_up(monkeypatch, rng, word):
    monkeypatch.setattr(ppm, "_FRESH", 50)
    monkeypatch.setattr(ppm, "_TALLY", 120)
    monkeypatch.setattr(ppm, "_ROWS", 32)
    tally, batches, want = ppm._Tally(word), [], Counter()
    for _ in range(40):
        keys = [rng.randrange(-300 if word else 0, 300) for _ in range(rng.randrange(40))]
        learnt = [word or rng.random() < 0.7 for _ in keys]
        for k, own in zip(keys, learnt, strict=True):
            want[k, "n"] += own
            want[k, "times"] += 1
        given = () if word else (np.array(learnt, bool),)
        batches += tally.add(np.array(keys, np.int64), *given)
    assert len(batches) > 3
    got = Counter()
    for batch in [*batches, *tally.rest(), *tally.rest()]:
        assert 0 < len(batch) <= 32
        for r in batch.to_pylist():
            assert r["is_word"] == word
            got[r["key"], "n"] += r["n"]
            got[r["key"], "times"] += r["times"]
    assert +got == +want
