import re

import numpy as np

from bibspark.llm.sentence_spans import span_dedup
from bibspark.llm.suffix_dedup import LEAST, suffix_dedup
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, words):
    out = []
    while words > 0:
        n = min(words, rng.choice([2, 6, 9, 14, 40]))
        out.append(sentence(rng, n, 2000).capitalize() + rng.choice([".", ".", "!", ""]) + rng.choice([" ", " ", "\n"]))
        words -= n
    return "".join(out)


def made(rng):
    passages = [prose(rng, 70) for _ in range(6)]
    rows = [(None, prose(rng, 80)), (1, None), (2, ""), (3, "one"), (3, "one"), (4, "pad " * 3000)]
    for i in range(10, 90):
        parts = [prose(rng, rng.choice([0, 20, 120])), rng.choice(passages) if i % 2 else "", prose(rng, rng.choice([3, 60]))]
        rows.append((i, "".join(parts)))
    copy = prose(rng, 300)
    return rows + [(200, copy), (201, copy), (202, copy.upper()), (202, copy.upper())]


def order(rows):
    return sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))


def spans_brute(rows, width=3, longest=16):
    def split(text):
        out, words = [], list(WORD.finditer(text or ""))
        for k, m in enumerate(words):
            fresh = k == 0 or words[k - 1][0][-1] in ".!?" or "\n" in text[words[k - 1].end():m.start()] or len(out[-1]) == longest
            out.append([]) if fresh else None
            out[-1].append(m)
        return out

    seen, result = set(), {}
    for doc_id, text in order(rows):
        parts = split(text)
        keys = [tuple(m[0].lower() for s in parts[i:i + width] for m in s) for i in range(len(parts) - width + 1)]
        gone, fresh = set(), set()
        for i, k in enumerate(keys):
            if k in seen or k in fresh:
                gone |= set(range(i, i + width))
            fresh.add(k)
        seen |= fresh
        edges = [s[0].start() for s in parts] + [len(text or "")]
        left = text if text is None else text[:edges[0]] + "".join(
            text[edges[j]:edges[j + 1]] for j in range(len(parts)) if j not in gone)
        result[doc_id] = (doc_id, len(parts), len(gone), left)
    return result


def test_spans_match_brute_force(spark, documents, rng):
    rows = made(rng)
    want = spans_brute(rows)
    got = span_dedup(documents(rows).selectExpr("*", "1 as place", "2 as a", "3 as marks")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r) == want[r.doc_id]
    assert sum(r.n_removed > 0 for r in got) > 20
    assert span_dedup(documents([])).count() == 0


def repeats_brute(rows):
    """For each document, the words that lie in a run of LEAST words which occurs earlier."""
    seen, out = set(), {}
    for doc_id, text in order(rows):
        words = [m[0].lower() for m in WORD.finditer(text or "")]
        gone = np.zeros(len(words), bool)
        fresh = set()
        for i in range(len(words) - LEAST + 1):
            k = tuple(words[i:i + LEAST])
            if k in seen or k in fresh:
                gone[i:i + LEAST] = True
            fresh.add(k)
        seen |= fresh
        out[doc_id] = gone
    return out


def test_suffixes_match_brute_force(spark, documents, rng):
    rows = made(rng)
    want = repeats_brute(rows)
    texts = dict(rows)
    got = suffix_dedup(documents(rows).selectExpr("*", "1 as place", "2 as seed", "3 as marks")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id == 4:  # one word again and again: all but a first run goes
            assert 1 <= r.n_words - r.n_removed <= LEAST
            continue
        words = [m[0] for m in WORD.finditer(texts[r.doc_id] or "")]
        left = [w for w, g in zip(words, want[r.doc_id], strict=True) if not g]
        assert [m[0] for m in WORD.finditer(r.text or "")] == left
        assert (r.n_words, r.n_removed) == (len(words), len(words) - len(left))
    assert sum(r.n_removed > 0 for r in got) > 20
    assert suffix_dedup(documents([])).count() == 0


def test_suffixes_among_edited_copies(spark, documents, rng):
    rows = []
    for group in range(12):
        words = sentence(rng, 130, 5000).split()
        for copy in range(8):
            own = list(words)
            for at in rng.sample(range(len(own)), rng.choice([0, 1, 1, 2])):
                own[at] = f"edit{group}-{rng.randrange(3)}"
            head, tail = (sentence(rng, rng.choice([0, 5, 30])) for _ in range(2))
            rows.append((10 * copy + 1000 * (group % 3) + group, " ".join([head, *own, tail])))
    want, texts = repeats_brute(rows), dict(rows)
    for parts in (1, 5):
        for r in suffix_dedup(documents(rows).repartition(parts)).collect():
            words = WORD.findall(texts[r.doc_id])
            assert WORD.findall(r.text) == [w for w, g in zip(words, want[r.doc_id], strict=True) if not g]
