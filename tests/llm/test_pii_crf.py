import hashlib
import itertools
import random
import re

import numpy as np

from bibspark.llm import pii_crf as crf
from bibspark.llm.pii_crf import CARD, KINDS, LABELS, OTHER, base_spans, marginals, pii_spans, tokens_of, train
from bibspark.llm.queries import op12_pii_spans

CARDS = ("4556737586899855", "4024007198964305")


def plain_spans(text):
    """The contract's patterns as they stand."""
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    def checked(d):
        values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return sum(v - 9 * (v > 9) for v in values) % 10 == 0

    tests = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and checked(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    return sorted((m.start(), k, m.end()) for k, (p, good) in enumerate(tests) for m in re.finditer(p, text) if good(m))


def test_base_equals_the_plain_patterns():
    rng = random.Random(1)
    for letters, size in (("aB1230.@+- ()%_.0٣5é\n12 9", 40), ("0123456789 -", 40), ("a.@-b1", 20), ("+1 5-(0).", 30)):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, size)))
            assert base_spans(text) == plain_spans(text), text


def test_base_takes_linear_time():
    for text in ("a" * 2_000_000, "1" * 1_000_000, "a@" * 300_000, "1." * 500_000, "+1" + " " * 1_000_000, "1 " * 400_000):
        assert tokens_of(text, base_spans(text)).spans is not None
    assert base_spans("x" * 1_200_000 + " me@mail.org")[0][0] == 1_200_001


def some_model(rng):
    return crf.Model(rng.normal(size=(crf._N_FEATURES, LABELS)), rng.normal(size=(LABELS, LABELS)), 1.3, 0.7)


def enumerated(model, features, labels, beside, equal, alike):
    """Exact marginals by summing over all labellings."""
    own = crf._bits(features) @ model.unary
    n, total = len(features), np.zeros((len(features), LABELS))
    for y in itertools.product(range(LABELS), repeat=n):
        if any(labels[i] != OTHER and y[i] != labels[i] for i in range(n)):
            continue
        e = sum(own[i, y[i]] for i in range(n)) + sum(model.chain[y[i - 1], y[i]] for i in range(n) if beside[i])
        e += sum(w for links, w in ((equal, model.equal), (alike, model.alike))
                 for i in range(n) if links[i] >= 0 and y[i] == y[links[i]])
        total[range(n), list(y)] += np.exp(e)
    return total / total.sum(1, keepdims=True)


def test_messages_give_exact_marginals_on_trees():
    rng = np.random.default_rng(3)
    none = np.full(5, -1)
    cases = [
        ([0, 1, 1, 1, 1], none, none), ([0, 1, 0, 1, 0], np.array([2, -1, -1, -1, -1]), np.array([-1, -1, -1, 4, -1])),
        ([0, 0, 0, 0, 0], np.array([3, 4, -1, -1, -1]), none),
    ]
    for beside, equal, alike in cases:
        features = rng.integers(0, 1 << crf._N_FEATURES, 5) & 0x1111111111
        labels = np.array([OTHER, CARD, OTHER, OTHER, OTHER])
        model = some_model(rng)
        got = marginals(model, features, labels, np.array(beside), equal, alike, rounds=200)
        assert np.allclose(got, enumerated(model, features, labels, beside, equal, alike), atol=1e-4)


def test_messages_on_a_loop_are_near_and_agree():
    rng = np.random.default_rng(5)
    features = np.zeros(4, np.int64)
    beside, equal, alike = np.array([0, 1, 1, 1]), np.array([3, -1, -1, -1]), np.full(4, -1)
    labels = np.array([CARD, OTHER, OTHER, OTHER])
    model = crf.Model(rng.normal(size=(crf._N_FEATURES, LABELS)) * 0.1, rng.normal(size=(LABELS, LABELS)) * 0.1, 2.0, 1.0)
    got = marginals(model, features, labels, beside, equal, alike)
    assert np.allclose(got, enumerated(model, features, labels, beside, equal, alike), atol=0.03)
    assert got[3].argmax() == CARD and got[3, CARD] > got[2, CARD]


def test_equal_and_alike_tokens_are_linked():
    text = "+1-555-2340199 and me.2@x.org or 555-2340199, then me.2@y.org; 555-2340199"
    t = tokens_of(text, base_spans(text))
    assert [text[a:b] for a, b in t.spans] == ["+1-555-2340199", "me.2@x.org", "555-2340199,", "me.2@y.org;", "555-2340199"]
    assert t.equal == [-1, -1, 4, -1, -1] and t.alike == [2, 3, -1, -1, -1]


def sample_rows(rng):
    words = ["the", "mail", "call", "paid", "with", "from", "and"]
    rows = []
    for i in range(400):
        card = rng.choice(CARDS)
        wrong = str(rng.randrange(10**15, 10**16))
        parts = rng.choices(words, k=30)
        parts[4], parts[9], parts[15] = card, f"a.{i}@mail{i % 9}.example.com", wrong
        parts[22] = f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
        parts[26] = ".".join(str(rng.randrange(256)) for _ in range(4))
        rows.append((i, " ".join(parts)))
    return rows


def test_repeated_token_carries_its_label(spark):
    rows = sample_rows(random.Random(7))
    card = CARDS[0]
    # side by side two cards make one digit row too long for the pattern
    rows += [(1000, f"paid with {card} and then {card} {CARDS[1]} for all"), (1001, "nothing 12 here 2024")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = train(docs)
    assert model.equal > 0
    found = {r.doc_id: r.spans for r in pii_spans(docs, model=model).collect()}
    text = rows[400][1]
    assert base_spans(text) == [(10, CARD, 26)]
    assert [(text[s.start:s.end], s.kind, s.base) for s in found[1000]] == [
        (card, "card", True), (card, "card", False), (CARDS[1], "card", False)]
    assert found[1001] == []
    # rows that fail the check digit and all words stay clean
    for doc_id, text in rows[:400]:
        assert [(s.start, KINDS.index(s.kind), s.end) for s in found[doc_id]] == plain_spans(text)


def test_query_base_equals_brute_force(spark, tmp_path):
    rows = [(i, t, "en", "k") for i, t in sample_rows(random.Random(8))]
    rows += [(900, None, None, None), (901, "", "e", None), (None, "me@mail.org", None, None), (902, "me@x.org me@x.org", "", "")]
    rows += [(902, "me@x.org me@x.org", "", ""), (903, "n " * 600_000 + " 1.2.3.4 é 8.8.8.8", None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, spans string, kind string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = op12_pii_spans(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = []
    for doc_id, text, *_ in rows:
        spans = plain_spans(text or "")
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want.append((doc_id, *[sum(k == n for _, k, _ in spans) for n in range(4)], hashlib.sha256(joined.encode()).hexdigest()))
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=key) == sorted(want, key=key)


def test_no_rows_and_no_tokens(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert pii_spans(empty).collect() == []
    plain = spark.createDataFrame([(1, "no such thing"), (2, None)], "doc_id bigint, text string")
    assert [(r.doc_id, r.spans) for r in pii_spans(plain).orderBy("doc_id").collect()] == [(1, []), (2, [])]
