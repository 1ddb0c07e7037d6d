import hashlib

from pyspark.sql import functions as F

from bibspark.llm.fingerprints import fingerprints, lexicon, terms
from tests.llm.conftest import sentence


def made(rng):
    rows = [(None, "no id"), (1, None), (2, ""), (3, "!!!"), (4, "???"), (-7, "below zero"), (6, "same text here"),
            (9, "same text here"), (9, "same text here"), (10**12, "é" * 5)]
    rows += [(2000 + 37 * i, sentence(rng, rng.choice([5, 40, 400]))) for i in range(200)]
    return rows + [(10**6, "pad words " * 50_000)]


def test_edits_and_order(spark, documents, rng):
    rows = made(rng)
    got = fingerprints(documents(rows).selectExpr("*", "1 as id", "2 as next", "3 as bucket").repartition(3)).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        text = dict(ordered)[r.doc_id]
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    assert len({by_text["!!!"], by_text["???"], by_text[""]}) == 3
    long = [r for r in got if r.n_chars > 200 and r.doc_id != 10**6]
    assert sum(r.near_edited for r in long) > 5 * sum(r.near_next for r in long)


def test_many_groups_of_ids(spark, documents, monkeypatch, rng):
    from bibspark.llm import fingerprints as module

    monkeypatch.setattr(module, "_BUCKET", 3)
    test_edits_and_order(spark, documents, rng)


def test_empty_table_and_native_plan(spark, documents):
    assert fingerprints(documents([])).count() == 0
    plan = fingerprints(documents([(1, "a b")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_lexicon_counts_every_term_by_itself(spark, documents):
    # more rare terms than any fixed number of slots could tell from those of the band
    rows = [(i, " ".join([*(f"rare{i}x{j}" for j in range(1500)), *(f"band{k}" for k in range(40) if (i + k) % 20 == 0), "all"]))
            for i in range(400)]
    docs = documents(rows)
    known = {r.term for r in lexicon(docs.select("text")).collect()}
    band = spark.createDataFrame([(f"band{k}",) for k in range(40)], "w string").select(F.get(terms(F.col("w")), 0).alias("term"))
    assert known == {r.term for r in band.collect()}


def test_a_lexicon_of_any_size_gives_the_same(spark, documents, monkeypatch, rng):
    from bibspark.llm import fingerprints as module

    frame = documents(made(rng))
    small = sorted(map(str, fingerprints(frame).collect()))
    monkeypatch.setattr(module, "MOST", 0)
    assert sorted(map(str, fingerprints(frame).collect())) == small


def test_no_plan_holds_the_lexicon(spark, documents, monkeypatch, rng):
    from bibspark.llm import fingerprints as module

    frame = documents([(i, sentence(rng, 60)) for i in range(100)])
    known = {str(r.term) for r in lexicon(frame.select("text")).collect()}
    assert len(known) > 100
    plans, kept = {}, module.written

    def spied(df, name):
        plans[name] = df._jdf.queryExecution().toString()
        return kept(df, name)

    monkeypatch.setattr(module, "written", spied)
    rows = fingerprints(frame)
    plans["result"] = rows._jdf.queryExecution().toString()
    for name, plan in plans.items():
        assert not any(t in plan for t in known), name
    # nor do rows carry it from one step to the next
    assert "AS _slots" not in plans["marked"].split("== Physical Plan ==")[1]


def test_a_lexicon_that_rows_carry_gives_the_same(spark, documents, rng):
    from bibspark.llm.fingerprints import fingerprint, in_slots, with_joined, with_looked_up

    frame = documents([(i, sentence(rng, 60)) for i in range(100)])
    known = lexicon(frame.select("text"))
    rows = frame.select("doc_id", F.upper("text").alias("t"))
    twice = F.concat("t", F.lit(" "), "t")
    got = with_looked_up(rows, twice, in_slots(known), "own", lambda text, fp: fp)
    assert "AS _slots" in got._jdf.queryExecution().executedPlan().toString()
    joined = with_joined(rows.withColumn("e", twice), "e", known, "found")
    want = joined.select("doc_id", "t", fingerprint(F.col("e"), F.col("found")).alias("own"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def brute_fingerprint(text, hashes_of, known):
    """The level and the terms of each subset, with sets of Python."""
    all_ = hashes_of[text]
    inside = [t for t in all_ if t in known]
    chosen = sorted(inside if len(inside) >= 8 else all_)
    if not chosen:
        return text
    level = max(0, (len(chosen) // 24).bit_length() - 1)
    cells = []
    for step in (0, 1):
        kept = [t for t in chosen if ((t % 2**64) >> 24) & (2 ** (level + step) - 1) == 0]
        cells += [tuple(t for t in kept if ((t % 2**64) >> 18) % 32 == k) for k in range(32)]
    return level, tuple(cells)


def brute_likeness(a, b):
    if a == b:
        return 1.0
    if isinstance(a, str) or isinstance(b, str) or abs(a[0] - b[0]) > 1:
        return 0.0
    low, high = slice(0, 32), slice(32, 64)
    both = slice(0, 64)
    x, y = {0: (both, both), 1: (high, low), -1: (low, high)}[b[0] - a[0]]
    pairs = [(p, q) for p, q in zip(a[1][x], b[1][y], strict=True) if p or q]
    return sum(p == q for p, q in pairs) / len(pairs) if pairs else 0.0


def test_against_brute_force(spark, documents, rng):
    rows = [(i, t) for i, t in made(rng) if i != 9 and i is not None]
    rows.sort(key=lambda r: -r[0])
    texts = [t or "" for _, t in rows]
    edited = []
    for k, text in enumerate(texts):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + texts[(k + 1) % len(texts)][:half])
    distinct = sorted({*texts, *edited})
    hashes = spark.createDataFrame([(t,) for t in distinct], "t string").select("t", terms(F.col("t")).alias("h")).collect()
    hashes_of = {r.t: r.h for r in hashes}
    counts = {}
    for text in texts:
        for t in hashes_of[text]:
            counts[t] = counts.get(t, 0) + 1
    known = {t for t, n in counts.items() if 2 <= n <= max(2, len(rows) / 4)}
    own = [brute_fingerprint(t, hashes_of, known) for t in texts]
    other = [brute_fingerprint(t, hashes_of, known) for t in edited]
    got = {r.doc_id: r for r in fingerprints(documents(rows)).collect()}
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        assert abs(got[i].near_edited - brute_likeness(own[k], other[k])) < 1e-9
        assert abs(got[i].near_next - brute_likeness(own[k], own[(k + 1) % len(rows)])) < 1e-9
    for a in range(len(rows)):
        for b in range(a):
            assert (got[rows[a][0]].fingerprint == got[rows[b][0]].fingerprint) == (own[a] == own[b])
