import re

from bibspark.llm.decontaminate import contamination, decontaminate, digest_of
from tests.llm.conftest import sentence


def brute(rows, items, size=13):
    def words(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)

    out = []
    for doc_id, text in rows:
        own, hit, ids = words(text), set(), set()
        for item, said in items:
            w = words(said)
            n = min(size, len(w))
            for k in range(len(w) - n + 1) if n else ():
                for i in range(len(own) - n + 1):
                    if own[i:i + n] == w[k:k + n]:
                        hit |= set(range(i, i + n))
                        ids.add(str(item))
        out.append((doc_id, len(own), len(hit), len(ids), digest_of(ids), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


def made(rng):
    items = [(i, sentence(rng, rng.choice([13, 14, 30, 60]))) for i in range(20)]
    items += [(100, "short Item"), (101, ""), (102, None), (103, "--- !"), (100, "short Item"), (9, "é é ñ")]
    rows = [(None, "short item"), (1, None), (2, ""), (3, "one"), (3, "one"), (4, "a SHORT-item, é,É é ñ é é ñ")]
    for i in range(60):
        parts = [sentence(rng, rng.choice([0, 5, 50, 300])) for _ in range(2)]
        words = rng.choice(items[:20])[1].split()
        cut = " ".join(words[rng.choice([0, 0, 3]):rng.choice([13, 16, 60])])
        rows.append((10 + i, rng.choice([". ", "\n"]).join([parts[0], cut.upper() if i % 3 else cut, parts[1]])))
    rows.append((999, "pad " * 9_000 + items[0][1]))
    return rows, items


def test_matches_brute_force(spark, documents, rng):
    rows, items = made(rng)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(rows, items)
    got = contamination(documents(rows), bench).collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_slices_add_up(spark, documents, rng):
    from bibspark.llm import decontaminate as module

    rows, items = made(rng)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = module.find_windows(documents(rows), bench).select("doc_id", "found").collect()
    many = module.find_windows(documents(rows), bench, slice_bytes=900).select("doc_id", "found").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_removal_keeps_columns_and_clean_rows(spark, documents, rng):
    rows, items = made(rng)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = documents(rows).selectExpr("*", "'x' as found", "'y' as row")
    dirty = {r[0] for r in brute(rows, items) if r[5]}
    kept = decontaminate(frame, bench)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i not in dirty}
    cut = decontaminate(frame, bench, remove="spans")
    assert cut.count() == len(rows) and not contamination(cut, bench).filter("contaminated").count()
    assert contamination(documents(rows), bench.limit(0)).filter("contaminated or n_items > 0").count() == 0
    assert contamination(documents([]), bench).count() == 0
