import random

from bibspark.llm.line_dedup import line_dedup
from tests.llm.conftest import sentence


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, threshold=2, shortest=24):
    seen, out = [], {}
    for doc_id, text in sorted({r for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out[doc_id] = (doc_id, 0, 0, None)
            continue
        kept, lines = [], text.split("\n")
        for line in lines:
            own = line.strip(" \t\r\x0b\x0c")
            if not own or not any(
                    own == o or (min(len(own), len(o)) >= shortest and abs(len(own) - len(o)) <= threshold
                                 and distance(own, o) <= threshold) for o in seen):
                kept.append(line)
            if own:
                seen.append(own)
        out[doc_id] = (doc_id, len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def edited(rng, line, edits):
    chars = list(line)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyzé")
        elif kind == 1:
            chars.insert(at, rng.choice("xyzé"))
        elif len(chars) > 1:
            del chars[at]
    return "".join(chars)


def made(rng):
    rows = [(None, "a line without any id in it\nx"), (1, None), (2, ""), (3, "\n\n"), (4, "x\nx\n x\t\ny"), (5, "y")]
    pool = [sentence(rng, rng.choice([3, 6, 9, 20])) for _ in range(40)]
    for i in range(10, 90):
        lines = []
        for _ in range(rng.randrange(1, 8)):
            line = rng.choice(pool)
            lines.append(edited(rng, line, rng.choice([0, 1, 2, 2, 3, 4])) if rng.random() < 0.6 else sentence(rng, 8))
        rows.append((i, "\n".join(lines)))
    return rows + [(10, rows[6][1])] + [(200, "many words " * 30_000)]


def test_matches_brute_force(spark, documents, rng):
    rows = made(rng)
    want = brute(rows)
    got = line_dedup(documents(rows).selectExpr("*", "1 as no", "2 as first", "'x' as line")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r) == want[r.doc_id]
    assert sum(r.n_removed for r in got) > 50


def test_every_close_pair_is_found(spark, documents):
    rng = random.Random(11)
    rows = []
    for i in range(0, 600, 2):
        line = "".join(rng.choice("ab c") for _ in range(rng.randrange(30, 60))).strip().ljust(30, "q")
        rows += [(i, line), (i + 1, edited(rng, line, rng.choice([1, 2])))]
    got = {r.doc_id: tuple(r) for r in line_dedup(documents(rows)).collect()}
    assert got == brute(rows)


def test_empty_table_and_native_plan(spark, documents):
    assert line_dedup(documents([])).count() == 0
    plan = line_dedup(documents([(1, "a\nb")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
