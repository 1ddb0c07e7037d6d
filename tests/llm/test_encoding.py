import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bibspark.llm.encoding import encoder
from bibspark.llm.packing import Schedule, pack
from bibspark.llm.token_counts import token_counts
from tests.llm.conftest import sentence

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def odd_texts(rng, count):
    parts = ["a", "It's", " ", "  ", "\n", " \n", "\n ", "\t", "é", "日本語", "\xa0", " ", "<|endoftext|>", "<|endof",
             "12", "!!", "'ll", "\U0001f600", "\r\n", "\x1c", "\x00", "​", "ß."]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(count)]


def test_ranks_and_splices_give_the_library_ids(rng):
    own = encoder(PATH)
    texts = odd_texts(rng, 3000) + [sentence(rng, 200) for _ in range(50)]
    assert own.ranks is not None
    for text in [*texts, sentence(rng, 300_000)]:
        assert np.frombuffer(own.ids(text), own.dtype).tolist() == library_ids(text)
    for text in [*odd_texts(rng, 400), "x" * 3000, "日本語" * 500, " " * 900]:
        for chunk, overlap in ((7, 3), (40, 8), (200, 16)):
            spliced = b"".join(own.spliced(text, chunk, overlap))
            assert np.frombuffer(spliced, own.dtype).tolist() == library_ids(text), (text, chunk)


def rows_made(rng):
    rows = [(None, "no id"), (1, None), (2, ""), (3, "one"), (3, "one"), (4, "A b <|endoftext|> c"), (5, "x" * 50_000)]
    rows += [(10 + i, sentence(rng, rng.choice([1, 30, 300, 3000]))) for i in range(80)]
    return rows + [(500, "word " * 300_000 + "ß")]


def test_counts(spark, documents, rng):
    rows = rows_made(rng)
    got = token_counts(documents(rows), PATH, chunk=5000).collect()
    want = [(i, len((t or "").encode()), len(library_ids(t)), len(library_ids(t)) > 1024) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts(documents([]), PATH).count() == 0


@pytest.mark.parametrize("targets", [None, {"s0": 5, "s1": 1}])
def test_packing_round_trip(spark, documents, rng, targets):
    rows = rows_made(rng)[:-1]
    frame = documents(rows).selectExpr("*", "'x' as place", "1 as queue", "2 as block").repartition(5)
    got = pack(frame, PATH, targets).collect()
    sequences, by_doc = {}, {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.source))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(s == 2048 or s & (s - 1) == 0 for s in sizes) and sum(s == 2048 for s in sizes) >= len(sizes) - 11
    for doc_id, text in rows:
        if rows.count((doc_id, text)) > 1:
            continue
        ids = np.array([*library_ids(text), 1], "<u4")
        at = 0
        for r in sorted(by_doc[(doc_id, len(ids))], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert sum(r.length for r in got) == sum(len(library_ids(t)) + 1 for _, t in rows)


def test_every_window_holds_the_targets():
    rng = random.Random(3)
    sizes = [rng.choice([1, 50, 4000, 300_000]) for _ in range(12)]
    plan = Schedule(sizes, sizes, length=256, span=8)
    share = np.array(sizes) / sum(sizes)
    windows, at = [], 0
    while sum(len(w) for w in windows) < sum(sizes) // 256:
        before, _ = plan.replay(at)
        windows.append(np.diff(before, axis=0))
        at += 1
    takes = np.concatenate(windows)[: sum(sizes) // 256]
    assert (takes.sum(axis=1) == 256).all() and (takes >= 0).all()
    drift = np.cumsum(takes - share * 256, axis=0)
    assert np.abs(drift).max() <= 2.5


@pytest.mark.parametrize("windows", [1, 98, 4883])
def test_targets_hold_in_every_window_until_a_queue_is_dry(windows):
    size = windows * 1024
    plan = Schedule([size, size], [5, 1])
    takes, at = [], 0
    while sum(map(len, takes)) < windows:
        takes.append(np.diff(plan.replay(at)[0], axis=0))
        at += 1
    takes = np.concatenate(takes)
    assert takes.sum(axis=0).tolist() == [size, size] and (takes.sum(axis=1) == 2048).all()
    wet = int(size * 6 / 5) // 2048
    assert np.abs(takes[:wet, 0] - 2048 * 5 / 6).max(initial=0) <= 2
    assert (takes[wet + 1 :, 0] <= 2).all()
    for queue, place in ((0, 0), (0, size - 1), (1, size // 3), (1, size - 1)):
        (_, n, _, _), = plan.pieces(queue, place, 1)
        assert n == 1


def test_many_sources_keep_their_targets(spark):
    heavy = {f"s{k}": 3 if k < 5 else 1 for k in range(10)}
    rows = [(i, "a b c d e f g h " * 400, f"s{i % 10}") for i in range(40)]
    rows += [(100 + i, "word " * (5 + i % 40), f"s{10 + i}") for i in range(1018)]
    rows += [(5000, "null", None), (5001, "empty", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = pack(docs, PATH, {**heavy, None: 0}).collect()
    assert sum(r.length for r in got) == sum(len(library_ids(t)) + 1 for _, t, _ in rows)
    share = {}
    for r in got:
        share.setdefault(r.sequence_id, {}).setdefault(r.source, 0)
        share[r.sequence_id][r.source] += r.length
    whole = 4 * (len(library_ids(rows[0][1])) + 1) * 20 // 3  # tokens until the first queue is dry
    assert whole > 4 * 2048
    for window in range(whole // 2048):
        for name, weight in heavy.items():
            assert abs(share[window].get(name, 0) - 2048 * weight / 20) <= 2


def test_packing_an_empty_table(spark, documents):
    assert pack(documents([]), PATH).count() == 0
