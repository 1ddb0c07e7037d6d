"""Collocations: frequent phrases, counted by multikey quicksort of suffix pointers.

Every word of a piece of text starts a suffix, of which the first ``depth`` words count.
Suffixes are routed to buckets by their leading words, so all suffixes that share them
meet in one task. There the pointers are sorted by three-way quicksort on one word at a
time: the equal part is the set of suffixes that share one word more, its size is the
count of that phrase, and it is sorted on by the next word. A part below ``least`` holds
no frequent phrase and is abandoned, unsorted.

No task gets a hot word whole. One pass over all texts first finds the hot prefixes,
those that may hold more than ``HOT`` of all words; a suffix is routed by its shortest
prefix that is not hot. The few hot prefixes are counted in all their buckets and
summed. At most 2/HOT of them exist for each length, so their table has a proven bound
and is broadcast. Equal suffixes are counted before they are sent, so copies of a text
and frequent passages cost little.

Cases: a NULL text is empty; a NULL language is ``und``; a document without words adds
nothing; repeated rows all count; further columns are not read; no rows give no phrases.
A text of any length is cut between words into steps, whose last words are carried over.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibspark.llm.rows import batches, rows_of, written
from bibspark.operators.ranking import top_per_group

DEPTH, LEAST, TOP = 5, 100, 2000
HOT = 1 / 8192  # the share of all words above which a prefix is routed by one word more
_STEP = 1 << 19  # words taken at a time
_SLICE = 1 << 22  # bytes of one text taken at a time
_PER_BUCKET = 1 << 19  # words for each bucket, about
_FEW_LANGUAGES = 10_000  # beyond it the sizes of the languages are joined by a shuffle
UNKNOWN = "und"

# Capitals, the ends of pieces, and the second blank.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in steps, a line end after each piece that ends there."""
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        to = at + _SLICE
        if to < len(text):
            cut = max(text.rfind(b" ", at, to), text.rfind(b"\n", at, to))
            if cut < 0:  # one very long word
                ends = [e for e in (text.find(b" ", to), text.find(b"\n", to)) if e >= 0]
                cut = min(ends, default=len(text))
            to = cut + 1
        yield [w for w in text[at:to].replace(b"\n", b" \n ").split(b" ") if w]
        at = to


@dataclass
class Suffixes:
    """Distinct suffixes of one language: word numbers (0 for none), their counts, the words."""

    rows: np.ndarray  # suffixes x depth, in order
    counts: np.ndarray
    words: list[bytes]  # word k has number k + 1
    n: int  # all words that start a suffix


def _heads(rows: np.ndarray, k: int) -> np.ndarray:
    """Where each distinct prefix of ``k`` words begins in ordered rows."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :k] != rows[:-1, :k]).any(1)
    return np.flatnonzero(new)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in order with their counts; exact.

    As many columns as fit are packed into one number and replaced by its rank.
    """
    bits = int(rows.max(initial=1)).bit_length()
    key, used = rows[:, 0].astype(np.int64), bits
    for k in range(1, rows.shape[1]):
        if used + bits > 62:
            order = np.argsort(key)
            new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            key[order] = new
            used = int(new[-1]).bit_length()
        key = (key << bits) | rows[:, k]
        used += bits
    order = np.argsort(key)
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    return rows[order[first]], np.diff(first, append=len(key))


def suffixes(run: list[bytes], depth: int, ended: bool) -> tuple[Suffixes, list[bytes]]:
    """The suffixes that start in ``run`` and the words to carry over.

    Unless the text has ``ended``, the last words need those that follow.
    """
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    number[b"\n"] = 0
    ids = np.array(list(map(number.__getitem__, run)), np.int32)
    starts = len(ids) if ended else max(0, len(ids) - depth + 1)
    carried = run[starts:]
    padded = np.concatenate([ids, np.zeros(depth, np.int32)])
    rows = np.stack([padded[k : k + starts] for k in range(depth)], 1)
    for k in range(1, depth):  # nothing after the end of a piece
        rows[:, k] *= rows[:, k - 1] > 0
    rows = rows[rows[:, 0] > 0]
    counts = np.zeros(0, np.int64)
    if len(rows):
        rows, counts = _distinct(rows)
        counts = counts.astype(np.int64)
    return Suffixes(rows, counts, list(number)[1:], int(counts.sum())), carried


def steps(parts: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[str, Suffixes]]:
    """The suffixes of all texts of a task, language by language, in steps of bounded size."""
    waiting: dict[str, list[bytes]] = {}
    for batch in parts:
        languages = batch.column("lang").to_pylist()
        for lang, text in zip(languages, rows_of(batch), strict=True):
            run = waiting.setdefault(lang, [])
            for step in tokens(text):
                run += step
                if len(run) >= _STEP:
                    found, run[:] = suffixes(run, depth, ended=False)
                    yield lang, found
            run.append(b"\n")
        while sum(map(len, waiting.values())) >= 2 * _STEP:  # many languages
            lang = max(waiting, key=lambda name: len(waiting[name]))
            yield lang, suffixes(waiting.pop(lang), depth, ended=True)[0]
    for lang, run in waiting.items():
        if run:
            yield lang, suffixes(run, depth, ended=True)[0]


def _phrase(words: list[bytes], row) -> bytes:
    return b" ".join(words[k - 1] for k in row if k)


# ---- first pass: the size of each language, hot prefixes ----

_HOT_ROWS = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64())])


def _prefix_counts(texts: DataFrame, depth: int, hot: float) -> DataFrame:
    """(lang, phrase, n): per language all words under the empty phrase, and the
    prefixes that hold at least half of ``hot`` of a step, which no hot prefix escapes
    in all steps."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in steps(parts, depth):
            rows = [(lang, b"", found.n)]
            for k in range(1, depth if found.n else 1):
                first = _heads(found.rows, k)
                counts = np.add.reduceat(found.counts, first)
                heads = found.rows[first, :k]
                often = (counts >= hot / 2 * found.n) & (heads[:, -1] > 0)
                rows += [(lang, _phrase(found.words, h), c) for h, c in zip(heads[often].tolist(), counts[often].tolist(), strict=True)]
            yield batches(dict(zip(_HOT_ROWS.names, zip(*rows, strict=True), strict=True)), _HOT_ROWS)

    return texts.mapInArrow(run, "lang string, phrase binary, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


# ---- second pass: routing ----

_BLOB = pa.schema([("bucket", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("rows", pa.binary()),
                   ("counts", pa.binary()), ("levels", pa.binary())])
_BLOB_DDL = "bucket bigint, lang string, words binary, `rows` binary, counts binary, levels binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _tries(hot: list[tuple[str, bytes]]) -> dict[str, list[dict[tuple[int, bytes], int]]]:
    """Per language and length the hot prefixes: (number of the prefix one word shorter, last word) to number."""
    tries: dict[str, list[dict]] = {}
    for lang, phrase in sorted(hot, key=lambda h: h[1].count(b" ")):
        words = phrase.split(b" ")
        levels = tries.setdefault(lang, [])
        if len(levels) < len(words):
            levels.append({})
        at = 0
        for level, word in zip(levels, words[:-1], strict=False):
            at = level[at, word]
        levels[len(words) - 1][at, words[-1]] = len(levels[len(words) - 1])
    return tries


def _route(found: Suffixes, lang: str, hot: dict, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Each suffix's bucket and the number of leading words it was dealt by."""
    n, depth = found.rows.shape
    number = {w: k + 1 for k, w in enumerate(found.words)}
    level, going, state = np.ones(n, np.int64), np.arange(n), np.zeros(n, np.int64)
    for k, trie in enumerate(hot.get(lang, ())[: depth - 1]):
        width = len(number) + 1
        known = [(at * width + number[word], to) for (at, word), to in trie.items() if word in number]
        if not known:
            break
        known_keys, known_to = np.array(sorted(known), np.int64).T
        keys = state * width + found.rows[going, k]
        place = np.minimum(np.searchsorted(known_keys, keys), len(known_keys) - 1)
        is_hot = known_keys[place] == keys
        going, state = going[is_hot], known_to[place[is_hot]]
        level[going] = k + 2
    hashes = np.concatenate([np.zeros(1, np.uint64), _word_hashes(found.words)])
    mixed = np.full(n, _word_hashes([lang.encode()])[0])
    for k in range(depth):
        some = np.flatnonzero(level > k)
        mixed[some] = _mixed(mixed[some] ^ hashes[found.rows[some, k]] + np.uint64(k))
    return (mixed % np.uint64(buckets)).astype(np.int64), level


def _packed(found: Suffixes, some: np.ndarray, level: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Some suffixes with their own small word list."""
    rows = found.rows[some]
    own = np.zeros(len(found.words) + 1, np.uint32)
    own[rows] = 1
    own[0] = 0
    used = np.flatnonzero(own)
    own[used] = np.arange(1, len(used) + 1)
    size = np.uint16 if len(used) < 1 << 16 else np.uint32
    words = b" ".join([found.words[k - 1] for k in used.tolist()])
    return words, own.astype(size)[rows].tobytes(), found.counts[some].astype(np.uint32).tobytes(), level[some].astype(np.uint8).tobytes()


def _routed(texts: DataFrame, depth: int, hot: list[tuple[str, bytes]], buckets: int) -> DataFrame:
    known = texts.sparkSession.sparkContext.broadcast(_tries(hot))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in steps(parts, depth):
            bucket, level = _route(found, lang, known.value, buckets)
            order = np.argsort(bucket, kind="stable")
            ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
            at, rows = 0, []
            for end in ends.tolist():
                some = order[at:end]
                rows.append((int(bucket[some[0]]), lang, *_packed(found, some, level)))
                at = end
            if rows:
                yield batches(dict(zip(_BLOB.names, zip(*rows, strict=True), strict=True)), _BLOB)

    return texts.mapInArrow(run, _BLOB_DDL)


# ---- sorting ----


def phrase_counts(rows: np.ndarray, weights: np.ndarray, levels: np.ndarray, least: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Word numbers and count of each frequent phrase of the suffixes ``rows``.

    Phrases shorter than the leading words a suffix was dealt by have further suffixes
    in other buckets: they come out with what they have here, and are not abandoned.
    """
    depth = rows.shape[1]
    columns = [np.ascontiguousarray(rows[:, k]) for k in range(depth)]
    parted = levels > 1  # mostly those dealt by one word more
    stack = [(np.arange(len(rows)), 0, ())] if len(rows) else []
    while stack:
        pointers, place, before = stack.pop()
        words = columns[place][pointers]
        # the middle of three as the pivot
        a, b, c = int(words[0]), int(words[len(words) // 2]), int(words[-1])
        pivot = max(min(a, b), min(max(a, b), c))
        same = words == pivot
        equal = pointers if same.all() else pointers[same]
        if len(equal) < len(pointers):
            for side in (words < pivot, words > pivot):
                part = pointers[side]
                if len(part) and (weights[part].sum() >= least or (parted[part].any() and (levels[part] > place + 1).any())):
                    stack.append((part, place, before))
        if pivot == 0:
            continue  # the ends of pieces
        total = int(weights[equal].sum())
        if total >= least or levels[equal[0]] > place + 1:
            phrase = (*before, pivot)
            yield phrase, total
            if place + 1 < depth:
                stack.append((equal, place + 1, phrase))


_COUNTED = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])


def _counted(routed: DataFrame, depth: int, least: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        languages = np.array(table.column("lang").to_pylist(), object)
        for lang in dict.fromkeys(languages):
            number: dict[bytes, int] = {}
            rows, weights, levels = [], [], []
            for k in np.flatnonzero(languages == lang).tolist():
                words = table["words"][k].as_py().split(b" ")
                own = np.array([0] + [number.setdefault(w, len(number) + 1) for w in words], np.int32)
                packed = table["rows"][k].as_py()
                weights.append(np.frombuffer(table["counts"][k].as_py(), np.uint32))
                size = np.uint16 if len(packed) == len(weights[-1]) * depth * 2 else np.uint32
                rows.append(own[np.frombuffer(packed, size)].reshape(-1, depth))
                levels.append(np.frombuffer(table["levels"][k].as_py(), np.uint8))
            known = list(number)
            found = phrase_counts(np.concatenate(rows), np.concatenate(weights).astype(np.int64), np.concatenate(levels), least)
            out += [(lang, len(p), b" ".join(known[i - 1] for i in p).decode(), n) for p, n in found]
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.table(dict(zip(_COUNTED.names, map(list, columns), strict=True)), schema=_COUNTED)

    return routed.groupBy("bucket").applyInArrow(run, "lang string, size int, phrase string, n bigint")


def frequent_phrases(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, hot: float = HOT) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``depth`` words that occur ``least`` times (lang, size, phrase, n),
    and the words of each language (lang, n)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    prefixes = written(_prefix_counts(texts, depth, hot), "prefixes")
    sizes = prefixes.filter((F.length("phrase") == 0) & (F.col("n") > 0)).select("lang", "n")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # bounded: at most 2 / hot prefixes of each length
    rows = prefixes.filter((F.length("phrase") > 0) & (F.col("n") >= hot / 2 * total)).select("lang", "phrase").collect()
    buckets = max(1, -(-total // _PER_BUCKET), int(spark.conf.get("spark.sql.shuffle.partitions")))
    routed = _routed(texts, depth, [(r.lang, bytes(r.phrase)) for r in rows], buckets)
    counted = _counted(routed, depth, least).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return written(counted.filter(F.col("n") >= least), "phrases"), sizes


def _words(phrase: str | Column, first: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, size), " ")


def _exact(x: Column) -> Column:
    return x.cast("decimal(17,0)")


def collocations(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, top: int | None = TOP, hot: float = HOT) -> DataFrame:
    """The best phrases of two or more words of each language, with rank and score.

    The score of a cut is floor(1000 a n / (l r)); the lowest counts, then the first. A
    phrase goes when a longer frequent one that contains it occurs as often.
    """
    phrases, sizes = frequent_phrases(docs, depth, least, hot)
    many = phrases.filter("size > 1")
    # how often each phrase occurs inside longer ones: contiguous parts of two words or more
    parts = many.filter("size > 2").select("lang", "n", "phrase", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k"), "size")
    parts = parts.select("lang", "n", "k", "phrase", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("i"))
    inside = parts.select("lang", _words("phrase", F.col("i"), F.col("k")).alias("phrase"), "n")
    inside = inside.groupBy("lang", "phrase").agg(F.max("n").alias("within"))
    kept = many.join(inside, ["lang", "phrase"], "left").filter(F.coalesce(F.col("within") < F.col("n"), F.lit(True)))
    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({
        "left": _words("phrase", F.lit(1), F.col("k")), "right": _words("phrase", F.col("k") + 1, F.col("size")),
    })
    known = phrases.select("lang", "phrase", "n")
    cuts = cuts.join(known.withColumnsRenamed({"phrase": "left", "n": "l"}), ["lang", "left"])
    cuts = cuts.join(known.withColumnsRenamed({"phrase": "right", "n": "r"}), ["lang", "right"])
    few = sizes.limit(_FEW_LANGUAGES + 1).count() <= _FEW_LANGUAGES
    cuts = cuts.join(F.broadcast(sizes) if few else sizes, "lang")
    product, divisor = _exact(F.col("a")) * _exact(F.col("n")) * F.lit(1000).cast("decimal(4,0)"), _exact(F.col("l")) * _exact(F.col("r"))
    cuts = cuts.withColumns({"_product": product, "_divisor": divisor})
    cuts = cuts.withColumn("score", F.expr("_product div _divisor"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = best.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    chosen = scored if top is None else top_per_group(scored, ["lang"], order, ["phrase"], top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return chosen.select("lang", rank.alias("rank"), "phrase", "a", "l", "r", "n", "score")
