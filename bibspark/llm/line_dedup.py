"""Line dedup: a segment-partition edit join over the distinct lines, in built-in functions only.

A line within THRESHOLD edits of another leaves one of THRESHOLD + 1 even segments of
the shorter one untouched. The segments of all lines are the index; each line probes it
with the substrings where such a segment of a line as long or shorter can lie. Lines
that meet on a substring are compared by banded edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.llm.rows import KEY, keyed, on_key, written

THRESHOLD = 2
SHORTEST = 24  # characters; shorter lines are compared for equality only
CLASSES = ("ae", "io", "nr", "st", "dlu", " cmh")  # characters counted before lines are compared; any choice is exact

_SPACE = " \t\r\x0b\x0c"


def segments(units: Column, size: Column, threshold: int) -> tuple[list[Column], list[Column]]:
    """A line's own segments, and the other substrings by which it finds lines as long or shorter.

    ``units`` are its characters in four bytes each, so a substring is cut without
    walking the text. For a partner ``less`` characters shorter, its i-th of n segments,
    starting at p, can lie where both the edits before it (i at most) and those behind it
    (n - 1 - i at most) suffice for the shift. The length of the shorter line is hashed
    with the segment, so lines whose lengths are too far apart never meet.
    """
    n = threshold + 1
    own, others = [], []
    for less in range(threshold + 1):
        base, longer = F.floor((size - less) / n).cast("int"), F.pmod(size - less, F.lit(n)).cast("int")
        for i in range(n):
            # the last segments are one character longer
            length = base + F.when(longer >= n - i, 1).otherwise(0)
            start = base * i + F.greatest(longer - (n - i), F.lit(0))
            low, high = max(-i, less - (n - 1 - i)), min(i, less + (n - 1 - i))
            for shift in range(low, high + 1):
                piece = F.substring(units, (start + shift) * 4 + 1, length * 4)
                found = others if less or shift else own
                found.append(F.xxhash64(F.lit(i), size - less, piece))
    return own, others


def _trimmed(line: Column) -> Column:
    """A line without outer white space; most have none, which is seen by two characters."""
    outer = [F.substring(line, at, 1).isin(*_SPACE) for at in (1, -1)]
    return F.when(outer[0] | outer[1], F.btrim(line, F.lit(_SPACE))).otherwise(line)


def _occurrences(docs: DataFrame) -> DataFrame:
    """Every line that is not blank, by two hashes of it without outer white space."""
    lines = keyed(docs.select("doc_id", "text")).select(
        "doc_id", KEY, F.posexplode(F.split("text", "\n")).alias("no", "line"))
    lines = lines.withColumn("line", _trimmed(F.col("line"))).filter("line <> ''")
    return lines.select("doc_id", KEY, "no", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"), "line")


def _near(lines: DataFrame, threshold: int, shortest: int) -> DataFrame:
    """(a, b) of the distinct lines that an earlier one is within the threshold of."""
    sized = lines.withColumn("size", F.length("line")).filter(F.col("size") >= shortest)
    units = sized.select("a", "size", F.encode("line", "UTF-32").alias("units"))
    own, others = segments(F.col("units"), F.col("size"), threshold)
    # one hash names a line here; lines that share it by chance are told apart by their texts below
    index = units.select("a", F.explode(F.array(*own)).alias("segment"))
    probes = units.select("a", F.explode(F.array(*others)).alias("segment"))
    held = index.groupBy("segment").agg(F.min("a").alias("low"), F.max("a").alias("high"))
    hits = written(
        probes.join(held, "segment").filter("low <> high or low <> a").select("segment", "a"), "hits")
    shared = held.filter("low <> high").select("segment").union(hits.select("segment")).distinct()
    met = written(hits.union(index.join(shared, "segment").select("segment", "a")), "segments")
    counts = {f"n{i}": F.length(F.translate("line", chars, "")) for i, chars in enumerate(CLASSES)}
    # the lines met grow with the input, so they are merged at every size and broadcast at none
    texts = written(sized.join(met.select("a").distinct().hint("merge"), "a", "left_semi").withColumns(counts), "near_lines")
    whole = met.join(texts, "a")
    other = whole.select("segment", F.col("line").alias("other"), F.col("size").alias("other_size"),
                         F.col("first").alias("other_first"), *[F.col(c).alias(f"other_{c}") for c in counts])
    # a replaced character moves two counts by one, a lost or added one moves one; the counts
    # are of what is left without a class, so the lengths' difference is taken off
    apart = sum((F.abs((F.col("size") - F.col(c)) - (F.col("other_size") - F.col(f"other_{c}"))) for c in counts), F.lit(0))
    close = ((F.col("other_first") < F.col("first")) & (F.abs(F.col("size") - F.col("other_size")) <= threshold)
             & (apart <= 2 * threshold) & (F.levenshtein("line", "other", threshold) >= 0))
    here = whole.alias("h")
    there = other.alias("t")
    return here.join(there, (F.col("h.segment") == F.col("t.segment")) & close, "left_semi").select("a", "b").distinct()


def duplicate_lines(docs: DataFrame, threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, row key and numbers (from 0) of the lines to be removed, a row per document that has any.

    A line goes if an equal one, or one within ``threshold`` edits, occurs earlier by
    doc_id, row key and line number, be that one kept or not.
    """
    lines = _occurrences(docs)
    place = F.struct("doc_id", KEY, "no")
    distinct = written(lines.groupBy("a", "b").agg(
        F.min(place).alias("first"), F.any_value("line").alias("line"), F.count("*").alias("times")), "lines")
    near = written(_near(distinct, threshold, shortest), "near")
    verdict = distinct.select("a", "b", "first", "times").join(near.withColumn("near", F.lit(True)), ["a", "b"], "left")
    verdict = verdict.filter(F.col("near") | (F.col("times") > 1)).drop("times")
    again = lines.drop("line").join(verdict.hint("merge"), ["a", "b"])
    again = again.filter(F.col("near") | ~place.eqNullSafe(F.col("first")))
    return again.groupBy("doc_id", KEY).agg(F.collect_set("no").alias("gone"))


def deduplicate(docs: DataFrame, threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with cut texts, and ``_line_counts`` (lines, removed): see :func:`line_dedup`."""
    gone = written(duplicate_lines(docs, threshold, shortest), "gone")
    rows = on_key(keyed(docs), gone.withColumnRenamed("gone", "_gone").hint("merge")).withColumn("_lines", F.split("text", "\n"))
    lines = F.col("_lines")  # a column, as the lambda below would split the text anew for each line
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    cut = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    counts = F.struct(F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("lines"),
                      F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("removed"))
    return rows.withColumns({"text": cut, "_line_counts": F.when(
        F.col("text").isNull(), F.struct(F.lit(0).cast("bigint").alias("lines"), F.lit(0).cast("bigint").alias("removed"))
    ).otherwise(counts)}).drop("_gone", "_lines", KEY)


def line_dedup(docs: DataFrame, threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_lines, n_removed, text of every row of ``docs``.

    Lines end at a line feed and are compared without outer white space. The first
    line of each set of equal lines stays, and so does a line that no earlier one is
    near to; blank lines always stay. Lines under ``shortest`` characters must be equal
    to count as repeated. A NULL text has no lines and stays NULL. Rows equal in id and
    text are one document: both keep or lose the same lines.
    """
    return deduplicate(docs.select("doc_id", "text"), threshold, shortest).select(
        "doc_id", F.col("_line_counts.lines").alias("n_lines"), F.col("_line_counts.removed").alias("n_removed"), "text")
