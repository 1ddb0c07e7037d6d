"""I-Match fingerprints over randomised lexicon subsets, in built-in functions only.

The lexicon holds the terms that are in two documents or more and whose share of
documents lies in a band, counted for each term by itself. As each of them is in one of
1 / RAREST documents, there are at most 1 / RAREST times as many as a document has terms
on average, whatever the number of documents. So all tasks get it whole, as one value of
SLOTS short lists, in which a text's terms are looked up where the text is. The value is
that of a scalar subquery: a literal would stand whole in every plan that Spark writes
out, and the driver keeps those. A lexicon of more than MOST terms (texts of a thousand
terms on average) is joined to the texts' terms instead. A random part of the lexicon,
the smaller the more terms a text has, is dealt to SUBSETS subsets, and each subset's
distinct terms in the text are sorted and hashed. Two such levels are kept, so that texts
of slightly different size share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibspark.llm.rows import written

RAREST, COMMONEST = 1 / 4096, 1 / 4  # of all documents
SUBSETS = 32
PER_LEVEL = 24  # lexicon terms that a level keeps at least
FEWEST = 8  # a text with fewer lexicon terms is taken with all its terms
SLOTS = 1 << 16
MOST = 1 << 22  # terms, 32 MB
_BUCKET = 1024
_LOWEST = -(1 << 63)


def terms(text: Column) -> Column:
    """Distinct term hashes of a text."""
    words = F.array_remove(F.array_distinct(F.split(F.lower(text), r"[\s\p{Punct}]+")), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, rarest: float = RAREST, commonest: float = COMMONEST) -> DataFrame:
    """The hashes of the terms inside the band, as ``term``."""
    total = docs.count()
    counts = docs.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("term")).groupBy("term").count()
    inside = counts.filter((F.col("count") >= max(2.0, rarest * total)) & (F.col("count") <= max(2.0, commonest * total)))
    return written(inside.select("term"), "lexicon")


def in_slots(known: DataFrame) -> DataFrame:
    """A lexicon of at most MOST terms as one row, ``slots``: the terms of each slot, in a list."""
    lists = known.groupBy(_slot(F.col("term")).alias("slot")).agg(F.collect_list("term").alias("own"))
    every = known.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot")).join(lists, "slot", "left")
    own = F.coalesce("own", F.array().cast("array<bigint>"))
    whole = every.agg(F.array_sort(F.collect_list(F.struct("slot", own.alias("own")))).alias("slots"))
    return written(whole.select(F.transform("slots", lambda x: x["own"]).alias("slots")), "lexicon_slots")


def _slot(term: Column) -> Column:
    return F.shiftrightunsigned(term, 40).bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def looked_up(slots: Column):
    """For a text: its terms, and those of them that the lexicon holds."""
    def use(text: Column) -> Column:
        return _bound(terms(text), lambda all_: F.struct(all_.alias("all"), F.filter(
            all_, lambda t: F.array_contains(F.get(slots, _slot(t)), t)).alias("inside")))

    return use


def with_looked_up(rows: DataFrame, text: Column, slots: DataFrame, name: str, use) -> DataFrame:
    """``rows`` with ``use(text, fingerprint)`` for such a lexicon.

    Spark takes no subquery inside a lambda, but moves one there from a column that is
    used once. It does not if ``text`` takes a computed column more than once or if such
    a column is kept beside it; the rows then carry the lexicon along, with the same result.
    """
    look = looked_up(F.col("_slots"))
    own = _bound(text, lambda t: _bound(look(t), lambda found: use(t, fingerprint(t, found))))
    return rows.withColumn("_slots", slots.scalar()).withColumn(name, own).drop("_slots")


def with_joined(rows: DataFrame, text: str, known: DataFrame, name: str) -> DataFrame:
    """``rows`` with such a struct of a text column, for a lexicon of any size; equal texts share them."""
    a, b = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    every = rows.select(a.alias("_a"), b.alias("_b"), F.explode(terms(F.col(text))).alias("term"))
    found = written(every.join(known, "term").groupBy("_a", "_b").agg(F.collect_set("term").alias("_in")), "known")
    joined = rows.withColumns({"_a": a, "_b": b}).join(found, ["_a", "_b"], "left")
    inside = F.coalesce("_in", F.array().cast("array<bigint>"))
    return joined.withColumn(name, F.struct(terms(F.col(text)).alias("all"), inside.alias("inside"))).drop("_a", "_b", "_in")


def _power(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int"))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def fingerprint(text: Column, found: Column) -> Column:
    """struct(level, hashes): two levels of SUBSETS hashes, NULL where a subset has no term.

    ``found`` holds the text's terms and those in the lexicon; the former count where
    the latter are fewer than FEWEST. A text without terms has its own hash as the only one.
    """
    chosen = F.when(F.size(found["inside"]) >= FEWEST, found["inside"]).otherwise(found["all"])
    return _bound(F.array_sort(chosen), lambda own: _hashed(text, own))


def _hashed(text: Column, chosen: Column) -> Column:
    level = F.greatest(F.lit(0), F.floor(F.log2(F.greatest(F.size(chosen), F.lit(1)) / PER_LEVEL))).cast("int")

    def at(step: int) -> Column:
        mask = _power(level + step) - 1
        kept = F.filter(chosen, lambda t: F.shiftrightunsigned(t, 24).bitwiseAND(mask) == 0)
        placed = F.transform(kept, lambda t: F.struct(
            F.pmod(F.shiftrightunsigned(t, 18), F.lit(SUBSETS)).cast("int").alias("k"), t.alias("t")))
        numbers = F.array(*[F.lit(k) for k in range(SUBSETS)])
        return _bound(placed, lambda own: F.transform(numbers, lambda k: _subset(own, k)))

    none = F.size(chosen) == 0
    alone = F.array(F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    return F.struct(F.when(none, F.lit(-2)).otherwise(level).alias("level"),
                    F.when(none, alone).otherwise(F.concat(at(0), at(1))).alias("hashes"))


def _subset(placed: Column, k: Column) -> Column:
    return _bound(F.filter(placed, lambda x: x["k"] == k), lambda own: F.when(
        F.size(own) > 0, F.xxhash64(own).bitwiseAND(F.lit(0xFFFFFF)).cast("int")))


def shown(fp: Column) -> Column:
    """A fingerprint as text: the level, then six digits a subset."""
    cells = F.transform(fp["hashes"], lambda h: F.coalesce(F.lower(F.lpad(F.hex(h), 6, "0")), F.lit("------")))
    return F.concat(fp["level"].cast("string"), F.lit(":"), F.array_join(cells, ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subset hashes on the levels both have; 1 for equal fingerprints."""
    half, step = F.lit(SUBSETS), b["level"] - a["level"]
    left = F.when(step == 1, F.slice(a["hashes"], half + 1, half)).when(step == -1, F.slice(a["hashes"], 1, half)).otherwise(a["hashes"])
    right = F.when(step == 1, F.slice(b["hashes"], 1, half)).when(step == -1, F.slice(b["hashes"], half + 1, half)).otherwise(b["hashes"])
    pairs = F.filter(F.arrays_zip(left.alias("x"), right.alias("y")), lambda p: p["x"].isNotNull() | p["y"].isNotNull())
    same = F.size(F.filter(pairs, lambda p: p["x"] == p["y"]))
    share = F.when(F.size(pairs) > 0, same / F.size(pairs)).otherwise(0.0)
    return F.when((step == 0) & (a["hashes"] == b["hashes"]), 1.0).when(
        (F.abs(step) <= 1) & (F.size(a["hashes"]) == F.size(b["hashes"])), share).otherwise(0.0)


def _above(groups: DataFrame, name: str) -> DataFrame:
    """(name, next_id): for every group of ids, the largest id below the group.

    Groups of _BUCKET neighbours are looked through together; the lowest of them asks
    the group above, until so few are left that one task may order them.
    """
    if groups.count() <= _BUCKET:
        return groups.select(name, F.lead("top").over(Window.orderBy(F.desc(name))).alias("next_id"))
    up = f"_{name}"
    wide = groups.withColumn(up, F.floor(F.col(name) / _BUCKET))
    upper = written(wide.groupBy(up).agg(F.max("top").alias("top")), "id_groups")
    over = Window.partitionBy(up).orderBy(F.desc(name))
    return wide.withColumn("near", F.lead("top").over(over)).join(
        _above(upper, up).withColumnRenamed("next_id", "far"), up).select(
        name, F.coalesce("near", "far").alias("next_id"))


def with_next(docs: DataFrame, marked) -> DataFrame:
    """doc_id, text, own and next(text, own), in descending id; after the last comes the first.

    Texts move once, to the group of ids they are in; each group also gets the rows of
    the largest id below it. ``marked`` adds ``own``, made of a text, to the rows that move.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST)).alias("id"), "text")
    text = F.coalesce("text", F.lit(""))
    bucket = F.floor(F.col("id") / _BUCKET)
    groups = written(rows.select("id").groupBy(bucket.alias("bucket")).agg(F.max("id").alias("top")), "id_groups")
    first = groups.agg(F.max("top")).first()[0]
    below = written(_above(groups, "bucket").select(
        "bucket", F.coalesce("next_id", F.lit(first)).cast("bigint").alias("id")), "id_edges")
    guests = rows.join(below, "id").select("id", "text", "bucket", F.lit(True).alias("guest"))
    at_home = rows.select("id", "text", bucket.alias("bucket"), F.lit(False).alias("guest"))
    both = marked(at_home, text, "own").unionByName(marked(guests, text, "own")).withColumn("text", text)
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("id"), F.xxhash64("text"), "text")
    following = F.lead(F.struct("text", "own")).over(order)
    return both.withColumn("next", following).filter("not guest").select(
        F.when(F.col("id") != _LOWEST, F.col("id")).alias("doc_id"), "text", "own", "next")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next smaller id, the first after the last;
    rows of one id follow each other by a hash of their text; a NULL id is the
    smallest. The edited text has its last half replaced by the beginning of the next
    document. A NULL text is empty; texts without any term are alike only if equal.
    """
    known = lexicon(docs.select("text"))
    slots = in_slots(known) if known.count() <= MOST else None

    def marked(rows: DataFrame, text: Column, name: str, use=lambda text, fp: fp) -> DataFrame:
        if slots is not None:
            return with_looked_up(rows, text, slots, name, use)
        found = with_joined(rows.withColumn("_text", text), "_text", known, "_found")
        made = use(F.col("_text"), fingerprint(F.col("_text"), F.col("_found")))
        return found.withColumn(name, made).drop("_text", "_found")

    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next.text", F.lit(1), half))
    rows = marked(with_next(docs, marked), edited, "edited", lambda text, fp: F.struct(
        F.sha2(text.cast("binary"), 256).alias("sha256"), fp.alias("fp")))
    rows = written(rows.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), "own", F.col("next.own").alias("following"), "edited"),
        "marked")
    own, other = F.col("own"), F.col("edited.fp")
    return rows.select(
        "doc_id", "n_chars", F.col("edited.sha256").alias("edited_sha256"),
        shown(own).alias("fingerprint"), shown(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"), likeness(own, F.col("following")).alias("near_next"))
