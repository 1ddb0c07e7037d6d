"""Quoted delimited files, read by many tasks though values may hold line breaks.

A line break ends a record where the quotes before it in the file are even in number.
One scan counts the quotes of every split of every file and keeps the first line of each
file; running sums over the splits of a file say which of them begin inside a value. A
second scan puts the lines of each split together to records from that known start.
Records that cross splits, at most one a split, are put together from their pieces.

What the driver learns is one entry for each different header and for each split that
begins inside a value; there are no more of the latter than the input has splits.
Quotes are doubled inside quoted values and may not occur in unquoted ones.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: How records are read.
OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
BROKEN = "_broken_record"
_RETURN = "\\r\\z"
_PLACE = ["file", "start", "place"]
_WHOLE, _HEAD, _TAIL = 0, 1, 2
_RECORDS = "file string, start bigint, place bigint, kind int, record string"


def lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, start, value): the lines of each split, which is known by its first byte.

    Splits are read whole and in order, so the lines of one are neighbours.
    """
    read = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def splits(rows: DataFrame) -> DataFrame:
    """(file, start, inside, goes_on, header): whether a split begins inside a quoted value,
    whether its last value goes on, and with the first split of a file its first line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    numbered = rows.withColumns({"_quotes": quotes, "_line": F.monotonically_increasing_id()})
    first = F.min_by(F.when(F.col("start") == 0, F.col("value")), "_line")
    counted = numbered.groupBy("file", "start").agg(F.sum("_quotes").alias("_quotes"), first.alias("header"))
    upto = F.sum("_quotes").over(Window.partitionBy("file").orderBy("start"))
    return counted.select(
        "file", "start", ((upto - F.col("_quotes")) % 2 == 1).alias("inside"), (upto % 2 == 1).alias("goes_on"), "header")


def _assemble(batches: Iterator[pa.RecordBatch], inside: dict[str, set[int]], pieces: bool) -> Iterator[pa.RecordBatch]:
    """The records of splits from their lines, or only the pieces of records cut by a split."""
    import numpy as np
    import pyarrow.compute as pc

    split, open_, place, held, head = None, False, 0, [], False
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("place", pa.int64()), ("kind", pa.int32()),
                        ("record", pa.string())])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def ended() -> list[tuple]:
        """What is left of a split: the piece that goes on in the next one."""
        if not held:
            return []
        return [(*split, place - 1, _HEAD if head else _TAIL, "\n".join(held))]

    for batch in batches:
        values, files, starts = batch.column("value"), batch.column("file"), batch.column("start").to_numpy()
        odd = np.asarray(pc.count_substring(values, '"')) % 2 == 1
        at = 0
        while at < len(batch):
            here = (files[at].as_py(), int(starts[at]))
            # the lines of this split in this batch
            others = np.flatnonzero(starts[at:] != here[1])
            to = at + int(others[0]) if len(others) else len(batch)
            same = np.asarray(pc.equal(files.slice(at, to - at), here[0]))
            if not same.all():
                to = at + int(np.flatnonzero(~same)[0])
            if here != split:
                if pieces and (rows := ended()):
                    yield out(rows)
                split, place, held = here, 0, []
                open_ = head = here[1] in inside.get(here[0], ())
            # a line is whole if no value is open before and after it
            after = (np.cumsum(odd[at:to]) + open_) % 2 == 1
            before = np.concatenate([[open_], after[:-1]])
            plain = ~before & ~after
            rows = []
            for k in np.flatnonzero(~plain).tolist():
                if not before[k]:
                    held, head = [], False
                held.append(values[at + k].as_py())
                if not after[k]:
                    rows.append((k, _HEAD if head else _WHOLE, "\n".join(held)))
                    held, head = [], False
            open_ = bool(after[-1])
            if pieces:
                if found := [(*split, place + k, kind, text) for k, kind, text in rows if kind == _HEAD]:
                    yield out(found)
            else:
                kept = np.flatnonzero(plain)
                found = [r for r in rows if r[1] == _WHOLE]
                order = np.argsort(np.concatenate([kept, np.array([k for k, _, _ in found], np.int64)]), kind="stable")
                texts = pa.concat_arrays([values.slice(at, to - at).take(pa.array(kept)).cast(pa.string()),
                                          pa.array([t for _, _, t in found], pa.string())]).take(pa.array(order))
                ordinal = np.concatenate([kept, np.array([k for k, _, _ in found], np.int64)])[order] + place
                n = len(texts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([split[0]] * n, pa.string()), pa.array(np.full(n, split[1])), pa.array(ordinal),
                    pa.array(np.full(n, _WHOLE, np.int32)), texts], schema=schema)
            place += to - at
            at = to
    if pieces and (rows := ended()):
        yield out(rows)


def records(spark: SparkSession, path: str | Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """(file, start, place, record): all records, headers among them, each known by its split
    and the line of that split on which it ends, or begins where it goes on in the next."""
    rows = lines(spark, path)
    known = known if known is not None else splits(rows)
    cut = known.filter("inside or goes_on").select("file", "start", "inside").collect()
    inside: dict[str, set[int]] = {}
    for r in cut:
        if r.inside:
            inside.setdefault(r.file, set()).add(r.start)
    found = rows.mapInArrow(lambda b: _assemble(b, inside, pieces=False), _RECORDS).drop("kind")
    if cut:
        here = spark.createDataFrame([(r.file, r.start) for r in cut], "file string, start bigint")
        some = rows.join(F.broadcast(here), ["file", "start"]).select(*rows.columns)
        crossing = some.mapInArrow(lambda b: _assemble(b, inside, pieces=True), _RECORDS)
        # the end of an earlier record comes before the begin of a later one
        upto = Window.partitionBy("file").orderBy("start", "kind")
        numbered = crossing.withColumn("_record", F.sum((F.col("kind") == _TAIL).cast("int")).over(upto))
        parts = F.sort_array(F.collect_list(F.struct("start", "kind", "place", "record")))
        joined = numbered.groupBy("file", "_record").agg(parts.alias("p"))
        found = found.unionByName(joined.select(
            "file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["place"].alias("place"),
            F.array_join(F.col("p.record"), "\n").alias("record")))
    # a carriage return before the line break that ends a record belongs to that break
    return found.withColumn("record", F.regexp_replace("record", _RETURN, "")).filter(F.col("record") != "")


def header_groups(known: DataFrame) -> list[tuple[list[str], list[str]]]:
    """(columns, files) for each different header, in the order of the headers."""
    header = F.regexp_replace("header", _RETURN, "").alias("header")
    found = known.filter(F.col("header") != "").groupBy(header).agg(F.sort_array(F.collect_list("file")).alias("files"))
    groups = []
    for r in found.orderBy("header").collect():
        if r.header.count('"') % 2:
            raise ValueError(f"a header with a line break: {r.files[0]}")
        groups.append((next(csv.reader([r.header])), [unquote(f) for f in r.files]))
    return groups


def parsed(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Records below a header of ``columns`` as texts; ``_broken_record`` is the text of a record
    that has another number of values, and NULL for all others."""
    schema = StructType([*[StructField(c, StringType()) for c in columns], StructField(BROKEN, StringType())])
    row = F.from_csv("record", schema.simpleString(), {**OPTIONS, "columnNameOfCorruptRecord": BROKEN})
    body = found.filter((F.col("start") > 0) | (F.col("place") > 0))
    return body.select(*_PLACE, row.alias("r")).select(*_PLACE, "r.*")


def tables(spark: SparkSession, path: str | Sequence[str]) -> list[tuple[list[str], DataFrame]]:
    """(columns, rows) for each different header among the files; one scan of the text for each."""
    known = splits(lines(spark, path))
    groups = header_groups(known)
    return [
        (names, parsed(records(spark, path if len(groups) == 1 else files, known if len(groups) == 1 else None), names))
        for names, files in groups
    ]
