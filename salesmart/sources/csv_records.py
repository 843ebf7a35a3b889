"""Records of CSV files whose quoted values hold line breaks, with many tasks to a file.

A file is read as lines, in splits. Whether a line begins inside a quoted value depends on all lines before it, but a
line, and so a split, only maps the two possibilities at its start to those at its end. One scan finds that map per
split, a prefix over the splits of a file gives the state at the start of each, and a second scan joins lines to
records. The first scan also keeps, for either state, what a split holds of records that cross its ends; one small
aggregation puts these pieces together. Only where they are long does a third scan get them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.sinks.staging import Area

# Executors need not have this package installed: the functions here are sent to them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Splits whose states are broadcast, some 200 bytes each. Beyond, lines are shuffled to them and sorted again.
BROADCAST_SPLITS = 200_000

#: The longest piece of a crossing record that the first scan keeps.
HELD_BYTES = 1 << 20

# A quoted field ends at its first quote that is not doubled; what follows up to the comma belongs to it.
_FIELD = r'(?:[^",][^,]*|"(?:[^"]|"")*"(?:[^",][^,]*)?)?'
_OPEN = r'"(?:[^"]|"")*'
#: A line that begins a record and ends inside a quoted value.
_OPENS = rf"^(?:{_FIELD},)*{_OPEN}$"
#: A line that begins inside a quoted value and ends inside one, the same or a later one.
_STAYS = rf'^(?:[^"]|"")*(?:"(?:[^",][^,]*)?(?:,{_FIELD})*,{_OPEN})?$'

_SPLIT = ["file", "start", "length"]
_EFFECT = "file string, start long, length long, after_outside boolean, after_inside boolean"
_FOUND = f"{_EFFECT}, ended_outside boolean, ended_inside boolean, head string, tail_outside string, tail_inside string"
_PARTS = "file long, start long, piece int, first boolean, text string"


def csv_records(spark: SparkSession, path: str, area: Area) -> DataFrame:
    """Columns ``first`` (whether it is the first record of its file) and ``text``, without its last line break.

    Fields are separated by commas, quotes in quoted values are doubled, records end with \\n or \\r\\n. A quote inside a
    value that does not begin with one is plain text. Blank lines between records are left out. A quoted value that is
    still open at a file's end gives one last record.
    Compressed files cannot be split and count as one split. Intermediate tables go to ``area``.
    """
    lines = _lines(spark, path)
    found = lines.mapInArrow(_effects, _FOUND).withColumn("file", F.col("file").cast("bigint"))
    effects = area.stage(found, "effects")
    states = area.stage(split_states(effects), "split_states")
    pieces = _pieces(lines, effects, states, area)
    joined = area.stage(_joined(pieces), "crossing_records")
    whole = _with_states(lines, states).mapInArrow(_parts, _PARTS).where("piece IS NULL")
    records = whole.select("first", "text").unionAll(joined)
    text = F.when(F.contains("text", F.lit("\r")), F.regexp_replace("text", "\r$", "")).otherwise(F.col("text"))
    records = records.withColumn("text", text)
    return records.where("first OR trim(text) <> ''")


def split_states(effects: DataFrame) -> DataFrame:
    """Per split whether it begins (``inside``) and ends (``inside_after``) within a quoted value.

    ``after_outside`` and ``after_inside`` say how it ends for either beginning. Where they agree the beginning does not
    matter; else a split keeps the state or swaps it. So a state follows from the last split that fixed it and the
    number of swaps since. The window holds one short row per split of a file.
    """
    before = Window.partitionBy("file").orderBy("start")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.when(F.expr("after_outside = after_inside"), F.struct(F.col("after_outside").cast("int").alias("state"), "swaps"))
    counted = effects.withColumn("swaps", F.sum(F.expr("int(after_outside AND NOT after_inside)")).over(before))
    known = counted.withColumns(
        {
            "fixed": F.last(fixed, ignorenulls=True).over(earlier),
            "so_far": F.coalesce(F.lag("swaps").over(before), F.lit(0)),
        }
    )
    inside = F.expr("(coalesce(fixed.state, 0) + so_far - coalesce(fixed.swaps, 0)) % 2 = 1")
    # Every file has a split that begins at 0, so two files under one number have two.
    clash = F.raise_error(F.lit("two splits of the CSV files have the same number and start")).cast("boolean")
    inside = F.when(F.lag("start").over(before) == F.col("start"), clash).otherwise(inside)
    return known.withColumn("inside", inside).select(
        *_SPLIT, "inside", F.expr("IF(inside, after_inside, after_outside)").alias("inside_after")
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines, in order within a task, with the split that each begins in and a number for the name of its file."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.xxhash64(F.input_file_name()).alias("file"),
        F.input_file_block_start().alias("start"),
        F.input_file_block_length().alias("length"),
        "value",
    )


def _pieces(lines: DataFrame, effects: DataFrame, states: DataFrame, area: Area) -> DataFrame:
    """The pieces of crossing records, as of ``_parts``: those that the first scan kept, and all of a split where one was too long."""
    piece = "IF({there}, struct({number} AS piece, {first} AS first, {text} AS text), NULL)"
    begins = piece.format(there="inside", number=0, first="false", text="head")
    after_inside = piece.format(there="inside AND ended_inside AND after_inside", number=1, first="false", text="tail_inside")
    after_outside = piece.format(
        there="NOT inside AND after_outside", number=1, first="start = 0 AND NOT ended_outside", text="tail_outside"
    )
    known = effects.join(states.withColumnRenamed("inside_after", "_after"), _SPLIT)
    kept = known.withColumn("pieces", F.expr(f"array_compact(array({begins}, {after_inside}, {after_outside}))"))
    kept = kept.withColumn("long", F.expr("exists(pieces, piece -> piece.text IS NULL)"))
    pieces = area.stage(kept.select(*_SPLIT, "long", "pieces"), "pieces")
    short = pieces.where("NOT long").select("file", "start", F.inline("pieces"))
    long = pieces.where("long").select(*_SPLIT)
    if long.isEmpty():
        return short
    again = _with_states(lines, states.join(long.withColumn("long", F.lit(True)), _SPLIT, "left"), "long")
    return short.unionAll(again.mapInArrow(_parts, _PARTS).where("piece IS NOT NULL"))


def _with_states(lines: DataFrame, states: DataFrame, condition: str | None = None) -> DataFrame:
    """Lines with the state that their split begins with, all or those of some splits, in order within a task.

    Should files be split otherwise now than when the states were found, the job fails.
    """
    if states.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS:
        placed = lines.join(F.broadcast(states), _SPLIT, "left")
    else:
        numbered = lines.withColumn("at", F.monotonically_increasing_id())
        spread = numbered.join(states.hint("merge"), _SPLIT, "left")
        placed = spread.repartition(*_SPLIT).sortWithinPartitions("file", "start", "at").drop("at")
    known = F.when(F.col("inside").isNull(), F.raise_error(F.lit("the splits of a CSV file changed during the job")))
    placed = placed.withColumn("inside", known.otherwise(F.col("inside")))
    return (placed.where(condition) if condition else placed).select("file", "start", "inside", "value")


def _joined(pieces: DataFrame) -> DataFrame:
    """Records from the pieces of them that splits hold, at most two a split: one goes on (0), then one begins (1)."""
    order = Window.partitionBy("file").orderBy("start", "piece")
    numbered = pieces.withColumn("record", F.sum("piece").over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "piece", "text")))
    return (
        numbered.groupBy("file", "record")
        .agg(F.max("first").alias("first"), F.array_join(F.transform(parts, lambda part: part["text"]), "\n").alias("text"))
        .select("first", "text")
    )


def _steps(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per line, whether it ends inside a quoted value if it begins outside, and if it begins inside one."""
    opens, stays = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    at = np.flatnonzero(_flags(pc.match_substring(lines, '"')))
    if len(at):
        quoted = lines.take(pa.array(at))
        opens[at] = _flags(pc.match_substring_regex(quoted, _OPENS))
        stays[at] = _flags(pc.match_substring_regex(quoted, _STAYS))
    return opens, stays


def _flags(found: pa.Array) -> np.ndarray:
    return found.to_numpy(zero_copy_only=False).astype(bool)


def _after(opens: np.ndarray, stays: np.ndarray, inside: bool) -> np.ndarray:
    """The state after each line, from the state before the first."""
    swaps = np.cumsum(opens & ~stays)
    last = np.maximum.accumulate(np.where(opens == stays, np.arange(len(opens)), -1))
    fixed = np.where(last >= 0, opens[last], inside)
    since = swaps - np.where(last >= 0, swaps[last], 0)
    return fixed ^ (since % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Consecutive rows of one split, with its file and start."""
    files, starts = (batch.column(name).to_numpy() for name in ("file", "start"))
    changed = (starts[1:] != starts[:-1]) | (files[1:] != files[:-1])
    edges = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        if high > low:
            yield (int(files[low]), int(starts[low])), batch.slice(low, high - low)


class _Side:
    """A split's lines for one state at its start: the state after them, whether a record has ended, the lines up to the
    first end and those after the last. Lines that are too long to keep are None."""

    def __init__(self, inside: bool) -> None:
        self.inside, self.ended = inside, False
        self.head: list[pa.Array] | None = []
        self.tail: list[pa.Array] | None = []

    def add(self, lines: pa.Array, opens: np.ndarray, stays: np.ndarray) -> None:
        after = _after(opens, stays, self.inside)
        self.inside = bool(after[-1])
        ends = np.flatnonzero(~after) + 1
        if not self.ended:
            self.head = _held(self.head, lines.slice(0, int(ends[0])) if len(ends) else lines)
        if len(ends):
            self.ended, self.tail = True, []
            lines = lines.slice(int(ends[-1]))
        if len(lines):
            self.tail = _held(self.tail, lines)


def _held(before: list[pa.Array] | None, lines: pa.Array) -> list[pa.Array] | None:
    if before is None or lines.nbytes + sum(part.nbytes for part in before) > HELD_BYTES:
        return None
    return [*before, lines]


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: for either state at its start that at its end, whether a record ends in it, and its pieces of
    records that cross its ends."""
    split, length, sides = None, 0, []

    def row() -> pa.RecordBatch:
        outside, inside = sides
        texts = [_text([pa.concat_arrays(held)]) if held else pa.nulls(1, pa.string()) for held in (inside.head, outside.tail, inside.tail)]
        columns = [[str(split[0])], [split[1]], [length], [outside.inside], [inside.inside], [outside.ended], [inside.ended]]
        types = [pa.string(), pa.int64(), pa.int64(), *[pa.bool_()] * 4]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(column, kind) for column, kind in zip(columns, types, strict=True)), *texts],
            names=[*_SPLIT, "after_outside", "after_inside", "ended_outside", "ended_inside", "head", "tail_outside", "tail_inside"],
        )

    for batch in batches:
        for found, rows in _runs(batch):
            if found != split:
                if split:
                    yield row()
                split, length, sides = found, rows.column("length")[0].as_py(), [_Side(False), _Side(True)]
            lines = rows.column("value").cast(pa.string())
            steps = _steps(lines)
            for side in sides:
                side.add(lines, *steps)
    if split:
        yield row()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each split, without a number; the piece at its start that goes on with an earlier record (0), and
    the one at its end that begins a record (1). A split without the end of a record it goes on with is all piece 0."""
    split, inside, goes_on, begun, waiting = None, False, False, False, []

    def made(texts: pa.Array, pieces: list[int | None], firsts: list[bool]) -> pa.RecordBatch:
        count = len(texts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(count, split[0]), pa.int64()),
                pa.array(np.full(count, split[1]), pa.int64()),
                pa.array(pieces, pa.int32()),
                pa.array(firsts, pa.bool_()),
                texts,
            ],
            names=["file", "start", "piece", "first", "text"],
        )

    def rest() -> pa.RecordBatch:
        """What is left at a split's end."""
        first = split[1] == 0 and not begun
        return made(_text([pa.concat_arrays(waiting)]), [0 if goes_on else 1], [first])

    for batch in batches:
        for found, rows in _runs(batch):
            if found != split:
                if waiting:
                    yield rest()
                split, inside, begun, waiting = found, rows.column("inside")[0].as_py(), False, []
                goes_on = inside
            lines = rows.column("value").cast(pa.string())
            after = _after(*_steps(lines), inside)
            inside = bool(after[-1])
            ends = np.flatnonzero(~after) + 1
            if len(ends):
                held = sum(map(len, waiting))
                lines = pa.concat_arrays([*waiting, lines])
                edges = np.concatenate([[0], ends + held])
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), lines), "\n")
                count = len(texts)
                yield made(
                    texts,
                    [0 if goes_on else None] + [None] * (count - 1),
                    [split[1] == 0 and not begun] + [False] * (count - 1),
                )
                goes_on, begun, waiting = False, True, []
                lines = lines.slice(int(edges[-1]))
            if len(lines):
                waiting.append(lines)
    if waiting:
        yield rest()


def _text(groups: list[pa.Array]) -> pa.Array:
    """Each group of lines as one text."""
    edges = np.cumsum([0, *map(len, groups)])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.concat_arrays(groups)), "\n")
