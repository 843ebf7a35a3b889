"""Shards of near equal bytes by k-d tree partitioning over metadata.

The tree starts with all rows in one node that must become ``shards`` leaves. A node
of several leaves is split along its widest dimension (its range over the range of the whole
table) at a weighted median: the value below which lies the share of the bytes that its
lower half of the leaves needs. With leaves of ``total / shards`` bytes each, splitting stops
when every node is one leaf.

Medians are found without sorting. All nodes of a level are searched at once by
narrowing an interval of the dimension: each round sums the bytes of a fixed number of
bins per node, combined in the map tasks, and keeps the bin the median falls into. Rows that
share one value of the dimension (a hot source, a common length) are split by a hash of
the row and its text, searched in the same way. Only rows equal in all of these are left; if there are many, all rows are written
once with a number, which then splits them too.

The driver sees the tree and, per round, one histogram per node: at most ``shards * bins``
numbers whatever the size of the table. The rows are read from a narrow staged table of
their metadata; the tree is turned into one expression, so that no row is shuffled to learn its shard.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.names import free_name
from salesmart.sinks.staging import stage

# The row hash that splits ties has this many values.
_TIE_BITS = 40


@dataclass
class Node:
    """A tree node: rows with ``low <= dimension`` or not, down to a leaf."""

    leaves: int
    first: int
    number: int = 1
    dimension: str | None = None
    value: int = 0
    tie: int = 0
    children: list[Node] = field(default_factory=list)


def text_code(column: Column) -> Column:
    """A number for a text: in the order of the first four bytes, and by a hash of the whole text among texts that share them.

    So different texts have different numbers, but for collisions of 30 bits. Null is -1.
    """
    start = F.rpad(F.substring(F.hex(F.encode(column, "UTF-8")), 1, 8), 8, "0")
    code = F.conv(start, 16, 10).cast("bigint") * F.lit(2**30) + F.pmod(F.xxhash64(column), F.lit(2**30))
    return F.when(column.isNotNull(), code).otherwise(F.lit(-1).cast("bigint"))


def with_sizes(docs: DataFrame, overhead: int = 16) -> DataFrame:
    """``docs`` with ``size``: bytes of the text in UTF-8 (null: none) plus ``overhead``."""
    return docs.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + F.lit(overhead))


def kd_shards(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    shards: int | None = None,
    target_bytes: int | None = None,
    bins: int = 1024,
    tolerance: float = 0.002,
    rows_per_run: int = 50_000,
) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``size``) with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    ``dimensions``: metadata expressions of integer type; nulls count as the smallest value.
    Give the number of shards, or the bytes a leaf should have. ``tolerance``: a median is
    close enough when what is left undecided is that share of a leaf. Every row gets a shard. Rows equal in
    doc_id, size, text (if there is one) and all dimensions stay together, unless there are more of them than a run holds or
    than 1 % of a leaf's rows (30 at least). An empty table gives an empty result. The columns shard and slot are replaced if
    ``docs`` has them.
    """
    docs = docs.drop("shard", "slot")
    names = {name: f"kd_{i}" for i, name in enumerate(dimensions)}
    expressions = {names[name]: F.coalesce(value.cast("bigint"), F.lit(-(2**62))) for name, value in dimensions.items()}
    row = [F.col(name) for name in ("doc_id", "size", "text") if name in docs.columns]
    meta, key = _metadata(docs, [*row, *expressions.values()], expressions)

    totals = meta.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    if totals["bytes"] is None:
        return docs.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("bigint"))
    count = shards or max(1, round(totals["bytes"] / target_bytes))
    number = None
    if _repeats(meta, totals["rows"], min(rows_per_run, max(30, totals["rows"] // (100 * count)))):
        number = free_name(docs.columns, "kd_number")
        docs = stage(docs.withColumn(number, F.monotonically_increasing_id()), "kd-numbered")
        row.append(F.col(number))
        meta, key = _metadata(docs, [*row, *expressions.values()], expressions)
    tree = build_tree(meta, list(names.values()), count, totals["bytes"] / count * tolerance, bins)

    suffix = "_of"
    while any(f"kd_tie{suffix}" == c.lower() or f"{n}{suffix}" == c.lower() for c in docs.columns for n in names.values()):
        suffix += "_"
    columns = {f"{n}{suffix}": e for n, e in expressions.items()} | {f"kd_tie{suffix}": key}
    placed = docs.withColumns(columns).withColumn("shard", _leaf(tree, list(names.values()), suffix)).drop(*columns)
    slotted = _with_slots(placed, row, totals["rows"], rows_per_run)
    return slotted.drop(number) if number else slotted


def _metadata(docs: DataFrame, row: list[Column], expressions: Mapping[str, Column]) -> tuple[DataFrame, Column]:
    """The narrow staged table that the tree is searched in, and the hash that splits ties."""
    key = F.pmod(F.xxhash64(*row), F.lit(2**_TIE_BITS))
    return stage(docs.select("size", key.alias("kd_tie"), *[e.alias(n) for n, e in expressions.items()]), "kd-rows"), key


def _repeats(meta: DataFrame, rows: int, most: int) -> bool:
    """Whether some row repeats more than about ``most`` times: its part of the hash's values then holds more rows than chance gives."""
    parts = 4096
    fullest = meta.groupBy(F.pmod("kd_tie", F.lit(parts))).count().agg(F.max("count")).first()[0]
    return fullest > rows / parts + 6 * (rows / parts) ** 0.5 + most


def build_tree(meta: DataFrame, dimensions: list[str], leaves: int, slack: float, bins: int) -> Node:
    """The tree over staged rows: size, kd_tie and the dimensions."""
    root = Node(leaves, 0)
    level = [root] if leaves > 1 else []
    widest = _ranges(meta.withColumn("kd_node", F.lit(1)), dimensions)[1]
    whole = {d: max(1, widest[d][1] - widest[d][0]) for d in dimensions}
    while level:
        routed = meta.withColumn("kd_node", _number(root, dimensions))
        ranges = _ranges(routed, dimensions)
        level = [node for node in level if node.number in ranges]
        for node in level:
            found = ranges[node.number]
            node.dimension = max(dimensions, key=lambda d: ((found[d][1] - found[d][0]) / whole[d], d))
        _find_medians(routed, level, ranges, dimensions, slack, bins)
        following = []
        for node in level:
            low = node.leaves // 2
            node.children = [
                Node(low, node.first, node.number * 2),
                Node(node.leaves - low, node.first + low, node.number * 2 + 1),
            ]
            following += [child for child in node.children if child.leaves > 1]
        level = following
    return root


def _ranges(routed: DataFrame, dimensions: list[str]) -> dict[int, dict[str, tuple]]:
    """Smallest and largest value of every dimension and the bytes, per node."""
    ends = [f(d).alias(f"{end}_{d}") for d in dimensions for end, f in (("low", F.min), ("high", F.max))]
    rows = routed.groupBy("kd_node").agg(F.sum("size").alias("bytes"), *ends).collect()
    return {
        r["kd_node"]: {d: (r[f"low_{d}"], r[f"high_{d}"]) for d in dimensions} | {"bytes": r["bytes"]} for r in rows
    }


def _find_medians(
    routed: DataFrame, level: list[Node], ranges: dict, dimensions: list[str], slack: float, bins: int
) -> None:
    """Set ``value`` and ``tie`` of every node: rows below (value, tie) make up the lower leaves' bytes."""
    searches = {}
    for node in level:
        low, high = ranges[node.number][node.dimension]
        wanted = ranges[node.number]["bytes"] * (node.leaves // 2) / node.leaves
        searches[node.number] = {"node": node, "low": low, "high": high + 1, "wanted": wanted, "below": 0, "fixed": None}
    open_ = dict(searches)
    while open_:
        for s in open_.values():
            s["step"] = max(1, -(-(s["high"] - s["low"]) // bins))
        sums = (
            _search_bins(routed, open_, dimensions)
            .groupBy("kd_node", "kd_bin")
            .agg(F.sum("size").alias("bytes"))
            .collect()
        )
        by_node: dict[int, list[tuple[int, int]]] = {}
        for row in sums:
            by_node.setdefault(row["kd_node"], []).append((row["kd_bin"], row["bytes"]))
        for number, s in list(open_.items()):
            _narrow(s, sorted(by_node.get(number, [])), slack)
            if s.get("done"):
                del open_[number]


def _search_bins(routed: DataFrame, searches: dict[int, dict], dimensions: list[str]) -> DataFrame:
    """Rows inside the search interval of their node, with the bin they fall into.

    The intervals are one constant map, looked up by node, so that the expression does not grow with the tree.
    """
    entries = []
    for number, s in searches.items():
        dimension = dimensions.index(s["node"].dimension) + 1
        by_tie = s["fixed"] is not None
        values = [dimension, len(dimensions) + 1 if by_tie else dimension, s["low"], s["high"], s["step"]]
        fixed = F.lit(s["fixed"]).cast("bigint")
        entries += [F.lit(number), F.array(*[F.lit(v).cast("bigint") for v in values], fixed)]
    interval = F.element_at(F.create_map(*entries), F.col("kd_node"))
    axes = F.array(*[F.col(d).cast("bigint") for d in dimensions], F.col("kd_tie"))
    part = {name: F.col("kd_at")[i] for i, name in enumerate(("dimension", "axis", "low", "high", "step", "fixed"))}
    return (
        routed.withColumn("kd_at", interval)
        .where(F.col("kd_at").isNotNull())
        .withColumn("kd_axes", axes)
        .withColumn("kd_position", F.element_at("kd_axes", part["axis"].cast("int")))
        .where(
            (F.col("kd_position") >= part["low"])
            & (F.col("kd_position") < part["high"])
            & (part["fixed"].isNull() | (F.element_at("kd_axes", part["dimension"].cast("int")) == part["fixed"]))
        )
        .select("kd_node", "size", F.call_function("div", F.col("kd_position") - part["low"], part["step"]).alias("kd_bin"))
    )


def _narrow(s: dict, histogram: list[tuple[int, int]], slack: float) -> None:
    """One round: keep the bin in which the wanted bytes are reached."""
    node, below = s["node"], s["below"]
    chosen, inside = s["high"], 0
    for bin_, size in histogram:
        if below + size > s["wanted"]:
            chosen, inside = s["low"] + bin_ * s["step"], size
            break
        below += size
    s["below"] = below
    ends_at = min(chosen + s["step"], s["high"])

    def settle(position: int) -> None:
        node.value, node.tie = (position, 0) if s["fixed"] is None else (s["fixed"], position)
        s["done"] = True

    if not inside or s["wanted"] - below <= slack:
        settle(chosen)
    elif below + inside - s["wanted"] <= slack:
        settle(ends_at)
    elif s["step"] > 1:
        s["low"], s["high"] = chosen, ends_at
    elif s["fixed"] is None:  # one value holds the median: go on among its rows
        s["fixed"], s["low"], s["high"] = chosen, 0, 2**_TIE_BITS
    else:  # one row, or equal rows: to the side that is left more even
        settle(chosen if s["wanted"] - below < below + inside - s["wanted"] else ends_at)


def _nodes(node: Node) -> list[Node]:
    return [node, *(n for child in node.children for n in _nodes(child))]


def _number(root: Node, dimensions: list[str], suffix: str = "") -> Column:
    """The number of the lowest node a row has reached so far, by walking down the tree from the root."""
    split = [n for n in _nodes(root) if n.children]
    if not split:
        return F.lit(1)
    entries = []
    for n in split:
        values = [dimensions.index(n.dimension) + 1, n.value, n.tie]
        entries += [F.lit(n.number), F.array(*[F.lit(v).cast("bigint") for v in values])]
    splits = F.create_map(*entries)
    axes = F.array(*[F.col(f"{d}{suffix}").cast("bigint") for d in dimensions])
    tie = F.col(f"kd_tie{suffix}")

    def step(number: Column, _: Column) -> Column:
        at = F.element_at(splits, number)
        value = F.element_at(axes, at[0].cast("int"))
        low = (value < at[1]) | ((value == at[1]) & (tie < at[2]))
        return F.when(at.isNull(), number).when(low, number * 2).otherwise(number * 2 + 1)

    depth = max(n.number for n in split).bit_length()
    return F.aggregate(F.array(*[F.lit(i) for i in range(depth)]), F.lit(1), step)


def _leaf(root: Node, dimensions: list[str], suffix: str) -> Column:
    leaves = [n for n in _nodes(root) if not n.children]
    shards = F.create_map(*[F.lit(v) for n in leaves for v in (n.number, n.first)])
    return F.element_at(shards, _number(root, dimensions, suffix))


def _with_slots(placed: DataFrame, row: list[Column], rows: int, rows_per_run: int) -> DataFrame:
    """Number the rows of each shard. A shard is dealt into runs by a hash of ``row``, the columns that tell rows apart; a row's slot
    is its place in its run after all earlier runs, so that no task gets a whole shard."""
    hash_, run, held, place, start = (free_name(placed.columns, f"kd_{n}") for n in ("row", "run", "rows", "place", "start"))
    runs = max(1, -(-rows // rows_per_run))
    placed = placed.withColumn(hash_, F.xxhash64(F.lit(7), *row)).withColumn(run, F.pmod(hash_, F.lit(runs)))
    counts = placed.groupBy("shard", run).agg(F.count(F.lit(1)).alias(held))
    earlier = Window.partitionBy("shard").orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(counts.select("shard", run, F.coalesce(F.sum(held).over(earlier), F.lit(0)).alias(start)), "kd-runs")
    in_run = Window.partitionBy("shard", run).orderBy(hash_, *row)
    return (
        placed.withColumn(place, F.row_number().over(in_run) - 1)
        .join(starts, ["shard", run])
        .withColumn("slot", (F.col(start) + F.col(place)).cast("bigint"))
        .drop(hash_, run, place, start)
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder per shard, rows in files in the order of their slots.

    Shards are split over tasks by ranges of (shard, slot), so a large shard is many files.
    """
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)
