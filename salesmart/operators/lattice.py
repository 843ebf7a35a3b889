"""Sums by several sets of keys from one scan: a lattice of stored aggregates.

A node is a set of keys with one mergeable exact sum per key combination. The nodes that are stored first come from one scan of the
rows; every coarser sum merges the states of the smallest stored node that has its keys. As the states are exact, each way down the lattice gives the same
bits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.exact import merged_state, sum_state, with_rounded

Keys = tuple[str, ...]

#: Writes a table, split into folders by the column named last, and gives it back as a scan.
Keep = Callable[[DataFrame, str, str], DataFrame]

NODE, STATE = "node", "total"


def _name(keys: Keys) -> str:
    return "_".join(keys)


def nodes_of(rows: DataFrame, nodes: Sequence[Keys], value: str) -> DataFrame:
    """Each node's rows in one table: its keys (others null), the state of the sum of ``value``, and ``node``.

    ``rows`` is scanned once; states are merged in the map tasks before the one shuffle.
    """
    keys = list(dict.fromkeys(key for node in nodes for key in node))
    state = sum_state(F.col(value)).alias(STATE)
    if len(nodes) == 1:
        return rows.groupBy(*keys).agg(state).withColumn(NODE, F.lit(_name(nodes[0])))
    sets = [[F.col(key) for key in node] for node in nodes]
    summed = rows.groupingSets(sets, *keys).agg(state, F.grouping_id().alias("_left_out"))
    # One bit per key, the first key highest; it is set where the key is left out.
    codes = [sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in node) for node in nodes]
    names = F.create_map(*[F.lit(x) for node, code in zip(nodes, codes, strict=True) for x in (code, _name(node))])
    return summed.withColumn(NODE, F.element_at(names, F.col("_left_out").cast("int"))).drop("_left_out")


@dataclass(frozen=True)
class Lattice:
    """Stored nodes."""

    nodes: dict[Keys, DataFrame]

    @classmethod
    def build(cls, rows: DataFrame, value: str, first: Sequence[Keys], then: Sequence[Keys], keep: Keep) -> Lattice:
        """Store ``first`` from one scan of ``rows``, then each node of ``then`` from its smallest stored parent."""
        lattice = cls({})
        lattice._add(keep(nodes_of(rows, first, value), "lattice_base", NODE), first)
        for node in then:
            if node not in lattice.nodes:
                lattice._add(keep(lattice._merged(node).withColumn(NODE, F.lit(_name(node))), f"lattice_{_name(node)}", NODE), [node])
        return lattice

    def _add(self, stored: DataFrame, nodes: Sequence[Keys]) -> None:
        for node in nodes:
            self.nodes[node] = stored.where(F.col(NODE) == _name(node)).select(*node, STATE)

    def parent(self, keys: Keys) -> Keys:
        """The stored node with the fewest rows that has the keys.

        A node with a part of another's keys has no more rows than it; rows are counted only where that does not decide.
        """
        fitting = [node for node in self.nodes if set(keys) <= set(node)]
        if not fitting:
            raise ValueError(f"no stored node has {', '.join(keys)}")
        least = [node for node in fitting if not any(set(other) < set(node) for other in fitting)]
        return least[0] if len(least) == 1 else min(least, key=lambda node: (self.nodes[node].count(), node))

    def _merged(self, keys: Keys) -> DataFrame:
        parent = self.parent(keys)
        if set(parent) == set(keys):
            return self.nodes[parent].select(*keys, STATE)
        return self.nodes[parent].groupBy(*keys).agg(merged_state(STATE).alias(STATE))

    def sums(self, keys: Sequence[str], name: str) -> DataFrame:
        """The sum per combination of ``keys``, as the double ``name``."""
        return with_rounded(self._merged(tuple(keys)), STATE, name)
