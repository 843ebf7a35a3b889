"""Which rows of a large table may be in a list of keys, told from a bitmap of the keys' hashes.

A join with a list that is too long to broadcast shuffles the whole table, texts and all, although few of its rows are in the list. The
bitmap takes two bytes a key, so that it can be broadcast for much longer: rows whose bit is not set are not in the list, and only the
others, 6 % beside those that are, need the exact join. From ``MOST`` blocks on the share of the others grows; nothing is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.names import free_name
from salesmart.sinks.staging import stage

#: Bits per key; bits per block, as a row of the bitmap holds; and blocks at most, 16 MB together.
BITS, BLOCK, MOST = 16, 512, 1 << 18

#: Fixed value: bits of what Spark's ``bitmap_construct_agg`` makes.
_SPARKS = 32768


@dataclass(frozen=True)
class Marks:
    """``bits``: block and bits; ``places``: bits in all; ``kinds``: column and type of a key."""

    bits: DataFrame
    places: int
    kinds: tuple

    def likely(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is in the list, and a few others."""
        return self._met(rows, "left_semi")

    def others(self, rows: DataFrame) -> DataFrame:
        """The rest: rows whose key is not in the list."""
        return self._met(rows, "left_anti")

    def _met(self, rows: DataFrame, how: str) -> DataFrame:
        block, bits = free_name(rows.columns, "marks_block"), free_name(rows.columns, "marks_bits")
        place = _place(self.kinds, self.places)
        byte = F.substring(F.col(bits), (F.pmod(place, F.lit(BLOCK)) / 8).cast("int") + 1, F.lit(1))
        is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1
        marks = F.broadcast(self.bits.select(F.col("block").alias(block), F.col("bits").alias(bits)))
        return rows.join(marks, (F.shiftright(place, BLOCK.bit_length() - 1) == F.col(block)) & is_set, how)


def _place(kinds: tuple, places: int) -> Column:
    return F.pmod(F.xxhash64(*(F.col(name).cast(kind) for name, kind in kinds)), F.lit(places))


def marks_of(listed: DataFrame, columns: list[str], most: int = MOST) -> Marks:
    """``listed``: a staged table, as it is counted first. Rows that are asked about have ``columns`` too."""
    blocks = max(1, min(most, -(-listed.count() * BITS // BLOCK)))
    kinds = tuple((name, listed.schema[name].dataType) for name in columns)
    place = _place(kinds, blocks * BLOCK)
    whole = (
        listed.select(place.alias("place"))
        .groupBy(F.shiftright("place", _SPARKS.bit_length() - 1).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(_SPARKS - 1))).alias("bits"))
    )
    per = _SPARKS // BLOCK
    cut = whole.select("part", "bits", F.explode(F.sequence(F.lit(0), F.lit(per - 1))).alias("i")).select(
        (F.col("part") * per + F.col("i")).alias("block"), F.substring(F.col("bits"), F.col("i") * (BLOCK // 8) + 1, F.lit(BLOCK // 8)).alias("bits")
    )
    return Marks(stage(cut.where(F.col("block") < blocks), "marks"), blocks * BLOCK, kinds)
