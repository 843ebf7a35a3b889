"""Labels that classify a sale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two customer types.
NEW = "New"
REPEAT = "Repeat"


def customer_type(sold_at: Column, first_at: Column) -> Column:
    """"Repeat" after the customer's first purchase, else "New".

    A missing time on either side compares as null and so counts as "New".
    """
    return F.when(sold_at > first_at, F.lit(REPEAT)).otherwise(F.lit(NEW))
