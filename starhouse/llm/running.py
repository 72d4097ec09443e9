"""Order and running aggregates inside groups that may hold most of all rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.operators.keys import number_rows

CHUNK_BITS = 10  # a window holds 1024 rows


def placed(rows: DataFrame, group: str, order: Sequence[Column | str], names: Sequence[str]) -> DataFrame:
    """``rows`` with ``place`` 1, 2, ... inside its group and ``size``, the number of rows of the group.

    ``order`` sorts a group; ``names`` are the columns that are kept. Rows are numbered over the whole
    table by range, so a group of any size spreads over many tasks. Groups are not null.
    """
    keys = {f"_o{i}": c for i, c in enumerate(order)}
    keyed = rows.select(*names, *[(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in keys.items()])
    numbered = number_rows(keyed, [group, *keys], "_number", columns=names)
    groups = numbered.groupBy(F.col(group).alias("_group")).agg(
        F.min("_number").alias("_first"), F.count("*").alias("size"))
    return numbered.join(groups, F.col(group) == F.col("_group")).select(
        *names, (F.col("_number") - F.col("_first") + 1).alias("place"), "size")


def running(rows: DataFrame, group: str, place: str, values: dict[str, Column],
            add: Callable[[Column], Column], join: Callable[[Column, Column], Column]) -> DataFrame:
    """``rows`` with, under each name, ``add`` of its value over the group's rows up to this one.

    ``add`` is an aggregate (``F.sum``, ``F.bit_xor``) and ``join`` puts two of its results together.
    A window holds one chunk of rows; what went before a chunk comes from a table of chunk results.
    Groups are not null.
    """
    chunk = F.shiftright(place, CHUNK_BITS).alias("_chunk")
    given = rows.select("*", chunk, *[v.alias(f"_v_{n}") for n, v in values.items()])
    so_far = (Window.partitionBy(group, "_chunk").orderBy(place)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = given.select("*", *[add(F.col(f"_v_{n}")).over(so_far).alias(n) for n in values])
    inside = inside.drop(*[f"_v_{n}" for n in values])
    before = (Window.partitionBy("_of").orderBy("_at")
              .rowsBetween(Window.unboundedPreceding, -1))
    ends = (given.groupBy(F.col(group).alias("_of"), F.col("_chunk").alias("_at"))
            .agg(*[add(F.col(f"_v_{n}")).alias(n) for n in values]))
    ends = ends.select("_of", "_at", *[add(F.col(n)).over(before).alias(f"_b_{n}") for n in values])
    ends = ends.filter(F.col(f"_b_{next(iter(values))}").isNotNull())  # groups of several chunks
    joined = inside.join(ends, (F.col(group) == F.col("_of")) & (F.col("_chunk") == F.col("_at")),
                         "left")
    return joined.select(*rows.columns, *[
        F.when(F.col(f"_b_{n}").isNull(), F.col(n)).otherwise(join(F.col(n), F.col(f"_b_{n}"))).alias(n)
        for n in values])
