"""Where the running weight of a table, in the order of a key, passes a target: found by narrowing histograms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys are whole numbers from 0 up to this.
TOP = (1 << 62) - 1
#: Cells of all histograms of a pass together, which is what reaches the driver.
CELLS = 1 << 15
#: Rows that all intervals together may hold for their keys to be collected as they are.
FEW = 1 << 15


@dataclass
class Cut:
    """Rows below ``key`` weigh ``below``, rows at it ``at``; with the latter the target is passed.

    ``key`` is None if all rows together do not pass the target.
    """

    key: int | None
    below: int
    at: int


def seeded(*columns: str | Column) -> Column:
    """An even key from 0 to TOP."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(TOP))


def cuts(rows: DataFrame, group: Column, key: Column, weight: Column, targets: dict[int, int]) -> dict[int, Cut]:
    """For each group number in ``targets``: the first key at which the running weight exceeds the target.

    Every pass is one aggregation of all rows of the groups to a histogram of the interval that
    holds the cut; the interval shrinks by the number of cells. Once few rows are left in all of them
    together, their keys are the cells. Rows of other groups are ignored.
    """
    out: dict[int, Cut] = {}
    open_: dict[int, tuple[int, int, int]] = {g: (0, TOP, 0) for g in targets}  # from, to, weight below
    rows = rows.select(group.cast("int").alias("g"), key.alias("k"), weight.cast("long").alias("w"))
    spark = rows.sparkSession
    rest = 0  # rows in the intervals
    if targets:  # the first interval is from the least key to the largest
        ends = rows.filter(F.col("g").isin(*open_) if len(open_) <= 64 else F.lit(True)).groupBy("g").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("n")).collect()
        known = {r.g: (r.a, r.b, 0) for r in ends if r.g in open_}
        out |= {g: Cut(None, 0, 0) for g in open_ if g not in known}
        open_, rest = known, sum(r.n for r in ends if r.g in known)
    while open_:
        cells = max(16, CELLS // len(open_))
        steps = {g: (lo, hi, 1 if rest <= FEW else max(1, -(-(hi - lo + 1) // cells))) for g, (lo, hi, _) in open_.items()}
        frame = F.broadcast(spark.createDataFrame([(g, *x) for g, x in steps.items()], "g int, lo long, hi long, step long"))
        got = rows.join(frame, "g").filter("k between lo and hi").select("g", F.expr("(k - lo) div step").alias("c"), "w").groupBy("g", "c").agg(F.sum("w").alias("w"), F.count("*").alias("n")).collect()
        by: dict[int, list[tuple[int, int, int]]] = {g: [] for g in open_}
        for r in got:
            by[r.g].append((r.c, r.w, r.n))
        following, rest = {}, 0
        for g, (lo, hi, below) in open_.items():
            step = steps[g][2]
            for c, w, n in sorted(by[g]):
                if below + w > targets[g]:
                    if step == 1:
                        out[g] = Cut(lo + c, below, w)
                    else:
                        following[g] = (lo + c * step, min(hi, lo + (c + 1) * step - 1), below)
                        rest += n
                    break
                below += w
            else:
                out[g] = Cut(None, below, 0)
        open_ = following
    return out
