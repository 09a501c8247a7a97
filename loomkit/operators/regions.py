"""Connected regions of pixel tables over horizontal runs.

Pixels of a layer (an image and a tone or seed value) become runs, one row per maximal
horizontal stretch. A strip of ``STRIP`` pixel rows is labelled in one task, so no task
holds more of an image than a strip. Labels of neighbouring strips meet along their border
rows only: each run there has at most one partner that starts before it and reaches it, so the
links are as few as the runs. They are contracted in rounds with pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomkit.session import cut_lineage

STRIP = 64
AT_ONCE = 100_000        # pixels that a task labels at a time (a strip of more is never cut)
_SPAN = 1 << 31          # a run's label is y * _SPAN + x0 of the first run of its region


def _group_numbers(table: pa.Table, cols: list[str]) -> np.ndarray:
    """0, 1, .. per stretch of rows with equal ``cols``."""
    new = np.zeros(table.num_rows, dtype=bool)
    for c in cols:
        codes = table[c].combine_chunks().dictionary_encode("encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(new)


def _regions(table: pa.Table, group: np.ndarray, keys: list[str], reach: int, strip: int) -> pa.Table:
    """Runs of whole strips with the labels of their regions; ``group`` numbers the strips."""
    y, x = table["y"].to_numpy().astype(np.int64), table["x"].to_numpy().astype(np.int64)
    order = np.lexsort((x, y, group))
    y, x, group = y[order], x[order], group[order]
    # rows of all strips on one axis, with an empty row between strips
    line = group * (strip + 1) + y % strip
    head = np.ones(len(y), dtype=bool)
    head[1:] = (line[1:] != line[:-1]) | (x[1:] > x[:-1] + 1)
    start = np.flatnonzero(head)
    stop = np.append(start[1:], len(y)) - 1
    line, ry, x0, x1 = line[start], y[start], x[start], x[stop]
    # the partner above: the last run of the row before that starts no later than x1 + reach ...
    rank = line * _SPAN + x0
    above = np.searchsorted(rank, (line - 1) * _SPAN + x1 + reach, "right") - 1
    first = np.searchsorted(rank, (line - 1) * _SPAN, "left")
    label = list(range(len(ry)))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i
    touched = np.flatnonzero(above >= first)
    starts, ends = x0.tolist(), x1.tolist()
    for i, j, low in zip(touched.tolist(), above[touched].tolist(), first[touched].tolist()):
        # ... and those before it, as long as they reach this run
        while j >= low and ends[j] + reach >= starts[i]:
            a, b = root(i), root(j)
            label[max(a, b)] = min(a, b)
            j -= 1
    roots = np.array([root(i) for i in range(len(ry))], dtype=np.int64)
    region = (ry * _SPAN + x0)[roots] if len(ry) else ry
    out = table.select(keys).take(pa.array(order[start]))
    for name, values, kind in (("y", ry, pa.int32()), ("x0", x0, pa.int32()), ("x1", x1, pa.int32()),
                               ("region", region, pa.int64())):
        out = out.append_column(name, pa.array(values, kind))
    return out


def _strip_regions(keys: list[str], reach: int, strip: int):
    """``_regions`` over batches that are sorted by strip: many small strips at once, and a strip is never cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, enough = [], 0, AT_ONCE

        def labelled(table: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
            if table.num_rows:
                yield from _regions(table, group, keys, reach, strip).to_batches()
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < enough:
                continue
            table = pa.Table.from_batches(held)
            group = _group_numbers(table, [*keys, "_strip"])
            cut = int(np.searchsorted(group, group[-1], "left"))  # the last strip may go on
            yield from labelled(table.slice(0, cut), group[:cut])
            held, rows = table.slice(cut).to_batches(), table.num_rows - cut
            enough = max(AT_ONCE, 2 * rows)
        if held:
            table = pa.Table.from_batches(held)
            yield from labelled(table, _group_numbers(table, [*keys, "_strip"]))
    return run


def _border_links(rows: DataFrame, keys: list[str], strip: int, reach: int) -> DataFrame:
    """``(keys, u, v)``: labels of touching runs on both sides of a strip border."""
    below = F.when((F.col("y") % strip == 0) & (F.col("y") > 0),
                   F.struct(F.floor(F.col("y") / strip).alias("border"), F.lit(True).alias("low")))
    above = F.when(F.col("y") % strip == strip - 1,
                   F.struct(F.floor((F.col("y") + 1) / strip).alias("border"), F.lit(False).alias("low")))
    edge = rows.select(*keys, "x0", "x1", "region", F.inline(F.filter(F.array(below, above), lambda e: e.isNotNull())))
    w = Window.partitionBy(*keys, "border").orderBy("x0", "low").rowsBetween(Window.unboundedPreceding, -1)
    found = edge
    for side in (True, False):
        mine = F.when(F.col("low") == side, F.struct("x1", "region"))
        found = found.withColumn(f"last_{side}", F.last(mine, ignorenulls=True).over(w))
    partner = F.when(F.col("low"), F.col("last_False")).otherwise(F.col("last_True"))
    touching = found.select(*keys, F.col("region").alias("u"), partner.alias("p"), "x0").where(
        F.col("p.x1") + reach >= F.col("x0"))
    # a run may also be reached by one that starts up to ``reach`` pixels later; that one sees it as earlier
    return touching.select(*keys, "u", F.col("p.region").alias("v")).where("u <> v").distinct()


def contract(links: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, region, root)``: the smallest label that each linked label reaches inside its layer.

    Every round each label takes its smallest neighbour, pointers are followed to their ends,
    and links are rewritten to the ends, until none joins two different ones.
    """
    edges = cut_lineage(links)
    found = None
    while not edges.isEmpty():
        both = edges.select(*keys, "u", "v").unionByName(edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        hook = both.groupBy(*keys, "u").agg(F.min("v").alias("v")).select(
            *keys, F.col("u").alias("region"), F.least("u", "v").alias("root"))
        while True:
            up = hook.select(*keys, F.col("region").alias("root"), F.col("root").alias("above"))
            hop = cut_lineage(hook.join(up, [*keys, "root"]).select(*keys, "region", "root", "above"))
            hook = hop.select(*keys, "region", F.col("above").alias("root"))
            if hop.where("root <> above").isEmpty():
                break
        if found is None:
            found = hook
        else:
            step = hook.select(*keys, F.col("region").alias("root"), F.col("root").alias("new"))
            found = cut_lineage(found.join(step, [*keys, "root"], "left")
                                .select(*keys, "region", F.coalesce("new", "root").alias("root")))
        at_u = hook.select(*keys, F.col("region").alias("u"), F.col("root").alias("ru"))
        at_v = hook.select(*keys, F.col("region").alias("v"), F.col("root").alias("rv"))
        edges = cut_lineage(edges.join(at_u, [*keys, "u"]).join(at_v, [*keys, "v"]).where("ru <> rv")
                            .select(*keys, F.col("ru").alias("u"), F.col("rv").alias("v")).distinct())
    if found is None:
        return edges.select(*keys, F.col("u").alias("region"), F.col("v").alias("root"))
    return found


def label_regions(px: DataFrame, keys: list[str], diagonal: bool = True, strip: int = STRIP,
                  one_strip: bool | None = None) -> DataFrame:
    """``(keys, y, x0, x1, region)``: every run of a layer with the label of its connected region.

    ``px`` has ``keys`` (the layer), ``y`` and ``x``, one row per pixel; repeated rows count once.
    Runs are connected when they touch in neighbouring rows, with ``diagonal`` also by a corner.
    """
    reach = 1 if diagonal else 0
    kinds = dict(px.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "y int, x0 int, x1 int, region bigint"])
    cells = px.select(*keys, "y", "x", F.floor(F.col("y") / strip).cast("int").alias("_strip"))
    by = [*keys, "_strip"]
    rows = cells.repartition(*by).sortWithinPartitions(*by).mapInArrow(_strip_regions(keys, reach, strip), schema)
    if one_strip is None:
        one_strip = px.where(F.col("y") >= strip).isEmpty()
    if one_strip:
        return rows
    rows = cut_lineage(rows)
    roots = contract(_border_links(rows, keys, strip, reach), keys)
    joined = rows.join(roots, [*keys, "region"], "left")
    return joined.select(*keys, "y", "x0", "x1", F.coalesce("root", "region").alias("region"))


def region_sizes(runs: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, region, area)`` in pixels."""
    return runs.groupBy(*keys, "region").agg(F.sum(F.col("x1") - F.col("x0") + 1).cast("bigint").alias("area"))


def drop_speckles(runs: DataFrame, keys: list[str], least) -> DataFrame:
    """``runs`` without the regions of fewer than ``least`` pixels (a number or a column of ``runs``)."""
    keep = region_sizes(runs, keys)
    bar = F.col(least) if isinstance(least, str) else F.lit(least)
    return runs.join(keep, [*keys, "region"]).where(F.col("area") >= bar).drop("area")
