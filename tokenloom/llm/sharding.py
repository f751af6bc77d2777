"""Contiguous shards of near equal bytes by global prefix sums.

Rows are range-partitioned by text hash and id, so equal texts stand together. Each partition adds up its own bytes and
rows while it is written; the totals of the partitions, one row each, give the offsets that make the sums global. The
byte line is cut at equal targets. A cut inside a run of equal texts moves to the edge of the run if that is within
``SLACK`` of a target size, else to the nearest row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm.common import fresh
from tokenloom.session import materialise

SHARDS = 24
SLACK = 0.02
ROW_BYTES = 8


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, and a fixed cost for each row."""
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + F.lit(ROW_BYTES).cast("long")


def shard_by_bytes(
    docs: DataFrame,
    n_shards: int = SHARDS,
    carry: list[str] | None = None,
    size: str = "size",
    shard: str = "shard",
    slot: str = "slot",
) -> DataFrame:
    """``docs`` with ``size``, ``shard`` (from 0) and ``slot``, the row's place in its shard, gapless from 0.

    ``carry`` names the columns to keep; leaving ``text`` out keeps the texts from being sorted and written.

    Null and empty texts count their fixed cost and are one run of equal texts; rows without an id come first in a
    run; repeated rows are rows of their own; a text longer than a target leaves shards empty; an empty table stays empty.
    Columns of ``docs`` that clash with the three names raise.
    """
    if clash := {size.lower(), shard.lower(), slot.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"docs already has columns {sorted(clash)}")
    run, part, before, place = (fresh(docs, c) for c in ("run_key", "part", "before", "place"))
    keyed = docs.withColumns({size: row_size(F.col("text")), run: F.xxhash64(F.coalesce("text", F.lit("")))})
    if carry is not None:
        keyed = keyed.select(*carry, size, run)
    order = [run, *(["doc_id"] if "doc_id" in keyed.columns else [])]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*ranged.schema, *(T.StructField(c, T.LongType()) for c in (part, before, place))])
    at = ranged.columns.index(size)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total, rows = TaskContext.get().partitionId(), 0, 0
        names = [f.name for f in schema]
        for batch in batches:
            sizes = batch.column(at).to_numpy()
            ends = total + np.cumsum(sizes)
            more = (np.full(len(sizes), number), ends - sizes, rows + np.arange(len(sizes)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in more)], names=names)
            if len(sizes):
                total, rows = int(ends[-1]), rows + len(sizes)

    local = materialise(ranged.mapInArrow(summed, schema))
    totals = sorted(local.groupBy(part).agg(F.sum(size), F.count("*")).collect())
    starts, bytes_, rows = [], 0, 0
    for number, n_bytes, n_rows in totals:
        starts.append((number, bytes_, rows))
        bytes_, rows = bytes_ + n_bytes, rows + n_rows
    offset, first = fresh(local, "offset"), fresh(local, "first")
    spark = docs.sparkSession
    offsets = spark.createDataFrame(starts, f"`{part}` long, `{offset}` long, `{first}` long")
    # One row per partition of the sort.
    rows_ = local.join(F.broadcast(offsets), part).withColumns({before: F.col(before) + F.col(offset), place: F.col(place) + F.col(first)})
    cuts = _cuts(rows_, bytes_, n_shards, run, size, before)
    shard_of = F.size(F.filter(F.lit(cuts).cast("array<long>"), lambda c: c <= F.col(before))) if cuts else F.lit(0)
    rows_ = rows_.withColumn(shard, shard_of.cast("int"))
    firsts = dict(rows_.groupBy(shard).agg(F.min(place)).collect())
    starts_of = F.lit([firsts.get(i, 0) for i in range(n_shards)]).cast("array<long>")
    placed = rows_.withColumn(slot, F.col(place) - F.get(starts_of, F.col(shard)))
    return placed.drop(run, part, before, place, offset, first)


def _cuts(rows: DataFrame, total: int, n_shards: int, run: str, size: str, before: str) -> list[int]:
    """The places on the byte line where a new shard begins, each at the edge of a row."""
    targets = [round(total * i / n_shards) for i in range(1, n_shards)]
    if not total or not targets:
        return []
    end = F.col(before) + F.col(size)
    inside = F.exists(F.lit(targets).cast("array<long>"), lambda c: (c >= F.col(before)) & (c < end))
    held = rows.filter(inside).select(run, F.col(before).alias("a"), end.alias("b")).collect()
    keys = sorted({r[0] for r in held})
    spans = rows.filter(F.col(run).isin(keys)).groupBy(run).agg(F.min(before), F.max(end))
    runs = {k: (a, b) for k, a, b in spans.collect()}
    cuts = []
    for c in targets:
        key, a, b = next(r for r in held if r[1] <= c < r[2])
        edge = min(runs[key], key=lambda e: abs(e - c))
        cuts.append(edge if abs(edge - c) <= SLACK * total / n_shards else min((a, b), key=lambda e: abs(e - c)))
    return sorted(cuts)
