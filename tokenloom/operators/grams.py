"""Counted n-grams that travel packed: one shuffle of compressed tables, put together where all of a gram's counts arrive.

A run of text gives each *bucket* one table: the tokens that stand in its grams, the grams as small numbers, and their
counts. A gram's bucket is made of its tokens alone, so equal grams of all runs meet. What is kept of a bucket at a
time is its tables as they travelled and a bounded number of grams.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLES = "bucket int, number long, size long, packed binary"
# Grams of a bucket that are put together at a time, and rows that are handed on as one batch.
_PASS = 1 << 21
_BATCH = 1 << 16
# Stored bytes of text per bucket, and what no real table reaches: the size of one that Spark cannot tell.
_BUCKET_BYTES = 8 << 20
_UNKNOWN_BYTES = 1 << 50

Grams = tuple[pa.Array, np.ndarray, np.ndarray]


def buckets_of(df: DataFrame, each: int = _BUCKET_BYTES) -> int:
    """How many buckets the grams of ``df`` are dealt to: by the size of the tables it reads, one per core and shuffle partition at least."""
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(s for s in sizes if s < _UNKNOWN_BYTES)
    conf = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(conf, spark.sparkContext.defaultParallelism, -(-size // each))


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits whose bits depend on all bits of those given."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hashes(words: pa.Array) -> np.ndarray:
    """A number of 64 bits per token, the same in every process."""
    return mixed(np.array([zlib.crc32(str(t).encode("utf-8", "surrogatepass")) for t in words.to_pylist()], np.uint64))


def coded(tokens: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct tokens, null being one, and the place of each token among them."""
    found = pc.dictionary_encode(tokens, null_encoding="encode")
    found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def counted(ids: np.ndarray, n: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """The different columns of ``ids``, numbers below ``distinct``, in order, and the sums of ``n`` over equal ones."""
    if not ids.shape[1]:
        return ids, n
    code, span = ids[0].astype(np.int64), distinct
    for row in ids[1:]:
        if span * distinct >= 1 << 62:
            known, code = np.unique(code, return_inverse=True)
            span = len(known)
        code, span = code * distinct + row, span * distinct
    order = np.argsort(code)
    code = code[order]
    starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    return ids[:, order[starts]], np.add.reduceat(n[order], starts)


def _small(values: np.ndarray) -> pa.Array:
    """Whole numbers as one list cell of the smallest type that holds them."""
    least, most = (int(values.min()), int(values.max())) if values.size else (0, 0)
    kind = np.result_type(np.min_scalar_type(least), np.min_scalar_type(most))
    return pa.ListArray.from_arrays(pa.array([0, values.size], pa.int32()), pa.array(values.ravel().astype(kind)))


def pack(dictionaries: list[pa.Array], ids: np.ndarray, n: np.ndarray) -> bytes:
    """Grams as compressed bytes. One dictionary serves all rows of ``ids``; otherwise there is one for each."""
    cells, names = [], []
    for i, words in enumerate(dictionaries):
        rows = ids if len(dictionaries) == 1 else ids[i : i + 1]
        used = np.zeros(len(words), bool)
        used[rows.ravel()] = True
        words = words.take(pa.array(np.flatnonzero(used)))
        cells += [pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), _small((np.cumsum(used) - 1)[rows])]
        names += [f"words{i}", f"ids{i}"]
    batch = pa.RecordBatch.from_arrays([*cells, _small(n)], names=[*names, "n"])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpack(packed: bytes) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """What :func:`pack` was given, dictionaries of what was used only."""
    with pa.ipc.open_stream(packed) as reader:
        cells = [column.flatten() for column in reader.read_next_batch().columns]
    n = cells[-1].to_numpy().astype(np.int64)
    ids = [c.to_numpy().astype(np.int64) for c in cells[1:-1:2]]
    return cells[:-1:2], np.concatenate(ids).reshape(-1, len(n)) if len(n) else np.empty((len(ids), 0), np.int64), n


def deal(dictionaries: list[pa.Array], ids: np.ndarray, n: np.ndarray, homes: np.ndarray, buckets: int, each: int = 1) -> Iterator[pa.RecordBatch]:
    """Rows of ``TABLES`` for the buckets ``homes % buckets`` of the grams; a gram counts as ``each`` where it is put together."""
    bucket = (homes % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        some = order[cuts[b] : cuts[b + 1]]
        cells = [b, 0, len(some) * each, pack(dictionaries, ids[:, some], n[some])]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=["bucket", "number", "size", "packed"])


def numbered(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tables of a task, each with a number that no other table has."""
    task = TaskContext.get().partitionId() << 32
    for i, table in enumerate(tables):
        yield table.set_column(1, "number", pa.array([task + i]))


def gathered(df: DataFrame, deal: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], buckets: int) -> DataFrame:
    """The tables that ``deal`` makes of the rows of ``df``, after the only shuffle: those of a bucket one after the other.

    A table is a group of its own: groups that are sorted, not hashed, are held one at a time.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return numbered(deal(batches))

    met = df.mapInArrow(made, TABLES).repartition(buckets, "bucket").groupBy("bucket", "number")
    return met.agg(F.first("size").alias("size"), F.first("packed").alias("packed")).sortWithinPartitions("bucket")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple[bytes, int]]]:
    """The tables of each bucket and how many grams a table counts for, from rows in order of bucket."""
    rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)))
    for _, some in groupby(rows, itemgetter(0)):
        yield ((packed.as_py(), size) for _, size, packed in some)


def whole(
    dealt: Iterable[tuple[bytes, int]], buckets: int, homes: Callable[[np.ndarray, np.ndarray], np.ndarray],
    spread: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] = lambda ids, n: (ids, n),
) -> Iterator[Grams]:
    """The different grams of a bucket's tables of one dictionary, with their sums: ``(words, ids, n)``, in as many passes as their number asks for.

    ``homes(hashes, ids)`` are the numbers that gave grams their buckets; ``spread`` makes the grams of a table from its rows.
    """
    tables, sizes = zip(*dealt)
    passes = -(-sum(sizes) // _PASS)
    parts = [unpack(table)[0][0] for table in tables]
    words, at = coded(pa.concat_arrays(parts))
    at, hashes = at.astype(np.int32), token_hashes(words)
    ends = np.cumsum([0, *map(len, parts)])
    del parts
    for i in range(passes):
        found = []
        for table, low, high in zip(tables, ends, ends[1:]):
            _, ids, n = unpack(table)
            ids = at[low:high][ids]
            if passes > 1:
                now = (homes(hashes, ids) // np.uint64(buckets)) % np.uint64(passes) == i
                ids, n = ids[:, now], n[now]
            found.append(spread(ids, n))
        ids, n = (np.concatenate([part[j] for part in found], axis=-1) for j in (0, 1))
        del found
        yield words, *counted(ids, n, len(words))


def slices(n: int) -> Iterator[slice]:
    """``n`` rows in batches that are handed on."""
    return (slice(i, i + _BATCH) for i in range(0, n, _BATCH))
