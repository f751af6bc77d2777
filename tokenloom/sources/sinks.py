"""Line rendering of each stage's result, and the text sink."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tokenloom.params import Params

#: Bytes of a part that one task copies into a single file.
_PIECE_BYTES = 64 << 20


def render_frequencies(df: DataFrame, params: Params = Params()) -> DataFrame:
    """``word \\t token \\t frequency``"""
    cells = [F.col(c).cast("string") for c in ("word", "token", "frequency")]
    return df.select(F.concat_ws(params.field_delimiter, *cells).alias("value"))


def render_windows(df: DataFrame, params: Params = Params(), index: Column | None = None) -> DataFrame:
    """Two lines per window, ``input_<i> \\t t,t,…`` and ``label_<i> \\t t``, from one pass over the windows."""
    i = (F.col("pos") if index is None else index).cast("string")
    d = F.lit(params.field_delimiter)
    lines = F.array(
        F.concat(F.lit("input_"), i, d, F.array_join(F.col("input").cast("array<string>"), ",")),
        F.concat(F.lit("label_"), i, d, F.col("label").cast("string")),
    )
    return df.select(F.explode(lines).alias("value"))


def render_vector(vector: Column, number_format: str | None = None) -> Column:
    """``[a, b]`` with each number in its shortest form, or in a printf format."""
    if number_format is None:
        numbers = vector.cast("array<string>")
    else:
        numbers = F.transform(vector, lambda x: F.format_string(number_format, x.cast("double")))
    return F.concat(F.lit("["), F.array_join(numbers, ", "), F.lit("]"))


def render_vectors(
    df: DataFrame, params: Params = Params(), token: str = "token", vector: str = "vector", number_format: str | None = None
) -> DataFrame:
    """``token \\t [a, b, …]``"""
    cells = (F.col(token).cast("string"), render_vector(F.col(vector), number_format))
    return df.select(F.concat_ws(params.field_delimiter, *cells).alias("value"))


def render_similar(df: DataFrame, params: Params = Params(), token: str = "token") -> DataFrame:
    """``token \\t t(0.9988),…``, best first, from ranked rows. A group holds at most k rows."""
    shown = F.format_string("%s(" + params.similarity_format + ")", F.col("similar").cast("string"), F.col("score"))
    lists = df.groupBy(token).agg(F.array_sort(F.collect_list(F.struct("rank", shown.alias("s")))).alias("l"))
    joined = F.array_join("l.s", params.similarity_pair_delimiter)
    return lists.select(F.concat_ws(params.field_delimiter, F.col(token).cast("string"), joined).alias("value"))


def write_lines(
    df: DataFrame, path: str, partitions: int | None = None, order: str | None = None, observation: Observation | None = None
) -> None:
    """Write ``value`` as text, replacing what is there once all of it is written.

    ``order`` sorts the whole output by that column over any number of files; ``partitions`` fixes the file count,
    1 giving a single totally ordered file as a last step: written in parts that tasks copy to their places where files have paths
    (``file:``), elsewhere by one task. ``observation`` gets the number of rows, ``n``. Lines are written
    beside the target, which readers pass over, and take its name at the end: if writing fails, the target is as it was.
    """
    joined = partitions == 1 and _file_system(df.sparkSession, path)[0].getUri().getScheme() == "file"
    if joined:
        # Every task writes a part, as many as there are, and the parts are put into one file at their places.
        partitions = None
    if order is not None:
        by_range = df.repartitionByRange(partitions, order) if partitions else df.repartitionByRange(order)
        df = by_range.sortWithinPartitions(order)
    elif partitions:
        df = df.repartition(partitions)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("n"))
    beside = _sibling(path, "new")
    parts = _sibling(path, "parts") if joined else beside
    try:
        df.select("value").write.text(parts)
        if joined:
            _join(df.sparkSession, parts, beside)
    except BaseException:
        _remove(df.sparkSession, beside)
        _remove(df.sparkSession, parts)
        raise
    if joined:
        _remove(df.sparkSession, parts)
    _replace(df.sparkSession, beside, path)


def _join(spark: SparkSession, parts: str, folder: str) -> None:
    """Put the files of the folder ``parts``, by name, into one file of the new ``folder``, both on a shared file system with paths.

    Each task copies a piece of bounded size to its place, so none reads the whole. A repeated task writes the same bytes again.
    """
    files, place = _file_system(spark, parts)
    found = sorted((s.getPath().getName(), s.getPath().toUri().getPath(), s.getLen()) for s in files.listStatus(place))
    found = [f for f in found if not f[0].startswith(("_", "."))]
    _, new = _file_system(spark, folder)
    files.mkdirs(new)
    target = f"{new.toUri().getPath()}/{found[0][0] if found else 'part-00000.txt'}"
    pieces, at = [], 0
    for _, source, size in found:
        pieces += [(source, begin, min(_PIECE_BYTES, size - begin), at + begin) for begin in range(0, size, _PIECE_BYTES)]
        at += size

    def copy(piece: tuple[str, int, int, int]) -> None:
        source, begin, left, to = piece
        out = os.open(target, os.O_WRONLY | os.O_CREAT, 0o644)
        with os.fdopen(out, "wb") as file:
            file.seek(to)
            if not left:
                return
            with open(source, "rb") as read:
                read.seek(begin)
                while left:
                    data = read.read(min(left, 1 << 20))
                    if not data:
                        raise OSError(f"{source} is shorter than it was")
                    file.write(data)
                    left -= len(data)

    # Without a byte there is still a file.
    pieces = pieces or [("", 0, 0, 0)]
    spark.sparkContext.parallelize(pieces, len(pieces)).foreach(copy)


def _sibling(path: str, kind: str) -> str:
    """A new hidden name in the folder of ``path``."""
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}.{name}-{kind}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it wants it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def _remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def _replace(spark: SparkSession, new: str, path: str) -> None:
    """Give the folder ``new`` the name ``path``; what had it before goes last, and comes back if that fails."""
    old = _sibling(path, "old")
    files, target = _file_system(spark, path)
    _, source = _file_system(spark, new)
    _, aside = _file_system(spark, old)
    there = files.exists(target)
    if there and not files.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(source, target):
        if there:
            files.rename(aside, target)
        raise OSError(f"cannot move {new} to {path}")
    if there:
        files.delete(aside, True)
