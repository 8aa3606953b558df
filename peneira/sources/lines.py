"""Text lines, with or without the first lines of each file."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str], skip: int = 0) -> DataFrame:
    """One row per line in column ``value``; line ends are removed, blanks kept.

    A line ends with a line feed, or a carriage return and a line feed. ``skip``
    leaves out that many lines at the start of *each file*.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return without_first_lines(lines, skip).select(cut_return(F.col("value")).alias("value"))


def cut_return(line: Column) -> Column:
    return F.when(line.endswith("\r"), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def without_first_lines(lines: DataFrame, skip: int, check: Callable[[str, str], None] | None = None) -> DataFrame:
    """Drop the first ``skip`` lines of each file, without a shuffle.

    ``check`` is called with every file's path and the last line dropped (without a byte order
    mark and carriage return), and raises an error if it does not like it.

    Only the first split of a file can hold its first lines, and Spark hands a task the
    rows of a split in file order. The rows of first splits go through Python, which counts
    them; those of later splits, most of any large file, stay in the JVM. Both are scans of
    their own, as reading lines is cheap beside sending them through Python.
    """
    if skip == 0:
        return lines.select("value")
    meta = F.col("_metadata")
    heads = lines.filter(meta["file_block_start"] == 0).select(
        "value",
        meta["file_path"].alias("head_of"),
        (meta["file_block_length"] < meta["file_size"]).alias("goes_on"),
    )
    kept = heads.mapInArrow(functools.partial(_drop_heads, skip=skip, verify=check), "value string")
    return kept.union(lines.filter(meta["file_block_start"] > 0).select("value"))


def plain_line(line: str) -> str:
    return line.removeprefix("\ufeff").removesuffix("\r")


def _drop_heads(batches: Iterator[pa.RecordBatch], skip: int, verify: Callable | None) -> Iterator[pa.RecordBatch]:
    path, seen, goes_on = "", 0, False  # the file whose first split is being read

    def check() -> None:
        if path and goes_on and seen < skip:
            raise ValueError(f"the first split of {path} holds only {seen} of the {skip} lines to skip")

    for batch in batches:
        lines = batch.select(["value"])
        if lines.num_rows == 0:
            continue
        heads = batch.column("head_of")
        changes = pc.not_equal(heads.slice(1), heads.slice(0, len(heads) - 1))
        starts = [0, *(np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1).tolist()]
        keep = None
        for start, end in zip(starts, [*starts[1:], len(heads)]):
            this = heads[start].as_py()
            if this != path:
                check()
                path, seen, goes_on = this, 0, batch.column("goes_on")[start].as_py()
            if seen < skip:
                keep = np.ones(len(heads), dtype=bool) if keep is None else keep
                stop = min(end, start + skip - seen)
                keep[start:stop] = False
                if verify and seen + stop - start == skip:
                    verify(path, plain_line(lines.column(0)[stop - 1].as_py()))
            seen += end - start
        yield lines if keep is None else lines.filter(pa.array(keep))
    check()
