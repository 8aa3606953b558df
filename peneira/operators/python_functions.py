"""Operators that take a Python function, for what no built-in expresses.

Data goes to the function's process in Arrow batches and comes back in batches
of bounded size. A built-in expression stays in the JVM and is faster: use these
only for functions that have none. Select the columns needed beforehand.
"""

from __future__ import annotations

import functools
import itertools
from collections import namedtuple
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from peneira.functions.names import named, quoted

OUTPUT_ROWS = 10_000
HELD_KEYS = 100_000
HELD_BYTES = 64 << 20
NATIVE = {"sum": F.sum, "min": F.min, "max": F.max}


def map_values(fn: Callable, kind: str, *columns: Column | str, pinned: bool = False) -> Column:
    """``fn`` applied to each row's values, as a column of type ``kind``.

    ``pinned`` has it evaluated where it is written. Otherwise the optimizer
    may move a filter on it ahead of an aggregate, to where there are more rows.
    """
    arrow_kind = _arrow(f"value {kind}").field(0).type

    @F.arrow_udf(kind)
    def apply(*arrays: pa.Array) -> pa.Array:
        rows = zip(*(array.to_pylist() for array in arrays))
        return pa.array([fn(*values) for values in rows], type=arrow_kind)

    return (apply.asNondeterministic() if pinned else apply)(*columns)


def keep_if(df: DataFrame, predicate: Callable, *columns: str, pinned: bool = False) -> DataFrame:
    """Rows for which ``predicate`` is true; returning nothing counts as false."""
    return df.filter(
        map_values(lambda *values: bool(predicate(*values)), "boolean", *columns, pinned=pinned)
    )


def for_each_record(df: DataFrame, process: Callable, schema: StructType | str) -> DataFrame:
    """``process`` gives no, one or many output records for each input record.

    It gets a named tuple, so fields go by name or by position, and returns an
    iterable of tuples in the order of ``schema``, or nothing for no records.
    """
    return df.mapInArrow(
        functools.partial(_process_records, process=process, schema=_arrow(schema)), schema
    )


def flat_map(df: DataFrame, fn: Callable[..., Iterable], column: str, name: str, kind: str) -> DataFrame:
    """One row per item ``fn`` gives for each value of ``column``."""
    return df.select(named(column)).mapInArrow(
        functools.partial(_flatten_items, fn=fn, kind=_arrow(f"{quoted(name)} {kind}")), f"{quoted(name)} {kind}"
    )


def combine_per_key(
    df: DataFrame, key: str, value: str, combiner: Callable[[Iterable], object] | str, kind: str | None = None
) -> DataFrame:
    """Reduce the values of each key with ``combiner``, e.g. Python's ``sum``.

    A name out of ``NATIVE``, such as ``"sum"``, takes Spark's own aggregate.

    ``combiner`` turns several values into one of the type ``kind``; the order and
    grouping in which it meets them must not matter. ``kind`` defaults to the values' type,
    with whole numbers as long and floats as double, so that sums have room. As in SQL, null
    values are passed over, a key with nothing else gets null, a null key is a key, and
    so are NaN and zero, of either sign. It runs once over the values within each task, and
    again over those partial results, so a frequent key costs one partial result per task.
    No group is ever held whole.
    """
    pairs = df.select(named(key), named(value))
    if isinstance(combiner, str):
        result = NATIVE[combiner](named(value))
        return pairs.groupBy(named(key)).agg((result if kind is None else result.cast(kind)).alias(value))
    field = pairs.schema[value].dataType
    wide = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}
    kind = kind or wide.get(field.simpleString(), field.simpleString())
    own = named(key)
    if pairs.schema[key].dataType.simpleString() in ("float", "double"):
        own = own + F.lit(0.0).cast(pairs.schema[key].dataType)  # minus zero is zero
    pairs = pairs.select(own.alias(key), named(value).cast(kind).alias(value))
    schema = pairs.schema
    partial = pairs.mapInArrow(functools.partial(_combine, combiner=combiner, by_key=False), schema)
    # Sorted by key, the partial results of a key follow each other.
    gathered = partial.repartition(named(key)).sortWithinPartitions(named(key))
    return gathered.mapInArrow(functools.partial(_combine, combiner=combiner, by_key=True), schema)


def _same(key: object) -> object:
    """What keys are looked up by: hashable, and with all NaN as one."""
    if isinstance(key, float) and key != key:
        return _same
    if isinstance(key, list):
        return tuple(map(_same, key))
    if isinstance(key, dict):
        return tuple((k, _same(v)) for k, v in key.items())
    return key


def _arrow(schema: StructType | str) -> pa.Schema:
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return to_arrow_schema(StructType([StructField(f.name, f.dataType, True) for f in schema]))


def _rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), type=field.type) for values, field in zip(columns, schema)], schema=schema
    )


def _process_records(
    batches: Iterator[pa.RecordBatch], process: Callable, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    ready: list[tuple] = []
    for batch in batches:
        record = namedtuple("Record", batch.schema.names, rename=True)
        for values in zip(*(column.to_pylist() for column in batch.columns)):
            for output in process(record(*values)) or ():
                ready.append(output)
                if len(ready) == OUTPUT_ROWS:
                    yield _rows_to_batch(ready, schema)
                    ready = []
    if ready:
        yield _rows_to_batch(ready, schema)


def _flatten_items(
    batches: Iterator[pa.RecordBatch], fn: Callable[..., Iterable], kind: pa.Schema
) -> Iterator[pa.RecordBatch]:
    ready: list = []
    for batch in batches:
        for value in batch.column(0).to_pylist():
            items = iter(fn(value) or ())
            while some := list(itertools.islice(items, OUTPUT_ROWS - len(ready))):
                ready += some
                if len(ready) == OUTPUT_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(ready, kind.field(0).type)], schema=kind)
                    ready = []
    if ready:
        yield pa.RecordBatch.from_arrays([pa.array(ready, kind.field(0).type)], schema=kind)


def _combine(
    batches: Iterator[pa.RecordBatch], combiner: Callable, by_key: bool
) -> Iterator[pa.RecordBatch]:
    """Combine values per key; with ``by_key`` the input is sorted by key.

    What is held is written out when it has ``HELD_KEYS`` keys, or comes from ``HELD_BYTES`` of input.
    """
    held: dict = {}  # key as looked up: (key, combined value)
    schema, taken = None, 0
    for batch in batches:
        schema, taken = batch.schema, taken + batch.nbytes
        met: dict = {}
        for key, value in zip(*(column.to_pylist() for column in batch.columns)):
            met.setdefault(_same(key), (key, []))[1].append(value)
        for same, (key, values) in met.items():
            there = [v for v in values if v is not None]
            if same in held and held[same][1] is not None:
                there = [held[same][1], *there]
            combined = there[0] if by_key and len(there) == 1 else combiner(there) if there else None
            held[same] = (key, combined)
        if by_key and len(held) > 1:
            # The last key may go on in the next batch.
            last = _same(key)
            yield _rows_to_batch([row for same, row in held.items() if same != last], schema)
            held = {last: held[last]}
        elif not by_key and (len(held) >= HELD_KEYS or taken >= HELD_BYTES):
            yield _rows_to_batch(list(held.values()), schema)
            held, taken = {}, 0
    if held:
        yield _rows_to_batch(list(held.values()), schema)
