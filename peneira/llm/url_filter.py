"""Rules on hosts and paths, looked up in a cascade of Bloom filters."""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peneira.llm.common import mixed, stored

BLOCK_KEYS = 20_000_000  # listed keys in one cascade: some 100 MB of filters
LEAST_BITS = 64
DEEPEST = 200  # levels; every level but the first halves what is left

Level = tuple[np.ndarray, int]  # 64-bit words, hashes


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def positions(a: np.ndarray, b: np.ndarray, depth: int, bits: int, hashes: int) -> np.ndarray:
    """The places of each key in the filter of a level, a row for each hash."""
    first, step = mixed(a, 2 * depth), mixed(b, 2 * depth + 1) | np.uint64(1)
    with np.errstate(over="ignore"):
        return (first + np.arange(hashes, dtype=np.uint64)[:, None] * step) % np.uint64(bits)


def passes(level: Level, depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a level's filter has each key: every key put in, and a share of the others."""
    words, hashes = level
    found = np.ones(len(a), bool)
    for at in positions(a, b, depth, len(words) * 64, hashes):
        found &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def members(cascade: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each key is listed; exact for every key of the universe that the cascade was made for.

    Even levels hold listed keys, odd ones the keys that passed the level before although they are
    not listed. The first level that refuses a key decides; if none does, the last one does.
    """
    found, open_ = np.zeros(len(a), bool), np.arange(len(a))
    for depth, level in enumerate(cascade):
        through = passes(level, depth, a[open_], b[open_])
        found[open_[~through]] = depth % 2 == 1
        open_ = open_[through]
    found[open_] = len(cascade) % 2 == 1
    return found


def _hashed(keys: DataFrame) -> DataFrame:
    """The keys with two hashes, from which the places in every level follow."""
    return keys.select("key", F.xxhash64("key").alias("a"), F.xxhash64(F.lit("b"), F.col("key")).alias("b"))


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def _filter_of(keys: DataFrame, n: int, depth: int, rate: float) -> Level:
    """The filter of ``n`` distinct keys with this rate of false positives.

    Tasks combine the bits of their keys, Spark those of all tasks; the driver gets the words, at
    most ``n * log2(1 / rate) / 44`` of them.
    """
    hashes = max(1, round(-math.log2(rate)))
    n_words = max(LEAST_BITS, math.ceil(n * hashes / math.log(2))) // 64 + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = positions(_numbers(batch, "a"), _numbers(batch, "b"), depth, n_words * 64, hashes).ravel()
            words, of = np.unique(at >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(words), np.uint64)
            np.bitwise_or.at(bits, of, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    parts = keys.mapInArrow(work, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(n_words, np.uint64)
    words[parts.column("word").to_numpy()] = parts.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return words, hashes


def _passing(keys: DataFrame, level: Level, depth: int) -> DataFrame:
    """The keys that a level's filter has; a key that repeats within a batch is there once."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            through = np.flatnonzero(passes(shared.value, depth, _numbers(batch, "a"), _numbers(batch, "b")))
            if len(through):
                names = batch.column("key").take(pa.array(through)).dictionary_encode()
                first = np.unique(names.indices.to_numpy(), return_index=True)[1]
                yield batch.take(pa.array(through[first]))

    return keys.mapInArrow(work, keys.schema)


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Filters that tell the listed keys from all others of the universe, without error.

    Both have one column of text, ``key``; repeats do not matter, nulls are no keys. The universe is
    read twice and never shuffled: once to estimate its size, once for the keys that the first level
    lets through. That level's rate makes them about as many as the listed ones, whatever the universe, and
    each later level halves one side, until no key is told wrongly. ``r`` listed keys of ``s`` take about
    ``r * (1.44 * log2(s / r) + 5)`` bits. No listed key: no level, and nothing is a member.
    """
    listed = stored(listed.select("key").filter("key IS NOT NULL").distinct(), "listed")
    r = listed.count()
    if r == 0:
        return []
    universe = universe.select("key").filter("key IS NOT NULL")
    s = universe.agg(F.approx_count_distinct("key")).first()[0]
    rate = min(0.5, r * math.sqrt(0.5) / max(s, 1))
    levels = [_filter_of(_hashed(listed), r, 0, rate)]
    met = _passing(_hashed(universe), levels[0], 0).select("key", F.lit(True).alias("met"), F.lit(False).alias("on"))
    own = listed.select("key", F.lit(False).alias("met"), F.lit(True).alias("on"))
    told = met.union(own).groupBy("key").agg(F.max("met").alias("met"), F.max("on").alias("on")).filter("met")
    told = stored(told, "passing")
    rest, inside = told.filter("on").select("key"), told.filter("NOT on").select("key")
    while n := inside.count():
        depth = len(levels)
        if depth > DEEPEST:
            raise RuntimeError("two keys have the same hashes")
        levels.append(_filter_of(_hashed(inside), n, depth, 0.5))
        wrong = stored(_passing(_hashed(rest), levels[-1], depth).select("key"), "wrong")
        rest, inside = inside, wrong
    return levels


def _candidates(host: Column, path: Column, shapes: dict[int, list[int]]) -> Column:
    """The keys under which a rule can stand that fits: for each length of a rule's host and path, the end
    of the host, if a label begins there, and the beginning of the path."""
    if not shapes:
        return F.array().cast("array<string>")
    kinds = F.array(
        *(F.struct(F.lit(size).alias("size"), F.array(*map(F.lit, sorted(paths))).alias("paths")) for size, paths in sorted(shapes.items()))
    )
    n = F.length(host)

    def fits(kind: Column) -> Column:
        before = F.substr(host, n - kind["size"], F.lit(1))
        return (n == kind["size"]) | ((n > kind["size"]) & (before == "."))

    def keys(kind: Column) -> Column:
        end = F.substr(host, n - kind["size"] + 1, kind["size"])
        return F.transform(
            F.filter(kind["paths"], lambda p: p <= F.length(path)), lambda p: F.concat(end, F.substr(path, F.lit(1), p))
        )

    return F.flatten(F.transform(F.filter(kinds, fits), keys))


def _clean_rules(rules: DataFrame) -> DataFrame:
    """``key``, ``host_size``, ``path_size``, ``block``, of the rules that can fit a URL, each key once."""
    host = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    possible = (
        host.isNotNull()
        & F.col("path").isNotNull()
        & F.col("verdict").isNotNull()
        & ~host.rlike("[/?#]")
        & ~F.col("path").rlike("[?#]")
        & ((F.col("path") == "") | F.col("path").startswith("/"))
    )
    rows = rules.filter(possible).select(
        F.concat(host, F.col("path")).alias("key"),
        F.length(host).alias("host_size"),
        F.length("path").alias("path_size"),
        F.when(F.col("verdict").isin("allow", "block"), F.col("verdict") == "block")
        .otherwise(F.raise_error(F.lit("a rule's verdict is allow or block")))
        .alias("block"),
    )
    return rows.groupBy("key", "host_size", "path_size").agg(F.max("block").alias("block"))


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", keep: list[str] | None = None, block_keys: int = BLOCK_KEYS
) -> DataFrame:
    """The columns in ``keep`` of every row with ``host``, ``path``, ``rule`` and ``verdict`` of its URL.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block), any number of rows. A rule fits its
    host and all subdomains where the URL's path starts with the rule's; the longest rule wins, of equally
    long ones that with the longer host, and of the same rule listed as both, block. ``rule`` is host
    and path of that rule, null where none fits; the URL is then on no list, and allowed.

    Null URLs and those without ``://`` have an empty host and path, which only a rule of an empty host
    fits. Null fields make no rule, and neither do hosts with ``/`` and paths that do not begin with it.
    Repeated rows are judged one by one, URLs of any length whole; no rows or no rules give an
    ordinary result. Columns outside ``keep`` are not read, so their names do not matter; one in
    ``keep`` must not be named as a column of the result.

    The keys a URL can be listed under go through two cascades, of all listed keys and of the blocked
    among them; rows are never joined or shuffled. A list of more than ``block_keys`` keys is taken in
    blocks by hash, a pass over the rows each, so that no task holds more than that.
    """
    keep = ["page_id"] if keep is None else keep
    spark = pages.sparkSession
    rules = stored(_clean_rules(rules), "rules")
    shapes: dict[int, list[int]] = {}
    for r in rules.select("host_size", "path_size").distinct().collect():  # as many as there are pairs of lengths
        shapes.setdefault(r.host_size, []).append(r.path_size)
    blocks = max(1, math.ceil(rules.count() / block_keys))
    parts = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = parts.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit("allow"))
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("key"), F.lit(blocks)) == block
        every = parts.select(F.explode(_candidates(F.col("host"), F.col("path"), shapes)).alias("key")).filter(mine)
        own = rules.filter(mine)
        listed = build_cascade(own, every)
        blocked = build_cascade(own.filter("block"), own)
        rows = _judged(spark, rows, shapes, listed, blocked, block, blocks)
        if block + 1 < blocks:
            rows = stored(rows, "judged")
    return rows


def _judged(spark, rows: DataFrame, shapes: dict, listed: list, blocked: list, block: int, blocks: int) -> DataFrame:
    shared = spark.sparkContext.broadcast((listed, blocked))
    keys = _candidates(F.col("host"), F.col("path"), shapes)
    mine = F.filter(keys, lambda k: F.pmod(F.xxhash64(k), F.lit(blocks)) == block) if blocks > 1 else keys
    asked = F.transform(mine, lambda k: F.struct(k.alias("key"), F.xxhash64(k).alias("a"), F.xxhash64(F.lit("b"), k).alias("b")))
    names, place = rows.columns, len(rows.columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on, bad = shared.value
        for batch in batches:
            lists = batch.column(place)
            own = lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            a, b = (own.field(i).to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64) for i in (1, 2))
            hits = np.flatnonzero(members(on, a, b))
            block_it = members(bad, a[hits], b[hits])
            rule, verdict = (batch.column(i).to_pylist() for i in (place - 2, place - 1))
            # Keys of one row follow each other from the shortest host to the longest.
            for row, name, stop in zip(owner[hits].tolist(), own.field(0).take(pa.array(hits)).to_pylist(), block_it.tolist(), strict=True):
                if rule[row] is None or _order(name) >= _order(rule[row]):
                    rule[row], verdict[row] = name, "block" if stop else "allow"
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: place - 2], pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=names,
            )

    return rows.withColumn("asked", asked).mapInArrow(work, rows.schema)


def _order(key: str) -> tuple[int, int]:
    return len(key), len(key.partition("/")[0])
