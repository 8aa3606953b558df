"""Moving documents to shards of equal bytes by minimum-cost flow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peneira.llm.common import partitions
from peneira.workspace import new_folder

BLOCKS = 4096  # of an old shard, by hash; a transfer moves whole blocks and cuts one
FINE = 4096  # places at which a block can be cut
SLICES = 16  # files of a shard at least, a power of two; each holds whole blocks
FILE_BYTES = 128 << 20  # of text in a file, as long as a block has no more
LARGE = 512  # a group of equal texts beyond this part of a shard is placed by itself


def cheapest_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Units sent from each source to each target at the least total cost; the sums must be equal.

    Successive shortest paths: again and again, as much as possible goes along the cheapest path from a
    source with something left to a target with room, where a path may take back what
    an earlier one sent.
    """
    if sum(supply) != sum(capacity):
        raise ValueError("supply and capacity differ")
    flow: dict[tuple[int, int], int] = {}
    left, room = list(supply), list(capacity)
    n, m = len(supply), len(capacity)
    while any(left):
        far = float("inf")
        near = [0 if x else far for x in left]  # cost to reach each source, then each target
        to, from_target, from_source = [far] * m, [-1] * n, [-1] * m
        for _ in range(n + m):
            changed = False
            for i in range(n):
                for j in range(m):
                    if near[i] + cost(i, j) < to[j]:
                        to[j], from_source[j], changed = near[i] + cost(i, j), i, True
            for (i, j), sent in flow.items():
                if sent and to[j] - cost(i, j) < near[i]:
                    near[i], from_target[i], changed = to[j] - cost(i, j), j, True
            if not changed:
                break
        end = min((j for j in range(m) if room[j]), key=lambda j: (to[j], j))
        steps, j, amount = [], end, room[end]
        while True:
            i = from_source[j]
            steps.append((i, j, 1))
            if from_target[i] < 0:
                break
            j = from_target[i]
            steps.append((i, j, -1))
            amount = min(amount, flow[i, j])
        amount = min(amount, left[i])
        left[i] -= amount
        room[end] -= amount
        for i, j, sign in steps:
            flow[i, j] = flow.get((i, j), 0) + sign * amount
    return {edge: sent for edge, sent in sorted(flow.items()) if sent}


@dataclass(frozen=True)
class Flow:
    """``transfers``: bytes from each old shard to each new one; ``bytes``: what each new shard shall hold;
    ``large``: the new shard of large groups of equal texts, or null for one that has to be cut; ``rest``:
    what each transfer has left for all others."""

    transfers: dict[tuple[int, int], int]
    bytes: list[int]
    large: DataFrame
    rest: dict[tuple[int, int], int]

    @property
    def affected(self) -> list[int]:
        """New shards that receive bytes from another shard or give some away."""
        moved = [(i, j) for i, j in self.transfers if i != j]
        return sorted({j for _, j in moved} | {i for i, _ in moved if i < len(self.bytes)})

    def located(self, rows: DataFrame) -> DataFrame:
        """The rows with their ``block`` and ``fine`` place, by hash of the text, in groups to be cut by hash of the id too.

        ``whole`` is the new shard of a large group that stays together, ``salt`` one of the writers it needs.
        """
        marked = rows.join(F.broadcast(self.large), ["old", "group"], "left")
        own = F.xxhash64("doc_id", "group")
        place = F.when(F.col("n").isNotNull() & F.col("whole").isNull(), own).otherwise(F.col("group"))
        writers = F.when(F.col("whole").isNotNull(), F.ceil(F.col("n") / FILE_BYTES)).otherwise(1)
        return marked.withColumns(
            {
                "block": F.pmod(place, F.lit(BLOCKS)).cast("int"),
                "fine": F.pmod(F.shiftrightunsigned(place, 24), F.lit(FINE)).cast("int"),
                "salt": F.pmod(own, writers).cast("int"),
            }
        ).drop("n")


@dataclass(frozen=True)
class Plan:
    """A flow, and ``places``: the new shard of every part (``low`` to ``high`` of ``fine``) of every block.

    ``targets``: the new shards that each block's rows go to.
    """

    flow: Flow
    places: DataFrame
    targets: dict[tuple[int, int], set[int]]

    @property
    def transfers(self) -> dict[tuple[int, int], int]:
        return self.flow.transfers

    @property
    def bytes(self) -> list[int]:
        return self.flow.bytes

    @property
    def affected(self) -> list[int]:
        return self.flow.affected

    def assign(self, rows: DataFrame) -> DataFrame:
        """The rows with their new ``shard``; the tables of places have a bounded number of rows per shard."""
        r = rows if "block" in rows.columns else self.flow.located(rows)
        p = self.places.toDF("p_old", "p_block", "low", "high", "p_shard")
        inside = (F.col("old") == F.col("p_old")) & (F.col("block") == F.col("p_block"))
        inside &= (F.col("fine") >= F.col("low")) & (F.col("fine") < F.col("high"))
        shard = F.coalesce("whole", "p_shard").alias("shard")
        return r.join(F.broadcast(p), inside, "left").select(*(c for c in r.columns if c != "whole"), shard)


def sized(docs: DataFrame, doc_id: str, text: str, old: Column) -> DataFrame:
    """Every row with its size (UTF-8 bytes and 8), its text's crc32, its old shard, and its ``group``: a hash of the text."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.coalesce(old, F.lit(0)).cast("int").alias("old"),
        F.xxhash64(raw).alias("group"),
    )


def flow_to_equal_bytes(rows: DataFrame, shards: int) -> Flow:
    """Transfers that make ``shards`` shards of equal bytes and move the fewest, and the places of large groups.

    Sizes are added up in the cluster; the flow is solved on a table of shards x shards numbers. Groups of
    equal texts of one old shard that hold more than 1 / ``LARGE`` of a shard, at most ``LARGE`` x
    shards, are dealt with by size: each goes to its old shard or else to the transfer with most room left. One
    that fits nowhere, as one larger than a shard, is cut like other rows.
    """
    totals = {r.old: r.n for r in rows.groupBy("old").agg(F.sum("size").alias("n")).collect()}
    supply = [totals.get(i, 0) for i in range(max([shards, *(i + 1 for i in totals)]))]
    total = sum(supply)
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    transfers = cheapest_flow(supply, capacity, lambda i, j: int(i != j))
    groups = rows.groupBy("old", "group").agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
    large = groups.filter((F.col("rows") > 1) & (F.col("n") * (LARGE * shards) > total))
    rest, placed = dict(transfers), []
    for r in sorted(large.collect(), key=lambda r: (-r.n, r.old, r.group)):
        own = [j for i, j in rest if i == r.old and rest[i, j] >= r.n]
        best = max(own, key=lambda j: (j == r.old, rest[r.old, j], -j), default=None)
        if best is not None:
            rest[r.old, best] -= r.n
        placed.append((r.old, r.group, r.n, best))
    schema = "old int, group long, n long, whole int"
    return Flow(transfers, capacity, rows.sparkSession.createDataFrame(placed, schema), rest)


def place_blocks(flow: Flow, located: DataFrame) -> Plan:
    """Where each block goes: an old shard's blocks, in order, fill what large groups leave of its transfers, in order.

    The blocks that two or more transfers share, fewer than there are transfers, are cut by a second hash.
    """
    spark = located.sparkSession
    blocks = located.groupBy("old", "block", "whole").agg(F.sum("size").alias("n")).orderBy("old", "block").collect()
    targets: dict[tuple[int, int], set[int]] = {}
    for r in blocks:
        targets.setdefault((r.old, r.block), set()).update([] if r.whole is None else [r.whole])
    blocks = [r for r in blocks if r.whole is None]

    ends: dict[int, list[tuple[int, int]]] = {}  # of each old shard: where each transfer ends in its bytes, and its target
    for (i, j), sent in flow.rest.items():
        own = ends.setdefault(i, [])
        own.append(((own[-1][0] if own else 0) + sent, j))
    places: list[tuple[int, int, int, int, int]] = []
    shared: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    reach: dict[int, int] = {}
    for r in blocks:
        low = reach.get(r.old, 0)
        reach[r.old] = low + r.n
        own = [(e, j) for e, j in ends[r.old] if e > low]
        if own[0][0] >= low + r.n:
            places.append((r.old, r.block, 0, FINE, own[0][1]))
        else:
            shared[r.old, r.block] = (low, own)
    if shared:
        names = F.broadcast(spark.createDataFrame(list(shared), "old int, block int"))
        loose = located.filter("whole is null").join(names, ["old", "block"], "left_semi")
        fine = loose.groupBy("old", "block", "fine").agg(F.sum("size").alias("n"))
        sizes: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r in fine.orderBy("old", "block", "fine").collect():  # at most FINE for each shared block
            sizes.setdefault((r.old, r.block), []).append((r.fine, r.n))
        for (i, block), (at, own) in shared.items():
            k = start = 0
            for place, n in sizes[i, block]:
                now = k
                while now + 1 < len(own) and at + n / 2 > own[now][0]:
                    now += 1
                if now != k:
                    if place > start:
                        places.append((i, block, start, place, own[k][1]))
                    k, start = now, place
                at += n
            places.append((i, block, start, FINE, own[k][1]))
    for i, block, _, _, j in places:
        targets[i, block].add(j)
    return Plan(flow, spark.createDataFrame(places, "old int, block int, low int, high int, shard int"), targets)


def plan_equal_bytes(rows: DataFrame, shards: int) -> Plan:
    """Flow and places for ``rows`` as ``sized`` gives them; old shards beyond the new number are emptied."""
    flow = flow_to_equal_bytes(rows, shards)
    return place_blocks(flow, flow.located(rows))


def slices_of(shard_bytes: int) -> int:
    """Files that a shard of so many bytes is cut into: a power of two, so that each holds whole blocks."""
    slices = SLICES
    while slices < BLOCKS and slices * FILE_BYTES < shard_bytes:
        slices *= 2
    return slices


def write_files(rows: DataFrame, path: str, shard: str) -> None:
    """Writes located rows below ``path``, a folder for each shard and slice of its blocks.

    A slice is written by one task, and by more where a large group needs them. Rows are sorted by
    block, place and id.
    """
    keys = (shard, "slice", "salt")
    (
        rows.repartition(partitions(rows.sparkSession), *keys)
        .sortWithinPartitions(*keys, "block", "fine", "doc_id", "text_crc32")
        .write.partitionBy(shard, "slice")
        .parquet(path)
    )


@dataclass(frozen=True)
class Layout:
    """Shards as files: ``kept`` are the old files (``old``, ``slice``) below ``old_path`` that now belong to ``shard``,
    unread and unchanged; the rows of the others, ``cut``, were written anew below ``new_path``."""

    old_path: str
    new_path: str
    schema: str
    kept: list[tuple[int, int, int]]
    cut: list[tuple[int, int]]

    def read(self, spark, columns: list[str | Column]) -> DataFrame:
        """``columns`` of all rows, their ``shard``, and ``slot``: the place in it, file after file."""
        place = (F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        kept = F.broadcast(spark.createDataFrame(self.kept, "old int, slice int, shard int"))
        old = spark.read.schema(f"{self.schema}, old int, slice int").parquet(self.old_path)

        def placed(*wanted) -> DataFrame:
            files = old.select("*", *place).join(kept, ["old", "slice"]).select(*wanted, "shard", "file", "row")
            if not self.cut:
                return files
            new = spark.read.schema(f"{self.schema}, old int, shard int, slice int").parquet(self.new_path)
            return files.unionByName(new.select("*", *place).select(*wanted, "shard", "file", "row"))

        counts = placed().groupBy("shard", "file").agg(F.count("*").alias("n"))
        earlier = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("shard", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
        found = placed(*columns)
        slot = (F.col("first") + F.col("row")).alias("slot")
        return found.join(starts, ["shard", "file"]).select(*(c for c in found.columns if c not in ("file", "row")), slot)


def reshard_files(docs: DataFrame, old: Column, shards: int, doc_id: str = "doc_id", text: str = "text") -> Layout:
    """Writes the rows as files of their old shards, then moves them to shards of near equal bytes.

    A file whose rows all go to one new shard is handed over as it is; only files that a
    transfer cuts, fewer than there are transfers and large groups, are read and written anew.
    """
    spark = docs.sparkSession
    rows = sized(docs, doc_id, text, old)
    flow = flow_to_equal_bytes(rows, shards)
    slices = slices_of(max(flow.bytes))
    old_path, new_path = new_folder(spark, "old-shards"), new_folder(spark, "new-shards")
    slice_ = F.floor(F.col("block") * slices / BLOCKS).cast("int")
    located = flow.located(rows).withColumn("slice", slice_)
    write_files(located, old_path, "old")
    kind = rows.schema["doc_id"].dataType.simpleString()
    stored = f"doc_id {kind}, text string, size bigint, text_crc32 bigint, group bigint, whole int, block int, fine int, salt int"
    files = spark.read.schema(f"{stored}, old int, slice int").parquet(old_path)
    plan = place_blocks(flow, files)
    targets: dict[tuple[int, int], set[int]] = {}
    for (i, block), own in plan.targets.items():
        targets.setdefault((i, block * slices // BLOCKS), set()).update(own)
    kept = [(i, part, min(own)) for (i, part), own in sorted(targets.items()) if len(own) == 1]
    cut = [key for key, own in sorted(targets.items()) if len(own) > 1]
    if cut:
        names = F.broadcast(spark.createDataFrame(cut, "old int, slice int"))
        moved = plan.assign(files.join(names, ["old", "slice"], "left_semi"))
        write_files(moved, new_path, "shard")
    return Layout(old_path, new_path, f"doc_id {kind}, text string, size bigint, text_crc32 bigint", kept, cut)


def reshard(
    docs: DataFrame,
    old: Column,
    shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    columns: tuple[str | Column, ...] = ("doc_id", "text", "old"),
) -> DataFrame:
    """All rows in shards of near equal bytes: ``columns`` of the files after the move, ``shard`` and ``slot``.

    ``old`` is the shard a row is in now (null: 0). Sizes differ from equal by about a document or a small group
    for each transfer. Equal texts of one old shard stay together, unless the transfers out of it have
    no room for them whole, as for those of more bytes than a shard; those are dealt out by id. Fully
    repeated rows always stay together. Null and empty texts count 8 bytes and are equal; one text is never
    cut, however long. Null ids are like others. Other columns of ``docs`` are not written, whatever
    their names. An empty table gives an empty result. ``reshard_files`` tells which files moved.
    """
    return reshard_files(docs, old, shards, doc_id, text).read(docs.sparkSession, list(columns))
