"""Resharding by minimum-cost flow.

Old shards have sizes in bytes, new shards have capacities. A byte that stays
in the shard of the same number costs nothing, a byte that moves has a cost,
which may differ by the shard it leaves. The flow of least cost says how many
bytes go from each old shard to each new one. Each old shard is then cut, in
its own order, into one run of documents per destination; the run that stays
comes first. New shards that gain or lose documents are rewritten as files,
the others stay as they are.

Flow: moves go through one node between the old and the new shards, so the
network has about three arcs a shard. It is solved on the driver, from one
number per shard, by the primal-dual method: shortest distances on the
residual network, then a blocking flow on the arcs that lie on shortest paths.
Everything per document runs in Spark: running sums are taken inside blocks of
``BLOCK`` rows and then over block totals, so no task ever holds a shard. The
runs, at most one for each arc that is used, are what the rewriting joins with.

Law: ``bytes``. Capacities differ by a byte at most; a document goes where the
middle of its bytes falls, so a shard is off by about one document per cut.

Defined results: a null text counts 1 byte and the crc32 of nothing (0); rows
with equal keys keep their order by size and checksum; an empty table gives an
empty plan.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm import kit

BLOCK = 4096
#: Bytes of text in one written file.
FILE_BYTES = 128 << 20


def least_cost_flow(nodes: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each arc (tail, head, capacity, cost of at least 0): as much as fits from source to sink, at the least cost."""
    head = [h for t, h, _, _ in arcs for h in (h, t)]  # arc 2i and its reverse 2i + 1
    room = [r for _, _, c, _ in arcs for r in (c, 0)]
    cost = [x for _, _, _, c in arcs for x in (c, -c)]
    leaving: list[list[int]] = [[] for _ in range(nodes)]
    for i, (t, h, _, _) in enumerate(arcs):
        leaving[t].append(2 * i)
        leaving[h].append(2 * i + 1)
    price = [0] * nodes
    while True:
        # Shortest reduced distances from the source.
        far: list[int | None] = [None] * nodes
        queue = [(0, source)]
        while queue:
            d, u = heapq.heappop(queue)
            if far[u] is not None:
                continue
            far[u] = d
            for a in leaving[u]:
                if room[a] and far[head[a]] is None:
                    heapq.heappush(queue, (d + cost[a] + price[u] - price[head[a]], head[a]))
        if far[sink] is None:
            return room[1::2]
        price = [p + (far[sink] if d is None else min(d, far[sink])) for p, d in zip(price, far, strict=True)]
        while _blocking_flow(leaving, head, room, cost, price, source, sink):
            pass


def _blocking_flow(leaving, head, room, cost, price, source: int, sink: int) -> bool:
    """Sends what fits along arcs of reduced cost 0, on paths with the fewest arcs; whether anything went."""
    level = {source: 0}
    wave = [source]
    while wave and sink not in level:
        after = []
        for u in wave:
            for a in leaving[u]:
                v = head[a]
                if room[a] and v not in level and cost[a] + price[u] == price[v]:
                    level[v] = level[u] + 1
                    after.append(v)
        wave = after
    if sink not in level:
        return False
    next_arc = dict.fromkeys(level, 0)
    path: list[int] = []
    while True:
        u = head[path[-1]] if path else source
        if u == sink:
            sent = min(room[a] for a in path)
            for a in path:
                room[a] -= sent
                room[a ^ 1] += sent
            path = path[: next(i for i, a in enumerate(path) if not room[a])]
            continue
        while next_arc[u] < len(leaving[u]):
            a = leaving[u][next_arc[u]]
            if room[a] and level.get(head[a]) == level[u] + 1 and cost[a] + price[u] == price[head[a]]:
                path.append(a)
                break
            next_arc[u] += 1
        else:
            if not path:
                return True
            next_arc[head[path.pop() ^ 1]] += 1


def transfers(sizes: list[int], capacities: list[int], costs: list[int] | None = None) -> dict[tuple[int, int], int]:
    """Units from each old to each new shard: everything placed, capacities kept, at the least cost of moving.

    costs: what moving a unit out of each old shard costs (1 by default).
    """
    if sum(sizes) > sum(capacities):
        raise ValueError("the new shards can't hold everything")
    n, m = len(sizes), len(capacities)
    source, middle, sink = n + m, n + m + 1, n + m + 2
    stays = [(i, n + i, min(sizes[i], capacities[i]), 0) for i in range(min(n, m))]
    leaves = [(i, middle, sizes[i], costs[i] if costs else 1) for i in range(n)]
    comes = [(middle, n + j, capacities[j], 0) for j in range(m)]
    ends = [(source, i, s, 0) for i, s in enumerate(sizes)] + [(n + j, sink, c, 0) for j, c in enumerate(capacities)]
    flow = least_cost_flow(n + m + 3, stays + leaves + comes + ends, source, sink)
    out = {(i, i): f for i, f in enumerate(flow[: len(stays)]) if f}
    # What meets in the middle is dealt in order of the shards.
    coming = [[j, f] for j, f in enumerate(flow[len(stays) + n : len(stays) + n + m]) if f]
    for i, f in enumerate(flow[len(stays) : len(stays) + n]):
        while f:
            j, sent = coming[-1][0], min(f, coming[-1][1])
            out[i, j] = out.get((i, j), 0) + sent
            f -= sent
            coming[-1][1] -= sent
            if not coming[-1][1]:
                coming.pop()
    return out


def min_cost_transfers(sizes: list[int], capacities: list[int], costs: list[int] | None = None) -> list[list[int]]:
    """``transfers`` as a table: one row an old shard, one column a new one."""
    flow = transfers(sizes, capacities, costs)
    return [[flow.get((i, j), 0) for j in range(len(capacities))] for i in range(len(sizes))]


def even_capacities(total: int, shards: int) -> list[int]:
    """Capacities that add up to total and differ by one at most."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def assign(docs: DataFrame, shards: int, *, old: str, position: str, size: str, costs: dict[int, int] | None = None) -> DataFrame:
    """docs with the new shard and the gapless slot in it.

    old: number of a document's present shard; position: its place there (unique, gaps allowed); size: its bytes;
    costs: what moving a byte out of an old shard costs, 1 where not given.
    """
    sizes = {r["old"]: r["n"] for r in docs.groupBy(F.col(old).alias("old")).agg(F.sum(size).alias("n")).collect()}
    numbers = [sizes.get(i, 0) for i in range(max(sizes, default=-1) + 1)]
    flow = transfers(numbers, even_capacities(sum(numbers), shards), [(costs or {}).get(i, 1) for i in range(len(numbers))])
    spark = docs.sparkSession
    cuts, at = [], [0] * len(numbers)
    for i, j in sorted(flow, key=lambda ij: (ij[0], ij[1] != ij[0], ij[1])):
        cuts.append((i, j, at[i]))
        at[i] += flow[i, j]
    own = {c: kit.free_name(docs, c) for c in ("block", "block_at", "at", "cuts", "cut_old", "slot_in", "slot_at", "n")}
    block, block_at, at, found, cut_old, slot_in, slot_at, n = own.values()
    runs = spark.createDataFrame(cuts, f"`{cut_old}` int, shard int, start long").groupBy(cut_old).agg(F.sort_array(F.collect_list(F.struct("start", "shard"))).alias(found))

    rows = docs.withColumn(block, F.floor(F.col(position) / BLOCK))
    blocks = rows.groupBy(old, block).agg(F.sum(size).alias(n))
    blocks = blocks.withColumn(block_at, F.sum(n).over(Window.partitionBy(old).orderBy(block)) - F.col(n)).drop(n)
    inside = Window.partitionBy(old, block).orderBy(position)
    placed = rows.withColumn(at, F.sum(size).over(inside) - F.col(size)).join(blocks, [old, block])
    # One row per old shard; all runs together are no more than the arcs of the flow.
    placed = placed.join(runs, F.col(old) == F.col(cut_old))
    middle = F.col(block_at) + F.col(at) + F.col(size) / 2
    placed = placed.withColumn("shard", F.element_at(F.filter(found, lambda c: c["start"] <= middle), -1)["shard"])

    placed = placed.withColumn(slot_in, F.row_number().over(Window.partitionBy(old, block, "shard").orderBy(position)) - 1)
    counts = placed.groupBy("shard", old, block).agg(F.count("*").alias(n))
    counts = counts.withColumn(slot_at, F.sum(n).over(Window.partitionBy("shard").orderBy(old, block)) - F.col(n)).drop(n)
    out = placed.join(counts, ["shard", old, block]).withColumn("slot", (F.col(slot_at) + F.col(slot_in)).cast("long"))
    return out.select(*docs.columns, "shard", "slot")


def rewrite_affected(docs: DataFrame, path: str, *, old: str, shard: str = "shard") -> list[int]:
    """Writes the shards that gain or lose documents, one folder each; returns their numbers.

    A shard whose documents all stay, and that gets none, is left as it is.
    """
    moved = docs.where(F.col(old) != F.col(shard))
    touched = sorted(r[0] for r in moved.select(F.explode(F.array(F.col(old), F.col(shard)))).distinct().collect())
    docs.where(F.col(shard).isin(touched)).repartition(max(1, len(touched)) * 4, shard, F.rand(7)).write.partitionBy(shard).parquet(path)
    return touched


def reshard_table(spark, path: str, out: str, shards: int, *, text: str = "text") -> tuple[DataFrame, tuple[str, str, str]]:
    """Deals a Parquet table, whose files are the old shards by name, into new shards, and writes those that change to out.

    Returns the table in its new order, read from the written files and the untouched old ones, and the names of
    its columns of old shard, new shard and slot.
    """
    table = spark.read.parquet(path)
    names = tuple(kit.free_name(table, c) for c in ("old_shard", "shard", "slot"))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    file, position = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    narrow = kit.written(table.select(file.alias("file"), position.alias("position"), size.alias("size")), "sizes")
    files = sorted(r["file"] for r in narrow.select("file").distinct().collect())
    numbers = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "file string, old int")
    placed = assign(narrow.join(numbers, "file"), shards, old="old", position="position", size="size")
    # Positions have no gaps, so a run of documents is told by where it starts, there and in its new shard.
    runs = placed.groupBy("file", "old", "shard").agg(F.min("position").alias("start"), F.min("slot").alias("slot"), F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()
    touched = sorted({k for r in runs if r["old"] != r["shard"] for k in (r["old"], r["shard"])} & set(range(shards)))
    plan = spark.createDataFrame([(r["file"], r["old"], r["shard"], r["start"], r["start"] + r["n"], r["slot"] - r["start"]) for r in runs], "of string, old int, new int, first long, after long, shift long")
    own = {c: kit.free_name(table, c) for c in ("file", "row", *plan.columns)}
    plan = plan.select(*[F.col(c).alias(own[c]) for c in plan.columns])
    at = F.col(own["row"])
    rows = table.select(*table.columns, file.alias(own["file"]), position.alias(own["row"]))
    # One row for each run: no more than the arcs of the flow, about one a file and shard.
    found = rows.join(F.broadcast(plan), (F.col(own["file"]) == F.col(own["of"])) & (at >= F.col(own["first"])) & (at < F.col(own["after"])))
    found = found.select(*table.columns, F.col(own["old"]).alias(names[0]), F.col(own["new"]).alias(names[1]), (at + F.col(own["shift"])).alias(names[2]))
    moving = sum(r["bytes"] for r in runs if r["shard"] in touched)
    if not touched:
        return found, names
    parts = max(len(touched), -(-moving // FILE_BYTES))
    changed = found.where(F.col(names[1]).isin(touched))
    changed.repartitionByRange(parts, names[1], names[2]).sortWithinPartitions(names[1], names[2]).write.partitionBy(names[1]).parquet(out)
    back = spark.read.schema(found.schema).parquet(out).select(*found.columns)
    return back.unionByName(found.where(~F.col(names[1]).isin(touched))), names


def plan(spark, path: str, shards: int = 8, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document of a Parquet table, read from the rewritten shards: its size, checksum, new shard and slot."""
    out, (old, shard, slot) = reshard_table(spark, path, f"{kit.scratch(spark)}/shards-{uuid.uuid4().hex}", shards, text=text)
    return out.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col(shard).cast("int").alias("shard"),
        F.col(slot).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col(old).alias("old_shard"),
    )
