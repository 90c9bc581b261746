"""Graph operators that iterate over DataFrames, for graphs of any size."""

from __future__ import annotations

import functools
import heapq
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: Directed edges of a graph that every task may hold, 16 bytes each.
SHARED_EDGES = 16_000_000
#: A graph of so many times as many is dealt packed, 5 bytes an edge while steps have at most 256 values; beyond that, rounds over DataFrames.
PACKED = 16
#: Edges a node from which steps are taken for all its neighbours at once.
DENSE = 16
#: Pairs of a source and a node that one block of such rounds takes on.
BLOCK_PAIRS = 200_000_000
#: Paths whose lengths differ by less are equally long.
ALIKE = 1e-12


def new_folder(spark: SparkSession, label: str) -> str:
    """A new name in the folder that all executors share. The file system removes it when the JVM ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="strandspark-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def _saved(df: DataFrame) -> DataFrame:
    """df written to the shared folder, so that rounds don't stack up in the plan."""
    path = new_folder(df.sparkSession, "graph")
    df.write.parquet(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    saved._folder = path
    return saved


def _forget(*frames: DataFrame) -> None:
    """Removes what _saved wrote, once nothing reads it any more."""
    for df in frames:
        jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._folder)
        jvm_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm_path, True)


def _both_ways(edges: DataFrame, *others: str) -> DataFrame:
    turned = edges.select(F.col("b").alias("u"), F.col("a").alias("v"), *others)
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v"), *others).unionByName(turned)


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component, the least node that edges reach. Each round every node takes the least component
    among its neighbours', then that component's own (pointer jumping), so long chains shrink fast."""
    both = _saved(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct())
    state = _saved(both.groupBy("u").agg(F.least(F.min("u"), F.min("v")).alias("c")))
    while True:
        offered = both.join(state.select(F.col("u").alias("v"), "c"), "v").groupBy("u").agg(F.min("c").alias("o"))
        lower = state.join(offered, "u").select("u", F.least("c", "o").alias("n"), "c")
        jumped = lower.join(state.select(F.col("u").alias("n"), F.col("c").alias("j")), "n", "left").select("u", F.least("n", F.coalesce("j", "n")).alias("c"), (F.least("n", F.coalesce("j", "n")) != F.col("c")).alias("moved"))
        jumped = _saved(jumped)
        if jumped.where("moved").isEmpty():
            return jumped.select(F.col("u").alias("node"), F.col("c").alias("component"))
        state = jumped.drop("moved")


def page_rank(edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-6, rounds: int = 100, at_once: int = 5) -> DataFrame:
    """node and rank of an undirected weighted graph (a, b, score); ranks sum to 1. Rounds end when ranks move by less
    than tolerance a node on average, or at their number. at_once of them are one job, which also measures the last move."""
    both = _both_ways(edges, "score")
    weight = both.groupBy("u").agg(F.sum("score").alias("total"))
    flow = _saved(both.join(weight, "u").where("total > 0").select("u", "v", (F.col("score") / F.col("total")).alias("share")))
    nodes = _saved(weight.select(F.col("u").alias("node"), (~(F.col("total") > 0)).alias("dead")))
    n, dead = nodes.agg(F.count("*"), F.count_if("dead")).first()
    rank, done = _saved(nodes.select("node", "dead", F.lit(1.0 / max(n, 1)).alias("rank"))), 0
    while done < rounds:
        now, before = rank, None
        steps = 1 if dead else min(at_once, rounds - done)
        for _ in range(steps):
            # What nodes without weight hold is spread evenly.
            lost = (rank.where("dead").agg(F.sum("rank")).first()[0] or 0.0) if dead else 0.0
            sent = flow.join(now.select(F.col("node").alias("u"), "rank"), "u").groupBy(F.col("v").alias("node")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
            moved = now.select("node", "dead", F.col("rank").alias("old")).join(sent, "node", "left")
            before = moved.select("node", "dead", "old", (F.lit((1 - damping) / max(n, 1)) + damping * (F.coalesce("got", F.lit(0.0)) + lost / max(n, 1))).alias("rank"))
            now = before.drop("old")
        seen = Observation()
        fresh = _saved(before.observe(seen, F.sum(F.abs(F.col("rank") - F.col("old"))).alias("change")).select("node", "dead", "rank"))
        _forget(rank)
        rank, done = fresh, done + steps
        if (seen.get["change"] or 0.0) < tolerance * n:
            break
    return rank.select("node", "rank")


def distances(edges: DataFrame, seeds: DataFrame, shared_edges: int = SHARED_EDGES) -> DataFrame:
    """seed, node, hops and distance: the fewest edges, and the least sum of edge distances, from each seed (column
    node) to each node it reaches over undirected edges (a, b, distance). A seed without edges reaches itself alone.
    Up to PACKED * shared_edges directed edges, tasks take a block of seeds each and no state is shuffled or kept. Beyond that there are
    rounds: each carries on only what became nearer in the last one, so they end with the longest best path."""
    both = _saved(_both_ways(edges, "distance").groupBy("u", "v").agg(F.min("distance").alias("step")))
    start = seeds.where("node IS NOT NULL").select(F.col("node").alias("seed"), "node").distinct()
    m = both.count()
    if m <= PACKED * shared_edges:
        kind = seeds.schema["node"].dataType.simpleString()
        return _by_source(both, start.select("node"), _distance_rows, f"seed {kind}, node {kind}, hops long, distance double", m if m > shared_edges else 0)
    state = _saved(start.select("seed", "node", F.lit(0).cast("long").alias("hops"), F.lit(0.0).alias("distance"), F.lit(True).alias("moved")))
    while not state.where("moved").isEmpty():
        offered = state.where("moved").join(both, F.col("node") == F.col("u")).select("seed", F.col("v").alias("node"), (F.col("hops") + 1).alias("hops"), (F.col("distance") + F.col("step")).alias("distance"), F.lit(False).alias("old"))
        known = state.select("seed", "node", "hops", "distance", F.lit(True).alias("old"))
        nearest = known.unionByName(offered).groupBy("seed", "node").agg(F.min("hops").alias("hops"), F.min("distance").alias("distance"), F.min(F.when(F.col("old"), F.col("hops"))).alias("h"), F.min(F.when(F.col("old"), F.col("distance"))).alias("d"))
        nearer = F.col("h").isNull() | (F.col("hops") < F.col("h")) | (F.col("distance") < F.col("d"))
        last, state = state, _saved(nearest.select("seed", "node", "hops", "distance", nearer.alias("moved")))
        _forget(last)
    return state.drop("moved")


def hops(edges: DataFrame, seeds: DataFrame, with_path: bool = False, shared_edges: int = SHARED_EDGES, joined: str | None = None) -> DataFrame:
    """seed, node and hops, the fewest edges from each seed (column node) to each node that it reaches over undirected
    edges (a, b); with_path adds path, the nodes on the way: of equally short ones that with the least node before the
    last, and so on backwards. joined makes it a text, with joined between nodes. Up to PACKED * shared_edges directed edges, tasks take a block of seeds each; beyond that there are
    rounds, each going on from what was first reached in the last one alone."""
    both = _saved(_both_ways(edges).distinct())
    m = both.count()
    if m <= PACKED * shared_edges:
        kind = seeds.schema["node"].dataType.simpleString()
        every = seeds.where("node IS NOT NULL").select("node").distinct()
        path = "" if not with_path else f", path array<{kind}>" if joined is None else ", path string"
        rows = _hop_rows if not with_path else _path_rows if joined is None else functools.partial(_text_rows, joined)
        return _by_source(both, every, rows, f"seed {kind}, node {kind}, hops long{path}", m if m > shared_edges else 0)
    start = seeds.where("node IS NOT NULL").select(F.col("node").alias("seed"), "node").distinct().withColumn("hops", F.lit(0).cast("long"))
    front = _saved(start.withColumn("path", F.array("node")) if with_path else start)
    rounds = [front]
    while not front.isEmpty():
        offered = front.join(both, F.col("node") == F.col("u"))
        path = [F.min_by(F.concat("path", F.array("v")), "u").alias("path")] if with_path else []
        reached = offered.groupBy("seed", F.col("v").alias("node")).agg((F.min("hops") + 1).alias("hops"), *path)
        # A node beside the front was reached in this round's two predecessors, or is new.
        for known in rounds[-2:]:
            reached = reached.join(known.select("seed", "node"), ["seed", "node"], "left_anti")
        front = _saved(reached)
        rounds.append(front)
    out = rounds[0]
    for x in rounds[1:]:
        out = out.unionByName(x)
    return out.withColumn("path", F.array_join("path", joined)) if with_path and joined is not None else out


def closeness(edges: DataFrame, shared_edges: int = SHARED_EDGES) -> DataFrame:
    """node and closeness by hops: nodes it reaches over the sum of hops to them, times the share of all other nodes that
    it reaches (so that small components count little)."""
    both = _saved(_both_ways(edges).distinct())
    nodes = _saved(both.select(F.col("u").alias("node")).distinct())
    n, m = F.lit(nodes.count()), both.count()
    if m <= PACKED * shared_edges:
        far = _by_source(both, nodes, _reached_row, f"node {nodes.schema['node'].dataType.simpleString()}, r long, far long", m if m > shared_edges else 0)
    else:
        far = hops(edges, nodes, shared_edges=shared_edges).groupBy(F.col("seed").alias("node")).agg((F.count("*") - 1).alias("r"), F.sum("hops").alias("far"))
    return far.select("node", F.when((F.col("far") > 0) & (n > 1), F.col("r") * F.col("r") / (F.col("far") * (n - 1))).otherwise(0.0).alias("closeness"))


def betweenness(edges: DataFrame, shared_edges: int = SHARED_EDGES, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """node and betweenness, the share of shortest paths by distance (a, b, distance; distances above ALIKE) between
    other nodes that lead through it, over all such pairs.

    A graph of at most PACKED * shared_edges directed edges is dealt to all tasks with a block of sources each, and
    each adds up what its sources give. A larger one is taken in rounds over DataFrames, a block of
    sources at a time, which hold no graph anywhere: paths are counted along the edges that lie on shortest ones, and what
    lies behind a node is gathered back along the same edges."""
    both = _saved(_both_ways(edges, "distance").where("u <> v").groupBy("u", "v").agg(F.min("distance").alias("step")))
    nodes = _saved(both.select(F.col("u").alias("node")).distinct())
    n, m = nodes.count(), both.count()
    by_source = lambda: _by_source(both, nodes, None, f"node {nodes.schema['node'].dataType.simpleString()}, through double", m if m > shared_edges else 0)
    through = by_source() if m <= PACKED * shared_edges else _through_rounds(both, nodes, n, block_pairs)
    total = through.groupBy("node").agg(F.sum("through").alias("through"))
    pairs = float((n - 1) * (n - 2)) if n > 2 else 1.0
    return nodes.join(total, "node", "left").select("node", (F.coalesce("through", F.lit(0.0)) / pairs).alias("betweenness"))


def _by_source(both: DataFrame, sources: DataFrame, rows, schema: str, packed: int = 0) -> DataFrame:
    """What rows(graph, source) gives for each of sources (node) over both (u, v, and step where there is one); without
    rows, node and through (see betweenness), summed in each task. A task is dealt a block of sources, and the graph beside
    them, by one shuffle; it hands on each source's rows before it goes to the next. A graph of packed edges, where that is
    not 0, is dealt a row a node, and read a batch at a time into arrays of its final size."""
    blocks = max(both.sparkSession.sparkContext.defaultParallelism, 1)
    if packed:
        graph_rows = _packed(both)
    else:
        step = F.col("step") if "step" in both.columns else F.lit(1.0)
        graph_rows = both.select("u", "v", step.alias("step"))
    fields = graph_rows.columns
    edges = graph_rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = edges.unionByName(sources.select(F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("_block"), F.col("node").alias("u")), allowMissingColumns=True)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        if packed:
            wanted, graph = _unpacked(batches, packed)
            if not len(wanted):
                return
        else:
            table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
            if table is None:
                return
            of_graph = pa.compute.is_valid(table["v"])
            wanted, graph = table["u"].filter(pa.compute.invert(of_graph)), _graph(table.filter(of_graph))
            del table, batches
        total = None if rows else np.zeros(len(graph[1]) - 1)
        at = pa.compute.index_in(wanted, graph[0])
        for name, source in zip(wanted, at.to_pylist(), strict=True):
            if rows:
                for columns in rows(graph, name, source):
                    yield pa.RecordBatch.from_arrays(columns, names)
            elif len(graph[2]) < DENSE * len(total):
                _from_source(source, graph[1], graph[2], graph[3], total)
            else:
                _from_dense(graph, source, total)
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([graph[0].take(pa.array(some)), pa.array(total[some])], names)

    return dealt.repartitionById(blocks, "_block").select(*fields).mapInArrow(run, schema)


def _packed(both: DataFrame) -> DataFrame:
    """A row a node of both: u, its number i along the order, first (edges of all nodes before it), its neighbours' numbers near in
    order, and their steps where there are any."""
    sizes = _saved(both.groupBy("u").agg(F.count("*").alias("size")).orderBy("u").withColumn("part", F.spark_partition_id()))
    parts = sizes.groupBy("part").agg(F.count("*").alias("nodes"), F.sum("size").alias("edges"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    starts = parts.select("part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("nodes", "edges")))
    within = Window.partitionBy("part").orderBy("u")
    i, first = F.row_number().over(within) - 1 + F.col("nodes"), F.sum("size").over(within) - F.col("size") + F.col("edges")
    numbered = _saved(sizes.join(F.broadcast(starts), "part").select("u", i.cast("int").alias("i"), first.alias("first")))
    near = both.join(numbered.select(F.col("u").alias("v"), "i").hint("merge"), "v")
    edge = F.struct(F.col("i").alias("near"), *(c for c in both.columns if c == "step"))
    listed = near.groupBy("u").agg(F.array_sort(F.collect_list(edge)).alias("edges")).join(numbered.hint("merge"), "u")
    return _saved(listed.select("u", "i", "first", "edges.near", *(F.col(f"edges.{c}") for c in both.columns if c == "step")))


class _Steps:
    """Steps by number of their edge, a byte each while there are at most 256 values."""

    def __init__(self, n: int):
        self.codes, self.values = np.zeros(n, np.uint8), np.empty(0)

    def put(self, at: np.ndarray, steps: pa.Array) -> None:
        if self.values is None:
            self.codes[at] = steps.to_numpy(zero_copy_only=False)
            return
        coded = steps.dictionary_encode()
        fresh = coded.dictionary.to_numpy(zero_copy_only=False)
        self.values = np.append(self.values, fresh[~np.isin(fresh, self.values)])
        if len(self.values) > 256:
            self.codes, self.values = self.values[self.codes], None
            self.put(at, steps)
            return
        order = np.argsort(self.values)
        self.codes[at] = order[np.searchsorted(self.values[order], fresh)][coded.indices.to_numpy()]

    def __getitem__(self, at):
        return self.codes[at] if self.values is None else self.values[self.codes[at]]

    def min(self) -> float:
        return self.codes.min() if self.values is None else self.values.min()


def _unpacked(batches, edges: int) -> tuple:
    """Names of the sources among batches of _packed and of names alone, and the graph (see _graph)."""
    wanted, named, numbers, firsts = [], [], [], []
    near, steps = np.empty(edges, np.int32), None
    for batch in batches:
        of_graph = pa.compute.is_valid(batch["i"])
        wanted.append(batch["u"].filter(pa.compute.invert(of_graph)))
        batch = batch.filter(of_graph)
        lists, first = batch["near"], batch["first"].to_numpy()
        size = np.diff(lists.offsets.to_numpy())
        at = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        near[at] = lists.flatten().to_numpy()
        if "step" in batch.schema.names:
            steps = steps or _Steps(edges)
            steps.put(at, batch["step"].flatten())
        named.append(batch["u"])
        numbers.append(batch["i"].to_numpy())
        firsts.append(first)
    order = np.argsort(np.concatenate(numbers)) if numbers else np.empty(0, np.int64)
    first = np.append(np.concatenate(firsts)[order], edges) if numbers else np.zeros(1, np.int64)
    names = pa.chunked_array(named).combine_chunks().take(pa.array(order)) if numbers else None
    return pa.chunked_array(wanted).combine_chunks() if wanted else [], (names, first, near, steps, None)


def _graph(edges: pa.Table) -> tuple:
    """Names in order, where the edges of each begin, their other ends in order, their steps and their own ends."""
    names = pa.compute.unique(edges["u"])
    names = names.take(pa.compute.sort_indices(names))
    u, v = (pa.compute.index_in(edges[c], names).to_numpy().astype(np.int32) for c in ("u", "v"))
    order = np.lexsort((v, u))
    u, v, step = u[order], v[order], edges["step"].to_numpy()[order]
    return names, np.searchsorted(u, np.arange(len(names) + 1)), v, step, u


def _edges_of(first: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all edges of nodes, and where those of each begin among them."""
    size = first[nodes + 1] - first[nodes]
    starts = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(first[nodes] - starts, size), starts


def _levels(graph: tuple, source: int):
    """Node numbers first reached with 0, 1, ... edges from source, and of each the least node before it."""
    _, first, near, _, _ = graph
    new = np.ones(len(first) - 1, bool)
    new[source] = False
    front, left, degree = np.array([source]), len(new) - 1, np.diff(first)
    yield front, front
    while len(front) and left:
        before = np.full(len(new), -1, np.int32)
        if degree[front].mean() >= 8 * DENSE:
            for u in front:  # in order, so the least comes first
                v = near[first[u] : first[u + 1]]
                v = v[new[v]]
                before[v], new[v], left = u, False, left - len(v)
                if not left:
                    break
        else:
            e, _ = _edges_of(first, front)
            v, u = near[e][::-1], np.repeat(front, degree[front])[::-1]
            met = new[v]
            before[v[met]] = u[met]  # of several the last written stays, which is the least
        front = np.flatnonzero(before >= 0)
        left -= int(new[front].sum())
        new[front] = False
        yield front, before[front]


def _nearest(graph: tuple, source: int) -> np.ndarray:
    """Least sums of steps from source, infinite where it doesn't reach."""
    _, first, near, step, _ = graph
    degree, least = np.diff(first), step.min()
    far, front = np.full(len(degree), np.inf), np.array([source])
    far[source] = 0.0

    def from_neighbours(late: np.ndarray) -> np.ndarray:
        e, starts = _edges_of(first, late)  # edges go both ways
        return np.minimum(far[late], np.minimum.reduceat(far[near[e]] + step[e], starts))

    while len(front):
        late = np.flatnonzero(far > far[front].min() + least)
        if not len(late):
            break
        fresh = far.copy()
        hubs = degree[front].mean() >= 8 * DENSE
        if not hubs and degree[late].sum() < degree[front].sum():
            fresh[late] = from_neighbours(late)
        elif degree[front].mean() >= DENSE:
            front = front[np.argsort(far[front], kind="stable")]
            left, looked = degree[front].sum(), len(far)
            for u in front:
                if looked >= len(far):  # what the rest of the front could still bring nearer may be little by now
                    late, looked = np.flatnonzero(fresh > far[u] + least), 0
                    if not len(late):
                        break
                    if degree[late].sum() < (min(left, 2 * len(far)) if hubs else left):
                        fresh[late] = np.minimum(fresh[late], from_neighbours(late))
                        break
                mine = slice(first[u], first[u + 1])
                fresh[near[mine]] = np.minimum(fresh[near[mine]], far[u] + step[mine])
                left, looked = left - degree[u], looked + degree[u]
        else:
            e, _ = _edges_of(first, front)
            np.minimum.at(fresh, near[e], np.repeat(far[front], degree[front]) + step[e])
        front, far = np.flatnonzero(fresh < far), fresh
    return far


def _hops(graph: tuple, source: int) -> np.ndarray:
    hops = np.full(len(graph[1]) - 1, -1, np.int64)
    for k, (front, _) in enumerate(_levels(graph, source)):
        hops[front] = k
    return hops


def _alike(value: pa.Scalar, n: int) -> pa.Array:
    return pa.repeat(value, n)


def _distance_rows(graph: tuple, name: pa.Scalar, source: int | None):
    if source is None:
        yield [_alike(name, 1), _alike(name, 1), pa.array([0], pa.int64()), pa.array([0.0])]
        return
    hops, far = _hops(graph, source), _nearest(graph, source)
    found = np.flatnonzero(hops >= 0)
    yield [_alike(name, len(found)), graph[0].take(pa.array(found)), pa.array(hops[found]), pa.array(far[found])]


def _hop_rows(graph: tuple, name: pa.Scalar, source: int | None):
    for columns in _distance_rows(graph, name, source) if source is None else ():
        yield columns[:3]
    for k, (front, _) in enumerate(_levels(graph, source) if source is not None else ()):
        yield [_alike(name, len(front)), graph[0].take(pa.array(front)), pa.array(np.full(len(front), k))]


def _path_rows(graph: tuple, name: pa.Scalar, source: int | None):
    if source is None:
        yield [_alike(name, 1), _alike(name, 1), pa.array([0], pa.int64()), pa.ListArray.from_arrays(pa.array([0, 1], pa.int32()), _alike(name, 1))]
        return
    ways, last = None, None
    for k, (front, before) in enumerate(_levels(graph, source)):
        ways = front[:, None] if ways is None else np.column_stack([ways[np.searchsorted(last, before)], front])
        last = front
        path = pa.ListArray.from_arrays(pa.array(np.arange(len(front) + 1) * (k + 1), pa.int32()), graph[0].take(pa.array(ways.ravel())))
        yield [_alike(name, len(front)), graph[0].take(pa.array(front)), pa.array(np.full(len(front), k)), path]


def _text_rows(joined: str, graph: tuple, name: pa.Scalar, source: int | None):
    """As _path_rows, with the names on the way as text."""
    ways, last = _alike(name, 1).cast(pa.string()), None
    if source is None:
        yield [_alike(name, 1), _alike(name, 1), pa.array([0], pa.int64()), ways]
        return
    for k, (front, before) in enumerate(_levels(graph, source)):
        nodes = graph[0].take(pa.array(front))
        if k:
            ways = pa.compute.binary_join_element_wise(ways.take(pa.array(np.searchsorted(last, before))), nodes.cast(pa.string()), joined)
        last = front
        yield [_alike(name, len(front)), nodes, pa.array(np.full(len(front), k)), ways]


def _reached_row(graph: tuple, name: pa.Scalar, source: int):
    far = [(k * len(front), len(front)) for k, (front, _) in enumerate(_levels(graph, source))]
    yield [_alike(name, 1), pa.array([sum(n for _, n in far) - 1], pa.int64()), pa.array([sum(x for x, _ in far)], pa.int64())]


def _stretches(first: np.ndarray, edges: int = 4_000_000):
    """Ranges of nodes that have about so many edges, or are one."""
    a, last = 0, len(first) - 1
    while a < last:
        b = max(a + 1, int(np.searchsorted(first, first[a] + edges, "right")) - 1)
        yield a, b
        a = b


def _from_dense(graph: tuple, source: int, total: np.ndarray) -> None:
    """As _from_source, by whole arrays: distances, then counts of ways along the edges that lie on shortest paths."""
    _, first, near, step, _ = graph
    far, u, v = _nearest(graph, source), [], []
    for a, b in _stretches(first):
        edges = slice(first[a], first[b])
        own = np.repeat(np.arange(a, b, dtype=np.int32), np.diff(first[a : b + 1]))
        with np.errstate(invalid="ignore"):
            on_path = np.abs(far[own] + step[edges] - far[near[edges]]) <= ALIKE
        u.append(own[on_path])
        v.append(near[edges][on_path])
    u, v = np.concatenate(u), np.concatenate(v)

    def along(x: np.ndarray, come: np.ndarray, go: np.ndarray) -> np.ndarray:
        every, part = x.copy(), x
        while (part := np.bincount(go, part[come], len(x))).any():
            every += part
        return every

    start = np.zeros(len(total))
    start[source] = 1.0
    ways = along(start, u, v)
    met = ways > 0
    behind = along(np.divide(1.0, ways, out=np.zeros(len(ways)), where=met), v, u)
    met[source] = False
    total[met] += ways[met] * behind[met] - 1


def _from_source(source: int, first: np.ndarray, near: np.ndarray, step: np.ndarray, total: np.ndarray) -> None:
    """Adds what the shortest paths from one source give to the nodes on them (Brandes 2001)."""
    best, count, before, order, heap = {source: 0.0}, {source: 1.0}, {source: []}, [], [(0.0, source)]
    done = set()
    while heap:
        far, u = heapq.heappop(heap)
        if u in done:
            continue
        done.add(u)
        order.append(u)
        for k in range(first[u], first[u + 1]):
            v, d = near[k], far + step[k]
            if v in done:
                continue
            known = best.get(v)
            if known is None or d < known - ALIKE:
                best[v], count[v], before[v] = d, count[u], [u]
                heapq.heappush(heap, (d, v))
            elif abs(d - known) <= ALIKE:
                count[v] += count[u]
                before[v].append(u)
    share = dict.fromkeys(order, 0.0)
    for v in reversed(order):
        for u in before[v]:
            share[u] += count[u] / count[v] * (1 + share[v])
        if v != source:
            total[v] += share[v]


def _along(start: DataFrame, steps: DataFrame, come: str, go: str) -> DataFrame:
    """seed, node and the sum over all ways along steps (seed, come, go) of the values (x) that they start from."""
    part, every = _saved(start), None
    while not part.isEmpty():
        every = part if every is None else every.unionByName(part)
        part = _saved(part.join(steps, [F.col("node") == F.col(come), part["seed"] == steps["seed"]]).groupBy(part["seed"], F.col(go).alias("node")).agg(F.sum("x").alias("x")))
    every = start.limit(0) if every is None else every
    return _saved(every.groupBy("seed", "node").agg(F.sum("x").alias("x")))


def _through_rounds(both: DataFrame, nodes: DataFrame, n: int, block_pairs: int) -> DataFrame:
    blocks, parts = -(-n * n // block_pairs), []
    pairs = both.select(F.col("u").alias("a"), F.col("v").alias("b"), F.col("step").alias("distance"))
    for k in range(blocks):
        sources = nodes.where(F.pmod(F.xxhash64("node"), F.lit(blocks)) == k)
        far = _saved(distances(pairs, sources).select("seed", "node", "distance"))
        ends = far.select("seed", F.col("node").alias("v"), F.col("distance").alias("to"))
        on_path = far.join(both, F.col("node") == F.col("u")).join(ends, ["seed", "v"]).where(F.abs(F.col("distance") + F.col("step") - F.col("to")) <= ALIKE)
        steps = _saved(on_path.select("seed", "u", "v"))
        count = _along(far.where("seed = node").select("seed", "node", F.lit(1.0).alias("x")), steps, "u", "v")
        behind = _along(count.select("seed", "node", (1 / F.col("x")).alias("x")), steps, "v", "u")
        both_sides = count.select("seed", "node", F.col("x").alias("paths")).join(behind, ["seed", "node"]).where("seed <> node")
        parts.append(_saved(both_sides.groupBy("node").agg(F.sum(F.col("paths") * F.col("x") - 1).alias("through"))))
        _forget(far, steps, count, behind)
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def communities(edges: DataFrame, sweeps: int = 10) -> DataFrame:
    """node and community (its least node) by merges that raise modularity over edges (a, b, score), in rounds (see _merges).

    Between merges nodes move, up to sweeps times: each node that would gain most in another community that it is linked with
    goes there, about half of them at once, by a hash that changes from sweep to sweep; a sweep that does not raise the modularity
    of the whole is undone, the first time an eighth go from then on, the second time sweeps end. What they leave is merged again. It ends when no two communities would gain by being one."""
    kind = edges.schema["a"].dataType
    links = _saved(edges.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("score").alias("w")))
    total, least = links.agg(F.sum("w"), F.min("w")).first()
    nodes = _saved(_both_ways(links, "w").groupBy(F.col("u").alias("node")).agg(F.sum("w").alias("d")))
    if not total:
        return nodes.select("node", F.col("node").alias("community"))
    renamed = lambda df, way, c: df.join(way.select(F.col("u").alias(c), "to"), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
    weights = lambda labels: labels.groupBy("c").agg(F.sum("d").alias("d"))
    labels = nodes.select("node", "d", F.col("node").alias("c"))
    labels = _saved(renamed(labels, _merges(links, _saved(weights(labels)), total, least), "c"))
    # What a node gives to the modularity of a community of other nodes, by its links with them and their weight.
    gives = lambda w, d: w / total - F.col("d") * d / (2 * total * total)

    def looked(labels: DataFrame) -> tuple[DataFrame, float]:
        """Of each node the best other community and its links with its own, and the modularity of the whole."""
        size = _saved(weights(labels))
        near = _both_ways(links, "w").join(labels.select(F.col("node").alias("v"), "c"), "v").groupBy("u", "c").agg(F.sum("w").alias("w"))
        mine = labels.select(F.col("node").alias("u"), "d", F.col("c").alias("own"))
        priced = near.join(mine, "u").join(size.select("c", F.col("d").alias("dc")), "c").join(size.select(F.col("c").alias("own"), F.col("d").alias("do")), "own")
        other, at_home = F.when(F.col("c") != F.col("own"), gives(F.col("w"), F.col("dc"))), F.sum(F.when(F.col("c") == F.col("own"), F.col("w")).otherwise(0.0))
        best = _saved(priced.groupBy("u").agg(F.max_by("c", other).alias("to"), F.max(other).alias("there"), at_home.alias("w"), F.max("d").alias("d"), F.max("do").alias("do")))
        apart = size.agg(F.sum(F.col("d") * F.col("d"))).first()[0] or 0.0
        return best, (best.agg(F.sum("w")).first()[0] or 0.0) / (2 * total) - apart / (4 * total * total)

    (best, reached), part = looked(labels), 2
    for k in range(sweeps):
        gains = F.col("there") > gives(F.col("w"), F.col("do") - F.col("d")) + 1e-10 * F.col("d") / abs(total)
        moves = best.where(gains & (F.pmod(F.xxhash64("u", F.lit(k)), F.lit(part)) == 0)).select(F.col("u").alias("node"), "to")
        tried = _saved(labels.join(moves, "node", "left").select("node", "d", F.coalesce("to", "c").alias("c")))
        then, now = looked(tried)
        if now > reached + 1e-12:
            labels, best, reached = tried, then, now
        elif part == 2:
            part = 8
        else:
            break
    way = labels.select(F.col("node").alias("u"), F.col("c").alias("to"))
    between = renamed(renamed(links, way, "a"), way, "b").where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("w"))
    labels = _saved(renamed(labels, _merges(_saved(between), _saved(weights(labels)), total, least), "c"))
    first = labels.groupBy("c").agg(F.min("node").cast(kind).alias("community"))
    return labels.join(first, "c").select("node", "community")


def _merges(links: DataFrame, size: DataFrame, total: float, least: float) -> DataFrame:
    """u and to: which communities (size: c and the weight d of its links) become part of which, in rounds of merges over
    links (a < b, w) until no two would gain by being one.

    In a round each names a neighbour that it would gain by joining: that of the greatest gain, where gains count once to
    twice by a hash of pair and round, lest all of a neighbourhood name the same. Those that name one of more weight join it,
    unless that one joins another itself; in every other round a hash decides instead, so that no chain takes a round for each of
    its links. Whoever is named by many takes them by falling gain, for as long as the next would still gain beside all before it. So
    a round always raises modularity, and some community joins in every second one. The links between two are one row, so rounds shrink."""
    applied, k = [], 0
    spark, kind = links.sparkSession, links.schema["a"].dataType.simpleString()
    gain = F.col("w") / total - F.col("da") * F.col("db") / (2 * total * total)
    falling = Window.partitionBy("to").orderBy(F.desc("gain"), "u")
    held = F.coalesce(F.sum("du").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    # Links among those that join are not counted: they only add to the gain. Where some are below zero, one joins at a time.
    still = F.col("w") / total > F.col("du") * (F.col("dv") + held) / (2 * total * total) if least >= 0 else F.row_number().over(falling) == 1
    while True:
        priced = links.join(size.toDF("a", "da"), "a").join(size.toDF("b", "db"), "b").withColumn("gain", gain).where(F.col("gain") > 1e-10 * F.abs(F.col("w") / total))
        priced = priced.withColumn("x", F.col("gain") * (1 + F.pmod(F.xxhash64("a", "b", F.lit(k)), F.lit(1 << 53)) / (1 << 53)))
        ends = [priced.select(F.col(a).alias("u"), F.col(b).alias("v"), F.col(f"d{a}").alias("du"), F.col(f"d{b}").alias("dv"), "w", "gain", "x") for a, b in ("ab", "ba")]
        best = [F.max_by(c, "x").alias(to) for c, to in (("v", "to"), ("dv", "dv"), ("w", "w"), ("gain", "gain"))]
        named = ends[0].unionByName(ends[1]).groupBy("u").agg(F.max("du").alias("du"), *best)
        if k % 2:
            sends = lambda c: F.pmod(F.xxhash64(c, F.lit(k)), F.lit(2)) == 1
            asked = named.where(sends(F.col("u")) & ~sends(F.col("to")))
        else:
            rising = _saved(named.where(F.struct("dv", "to") > F.struct("du", "u")))
            asked = rising.join(rising.select(F.col("u").alias("to")), "to", "left_anti")
        moves = _saved(asked.withColumn("still", still).where("still").select("u", "to"))
        k += 1
        if moves.isEmpty():
            if k % 2:
                break
            continue
        applied.append(moves)
        name = lambda df, c: df.join(moves.select(F.col("u").alias(c), "to"), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
        links = _saved(name(name(links, "a"), "b").where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("w")))
        size = _saved(name(size, "c").groupBy("c").agg(F.sum("d").alias("d")))
    # A community joins another once, so all moves are a forest, no deeper than there were rounds.
    schema = f"u {kind}, to {kind}"
    way = spark.read.schema(schema).parquet(*(m._folder for m in applied)) if applied else spark.createDataFrame([], schema)
    for _ in range(len(applied).bit_length()):
        way = _saved(way.join(way.select(F.col("u").alias("to"), F.col("to").alias("up")), "to", "left").select("u", F.coalesce("up", "to").alias("to")))
    return way
