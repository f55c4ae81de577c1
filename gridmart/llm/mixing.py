"""Mixing sources to target weights as a min-cost flow.

Documents are aggregated by membership pattern: the set of sources they belong
to (sources may overlap).  Token capacity is routed from patterns to source
quotas; taking a pattern once costs less a token than taking it a second time,
and so on (convex repetition costs), so repetition is used only where a quota
needs it.  The network has a node for each pattern and source, and its size
does not depend on the number of documents.

A pattern with flow f and capacity c takes every document f // c times whole
and a seeded selection for the rest: its documents in the order of a seeded
hash up to the largest prefix that fits, then, because the next document may
be long, those of the following ones that still fit, again by prefixes, until
none does.  Prefix sums are taken over hash cells first and within a cell
after, so no source, however large, is sorted in one task.

Defined results: a null text has size 0 and is never taken; a null source is a
source of its own, after all others; documents that are equal in all columns
are interchangeable; reruns and other partitionings give the same selection.
Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CELL_BITS = 12

# Fixed values of the mix: weights of the sources in order, tokens taken in
# all as a share of the tokens there are, and the most often a document is taken.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2


def targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> dict:
    """Target of each source: the weights' share of ``share`` times all sizes,
    at most ``repeats`` times the source's size; what is cut off is shared
    again by weight among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > repeats * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = float(repeats * sizes[s])
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


def min_cost_flow(nodes: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost) of a maximum flow of least
    cost, by successive cheapest paths."""
    head, cap, cost, out = [], [], [], [[] for _ in range(nodes)]
    for a, b, c, w in arcs:
        for x, y, z, v in ((a, b, c, w), (b, a, 0, -w)):
            out[x].append(len(head))
            head.append(y)
            cap.append(z)
            cost.append(v)
    while True:
        far, via = [None] * nodes, [0] * nodes
        far[source] = 0
        queue, waiting = deque([source]), {source}
        while queue:
            x = queue.popleft()
            waiting.discard(x)
            for e in out[x]:
                if cap[e] and (far[head[e]] is None or far[x] + cost[e] < far[head[e]]):
                    far[head[e]], via[head[e]] = far[x] + cost[e], e
                    if head[e] not in waiting:
                        queue.append(head[e])
                        waiting.add(head[e])
        if far[sink] is None:
            return [cap[2 * i + 1] for i in range(len(arcs))]
        path, x = [], sink
        while x != source:
            path.append(via[x])
            x = head[via[x] ^ 1]
        push = min(cap[e] for e in path)
        for e in path:
            cap[e] -= push
            cap[e ^ 1] += push


def route(patterns: dict[tuple, int], quotas: dict, repeats: int = REPEATS) -> dict[tuple, int]:
    """Tokens to take of each pattern (its sources -> its capacity once)."""
    names, sources = list(patterns), list(quotas)
    at = {s: 1 + len(names) + i for i, s in enumerate(sources)}
    sink = 1 + len(names) + len(sources)
    arcs = []
    for i, p in enumerate(names):
        for r in range(repeats):
            arcs.append((0, 1 + i, patterns[p], (r + 1) ** 2))
        arcs += [(1 + i, at[s], repeats * patterns[p], 0) for s in p if s in at]
    arcs += [(at[s], sink, int(quotas[s]), 0) for s in sources]
    flow = min_cost_flow(sink + 1, arcs, 0, sink)
    taken = dict.fromkeys(names, 0)
    for (a, b, _, _), f in zip(arcs, flow):
        if a == 0:
            taken[names[b - 1]] += f
    return taken


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, sources (distinct, sorted), uid, size in words, h (seeded hash),
    t (hash of the text, so that only equal rows tie)."""
    def run(batches):
        for batch in common.slices(batches, "text"):
            texts = common.byte_texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("sources"), batch.column("uid"),
                 pa.array([len(t.split()) for t in texts], pa.int64()),
                 pa.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts], pa.int64())],
                names=["doc_id", "sources", "uid", "size", "t"])
    return common.columns(docs, {"doc_id": "long", "sources": "array<string>", "text": "string"}) \
        .withColumn("sources", F.array_sort(F.array_distinct("sources"))) \
        .withColumn("uid", F.monotonically_increasing_id()) \
        .mapInArrow(run, "doc_id long, sources array<string>, uid long, size long, t long") \
        .withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "t"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
        seed: int = 0) -> DataFrame:
    """``docs``: doc_id, text, sources (array of strings; a null element is the
    null source).  Returns doc_id, uid, sources, size, source_size and target
    (of its first source), taken."""
    spark = docs.sparkSession
    rows = common.cut(_sized(docs, seed))
    # one row for each pattern and each source: bounded by the mix, not the corpus
    capacity = {tuple(r.sources): r["n"] for r in
                rows.groupBy("sources").agg(F.sum("size").alias("n")).collect() if r.sources}
    sizes: dict = {}
    for p, n in capacity.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    goal = targets(sizes, weights, share, repeats)
    flow = route(capacity, {s: round(t) for s, t in goal.items()}, repeats)
    plan = []
    for i, (p, n) in enumerate(sorted(capacity.items(), key=lambda x: [(s is None, s or "") for s in x[0]])):
        plan.append((i, list(p), flow[p] // n if n else 0, flow[p] % n if n else 0, sizes[p[0]], goal[p[0]]))
    plan_df = spark.createDataFrame(
        plan, "pattern int, sources array<string>, whole long, rest long, source_size long, target double")

    rows = rows.join(F.broadcast(plan_df), rows.sources.eqNullSafe(plan_df.sources), "left") \
        .drop(plan_df.sources) \
        .withColumn("cell", F.shiftrightunsigned("h", 64 - CELL_BITS))
    by_pattern = Window.partitionBy("pattern").orderBy("cell")
    before = rows.groupBy("pattern", "cell").agg(F.sum("size").alias("n")) \
        .withColumn("before", F.sum("n").over(by_pattern) - F.col("n")) \
        .select(F.col("pattern").alias("p"), F.col("cell").alias("c"), "before")
    in_cell = Window.partitionBy("pattern", "cell").orderBy("h", "doc_id", "t", "size") \
        .rowsBetween(Window.unboundedPreceding, 0)
    summed = common.cut(
        rows.withColumn("upto", F.sum("size").over(in_cell))
        .join(before, F.col("pattern").eqNullSafe(F.col("p")) & (F.col("cell") == F.col("c")), "left")
        .withColumn("upto", F.col("upto") + F.col("before")).drop("p", "c", "before"))

    extra = spark.createDataFrame(_fill(summed), "p int, after long, stop long, most long")
    summed = summed.join(F.broadcast(extra), (F.col("pattern") == F.col("p")) & (F.col("upto") > F.col("after"))
                         & (F.col("upto") < F.col("stop")) & F.col("size").between(1, F.col("most")), "left")
    once_more = (F.col("upto") <= F.col("rest")) | F.col("p").isNotNull()
    copies = F.coalesce("whole", F.lit(0)) + F.when(once_more, 1).otherwise(0)
    return summed.select("doc_id", "uid", "sources", "size",
                         F.coalesce("source_size", F.lit(0)).alias("source_size"),
                         F.coalesce("target", F.lit(0.0)).alias("target"),
                         (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def _fill(summed: DataFrame) -> list[tuple[int, int, int, int]]:
    """(pattern, after, stop, most): past its first prefix, a pattern also takes
    the documents of at most ``most`` words whose prefix sum lies between.

    A round takes of the documents that still fit the largest prefix; the next
    one goes on behind the first that did not.  What was passed over never fits
    later, so this takes what trying all documents one by one would.  What is
    left falls below the size passed over, so rounds are few; they end when no
    document fits."""
    spark, out = summed.sparkSession, []
    got = F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))), F.lit(0))
    state = [(r["pattern"], r["got"], r["rest"] - r["got"]) for r in
             summed.filter("rest > 0").groupBy("pattern").agg(F.max("rest").alias("rest"), got.alias("got")).collect()]
    by_cell = Window.partitionBy("pattern").orderBy("cell")
    in_cell = Window.partitionBy("pattern").orderBy("upto").rowsBetween(Window.unboundedPreceding, 0)
    while state := [x for x in state if x[2]]:
        now = spark.createDataFrame(state, "p int, after long, left long")
        fit = summed.join(F.broadcast(now), F.col("pattern") == F.col("p")) \
            .filter("upto > after AND size > 0 AND size <= left").select("pattern", "cell", "upto", "size", "left")
        # the cell in which the sum passes what is left; none if all that fit are taken
        last = fit.groupBy("pattern", "cell").agg(F.sum("size").alias("n"), F.max("left").alias("left")) \
            .withColumn("before", F.sum("n").over(by_cell) - F.col("n")) \
            .filter("before <= left AND before + n > left") \
            .select(F.col("pattern").alias("p"), F.col("cell").alias("c"), "before")
        ends = {r["pattern"]: r for r in
                fit.join(F.broadcast(last), (F.col("pattern") == F.col("p")) & (F.col("cell") == F.col("c")))
                .withColumn("held", F.sum("size").over(in_cell) + F.col("before"))
                .groupBy("pattern").agg(
                    F.max(F.when(F.col("held") <= F.col("left"), F.col("held"))).alias("held"),
                    F.max("before").alias("before"),
                    F.min(F.when(F.col("held") > F.col("left"), F.col("upto"))).alias("stop")).collect()}
        out += [(p, after, ends[p]["stop"] if p in ends else (1 << 63) - 1, left) for p, after, left in state]
        state = [(p, ends[p]["stop"], left - (ends[p]["before"] if ends[p]["held"] is None else ends[p]["held"]))
                 for p, _, left in state if p in ends]
    return out


def by_source(docs: DataFrame) -> DataFrame:
    """``docs`` with ``sources``: its one source (``source``, null included)."""
    return common.columns(docs, {"doc_id": "long", "text": "string", "source": "string"}) \
        .withColumn("sources", F.array("source"))


def repeat_rows(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``docs`` (with column ``source``) as the mix takes it: a document taken
    twice stands there twice, one not taken not at all; all its columns."""
    uid, n = common.fresh(docs, "_row_id"), common.fresh(docs, "_copies")
    taken = mix(by_source(docs), seed=seed).filter("taken > 0") \
        .select(F.col("uid").alias(uid), F.col("copies").alias(n))
    i = common.fresh(docs, "_copy")
    return docs.withColumn(uid, F.monotonically_increasing_id()).join(taken, uid) \
        .withColumn(i, F.explode(F.sequence(F.lit(1), n))).drop(uid, n, i)
