"""Merkle manifest of a dataset, its proofs found by butterfly exchange.

Every row is a leaf: the SHA-256 of its fields.  The leaves of a tree (one for
each language) stand in order; every ``FANOUT`` consecutive nodes become the
digest of their digests until one is left, the subroot; the subroots are the
leaves of one more tree, whose last node is the root.

Leaves are dealt to partitions of ``FANOUT ** PART_LEVELS`` consecutive ones, so
that a partition is a whole subtree.  Each hashes its own subtree.
Then, round by round, partitions exchange roots in aligned groups of a fanout:
in round r those whose numbers differ in their r-th digit only.  Each member
gets the others' nodes, keeps them as its proof of that level and hashes the
ancestor itself, as all the others do.  After as many rounds as the numbers have
digits every partition knows the subroot and its upper proof; nothing is sent
down again.  At the ragged end of a tree a group may lack a member, since the
last node has fewer partitions: those that it has send to the groups of the
missing ones too, taking turns.

On Spark a round is one grouping of at most ``FANOUT`` short rows for each
partition; its result is kept in the shared folder.  Only digests are shuffled,
never texts: by range, so that a language with a third of all rows is split; by
partition of the tree; and once more with the upper proofs before them, when
each leaf's own proof is found and folded in one stream.

Defined results: null fields count as ``-``; null ids come first, as do null
languages; rows of one id are ordered by their leaf; repeated rows are leaves of
their own; a tree of one leaf is that leaf, and its proof is empty; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

FANOUT = 8
#: Levels of a partition's own subtree (4,096 leaves).
PART_LEVELS = 4

#: The fields of a document's leaf, in order.
FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}

SIBLINGS = "array<struct<before:string,after:string>>"


def leaf_of(fields: list[Column]) -> Column:
    """Digest of a row: each field as its length in bytes, a colon and its text."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def digest(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def subtree(leaves: list[str], levels: int | None) -> list[list[str]]:
    """The nodes of each level: ``levels`` above the leaves, or until one is left."""
    nodes = [leaves]
    while len(nodes) <= levels if levels is not None else len(nodes[-1]) > 1:
        below = nodes[-1]
        nodes.append([digest(*below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return nodes


def _levels(leaves_in_tree: int, part_levels: int) -> int | None:
    """Levels of a partition of a tree: as far as one node if it is the only one."""
    return None if leaves_in_tree <= FANOUT ** part_levels else part_levels


# Places of the leaves

def _placed(entries: DataFrame, part: int) -> DataFrame:
    """``entries`` (tree, id, label, leaf, probe) with the number of the leaf's
    partition (of ``part`` leaves), its place there and the leaves of the tree."""
    order = ["tree", "id", "label", "leaf", "uid"]
    # the row number splits ranges of equal rows
    ordered = common.cut(common.cut(entries).withColumn("uid", F.monotonically_increasing_id())
                         .repartitionByRange(*order).sortWithinPartitions(*order).drop("uid"))
    row = ordered.withColumns({"_task": F.spark_partition_id(),
                               "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    runs = row.groupBy("tree", "_task").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    by_tree = Window.partitionBy("tree")
    runs = runs.select(
        F.col("tree").alias("_tree"), F.col("_task").alias("_run"), "_first",
        (F.sum("_n").over(by_tree.orderBy("_task")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(by_tree).alias("leaves"))
    index = F.col("_row") - F.col("_first") + F.col("_before")
    return row.join(runs, (F.col("_task") == F.col("_run")) & F.col("tree").eqNullSafe(F.col("_tree"))) \
        .select("tree", "id", "label", "leaf", "probe", "leaves",
                (index / part).cast("long").alias("part"), (index % part).cast("int").alias("place"))


def _roots(placed: DataFrame, part_levels: int) -> DataFrame:
    """Each partition's root: (tree, part, parts, node)."""
    def run(batches):
        for _, rows in _groups(batches, ("tree", "part", "leaf", "leaves")):
            (tree, part, _, leaves), hashes = rows[0], [r[2].hex() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree], pa.string()), pa.array([part], pa.int64()),
                 pa.array([-(-leaves // FANOUT ** part_levels)], pa.int64()),
                 pa.array([subtree(hashes, _levels(leaves, part_levels))[-1][0]], pa.string())],
                names=["tree", "part", "parts", "node"])

    return placed.select("tree", "part", "place", "leaf", "leaves").repartition("tree", "part") \
        .sortWithinPartitions("tree", "part", "place") \
        .mapInArrow(run, "tree string, part long, parts long, node string")


def _groups(batches, names) -> Iterator[tuple]:
    """Rows of sorted batches by (tree, part): a partition's leaves, and its head."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names)):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row)
    if held:
        yield key, held


# The exchange

def exchange(parts: DataFrame, r: int) -> DataFrame:
    """Round ``r``: (tree, part, parts, node, proof) one level up.

    Partitions whose numbers differ in digit ``r`` only swap their nodes; each
    keeps the others' as its siblings and hashes the ancestor of them all."""
    size = FANOUT ** r                                    # partitions below a whole node
    part, node = F.col("part"), (F.col("part") / size).cast("long")
    low, held = part % size, F.least(F.lit(size), F.col("parts") - node * size)
    # the last node's partitions stand in for those it lacks, if others ask
    asked = F.when(node % FANOUT == 0, held).otherwise(F.lit(size))
    sent = parts.withColumns({
        "_digit": (node % FANOUT).cast("int"), "_group": (node / FANOUT).cast("long"), "_own": low,
        "_low": F.explode(F.sequence(low, asked - 1, held))})
    met = sent.groupBy("tree", "_group", "_low").agg(F.sort_array(F.collect_list(
        F.struct("_digit", "node", "part", "parts", "proof", (F.col("_own") == F.col("_low")).alias("own")))).alias("m"))

    def nodes(members: Column) -> Column:
        return F.concat_ws("", F.transform(members, lambda x: x["node"]))

    return met.select("tree", "m", F.sha2(nodes(F.col("m")).cast("binary"), 256).alias("up"),
                      F.explode(F.filter("m", lambda x: x["own"])).alias("x")).select(
        "tree", F.col("x.part").alias("part"), F.col("x.parts").alias("parts"), F.col("up").alias("node"),
        F.concat(F.col("x.proof"), F.array(F.struct(
            nodes(F.filter("m", lambda y: y["_digit"] < F.col("x._digit"))).alias("before"),
            nodes(F.filter("m", lambda y: y["_digit"] > F.col("x._digit"))).alias("after")))).alias("proof"))


def _climb(roots: DataFrame) -> DataFrame:
    """Every partition with its tree's last node and its upper proof."""
    state = common.cut(roots.withColumn("proof", F.array().cast(SIBLINGS)))
    most = state.agg(F.max("parts")).first()[0] or 0
    r = 0
    while FANOUT ** r < most:
        done = state.filter(F.col("parts") <= FANOUT ** r)
        state = common.cut(exchange(state.filter(F.col("parts") > FANOUT ** r), r).unionByName(done))
        r += 1
    return state


# Proofs

OUTPUTS = {
    "label": ("string", pa.string()),
    "leaf": ("string", pa.string()),
    "subroot": ("string", pa.string()),
    "root": ("string", pa.string()),
    "proof": (SIBLINGS, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
    "proof_sha256": ("string", pa.string()),
    "folded_root": ("string", pa.string()),
    "verified": ("boolean", pa.bool_()),
}


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in proof:
        leaf = digest(before, leaf, after)
    return leaf


def _proofs(placed: DataFrame, heads: DataFrame, outputs: tuple[str, ...], part_levels: int) -> DataFrame:
    """The asked ``outputs`` of every leaf; ``heads`` has for each partition
    (tree, part) the siblings above its subtree, the subroot and the root."""
    # "leaves" of a head says nothing: it comes first and names no leaf
    lead = heads.select("tree", "part", F.lit(-1).alias("place"), F.lit(None).cast("long").alias("id"),
                        F.lit(None).cast("string").alias("label"), F.lit(None).cast("binary").alias("leaf"),
                        F.lit(None).cast("binary").alias("probe"), F.lit(0).cast("long").alias("leaves"),
                        "subroot", "root", "proof")
    rows = placed.withColumns({"subroot": F.lit(None).cast("string"), "root": F.lit(None).cast("string"),
                               "proof": F.lit(None).cast(SIBLINGS)}).select(lead.columns)
    names = lead.columns

    def run(batches):
        for _, (head, *members) in _groups(batches, names):
            subroot, root, above = head[8], head[9], [(s["before"], s["after"]) for s in head[10]]
            levels = subtree([m[5].hex() for m in members], _levels(members[0][7], part_levels))[:-1]
            beside = [[("".join(nodes[i // FANOUT * FANOUT:i]), "".join(nodes[i + 1:i // FANOUT * FANOUT + FANOUT]))
                       for i in range(len(nodes))] for nodes in levels]
            out: dict[str, list] = {"id": [m[3] for m in members], **{o: [] for o in outputs}}
            for i, (_, _, _, _, label, leaf, probe, *_) in enumerate(members):
                proof = []
                for nodes in beside:
                    proof.append(nodes[i])
                    i //= FANOUT
                proof += above
                folded = fold((leaf if probe is None else probe).hex(), proof)
                found = {"label": label, "leaf": leaf.hex(), "subroot": subroot, "root": root,
                         "proof": [{"before": b, "after": a} for b, a in proof] if "proof" in out else None,
                         "proof_sha256": digest(*(s for pair in proof for s in pair)),
                         "folded_root": folded, "verified": folded == root}
                for o in outputs:
                    out[o].append(found[o])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["id"], pa.int64()), *(pa.array(out[o], OUTPUTS[o][1]) for o in outputs)],
                names=["id", *outputs])

    return lead.unionByName(rows).repartition("tree", "part").sortWithinPartitions("tree", "part", "place") \
        .mapInArrow(run, ", ".join(["id long", *(f"{o} {OUTPUTS[o][0]}" for o in outputs)]))


def manifest(docs: DataFrame, probe: Column | None = None,
             outputs: tuple[str, ...] = ("leaf", "subroot", "root", "proof", "proof_sha256"),
             part_levels: int = PART_LEVELS) -> DataFrame:
    """doc_id and the asked ``outputs`` of every row of ``docs``.

    ``probe`` is a text held against the manifest: its row's root is folded from
    the leaf with that text (null: from the row's own leaf) and the row's
    siblings, and ``verified`` says whether it is the root."""
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    docs = docs.withColumn("_probe", F.lit(None).cast("string") if probe is None else probe)
    rows = common.columns(docs, FIELDS | {"_probe": "string"})
    own, other = ([F.col(c) for c in (*list(FIELDS)[:-1], last)] for last in ("text", "_probe"))
    entries = rows.select(F.col("lang").alias("tree"), F.col("doc_id").alias("id"),
                          F.lit(None).cast("string").alias("label"), leaf_of(own).alias("leaf"),
                          F.when(F.col("_probe").isNotNull(), leaf_of(other)).alias("probe"))
    part = FANOUT ** part_levels
    placed = _placed(entries, part)
    parts = _climb(_roots(placed, part_levels))

    # the trees' last nodes are the leaves of the tree above
    subroots = parts.filter(F.col("part") == 0).select(
        F.lit(None).cast("string").alias("tree"), F.lit(None).cast("long").alias("id"),
        F.col("tree").alias("label"), F.unhex("node").alias("leaf"), F.lit(None).cast("binary").alias("probe"))
    above_placed = _placed(subroots, part)
    above = _climb(_roots(above_placed, part_levels))
    top = _proofs(above_placed, above.select("tree", "part", F.col("node").alias("subroot"),
                                             F.col("node").alias("root"), "proof"),
                  ("label", "root", "proof"), part_levels).select(F.col("label").alias("_label"), "root",
                                                     F.col("proof").alias("_proof"))
    heads = parts.join(top, F.col("tree").eqNullSafe(F.col("_label"))).select(
        "tree", "part", F.col("node").alias("subroot"), "root", F.concat("proof", "_proof").alias("proof"))
    return _proofs(placed, heads, outputs, part_levels).withColumnRenamed("id", "doc_id")
