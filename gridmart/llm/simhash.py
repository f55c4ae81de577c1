"""SimHash near-duplicates by a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints that differ
in at most ``max_bits`` bits differ in at most ``max_bits`` bytes, so they
share at least ``8 - max_bits`` positional bytes: the guaranteed minimum of
the count filter.

A posting list of one positional byte holds a 256th of the corpus, and
tallying its pairs grows with the square of the corpus.  The postings are
therefore keyed by the ``8 - max_bits`` subsets of positional bytes (56 keys
for three bits): two fingerprints meet in a list exactly when their tally
reaches the minimum, so the tally is taken by the key itself, the postings
grow with the number of distinct fingerprints, and a list holds at most
``2 ** (8 * max_bits)`` of them whatever the corpus.  Pairs that met are
verified by their bit distance.  A list gives the edges of a spanning forest
of its verified links, never all pairs; links not emitted are implied by them,
so components are whole.

Equal fingerprints are one class before any of this, so a group of copies,
however large, is one posting.

Defined results: a null text counts as empty; a text of fewer words than the
shingle length is one shingle of all its words; a text without words has
fingerprint zero, linked like any other.  A null ``doc_id`` is never a
component's id unless all its ids are null.  Empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import connected

#: Fixed by the fingerprint's definition.
HASH_SEED = 42
#: Lists up to this length are searched by comparing, longer ones by
#: enumerating the neighbours of each member.
COMPARE_UP_TO = 1 << 16

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    run = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(run, HASH_SEED)], np.uint64)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(run[a:b - 1], HASH_SEED) for a, b in zip(starts, ends[shingle - 1:])),
                       np.uint64, len(words) - shingle + 1)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint: a bit is 1 if set in over half the hashes."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, uid (position id of the row) and fp (signed 64-bit)."""
    def run(batches):
        for batch in common.slices(batches, "text"):
            fps = np.array([fingerprint(t, shingle) for t in common.byte_texts(batch.column("text"))],
                           np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("uid"), pa.array(fps, pa.int64())],
                names=["doc_id", "uid", "fp"])
    return common.columns(docs, {"doc_id": "long", "text": "string"}) \
        .withColumn("uid", F.monotonically_increasing_id()) \
        .mapInArrow(run, "doc_id long, uid long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _posting_masks(max_bits: int) -> list[int]:
    return [sum(0xFF << (8 * i) for i in kept) for kept in combinations(range(8), 8 - max_bits)]


def _compare(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest by breadth-first search; each member is
    compared with the members not yet reached."""
    edges, left = [], fps
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            member = queue.pop(0)
            near = np.bitwise_count(left ^ member) <= max_bits
            if near.any():
                found, left = left[near], left[~near]
                edges += [(f, member) for f in found]
                queue += list(found)
    return edges


def _enumerate(fps: np.ndarray, mask: int, max_bits: int) -> list[tuple[int, int]]:
    """Links of the same forest with work linear in the list: members agree
    outside the free bytes, so a neighbour differs by one of the few patterns of
    at most ``max_bits`` free bits.  Components come from labels that sink to
    their least member, the forest from all components' first members at once."""
    free = [b for b in range(64) if not mask >> b & 1]
    flips = np.array([sum(1 << b for b in bits) for n in range(1, max_bits + 1)
                      for bits in combinations(free, n)], np.uint64)
    order = np.sort(fps)

    def neighbours(members: np.ndarray):
        for flip in flips:
            near = order[members] ^ flip      # distinct, so a member is met once
            at = np.minimum(np.searchsorted(order, near), len(order) - 1)
            hit = order[at] == near
            yield members[hit], at[hit]

    every = np.arange(len(order))
    label, before = every.copy(), None
    while before is None or (label != before).any():
        before = label.copy()
        for member, other in neighbours(every):
            label[member] = np.minimum(label[member], label[other])
        label = label[label]
    new, edges = label != every, []
    frontier = every[~new]
    while len(frontier):
        reached = []
        for member, other in neighbours(frontier):
            fresh = new[other]
            new[other[fresh]] = False
            reached.append(other[fresh])
            edges += zip(order[other[fresh]], order[member[fresh]])
        frontier = np.concatenate(reached) if reached else every[:0]
    return edges


def _links_of(masks: list[int], max_bits: int):
    """Forest edges of every posting list; input sorted by (subset, part)."""
    def edges_of(subset, fps):
        fps = fps.view(np.uint64)
        if len(fps) <= COMPARE_UP_TO:
            return _compare(fps, max_bits)
        return _enumerate(fps, masks[subset], max_bits)

    def batch_of(edges):
        flat = np.array(edges, np.uint64).view(np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])],
                                          names=["u", "v"])

    def run(batches):
        open_key, open_runs = None, []      # the list that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            subset, part, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cuts = np.flatnonzero((subset[1:] != subset[:-1]) | (part[1:] != part[:-1])) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(fp)]
            edges = []
            first = (int(subset[0]), int(part[0]))
            if open_key is not None and open_key != first:
                held = np.concatenate(open_runs)
                if len(held) > 1:
                    edges += edges_of(open_key[0], held)
                open_runs = []
            if len(starts) == 1:
                open_key, open_runs = first, [*open_runs, fp]
            else:
                held = np.concatenate([*open_runs, fp[:ends[0]]])
                if len(held) > 1:
                    edges += edges_of(first[0], held)
                for i in np.flatnonzero(ends[1:-1] - starts[1:-1] > 1) + 1:
                    edges += edges_of(int(subset[starts[i]]), fp[starts[i]:ends[i]])
                last = starts[-1]
                open_key, open_runs = (int(subset[last]), int(part[last])), [fp[last:]]
            if edges:
                yield batch_of(edges)
        if open_key is not None:
            held = np.concatenate(open_runs)
            if len(held) > 1 and (edges := edges_of(open_key[0], held)):
                yield batch_of(edges)
    return run


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Verified links (u, v) between the distinct fingerprints of column
    ``fp``: a forest for each posting list, which spans all its links."""
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits from 0 to 4")
    masks = _posting_masks(max_bits)
    postings = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("subset"),
                 F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
        for i, m in enumerate(masks)])).alias("p")).select("p.subset", "p.part", "fp")
    return postings.repartition("subset", "part").sortWithinPartitions("subset", "part") \
        .mapInArrow(_links_of(masks, max_bits), "u long, v long").distinct()


def _first_row() -> Column:
    """Rows in order of doc_id, null ones last, then of position."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: doc_id, uid, fp, component_id (the smallest
    doc_id reachable over links, itself included), kept (true for one row of
    each component, the first)."""
    rows = common.cut(fingerprints(docs, shingle))
    classes = rows.groupBy("fp").agg(F.min(_first_row()).alias("first"))
    roots = connected(links(classes.select("fp"), max_bits))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("one"))
    of_class = rooted.join(firsts, "root").select("fp", "one")
    return rows.join(of_class, "fp").select(
        "doc_id", "uid", "fp", F.col("one.doc_id").alias("component_id"),
        (F.col("uid") == F.col("one.uid")).alias("kept"))


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component, all its columns (``docs`` must
    be replayable in the same order, as a stored table is)."""
    uid = common.fresh(docs, "_row_id")
    stay = near_duplicates(docs, shingle, max_bits).filter("kept").select(F.col("uid").alias(uid))
    return docs.withColumn(uid, F.monotonically_increasing_id()).join(stay, uid, "left_semi").drop(uid)
