"""Exact deduplication with a cuckoo-filter index of live digests.

Texts are equal when their UTF-8 bytes are identical after lower-casing A-Z.
Each text has a SHA-256 digest.  The index is partitioned by digest, into as many
partitions as its bytes ask for; every partition holds

* a cuckoo filter over the digests that are live in it (16-bit fingerprints,
  four slots a bucket, partial-key cuckoo hashing), which answers "not here"
  without touching content and supports deletion, and
* the content buckets: digest -> the entries stored under it, with their bytes.

A filter hit is only a candidate.  It is verified against the bucketed
content, so neither a fingerprint collision nor a digest collision can merge
two different texts.  When an insertion finds no slot after ``MAX_KICKS``
evictions, the filter doubles and is rebuilt from the stored digests.

Rows are combined before the shuffle: a batch sends one record for each
distinct text in it, with its row count and its best row, so a text that makes
up a third of a corpus reaches its index partition as one record a batch.

Defined results: a null text counts as empty; a null ``doc_id`` ranks below
every other; of rows with equal text and equal ``doc_id`` exactly one stays
(the input must be replayable in the same order, as a stored table is); an
empty table gives no rows; columns other than ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SLOTS = 4
MAX_KICKS = 500
START_BUCKETS = 64
#: Text bytes that a partition of the index holds, about.
INDEX_BYTES = 64 << 20


class CuckooFilter:
    """Set of digests with insertion and deletion; may err by false hits only.

    A digest is (fingerprint, bucket) taken from its bytes; the second bucket
    is ``bucket ^ mix(fingerprint)``.
    """

    def __init__(self, buckets: int = START_BUCKETS):
        self.mask = buckets - 1
        self.slots = array("H", bytes(2 * SLOTS * buckets))
        self.size = 0

    @staticmethod
    def _mix(fp: int) -> int:
        return (fp * 0x5BD1E995) & 0xFFFFFFFF

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        fp = int.from_bytes(digest[:2], "big") or 1
        one = int.from_bytes(digest[2:6], "big") & self.mask
        return fp, one, (one ^ self._mix(fp)) & self.mask

    def _put(self, bucket: int, fp: int) -> bool:
        for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if self.slots[i] == 0:
                self.slots[i] = fp
                return True
        return False

    def __contains__(self, digest: bytes) -> bool:
        fp, one, two = self._places(digest)
        s = self.slots
        return fp in s[one * SLOTS:one * SLOTS + SLOTS] or fp in s[two * SLOTS:two * SLOTS + SLOTS]

    def insert(self, digest: bytes) -> bool:
        """False when no slot was found; the filter is then overfull (one
        fingerprint has no place) and must be rebuilt from the stored keys."""
        fp, one, two = self._places(digest)
        if self._put(one, fp) or self._put(two, fp):
            self.size += 1
            return True
        at = two
        for kick in range(MAX_KICKS):
            i = at * SLOTS + kick % SLOTS
            fp, self.slots[i] = self.slots[i], fp
            at = (at ^ self._mix(fp)) & self.mask
            if self._put(at, fp):
                self.size += 1
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        """Removes one copy of a digest that was inserted."""
        fp, one, two = self._places(digest)
        for bucket in (one, two):
            for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.slots[i] == fp:
                    self.slots[i] = 0
                    self.size -= 1
                    return True
        return False


class LiveIndex:
    """Cuckoo filter plus bucketed content of one index partition."""

    def __init__(self):
        self.filter = CuckooFilter()
        self.stored: dict[bytes, list[list]] = {}   # digest -> [content, value]

    def find(self, digest: bytes, content: bytes) -> list | None:
        """The live entry with this very content."""
        if digest not in self.filter:
            return None
        for entry in self.stored.get(digest, ()):   # verify: a hit may be false
            if entry[0] == content:
                return entry
        return None

    def insert(self, digest: bytes, content: bytes, value) -> None:
        self.stored.setdefault(digest, []).append([content, value])
        if not self.filter.insert(digest):
            self._resize()

    def delete(self, digest: bytes, content: bytes) -> bool:
        entry = self.find(digest, content)
        if entry is None:
            return False
        bucket = self.stored[digest]
        bucket.remove(entry)
        if not bucket:
            del self.stored[digest]
        return self.filter.delete(digest)

    def _resize(self) -> None:
        buckets = 2 * (self.filter.mask + 1)
        while True:
            grown = CuckooFilter(buckets)
            if all(grown.insert(d) for d, held in self.stored.items() for _ in held):
                self.filter = grown
                return
            if buckets > 64 * (len(self.stored) + START_BUCKETS):
                raise OverflowError("many entries share one fingerprint and bucket")
            buckets *= 2

    def entries(self) -> Iterator[tuple[bytes, bytes, object]]:
        for digest, held in self.stored.items():
            for content, value in held:
                yield digest, content, value


_RECORD = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("uid", pa.int64()),
                     ("n", pa.int64()), ("op", pa.int32()), ("content", pa.binary())])
_CLASS = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_uid", pa.int64()),
                    ("group_size", pa.int64())])
_ROW = pa.schema([("doc_id", pa.int64()), ("uid", pa.int64()), ("digest", pa.binary())])

INSERT, DELETE = 0, 1


def _rank(doc_id: int | None, uid: int) -> tuple:
    """Of equal texts the row of the largest rank stays."""
    return (doc_id is not None, doc_id or 0, -uid)


def _digests(batches):
    for batch in common.slices(batches, "text"):
        texts = common.byte_texts(batch.column("text"))
        digests = [hashlib.sha256(t.lower()).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("uid"), pa.array(digests, pa.binary())],
            schema=_ROW)


def _combine(op: int):
    """One record for each distinct text of an input batch."""
    def run(batches):
        for batch in batches:
            best: dict[bytes, list] = {}
            for part in common.slices(iter([batch]), "text"):
                for text, doc_id, uid in zip(common.byte_texts(part.column("text")),
                                             part.column("doc_id").to_pylist(),
                                             part.column("uid").to_pylist()):
                    text = text.lower()
                    held = best.get(text)
                    if held is None:
                        best[text] = [doc_id, uid, 1]
                    else:
                        held[2] += 1
                        if _rank(doc_id, uid) > _rank(held[0], held[1]):
                            held[0], held[1] = doc_id, uid
            out, size = [], 0
            for text, (doc_id, uid, n) in best.items():
                out.append((hashlib.sha256(text).digest(), doc_id, uid, n, op, text))
                size += len(text)
                if size > 4 * common.SLICE_BYTES:
                    yield _records(out)
                    out, size = [], 0
            if out:
                yield _records(out)
    return run


def _records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)


def _index(batches):
    """Builds the partition's index: all insertions, then all deletions."""
    index, gone = LiveIndex(), []
    for batch in common.slices(batches, "content", 4 * common.SLICE_BYTES):
        for digest, doc_id, uid, n, op, content in zip(*(c.to_pylist() for c in batch.columns)):
            if op == DELETE:
                gone.append((digest, content))
                continue
            entry = index.find(digest, content)
            if entry is None:
                index.insert(digest, content, (doc_id, uid, n))
                continue
            old = entry[1]
            if _rank(doc_id, uid) > _rank(old[0], old[1]):   # the newer row takes its place
                index.delete(digest, content)
                index.insert(digest, content, (doc_id, uid, n + old[2]))
            else:
                entry[1] = (old[0], old[1], n + old[2])
    for digest, content in gone:
        index.delete(digest, content)
    rows = [(d, v[0], v[1], v[2]) for d, _, v in index.entries()]
    for i in range(0, len(rows), 10_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 10_000]), _CLASS)],
            schema=_CLASS)


def _keyed(docs: DataFrame) -> DataFrame:
    return common.columns(docs, {"doc_id": "long", "text": "string"}) \
        .withColumn("uid", F.monotonically_increasing_id())


_ddl = "digest binary, doc_id long, uid long, n long, op int, content binary"


def _partitions(docs: DataFrame) -> int:
    """Partitions of the index: as many as its texts need, whatever the session's
    setting, since a task holds its partition's texts."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // INDEX_BYTES))


def build_index(docs: DataFrame, deletes: DataFrame | None = None) -> DataFrame:
    """Live texts: (digest, keep_id, keep_uid, group_size).

    ``deletes`` (a frame with a ``text`` column) takes its texts out again
    after all insertions."""
    records = _keyed(docs).mapInArrow(_combine(INSERT), _ddl)
    if deletes is not None:
        gone = deletes.select(F.lit(None).cast("long").alias("doc_id"), "text")
        records = records.unionByName(_keyed(gone).mapInArrow(_combine(DELETE), _ddl))
    return records.repartition(_partitions(docs), "digest").mapInArrow(
        _index, "digest binary, keep_id long, keep_uid long, group_size long")


def dedup(docs: DataFrame, deletes: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, uid.

    ``uid`` is the row's position id in ``docs``.  Rows whose text was deleted
    from the index are left out."""
    rows = _keyed(docs).mapInArrow(_digests, "doc_id long, uid long, digest binary")
    index = build_index(docs, deletes)
    # The side of the rows may be hot on one digest; it is split by the
    # adaptive skew join, the index side holds a digest once.
    return rows.join(index, "digest").select(
        "doc_id", "keep_id", "group_size",
        (F.col("uid") == F.col("keep_uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "uid")


def keep_latest(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns."""
    uid = common.fresh(docs, "_row_id")
    stay = dedup(docs).filter("kept").select(F.col("uid").alias(uid))
    return docs.withColumn(uid, F.monotonically_increasing_id()) \
        .join(stay, uid, "left_semi").drop(uid)
