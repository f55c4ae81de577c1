"""Removal of repeated passages with a distributed sparse suffix array.

Every byte covered by a ``window``-byte string that also starts in a document
of a smaller doc_id is removed.

1. Suffixes are sampled by content: of each window the suffix at its least
   ``LEAD``-gram by hash.  Equal windows sample the same place of their bytes,
   so no repeated window is lost, and about one suffix in 17 is kept.
2. Splitters from a bounded sample range-partition the suffixes by their
   leading tokens (8-byte words of the text).  A key is followed by a hash of
   its document, so equal suffixes, however many, split over several buckets.
3. A bucket sorts its suffixes by multikey quicksort: by the first token, each
   run of equals by the next.  Neighbours that agree in their leading tokens
   form a group; one that a splitter cuts goes on in the next bucket.
4. Members of a group whose windows cover the same bytes (their context) form a
   class.  All windows of a member are removed if its class holds a smaller
   document.  What is left, the first document of each class where a group has
   several, may still share single windows with another class:
   groups within a bucket send these contexts' bytes to one more bucket, which
   compares their windows; groups of more than ``near_classes`` classes and
   those across bucket boundaries compare single windows by a minimum and a
   join on the window's 128-bit hash, which combines before it shuffles and
   splits hot keys.  Both give the same answer, so nothing depends on a limit.
5. The removed places return to the texts, which travel once, in compressed
   slices of about ``slice_bytes``.

Suffixes travel in compressed blocks, one for each slice and bucket, and what
a task holds is bounded by a slice or a bucket.

Defined results: a null text is empty; a text shorter than the window loses
nothing; strings never cross documents; a null doc_id ranks above all others
and rows with equal doc_id never remove each other's bytes.  Empty tables give
no rows; extra columns are ignored.  ``docs`` must be replayable in the same
order, as a stored table is.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 50
LEAD = 16
#: Text bytes of a slice and of a bucket; of the sample that splitters come from, at least, and for
#: each bucket (some hundred candidates).
SLICE_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
SAMPLE_BYTES = 16 << 20
SAMPLE_BUCKET_BYTES = 16 << 10
#: Most rows of a slice, empty texts included (``_runs`` packs a row's number above 40 bits).
SLICE_ROWS = 1 << 16
#: Most buckets: the splitters (24 bytes each, at most two a bucket) go to every task.  Buckets grow
#: beyond ``BUCKET_BYTES`` above 8 TB of text (100 MB each at 100 TB, with some six candidates a MB).
MAX_BUCKETS = 1 << 20
#: One suffix in so many of the sampled documents is a splitter candidate.
SAMPLE_EVERY = 8
NEAR_CLASSES = 1 << 16
#: Rows of a batch of single windows.
WINDOW_ROWS = 1 << 15
#: Low bits of a suffix's order that hold its place among the texts sampled at once.
PLACE_BITS = 25
#: Longer texts are sampled in pieces; each has so many bytes and those its last window needs.
PIECE_BYTES = common.SLICE_BYTES

REMOVED, NEAR, WIDE = 0, 1, 2
_LAST = np.iinfo(np.int64).max

MIX = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0x2545F4914F6CDD1D, 0xD1342543DE82EF95)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:                    # doubling: out[done:2 done] = out[:done] * base ** done
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


class Rolling:
    """Hashes of all substrings of a byte array from one prefix sum: byte i
    adds table[byte] * base ** i (mod 2 ** 64), base odd."""

    def __init__(self, text: np.ndarray, which: int = 0):
        base = _BASES[which]
        table = np.random.default_rng(which + 1).integers(1, 1 << 63, 256, np.uint64)
        n = len(text)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[text] * _powers(base, n), out=self.sums[1:])
        self.inverse = _powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


@dataclass
class Anchors:
    """Sampled suffixes: text index, start of the suffix, first and last start
    of the windows that sample it, all within the text; hash of the bytes that
    those windows cover."""
    text: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    context: np.ndarray
    words: np.ndarray       # leading tokens, one row of uint64 for each suffix


def sample_suffixes(texts: list[bytes], window: int, lead: int) -> Anchors:
    """Of each window the suffix that starts at its least ``lead``-gram (by
    hash, the first of equal ones).  Equal windows sample the same place."""
    if sum(map(len, texts)) > 1 << PLACE_BITS:
        raise ValueError(f"at most {1 << PLACE_BITS} bytes at once")
    lens = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lens)
    starts = ends - lens
    flat = np.frombuffer(b"".join(texts), np.uint8)
    n = len(flat) - window + 1
    if n <= 0:
        return Anchors(*(np.empty(0, np.int64) for _ in range(4)), np.empty(0, np.uint64),
                       np.empty((0, lead // 8), np.uint64))
    roll = Rolling(flat)
    grams = len(flat) - lead + 1
    at = np.arange(grams)
    # the hash orders, the place in the low bits breaks ties and comes back
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (mixed(roll.of(at, at + lead)) & ~low) | at.astype(np.uint64)
    span, width = window - lead + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    place = (least[:n] & low).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lens)[:n]
    inside = np.arange(n) + window <= ends[owner]
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    # a run of windows ends before the first one that leaves the text
    first = np.flatnonzero(new & inside)
    valid_end = np.flatnonzero(inside & np.r_[new[1:] | ~inside[1:], True])
    at, text = place[first], owner[first]
    covered = roll.of(first, valid_end + window) ^ mixed((at - first).astype(np.uint64) * np.uint64(64)
                                                         + (valid_end - first).astype(np.uint64))
    lead_bytes = flat[at[:, None] + np.arange(lead)]
    words = np.ascontiguousarray(lead_bytes).view(">u8").astype(np.uint64)
    off = starts[text]
    return Anchors(text, at - off, first - off, valid_end - off, mixed(covered), words)


def multikey_order(tokens: list[np.ndarray]) -> np.ndarray:
    """Order of the rows by their tokens: quicksort by the first, then each run
    of equal rows by the next, until all differ or the tokens end."""
    order = np.argsort(tokens[0])
    same = np.zeros(len(order) + 1, bool)             # equal to the row before
    same[1:-1] = tokens[0][order[1:]] == tokens[0][order[:-1]]
    for token in tokens[1:]:
        tied = same[:-1] | same[1:]
        if not tied.any():
            break
        rows = order[tied]
        run = np.cumsum(~same[:-1])[tied]
        order[tied] = rows[np.lexsort((token[rows], run))]
        same[1:-1] &= token[order[1:]] == token[order[:-1]]
    return order


def _pack(*parts) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(parts, 5))


def _unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


@dataclass
class Slice:
    """Consecutive rows of the table; ``number`` is the position id of the first."""
    number: int
    ids: list
    texts: list[bytes]

    @property
    def ranks(self) -> np.ndarray:
        return np.array([_LAST if i is None else i for i in self.ids], np.int64)

    def packed(self) -> bytes:
        return _pack(self.ids, np.array([len(t) for t in self.texts], np.int64), b"".join(self.texts))

    @staticmethod
    def unpacked(number: int, blob: bytes) -> "Slice":
        ids, lens, joined = _unpack(blob)
        ends = np.cumsum(lens)
        return Slice(number, ids, [joined[e - n:e] for n, e in zip(lens, ends)])


def _slices(batches, slice_bytes: int) -> Iterator[Slice]:
    """The same slices whatever the batches are: closed by text bytes or rows."""
    number, ids, texts, size = None, [], [], 0
    for batch in common.slices(batches, "text"):
        for uid, doc_id, text in zip(batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist(),
                                     common.byte_texts(batch.column("text"))):
            number = uid if number is None else number
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= slice_bytes or len(ids) == SLICE_ROWS:
                yield Slice(number, ids, texts)
                number, ids, texts, size = None, [], [], 0
    if ids:
        yield Slice(number, ids, texts)


def _suffixes(part: Slice, window: int, piece_bytes: int = PIECE_BYTES) -> Anchors:
    """The sampled suffixes of the slice.  A long text is sampled in pieces that
    overlap by a window less one byte, so each window lies in one piece; a run
    of windows that a piece ends goes on in the next."""
    found, i = [], 0
    while i < len(part.texts):
        j, size = i, 0
        while j < len(part.texts) and (size == 0 or size + len(part.texts[j]) <= piece_bytes):
            size += len(part.texts[j])
            j += 1
        for off in range(0, size, piece_bytes) if size > piece_bytes else (0,):
            # only a text alone is longer than a piece, but empty ones may stand before it
            texts = part.texts[i:j] if size <= piece_bytes else [part.texts[j - 1][off:off + piece_bytes + window - 1]]
            one = sample_suffixes(texts, window, LEAD)
            one.text = one.text + (i if size <= piece_bytes else j - 1)
            one.at, one.first, one.last = one.at + off, one.first + off, one.last + off
            found.append(one)
        i = j
    return Anchors(*(np.concatenate([getattr(a, f) for a in found])
                     for f in ("text", "at", "first", "last", "context", "words")))


def _keys(words: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Leading tokens and the document's hash as bytes that compare in order."""
    return np.ascontiguousarray(np.column_stack([words, tie]).astype(">u8")).view(f"S{LEAD + 8}").ravel()


def _ties(part: Slice, text: np.ndarray) -> np.ndarray:
    return mixed(np.uint64(part.number) + text.astype(np.uint64))


def _splitters(rows: DataFrame, window: int, slice_bytes: int, piece_bytes: int, total: int,
               buckets: int) -> np.ndarray:
    """Keys that cut the sampled suffixes evenly.

    The sample grows with the buckets and is sorted by Spark; only the cuts, every
    so many candidates, reach the driver."""
    def keys(batches):
        for part in _slices(batches, slice_bytes):
            a = _suffixes(part, window, piece_bytes)
            tie = _ties(part, a.text)
            some = mixed(tie ^ a.at.astype(np.uint64)) % np.uint64(SAMPLE_EVERY) == 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.ljust(LEAD + 8, b"\0") for k in _keys(a.words[some], tie[some]).tolist()],
                          pa.binary())], names=["k"])
    draw = F.shiftrightunsigned(F.xxhash64("uid"), 11) / float(1 << 53)
    share = min(1.0, max(SAMPLE_BYTES, buckets * SAMPLE_BUCKET_BYTES) / max(total, 1))
    sample = common.cut(rows.filter(draw < share).mapInArrow(keys, "k binary"))
    ordered = common.cut(sample.repartitionByRange("k").sortWithinPartitions("k")).select(
        "k", F.spark_partition_id().alias("task"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    counts = {r.task: r["n"] for r in ordered.groupBy("task").agg(F.count("*").alias("n")).collect()}
    before, size = {}, 0
    for task in sorted(counts):
        before[task], size = size, size + counts[task]
    # never a candidate twice: then a lead that several cuts have is one group
    buckets = min(buckets, max(1, size // 2))
    if size and buckets > 1:
        offsets = rows.sparkSession.createDataFrame(sorted(before.items()), "task int, before long")
        at = F.col("before") + F.col("row")
        # candidate number size * i // buckets, for i from 1
        i = F.ceil(at * buckets / size)
        wanted = ordered.join(offsets, "task").withColumn("at", at).withColumn("i", i.cast("long")) \
            .filter((F.col("i") > 0) & (F.col("i") < buckets) & (F.floor(F.col("i") * size / buckets) == F.col("at")))
        return cut_keys([bytes(r.k) for r in wanted.select("k").collect()])
    return cut_keys([])


def cut_keys(cuts: list[bytes]) -> np.ndarray:
    """A cut lies before the first of equal suffixes; only a group that several
    cuts fall into, so one larger than a bucket, is also cut inside."""
    fell = Counter(c[:LEAD] for c in cuts)
    inside = {c for c in cuts if fell[c[:LEAD]] > 1}
    return np.array(sorted({lead.ljust(LEAD + 8, b"\0") for lead in fell} | inside), f"S{LEAD + 8}")


def _blocks(window: int, slice_bytes: int, piece_bytes: int, splitters):
    """(bucket, slice, block) of each slice's suffixes, sorted within the block."""
    def run(batches):
        cuts = splitters.value
        for part in _slices(batches, slice_bytes):
            a = _suffixes(part, window, piece_bytes)
            tie, ranks = _ties(part, a.text), part.ranks
            order = multikey_order([a.words[:, 0], a.words[:, 1], tie])
            keys = _keys(a.words[order], tie[order])
            ends = np.r_[0, np.searchsorted(keys, cuts), len(order)]
            rows = []
            for bucket in np.flatnonzero(np.diff(ends)):
                o = order[ends[bucket]:ends[bucket + 1]]
                docs, doc = np.unique(a.text[o], return_inverse=True)
                rows.append((int(bucket), part.number, _pack(
                    a.words[o].astype(">u8"), a.context[o], docs.astype(np.int32), ranks[docs],
                    doc.astype(np.uint16 if len(docs) <= 1 << 16 else np.int32),
                    a.first[o].astype(np.int32), (a.at - a.first)[o].astype(np.uint8),
                    (a.last - a.first)[o].astype(np.uint8))))
            if rows:
                yield _batch(rows, (pa.int32(), pa.int64(), pa.binary()), ("bucket", "slice", "block"))
    return run


def _batch(rows: list[tuple], types, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=list(names))


def _starts(flags: np.ndarray) -> np.ndarray:
    return np.flatnonzero(flags)


def _resolve(splitters, near_classes: int):
    """Groups and classes of one bucket: (slice, wide, spans) for each slice."""
    def run(batches):
        bucket, numbers, blocks = None, [], []
        for batch in batches:
            for b, number, block in zip(*(c.to_pylist() for c in batch.columns)):
                bucket = b
                numbers.append(number)
                blocks.append(_unpack(block))
        if not blocks:
            return
        words = np.concatenate([b[0] for b in blocks]).astype(np.uint64)
        context = np.concatenate([b[1] for b in blocks])
        of = np.repeat(np.arange(len(blocks)), [len(b[0]) for b in blocks])
        doc = np.concatenate([b[2][b[4]] for b in blocks])
        rank = np.concatenate([b[3][b[4]] for b in blocks])
        first, off, span = (np.concatenate([b[i] for b in blocks]) for i in (5, 6, 7))
        del blocks
        order = multikey_order([words[:, 0], words[:, 1]])
        ordered = words[order]
        del words
        new = np.ones(len(order), bool)
        new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
        group = np.cumsum(new) - 1
        at_edge = np.zeros(group[-1] + 1, bool)
        cuts = splitters.value
        for cut in cuts[max(bucket - 1, 0):bucket + 1]:
            *edge, tie = np.frombuffer(cut.ljust(LEAD + 8, b"\0"), ">u8").astype(np.uint64)
            if tie == 0:                  # a cut between groups
                continue
            at_edge[group[(ordered == edge).all(axis=1)]] = True
        del ordered
        some = (np.bincount(group) > 1)[group] | at_edge[group]
        order, group = order[some], group[some]
        if not len(order):
            return
        by_class = np.lexsort((rank[order], context[order], group))
        order, group = order[by_class], group[by_class]
        edge = at_edge[group]
        new_group = np.r_[True, group[1:] != group[:-1]]
        new_class = new_group | np.r_[True, context[order[1:]] != context[order[:-1]]]
        r, g = rank[order], np.cumsum(new_group) - 1
        starts = _starts(new_group)
        classes = np.add.reduceat(new_class.astype(np.int64), starts)[g]
        several_docs = (np.maximum.reduceat(r, starts) > np.minimum.reduceat(r, starts))[g]
        class_first = r[_starts(new_class)][np.cumsum(new_class) - 1]
        state = np.full(len(order), 255, np.uint8)
        state[(several_docs & (classes > 1)) | edge] = NEAR
        state[(state == NEAR) & (edge | (classes > near_classes))] = WIDE
        state[r > class_first] = REMOVED
        told = state != 255
        order, state = order[told], state[told]
        by_slice = np.argsort(of[order], kind="stable")
        order, state = order[by_slice], state[by_slice]
        cuts_at = np.r_[_starts(np.r_[True, of[order[1:]] != of[order[:-1]]]), len(order)] if len(order) else []
        rows = []
        for a, b in zip(cuts_at[:-1], cuts_at[1:]):
            o, s = order[a:b], state[a:b]
            rows.append((numbers[of[o[0]]], bool((s == NEAR).any()), bool((s == WIDE).any()),
                         _pack(doc[o], first[o], off[o], span[o], s)))
        if rows:
            yield _batch(rows, (pa.int64(), pa.bool_(), pa.bool_(), pa.binary()),
                         ("slice", "near", "wide", "spans"))
    return run


def _merge(window: int):
    """Of each slice the removed spans as maximal runs, and the open ones."""
    def run(batches):
        for number, near, wide, blobs in _rows(batches, "slice", "near", "wide", "spans"):
            parts = [_unpack(b) for b in blobs]
            doc, first, off, span, state = (np.concatenate([p[i] for p in parts]) for i in range(5))
            gone = state == REMOVED
            start = first[gone].astype(np.int64)
            runs = _runs(doc[gone], start, start + span[gone] + window)
            left = ~gone
            order = np.lexsort((first[left], doc[left]))
            yield _batch([(number, near, wide, _pack(*(x.astype(np.int32) for x in runs)),
                           _pack(*(x[left][order] for x in (doc, first, off, span, state))))],
                         (pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary()),
                         ("slice", "near", "wide", "removed", "open"))
    return run


def _contexts(window: int, buckets: int):
    """(bucket, slice, block) of the contexts that are left, by leading tokens."""
    def run(batches):
        for number, texts, open_ in _rows(batches, "slice", "texts", "open"):
            part = Slice.unpacked(number, texts)
            doc, first, off, span, state = _unpack(open_)
            near = state == NEAR
            doc, first, off, span = doc[near], first[near], off[near], span[near]
            ranks = part.ranks[doc]
            cut = [part.texts[d][f:f + s + window] for d, f, s in
                   zip(doc.tolist(), first.tolist(), span.tolist())]
            to = np.array([int.from_bytes(hashlib.blake2b(c[o:o + LEAD], digest_size=4).digest(), "big") % buckets
                           for c, o in zip(cut, off.tolist())], np.int32)
            rows = []
            for b in np.unique(to):
                at = np.flatnonzero(to == b)
                rows.append((int(b), number, _pack(doc[at], ranks[at], first[at], span[at],
                                                   b"".join([cut[i] for i in at]))))
            if rows:
                yield _batch(rows, (pa.int32(), pa.int64(), pa.binary()), ("bucket", "slice", "block"))
    return run


def _rows(batches, *names):
    for batch in batches:
        cols = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield [c[i].as_py() for c in cols]


def _windows(texts: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of the window at each start, as two words."""
    return tuple(mixed(Rolling(texts, i).of(starts, starts + window)) for i in (0, 1))


def _expand(first: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the span and the start of every window in the spans."""
    n = span.astype(np.int64) + 1
    of = np.repeat(np.arange(len(n)), n)
    return of, first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)


def _compare(window: int):
    """Windows of the bucket's contexts that start in a smaller document too."""
    def run(batches):
        numbers, blocks = [], []
        for number, block in _rows(batches, "slice", "block"):
            numbers.append(number)
            blocks.append(_unpack(block))
        if not blocks:
            return
        part = np.repeat(np.arange(len(blocks)), [len(b[0]) for b in blocks])
        doc, rank, first, span = (np.concatenate([b[i] for b in blocks]) for i in range(4))
        text = np.frombuffer(b"".join([b[4] for b in blocks]), np.uint8)
        del blocks
        lens = span.astype(np.int64) + window
        of, at = _expand(np.cumsum(lens) - lens, span)
        one, two = _windows(text, at, window)
        order = np.lexsort((rank[of], two, one))
        one, two, owner = one[order], two[order], of[order]
        new = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
        r = rank[owner]
        gone = order[r > r[_starts(new)][np.cumsum(new) - 1]]
        of, at = of[gone], at[gone]
        start = first[of] + at - (np.cumsum(lens) - lens)[of]
        by_slice = np.argsort(part[of], kind="stable")
        of, start = of[by_slice], start[by_slice]
        rows = []
        for p in np.unique(part[of]):
            a, b = np.searchsorted(part[of], [p, p + 1])
            rows.append((numbers[p], _pack(doc[of[a:b]], start[a:b].astype(np.int32))))
        if rows:
            yield _batch(rows, (pa.int64(), pa.binary()), ("slice", "starts"))
    return run


def _wide_windows(window: int):
    """Single windows of the spans of large or cut groups."""
    def run(batches):
        for number, texts, open_ in _rows(batches, "slice", "texts", "open"):
            part = Slice.unpacked(number, texts)
            doc, first, off, span, state = _unpack(open_)
            wide = state == WIDE
            doc, first, span = doc[wide], first[wide].astype(np.int64), span[wide]
            found = []
            for d in np.unique(doc):
                mine = doc == d
                _, at = _expand(first[mine], span[mine])
                one, two = _windows(np.frombuffer(part.texts[d], np.uint8), at, window)
                found.append((one.view(np.int64), two.view(np.int64), np.full(len(at), d, np.int32),
                              at.astype(np.int32)))
            if found:
                yield from _by_window(number, part.ranks, *(np.concatenate(c) for c in zip(*found)))
    return run


def _by_window(number: int, ranks: np.ndarray, one: np.ndarray, two: np.ndarray, doc: np.ndarray,
               start: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each distinct window of a slice: its place of least rank, the
    greatest rank, and the other places.  A window that a large group shares is
    then one row a slice on its way to the join, not one a document."""
    order = np.lexsort((start, ranks[doc], two, one))
    one, two, doc, start = one[order], two[order], doc[order], start[order]
    rank = ranks[doc]
    head = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
    at = _starts(head)
    sizes = np.diff(np.r_[at, len(one)])
    rest = pa.StructArray.from_arrays([pa.array(c[~head]) for c in (rank, doc, start)], ["rank", "doc", "start"])
    more = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes - 1)].astype(np.int32)), rest,
                                    mask=pa.array(sizes == 1))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(one[at]), pa.array(two[at]), pa.array(rank[at]), pa.array(rank[at + sizes - 1]),
         pa.array(np.full(len(at), number)), pa.array(doc[at]), pa.array(start[at]), more],
        names=["one", "two", "rank", "most", "slice", "doc", "start", "more"])
    for i in range(0, batch.num_rows, WINDOW_ROWS):
        yield batch.slice(i, WINDOW_ROWS)


def _runs(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs (doc, start, end) of the intervals; touching ones join."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order].astype(np.int64), start[order].astype(np.int64), end[order].astype(np.int64)
    if not len(doc):
        return doc, start, end
    reach = np.maximum.accumulate(doc * (1 << 40) + end)
    new = np.r_[True, (doc[1:] * (1 << 40) + start[1:]) > reach[:-1]]
    at = _starts(new)
    last = np.r_[at[1:], len(doc)] - 1
    return doc[at], start[at], reach[last] - doc[at] * (1 << 40)


#: What ``remove_repeats`` can add for each document.
OUTPUTS = {
    "spans": ("array<struct<start:bigint,end:bigint>>",
              pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    "kept": ("binary", pa.binary()),
}


def _finish(window: int, outputs: tuple[str, ...]):
    def run(batches):
        for number, texts, removed, found in _rows(batches, "slice", "texts", "removed", "found"):
            part = Slice.unpacked(number, texts)
            doc, start, end = (np.empty(0, np.int64) for _ in range(3))
            if removed:
                doc, start, end = (x.astype(np.int64) for x in _unpack(removed))
            if found:
                more = [_unpack(x) for x in found]
                d, f = (np.concatenate([m[i] for m in more]) for i in (0, 1))
                doc, start, end = np.r_[doc, d], np.r_[start, f], np.r_[end, f.astype(np.int64) + window]
            doc, start, end = _runs(doc, start, end)
            cuts = np.searchsorted(doc, np.arange(len(part.texts) + 1))
            start, end = start.tolist(), end.tolist()
            rows = []
            for i, (doc_id, text) in enumerate(zip(part.ids, part.texts)):
                runs = list(zip(start[cuts[i]:cuts[i + 1]], end[cuts[i]:cuts[i + 1]]))
                kept, at = [], 0
                for a, b in runs:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                row = [doc_id, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()]
                if "spans" in outputs:
                    row.append([{"start": a, "end": b} for a, b in runs])
                if "kept" in outputs:
                    row.append(kept)
                rows.append(tuple(row))
            yield _batch(rows, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                                *(OUTPUTS[o][1] for o in OUTPUTS if o in outputs)),
                         ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                          *(o for o in OUTPUTS if o in outputs)))
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, outputs: tuple[str, ...] = (),
                   slice_bytes: int = SLICE_BYTES, bucket_bytes: int = BUCKET_BYTES,
                   near_classes: int = NEAR_CLASSES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and
    the asked ``outputs``: the removed spans, the kept bytes.  The last four
    arguments size the work; the result does not depend on them."""
    if not LEAD <= window <= LEAD + 64:
        raise ValueError(f"window from {LEAD} to {LEAD + 64}")
    sc = docs.sparkSession.sparkContext
    rows = common.columns(docs, {"doc_id": "long", "text": "string"}) \
        .withColumn("uid", F.monotonically_increasing_id())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                  min(-(-total // bucket_bytes), MAX_BUCKETS))
    splitters = sc.broadcast(_splitters(rows, window, slice_bytes, piece_bytes, total, buckets))
    buckets = len(splitters.value) + 1

    def packed(batches):
        for part in _slices(batches, slice_bytes):
            yield _batch([(part.number, part.packed())], (pa.int64(), pa.binary()), ("slice", "texts"))

    # "not null" keeps the plans over the slices alike, so that their one
    # exchange serves all three joins
    slices = rows.mapInArrow(packed, "slice long not null, texts binary")
    spans = common.cut(
        rows.mapInArrow(_blocks(window, slice_bytes, piece_bytes, splitters), "bucket int, slice long, block binary")
        .repartitionById(buckets, F.col("bucket"))
        .mapInArrow(_resolve(splitters, near_classes), "slice long, near boolean, wide boolean, spans binary")
        .groupBy("slice").agg(F.max("near").alias("near"), F.max("wide").alias("wide"),
                              F.collect_list("spans").alias("spans"))
        .mapInArrow(_merge(window), "slice long, near boolean, wide boolean, removed binary, open binary"))
    joined = slices.join(spans, "slice", "left")
    near = joined.filter("near").select("slice", "texts", "open") \
        .mapInArrow(_contexts(window, buckets), "bucket int, slice long, block binary") \
        .repartitionById(buckets, F.col("bucket")) \
        .mapInArrow(_compare(window), "slice long, starts binary")
    single = joined.filter("wide").select("slice", "texts", "open").mapInArrow(
        _wide_windows(window), "one long, two long, rank long, most long, slice long, doc int, start int, "
                               "more array<struct<rank:bigint,doc:int,start:int>>")
    least = single.groupBy("one", "two").agg(F.min("rank").alias("least"), F.max("most").alias("last")) \
        .filter("least < last").drop("last")

    def gathered(batches):
        for number, found in _rows(batches, "slice", "found"):
            yield _batch([(number, _pack(np.array([x["doc"] for x in found], np.int32),
                                         np.array([x["start"] for x in found], np.int32)))],
                         (pa.int64(), pa.binary()), ("slice", "starts"))

    places = F.concat(F.array(F.struct("rank", "doc", "start")),
                      F.coalesce("more", F.array().cast("array<struct<rank:bigint,doc:int,start:int>>")))
    wide = single.join(least, ["one", "two"]).filter("most > least") \
        .select("slice", "least", F.explode(places).alias("p")).filter("p.rank > least") \
        .groupBy("slice").agg(F.collect_list(F.struct("p.doc", "p.start")).alias("found")) \
        .mapInArrow(gathered, "slice long, starts binary")
    found = near.unionByName(wide).groupBy("slice").agg(F.collect_list("starts").alias("found"))
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + "".join(
        f", {o} {OUTPUTS[o][0]}" for o in OUTPUTS if o in outputs)
    return joined.join(found, "slice", "left").select("slice", "texts", "removed", "found") \
        .mapInArrow(_finish(window, outputs), ddl)
