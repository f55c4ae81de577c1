"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is normalised by the library and cut into segments that no merge can
join: before a space mark that follows another character (if no piece of the
vocabulary holds such a place) and around characters that stand in no longer
piece.  Each segment is encoded by a score-ordered agenda of adjacent symbol
pairs: the pair of the best score, leftmost among equals, is merged first, and
the pairs that the merged symbol forms with its neighbours join the agenda.
Symbols without a piece become their UTF-8 byte pieces.  Short segments of a
batch keep their agendas as rows of one matrix; a long one has a heap.

Every segment encoded this way is checked against the sentencepiece library in
the Arrow batch that brings it; a difference raises.  Where the model has no
character that stands alone, or normalises more than spaces, whole texts are
checked instead.  Segments met again are looked up, so a batch costs its
distinct words.

Memory: a text, its normalised form and one stretch of ids are held at a time.
A segment above ``LONG_SEGMENT`` characters is first cut wherever no piece holds
the two characters side by side; only a run without such a place (one character
repeated, say) stands whole in the agenda, at some hundred bytes a character.

Defined results: null is taken as empty; an empty text has the begin and end ids
alone and decodes to an empty text; strings of control pieces are ordinary text;
rows of equal texts get equal results each; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import operator
import os
import re
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: Stands for a space in pieces.
MARK = "▁"
#: Segments above this length are cut at safe places and not remembered.
LONG_SEGMENT = 256
#: Segments a worker remembers in each of two generations.
REMEMBERED = 1 << 19
#: Cells of the matrix in which many segments are merged side by side.
CELLS = 1 << 16
#: A symbol merged into its neighbour, or none; the rank of no pair.
GONE, NEVER = -1, 1 << 40
#: Segments of a text handled at once, and so the ids decoded at once.
STRETCH = 1 << 15
#: Model files above this size are refused (they are sent to every executor).
MAX_MODEL_BYTES = 64 << 20

# Fixed values of the model file's format: the kinds of pieces and the merge type.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGE_TYPE = 2

_ENCODERS: dict[str, "Encoder"] = {}


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message of the model file."""
    at, n = 0, len(message)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < n:
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            yield number, message[at:at + size]
            at += size


class Vocabulary:
    """What the agenda needs of a model file."""

    def __init__(self, model: bytes):
        self.rank: dict[str, int] = {}     # a normal piece's place by score, equal scores alike
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = 0
        scores, model_type, normaliser = {}, 1, {}
        for place, (number, value) in enumerate(f for f in _fields(model) if f[0] == 1):
            piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
            text, score, kind = piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]
            if kind == NORMAL:
                scores[text], self.ids[text] = score, place
            elif kind == BYTE:
                self.bytes[int(text[3:5], 16)] = place
            elif kind == UNKNOWN:
                self.unknown = place
            elif kind in (USER_DEFINED, UNUSED):
                raise ValueError("vocabularies with user-defined or unused pieces are not supported")
        for number, value in _fields(model):
            if number == 2:
                model_type = dict(_fields(value)).get(3, 1)
            elif number == 3:
                normaliser = dict(_fields(value))
        if model_type != MERGE_TYPE:
            raise ValueError("not a merge-type vocabulary")
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no piece for every byte")
        order = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {text: order[score] for text, score in scores.items() if len(text) > 1}
        #: Characters that stand side by side in some piece.
        self.beside = {text[i:i + 2] for text in self.rank for i in range(len(text) - 1)}
        inside = set().union(*self.rank) if self.rank else set()
        self.alone = [c for c in "\n\t\r\x0b\x0c" if c not in inside]
        self.marks_lead = not any(b[0] != MARK and b[1] == MARK for b in self.beside)
        self._tables()
        #: Nothing but spaces is changed before the pieces are sought.
        self.plain = not normaliser.get(2) and normaliser.get(4, 1) == 0 and normaliser.get(5, 1) == 1


    def _tables(self) -> None:
        """The same merges by number: symbols are piece ids, then the characters
        that stand only in longer pieces, then one for all others."""
        singles = sorted({c for text in self.rank for c in text} - set(self.ids))
        self.size = max([*self.ids.values(), *self.bytes.values(), self.unknown]) + 1
        number = self.ids | {c: self.size + i for i, c in enumerate(singles)}
        other = self.size + len(singles)
        self.symbol_of = np.full(0x110000, other, np.int64)
        for text, i in number.items():
            if len(text) == 1:
                self.symbol_of[ord(text)] = i
        pairs = [(number[text[:i]] << 32 | number[text[i:]], rank, self.ids[text])
                 for text, rank in self.rank.items() for i in range(1, len(text))
                 if text[:i] in number and text[i:] in number]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.pair_keys, self.pair_ranks, self.pair_pieces = (np.ascontiguousarray(table[:, j]) for j in range(3))

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or ``NEVER``) and merged symbol of pairs of symbols."""
        keys = left << 32 | right
        if not len(self.pair_keys):
            return np.full(keys.shape, NEVER, np.int64), np.zeros(keys.shape, np.int64)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_ranks[at], NEVER), self.pair_pieces[at]

    def byte_ids(self, symbol: str) -> list[int]:
        return [self.bytes[b] for b in symbol.encode()]


class Encoder:
    """Ids of texts and texts of ids under one model."""

    def __init__(self, model: bytes, check: bool = True):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.v = v = Vocabulary(model)
        lone = re.escape("".join(v.alone))
        self.segment = re.compile(f"{MARK}+[^{MARK}{lone}]*|[^{MARK}{lone}]+" + (f"|[{lone}]" if lone else "")
                                  if v.marks_lead else r"(?s).+")
        self.check = check
        self.by_segment = bool(check and v.alone and v.plain)
        self.lone = v.alone[0] if v.alone else ""
        # segments remembered: those met lately and those met before them
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # an ordinary first id, so that a stretch's leading space is kept
        self.guard = next(i for p, i in v.ids.items() if len(p) == 1 and p != MARK)
        self.guard_text = self.library.decode([self.guard])
        self.begin = [i for i in [self.library.bos_id()] if i >= 0]
        self.end = [i for i in [self.library.eos_id()] if i >= 0]

    # one segment

    def agenda(self, segment: str) -> list[int]:
        """Ids of a segment: adjacent pairs are merged best score first."""
        rank, n = self.v.rank, len(segment)
        symbols = list(segment)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = []
        for i in range(n - 1):
            r = rank.get(segment[i:i + 2])
            if r is not None:
                pairs.append((r, i, 2))
        heapq.heapify(pairs)
        while pairs:
            _, left, size = heapq.heappop(pairs)
            right = after[left]
            if not symbols[left] or right >= n or len(symbols[left]) + len(symbols[right]) != size:
                continue                                   # one of the two was merged meanwhile
            merged = symbols[left] + symbols[right]
            symbols[left], symbols[right] = merged, ""
            following = after[left] = after[right]
            if following < n:
                before[following] = left
                r = rank.get(merged + symbols[following])
                if r is not None:
                    heapq.heappush(pairs, (r, left, size + len(symbols[following])))
            previous = before[left]
            if previous >= 0:
                r = rank.get(symbols[previous] + merged)
                if r is not None:
                    heapq.heappush(pairs, (r, previous, size + len(symbols[previous])))
        ids: list[int] = []
        for symbol in symbols:
            if symbol:
                known = self.v.ids.get(symbol)
                ids += self.v.byte_ids(symbol) if known is None else [known]
        return ids

    def _long(self, segment: str) -> bytes:
        """Ids of a long segment, cut where no piece reaches across."""
        out, start, beside = bytearray(), 0, self.v.beside
        for i in [*(i for i in range(1, len(segment)) if segment[i - 1:i + 1] not in beside), len(segment)]:
            out += array("I", self.agenda(segment[start:i])).tobytes()
            start = i
        return bytes(out)

    # many segments

    def agendas(self, segments: list[str]) -> list[bytes]:
        """Ids of segments of about one length, merged side by side.

        A row of ``score`` is one segment's agenda: at each symbol the rank of
        the pair it forms with the next one.  Every round merges each row's
        best pair (``argmin`` finds the leftmost of equals) and looks up the
        two pairs that the merge made; rows without a pair are done."""
        v, k = self.v, len(segments)
        lengths = np.fromiter(map(len, segments), np.int64, k)
        width = int(lengths.max())
        inside = np.arange(width) < lengths[:, None]
        symbol = np.full((k, width), GONE, np.int64)
        symbol[inside] = v.symbol_of[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)]
        characters = symbol.copy() if (symbol >= v.size).any() else None
        after = np.tile(np.arange(1, width + 1), (k, 1))
        before = np.tile(np.arange(-1, width - 1), (k, 1))
        score, merged = np.full((k, width), NEVER, np.int64), np.zeros((k, width), np.int64)
        if width > 1:
            score[:, :-1], merged[:, :-1] = v.pair(symbol[:, :-1], symbol[:, 1:])
        rows = np.arange(k)
        while len(rows):
            left = score[rows].argmin(1)
            open_ = score[rows, left] < NEVER
            rows, left = rows[open_], left[open_]
            right = after[rows, left]
            symbol[rows, left], symbol[rows, right] = merged[rows, left], GONE
            score[rows, left] = score[rows, right] = NEVER
            following = after[rows, left] = after[rows, right]
            has = following < width
            r, c, f = rows[has], left[has], following[has]
            before[r, f] = c
            score[r, c], merged[r, c] = v.pair(symbol[r, c], symbol[r, f])
            previous = before[rows, left]
            has = previous >= 0
            r, c, p = rows[has], left[has], previous[has]
            score[r, p], merged[r, p] = v.pair(symbol[r, p], symbol[r, c])
        left_over = symbol != GONE
        ids, ends = symbol[left_over], left_over.sum(1).cumsum()
        packed = ids.astype(np.uint32).tobytes()
        out = [packed[4 * a:4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        if characters is not None:                         # characters without a piece
            for row in np.flatnonzero((symbol >= v.size).any(1)).tolist():
                row_ids: list[int] = []
                for i in np.flatnonzero(left_over[row]).tolist():
                    s = int(symbol[row, i])
                    row_ids += [s] if s < v.size else v.byte_ids(segments[row][i])
                out[row] = array("I", row_ids).tobytes()
        return out

    def encode_segments(self, segments: list[str]) -> dict[str, bytes]:
        """Each segment's ids, by agenda, as 32-bit integers."""
        found = {s: self._long(s) for s in segments if len(s) > LONG_SEGMENT}
        short = sorted((s for s in segments if len(s) <= LONG_SEGMENT), key=len)
        at = 0
        while at < len(short):
            # as many as fit a matrix of CELLS cells, none over twice the shortest
            most = 2 * len(short[at]) + 8
            end = at
            while end < len(short) and len(short[end]) <= most and (end - at) * len(short[end]) < CELLS:
                end += 1
            end = max(end, at + 1)
            found.update(zip(short[at:end], self.agendas(short[at:end])))
            at = end
        return found

    # whole texts

    def learn(self, segments: Iterable[str]) -> dict[str, bytes]:
        """The ids of each distinct segment of one stretch or batch."""
        wanted = set(segments)
        new = [s for s in wanted if s not in self.known]
        if len(self.known) + len(new) > REMEMBERED and new:
            self.older, self.known, new = self.known, {}, list(wanted)
        known = self.known
        known.update([(s, self.older[s]) for s in new if s in self.older])
        found = self.encode_segments([s for s in new if s not in known])
        if self.by_segment and found:
            self._compare(found)
        long = {s: p for s, p in found.items() if len(s) > LONG_SEGMENT}
        known.update((s, p) for s, p in found.items() if s not in long)
        return known | long if long else known

    def _compare(self, found: dict[str, bytes]) -> None:
        """Holds the segments' ids against the library's, which encodes all of
        them as one text with a character that stands alone before each."""
        lone = self.lone
        stop = array("I", self.agenda(lone)).tobytes()
        text = "".join([lone + s.replace(MARK, " ") for s in found])
        want = array("I", self.library.encode(text, add_bos=False, add_eos=False)).tobytes()
        have = b"".join([stop + p for p in found.values()])
        if want != array("I", self.agenda(MARK)).tobytes() + have:
            for s, p in found.items():
                ids = array("I", self.agenda(MARK) + self.agenda(lone)).tobytes() + p
                if array("I", self.library.encode(lone + s.replace(MARK, " "))).tobytes() != ids:
                    raise ValueError(f"agenda and library differ on {s[:200]!r}")
            raise ValueError("agenda and library differ on a batch of segments")

    def segments(self, text: str) -> Iterator[str]:
        return map(operator.methodcaller("group"), self.segment.finditer(self.library.normalize(text)))

    def stretches(self, text: str) -> Iterator[bytes]:
        """The text's ids (32-bit integers) without begin and end, in stretches
        that end between two segments."""
        whole, found = [], self.segments(text)
        while segments := list(itertools.islice(found, STRETCH)):
            known = self.learn(segments)
            packed = b"".join([known[s] for s in segments])
            if self.check and not self.by_segment:
                whole.append(packed)
            yield packed
        if self.check and not self.by_segment:
            if array("I", b"".join(whole)).tolist() != self.library.encode(text):
                raise ValueError(f"agenda and library differ on {text[:200]!r}")

    def batch(self, texts: list[str]) -> Iterator[Iterable[bytes]]:
        """``stretches`` of each text; the new segments of all short texts of
        the batch are merged side by side."""
        if sum(map(len, texts)) > 4 * common.SLICE_BYTES or (self.check and not self.by_segment):
            yield from map(self.stretches, texts)
            return
        known = self.known
        split = [self.segment.findall(self.library.normalize(t)) for t in texts]
        found = [list(map(known.get, segments)) for segments in split]
        new = [s for segments, parts in zip(split, found) if None in parts
               for s, p in zip(segments, parts) if p is None]
        known = self.learn(new) if new else known
        for segments, parts in zip(split, found):
            if None in parts:
                parts = [known[s] if p is None else p for s, p in zip(segments, parts)]
            yield (b"".join(parts[i:i + STRETCH]) for i in range(0, len(parts), STRETCH))

    def decode(self, ids: Iterable[int]) -> str:
        return self.library.decode(list(ids))

    def decode_stretch(self, ids: list[int], first: bool) -> str:
        """What ``ids`` add to the decoded text."""
        if first:
            return self.library.decode(ids)
        return self.library.decode([self.guard, *ids])[len(self.guard_text):]


def encoder(model: bytes, check: bool) -> Encoder:
    key = f"{hashlib.sha256(model).hexdigest()}{check}"
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(model, check)
    return _ENCODERS[key]


def read_model(path: str) -> bytes:
    if os.path.getsize(path) > MAX_MODEL_BYTES:
        raise ValueError(f"model file above {MAX_MODEL_BYTES} bytes: {path}")
    with open(path, "rb") as f:
        return f.read()


#: What ``encode`` can add for each document.
OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32())),
    "n_tokens": ("long", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def _little(packed: array) -> bytes:
    if struct.pack("=I", 1) != struct.pack("<I", 1):
        packed = array("I", packed)
        packed.byteswap()
    return packed.tobytes()


def _row(enc: Encoder, stretches: Iterable[bytes], outputs: tuple[str, ...]) -> dict:
    """The asked outputs of one text, built stretch by stretch."""
    ids, n = array("I"), 0
    id_hash, text_hash, texts = hashlib.sha256(), hashlib.sha256(), []
    decoding = "decoded" in outputs or "decoded_sha256" in outputs
    first = True
    for packed in itertools.chain([array("I", enc.begin).tobytes()], stretches,
                                  [array("I", enc.end).tobytes()]):
        part = array("I")
        part.frombytes(packed)
        n += len(part)
        id_hash.update(_little(part))
        if "ids" in outputs:
            ids += part
        if decoding and len(part):
            piece = enc.decode_stretch(part.tolist(), first)
            first = first and not piece and part.tolist() == enc.begin
            text_hash.update(piece.encode())
            if "decoded" in outputs:
                texts.append(piece)
    return {"ids": ids.tolist(), "n_tokens": n, "ids_sha256": id_hash.hexdigest(),
            "decoded": "".join(texts), "decoded_sha256": text_hash.hexdigest()}


def encode(docs: DataFrame, model_path: str, outputs: tuple[str, ...] = ("ids", "n_tokens"),
           check: bool = True) -> DataFrame:
    """doc_id plus the asked ``outputs`` for every whole text of ``docs``, with
    begin and end ids.  ``decoded`` columns come from the ids, not from the text."""
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches):
        enc = encoder(model.value, check)
        for batch in common.slices(batches, "text"):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            rows = [_row(enc, stretches, outputs) for stretches in enc.batch(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([r[o] for r in rows], OUTPUTS[o][1]) for o in outputs)],
                names=["doc_id", *outputs])

    ddl = ", ".join(["doc_id long", *(f"{o} {OUTPUTS[o][0]}" for o in outputs)])
    return common.columns(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, ddl)


def decode(tokens: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the text of its ``ids`` (null ids: an empty text)."""
    model = tokens.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches):
        enc = encoder(model.value, False)
        for batch in batches:
            texts = [enc.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "decoded"])

    return common.columns(tokens, {"doc_id": "long", "ids": "array<int>"}).mapInArrow(
        run, "doc_id long, decoded string")
