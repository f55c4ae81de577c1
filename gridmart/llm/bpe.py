"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is read once on the driver and sent to the executors as bytes
(its size is checked), so executors need no local copy; each worker process
builds the encoder once.

Long texts are split before the library sees them, only at places where no
match of the split pattern can reach across: between a letter and a
character that is not one, and likewise for numbers, found with the pattern's
own classes.  A match never holds a letter followed by a non-letter nor a
number followed by a non-number, so encoding the parts one after the other
gives the ids of the whole.  A run without such a place is matched by the
pattern here and its matches are merged one at a time, so neither the
regular-expression engine's stack nor its backtracking limit is ever met.

Defined results: a null or empty text has no ids and decodes to no bytes;
special tokens are ordinary text; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common

#: Longest text handed to the library in one call, in characters.
PART_CHARS = 32_768
#: Rank files above this size are refused (they are sent to every executor).
MAX_RANK_BYTES = 64 << 20

_SAFE = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})")
_ENCODERS: dict[tuple[str, str], "Encoder"] = {}


class Encoder:
    """Ids of texts and bytes of ids under one rank file and split pattern."""

    def __init__(self, rank_bytes: bytes, pattern: str):
        import tiktoken
        ranks = {}
        for line in rank_bytes.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})
        self.pattern = regex.compile(pattern)
        self.names = {rank: str(rank) for rank in ranks.values()}

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Consecutive parts; the flag says that the part held no safe place
        and is still long."""
        at, n = 0, len(text)
        while n - at > PART_CHARS:
            end = self._safe_before(text, at, at + PART_CHARS)
            if end is None:
                hit = _SAFE.search(text, at + PART_CHARS)
                end = hit.start() if hit else n
            yield text[at:end], end - at > PART_CHARS
            at = end
        if at < n:
            yield text[at:], False

    @staticmethod
    def _safe_before(text: str, start: int, end: int) -> int | None:
        """The last safe place after ``start`` and up to ``end``, looked for
        near the end first.  The search sees one character more than it may
        cut before, or the end of the search would look like a safe place."""
        for back in (256, 4096, end - start):
            last = None
            for hit in _SAFE.finditer(text, max(end - back, start + 1), end + 1):
                if hit.start() <= end:
                    last = hit.start()
            if last is not None:
                return last
        return None

    def encode(self, text: str) -> list[int]:
        if len(text) <= PART_CHARS:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for part, unsplit in self.parts(text):
            if unsplit:
                for match in self.pattern.finditer(part):
                    ids += self.encoding._encode_single_piece(match.group())
            else:
                ids += self.encoding.encode_ordinary(part)
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        """The raw bytes, which need not be valid UTF-8 for a cut id list."""
        return self.encoding.decode_bytes(ids)

    def joined(self, ids: list[int]) -> bytes:
        names = self.names
        return ",".join([names[i] for i in ids]).encode()


def encoder(rank_bytes: bytes, pattern: str) -> Encoder:
    key = (hashlib.sha256(rank_bytes).hexdigest(), pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(rank_bytes, pattern)
    return _ENCODERS[key]


def read_ranks(path: str) -> bytes:
    if os.path.getsize(path) > MAX_RANK_BYTES:
        raise ValueError(f"rank file above {MAX_RANK_BYTES} bytes: {path}")
    with open(path, "rb") as f:
        return f.read()


#: What ``encode`` can add for each document.
OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32())),
    "n_tokens": ("long", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded": ("binary", pa.binary()),
    "decoded_sha256": ("string", pa.string()),
}


def encode(docs: DataFrame, rank_path: str, pattern: str,
           outputs: tuple[str, ...] = ("ids", "n_tokens")) -> DataFrame:
    """doc_id plus the asked ``outputs`` for every whole text of ``docs``.

    ``decoded`` columns come from the ids, not from the text."""
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def run(batches):
        enc = encoder(ranks.value, pattern)
        for batch in common.slices(batches, "text"):
            out: dict[str, list] = {name: [] for name in outputs}
            for text in batch.column("text").to_pylist():
                ids = enc.encode(text or "")
                if "ids" in out:
                    out["ids"].append(ids)
                if "n_tokens" in out:
                    out["n_tokens"].append(len(ids))
                if "ids_sha256" in out:
                    out["ids_sha256"].append(hashlib.sha256(enc.joined(ids)).hexdigest())
                if "decoded" in out or "decoded_sha256" in out:
                    raw = enc.decode(ids)
                    if "decoded" in out:
                        out["decoded"].append(raw)
                    if "decoded_sha256" in out:
                        out["decoded_sha256"].append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *(pa.array(out[o], OUTPUTS[o][1]) for o in outputs)],
                names=["doc_id", *outputs])

    ddl = ", ".join(["doc_id long", *(f"{o} {OUTPUTS[o][0]}" for o in outputs)])
    return common.columns(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, ddl)


def decode(tokens: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id and the raw bytes of its ``ids`` (null ids: no bytes)."""
    ranks = tokens.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def run(batches):
        enc = encoder(ranks.value, pattern)
        for batch in batches:
            raw = [enc.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(raw, pa.binary())],
                names=["doc_id", "decoded"])

    return common.columns(tokens, {"doc_id": "long", "ids": "array<int>"}).mapInArrow(
        run, "doc_id long, decoded binary")
