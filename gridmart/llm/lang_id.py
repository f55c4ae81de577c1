"""Language identification with language-bitmask n-gram filters.

The filter is bit-sliced: a slot holds one bit for each language, and an
n-gram's languages are the AND of the slots its hashes name, so one lookup
answers for all languages at once.  A document's n-grams are looked up, the
set bits counted by language, and each count corrected for the false positives
that the language's share of set slots implies:

    corrected = (count - n * rate) / (1 - rate),  rate = filled share ** hashes

The language of the largest corrected share of n-grams is predicted; the share
(0 to 1) is the score.

N-grams are runs of ``ORDERS`` characters of the lower-cased text in which
every character that is no letter has become a blank and runs of blanks one;
an n-gram holds at least one letter.  A language's filter holds the n-grams
that make up at least ``MIN_SHARE`` of its n-grams of that order, hence at
most ``1 / MIN_SHARE`` for each order: the model is bounded whatever the
corpus.  It is learned from at most about ``MAX_DOCS`` documents of each
language, drawn by a hash of their text (all of them where there are fewer).

Defined results: ``und`` with score 0 where the text is null or has no letter
(and for every text if there was nothing to learn from); equal shares go to
the language that comes first by code point.  Documents without a language are
not learned from but are predicted.  Repeated rows are predicted one by one;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

UNKNOWN = "und"
ORDERS = (2, 3, 4)
MIN_SHARE = 1e-4
#: Bound of the sample of labelled rows for each language, in documents.
MAX_DOCS = 4000
#: Hash functions, and slots for each n-gram a language may hold.
HASHES = 3
SLOTS_PER_GRAM = 16


@cache
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
    """Hashes of all n-grams of the texts, the index of the text of each, and
    whether each text has a letter."""
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    has = [bool(len(c)) and bool(_letters()[c].any()) for c in codes]
    lens = np.array([len(c) + 1 for c in codes])
    flat = np.full(int(lens.sum()) + 1, 0, np.uint32)     # 0: blank, also between texts
    at = 1
    for c in codes:
        flat[at:at + len(c)] = c
        at += len(c) + 1
    owner = np.empty(len(flat), np.int32)
    owner[0] = 0
    owner[1:] = np.repeat(np.arange(len(codes), dtype=np.int32), lens)
    flat[~_letters()[flat]] = 0
    keep = np.ones(len(flat), bool)                       # runs of blanks become one
    keep[1:] = (flat[1:] != 0) | (flat[:-1] != 0)
    flat, owner = flat[keep], owner[keep]
    hashes, owners = [], []
    for order in ORDERS:
        n = len(flat) - order + 1
        if n <= 0:
            continue
        inner = np.ones(n, bool)      # a blank inside belongs to two words or texts
        for i in range(1, order - 1):
            inner &= flat[i:n + i] != 0
        if order == 2:
            inner &= (flat[:n] != 0) | (flat[1:n + 1] != 0)
        h = np.full(n, order, np.uint64)
        for i in range(order):
            h = (h ^ flat[i:n + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        hashes.append(h[inner])
        # the letter that makes the n-gram the text's own is at its start or next to it
        owners.append(np.where(flat[:n] != 0, owner[:n], owner[1:n + 1])[inner])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int32), has
    return np.concatenate(hashes), np.concatenate(owners), has


class Model:
    """The bit-sliced filter: one mask of languages for each slot."""

    def __init__(self, langs: list[str], grams: list[np.ndarray]):
        self.langs = langs
        held = max([len(g) for g in grams], default=0)
        self.bits = max(8, int(SLOTS_PER_GRAM * held).bit_length())
        width = next((w for w in (8, 16, 32, 64) if len(langs) <= w), 64)
        words = -(-len(langs) // width) or 1
        self.width = width
        self.slots = np.zeros((words, 1 << self.bits), f"uint{width}")
        for i, g in enumerate(grams):
            for at in self._places(g):
                self.slots[i // width, at] |= self.slots.dtype.type(1 << i % width)
        filled = [((self.slots[i // width] >> i % width) & 1).mean() for i in range(len(langs))]
        self.rates = np.array(filled) ** HASHES

    def _places(self, hashes: np.ndarray) -> list[np.ndarray]:
        size = np.uint64((1 << self.bits) - 1)
        step = (hashes >> np.uint64(40)) | np.uint64(1)
        return [((hashes + np.uint64(i) * step) & size).astype(np.int64) for i in range(HASHES)]

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """The languages that hold each n-gram, one row of masks for each word."""
        places = self._places(hashes)
        found = self.slots[:, places[0]]
        for at in places[1:]:
            found &= self.slots[:, at]
        return found

    def shares(self, hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """Corrected share of each text's n-grams in each language."""
        total = np.bincount(owner, minlength=texts).astype(float)
        masks, out = self.masks(hashes), np.zeros((texts, len(self.langs)))
        for i, rate in enumerate(self.rates):
            bit = (masks[i // self.width] >> i % self.width) & 1
            count = np.bincount(owner, weights=bit, minlength=texts)
            out[:, i] = (count - total * rate) / ((1 - rate) * np.maximum(total, 1))
        return np.clip(out, 0, 1)

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        hashes, owner, has = gram_hashes(texts)
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        shares = self.shares(hashes, owner, len(texts))
        best = shares.argmax(axis=1)
        return [(self.langs[b], float(s[b])) if ok else (UNKNOWN, 0.0)
                for ok, b, s in zip(has, best, shares)]


def learn(docs: DataFrame, max_docs: int = MAX_DOCS, min_share: float = MIN_SHARE) -> Model:
    """The model of the rows of ``docs`` (text, lang) that have a language."""
    known = common.columns(docs, {"text": "string", "lang": "string"}).filter("lang IS NOT NULL")
    sizes = {r.lang: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], [])
    # [0, 1) by a hash of the text; copies are drawn together
    draw = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 11) / float(1 << 53)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, max_docs / n))])
    sample = known.filter(draw < F.element_at(share, F.col("lang")))

    def count(batches):
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in common.slices(batches, "text"):
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for lang in set(langs):
                h, _, _ = gram_hashes([t or "" for t, x in zip(texts, langs) if x == lang])
                grams, n = np.unique(h, return_counts=True)
                if lang in sums:
                    grams = np.concatenate([sums[lang][0], grams])
                    n = np.concatenate([sums[lang][1], n])
                    grams, inverse = np.unique(grams, return_inverse=True)
                    n = np.bincount(inverse, weights=n).astype(np.int64)
                sums[lang] = grams, n
        for lang, (grams, n) in sums.items():
            for i in range(0, len(grams), 100_000):
                part = grams[i:i + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part),
                     pa.array(n[i:i + 100_000], pa.int64())], names=["lang", "gram", "n"])

    counts = common.cut(sample.mapInArrow(count, "lang string, gram long, n long")
                        .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # every order has about as many n-grams as the text has characters
    totals = counts.groupBy("lang").agg((F.sum("n") / len(ORDERS)).alias("total"))
    held = counts.join(F.broadcast(totals), "lang").filter(F.col("n") >= min_share * F.col("total")) \
        .select("lang", "gram").collect()          # at most 1 / min_share by order and language
    langs = sorted(sizes)
    return Model(langs, [np.array([r.gram for r in held if r.lang == lang], np.int64).view(np.uint64)
                         for lang in langs])


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score for every row."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text_"))

    def run(batches):
        for batch in common.slices(batches, "text_"):
            found = given.value.predict([t or "" for t in batch.column("text_").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array([p for p, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())],
                names=[*keep, "lang_pred", "score"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    ddl = ", ".join([*(f"`{c}` {types[c]}" for c in keep), "lang_pred string, score double"])
    return rows.mapInArrow(run, ddl)


def keep_known(docs: DataFrame, model: Model, min_score: float = 0.0) -> DataFrame:
    """``docs`` without the documents that have no language or whose best
    share of n-grams is below ``min_score``; all their columns, no shuffle."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in common.slices(batches, "text"):
            found = given.value.predict([t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array([p != UNKNOWN and s >= min_score for p, s in found]))

    return docs.mapInArrow(run, docs.schema)
