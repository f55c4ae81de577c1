"""URL lists with a Bloom filter cascade.

The listed keys are the rules (host + path).  A url can only be hit by the
keys made of one of its host's suffixes, none longer than the longest listed
host, and one of the rules' path lengths; the keys of all urls of the table are
the corpus's complete key universe.

Level 1 of the cascade encodes the listed keys, level 2 the keys of the
universe that level 1 passes wrongly, level 3 the listed keys that level 2
passes wrongly, and so on until a level errs on nothing.  A key's membership
is then exact for every key of the universe, with no join: the levels, a few
bytes a rule, travel with the task.  The first level is sized to the ratio of
listed keys to universe, so its errors stay below the number of listed keys
whatever the corpus; they are all that ever reaches the driver.

A second cascade, over the listed keys, holds the blocking ones.

Defined results: host is what stands after the first ``://`` up to ``/``,
``?``, ``#`` or the end, A-Z lower-cased; path what follows up to ``?``, ``#``
or the end; both are empty for a null url or one without ``://``.  A rule fits
its host and all subdomains if the path starts with the rule's; the longest
rule string wins, at equal length the one of the longer host.  Without a
fitting rule the verdict is ``default``.  Repeated rows are judged one by one;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Rules whose cascades would be larger are refused: they go to every task.
MAX_FILTER_BYTES = 256 << 20


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


class Bloom:
    """Bloom filter of one cascade level; the level number salts its hashes."""

    def __init__(self, keys: Iterable[str], rate: float, level: int):
        keys = list(keys)
        self.level = level
        self.hashes = max(1, round(-math.log2(rate)))
        self.size = max(8, math.ceil(1.4427 * self.hashes * len(keys)))
        self.bits = bytearray((self.size + 7) // 8)
        for key in keys:
            for at in self._places(key):
                self.bits[at >> 3] |= 1 << (at & 7)

    def _places(self, key: str):
        h = xxhash.xxh3_128_intdigest(key.encode(), self.level)
        one, step = h >> 64, (h & 0xFFFFFFFFFFFFFFFF) | 1
        return [(one + i * step) % self.size for i in range(self.hashes)]

    def __contains__(self, key: str) -> bool:
        bits = self.bits
        return all(bits[at >> 3] >> (at & 7) & 1 for at in self._places(key))


@dataclass
class Cascade:
    levels: list[Bloom] = field(default_factory=list)

    def __contains__(self, key: str) -> bool:
        """Exact for listed keys and for the universe it was built over."""
        for i, level in enumerate(self.levels):
            if key not in level:
                return i % 2 == 1
        return len(self.levels) % 2 == 1

    def extend(self, listed: set[str], wrong: set[str]) -> "Cascade":
        """Adds levels until nothing errs.  ``wrong``: the unlisted keys of the
        universe that the first level passes."""
        encoded, against = wrong, listed
        while encoded:
            level = Bloom(encoded, 0.5, len(self.levels))
            self.levels.append(level)
            encoded, against = {k for k in against if k in level}, encoded
        return self

    @property
    def n_bytes(self) -> int:
        return sum(len(x.bits) for x in self.levels)


def first_rate(listed: int, universe: int) -> float:
    """Error rate of level 1 at which it passes fewer unlisted keys of the
    universe than there are listed ones."""
    return min(0.5, listed / (math.sqrt(2) * max(universe, 1)))


def split_url(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, rest = rest[:end], rest[end:]
    stop = next((i for i, c in enumerate(rest) if c in "?#"), len(rest))
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, rest[:stop]


def keys_of(host: str, path: str, lengths: list[int], longest: int) -> list[str]:
    """The keys that could hit (host, path), the winning one first: those of
    the host's suffixes up to ``longest``, the longest listed host, and of the
    rules' path ``lengths``.  A very long host costs no more than a short one."""
    suffixes, at = [host] if len(host) <= longest else [], len(host)
    while (at := host.rfind(".", max(0, len(host) - longest - 1), at)) >= 0:
        suffixes.append(host[at + 1:])
    found = [(len(s) + n, len(s), s + path[:n]) for s in suffixes for n in lengths if n <= len(path)]
    return [key for _, _, key in sorted(found, key=lambda x: (-x[0], -x[1]))]


def build(urls: DataFrame, rules: list[Rule]) -> Cascade:
    """The cascade of the rules' keys over the universe of ``urls`` (column
    ``url``).  Two passes over the urls: one counts the universe, one finds
    the keys that level 1 passes wrongly."""
    listed = {r.key for r in rules}
    if not listed:
        return Cascade()
    lengths, longest = sorted({len(r.path) for r in rules}), max(len(r.host) for r in rules)

    def universe(batches):
        for batch in batches:
            for url in batch.column("url").to_pylist():
                yield from keys_of(*split_url(url), lengths, longest)

    def count(batches):
        yield pa.RecordBatch.from_pydict({"n": pa.array([sum(1 for _ in universe(batches))], pa.int64())})

    urls = common.columns(urls, {"url": "string"})
    n = urls.mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    cascade = Cascade([Bloom(listed, first_rate(len(listed), n), 0)])
    if cascade.n_bytes > MAX_FILTER_BYTES:
        raise ValueError(f"the rules need {cascade.n_bytes} bytes of filter; split the list")

    def passed(batches):
        level = cascade.levels[0]
        keys = sorted({k for k in universe(batches) if k in level} - listed)
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.string())})

    wrong = {r.key for r in urls.mapInArrow(passed, "key string").distinct().toLocalIterator()}
    return cascade.extend(listed, wrong)


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``."""
    if {r.verdict for r in rules} - {"allow", "block"}:
        raise ValueError("a rule's verdict is allow or block")
    listed = {r.key for r in rules}
    if len({(r.key, r.verdict) for r in rules}) > len(listed):
        raise ValueError("a rule is listed with both verdicts")
    members = build(pages, rules)
    blocked = {r.key for r in rules if r.verdict == "block"}
    blocking = Cascade()
    if blocked:      # its universe is the list itself
        level = Bloom(blocked, 0.5, 0)
        blocking = Cascade([level]).extend(blocked, {k for k in listed - blocked if k in level})
    lengths, longest = sorted({len(r.path) for r in rules}), max((len(r.host) for r in rules), default=0)

    def run(batches):
        for batch in batches:
            out = {"host": [], "path": [], "rule": [], "verdict": []}
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                rule = next((k for k in keys_of(host, path, lengths, longest) if k in members), None)
                out["host"].append(host)
                out["path"].append(path)
                out["rule"].append(rule)
                out["verdict"].append(default if rule is None else
                                      "block" if rule in blocking else "allow")
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(v, pa.string()) for v in out.values())],
                names=["page_id", *out])

    return common.columns(pages, {"page_id": "long", "url": "string"}).mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string")
