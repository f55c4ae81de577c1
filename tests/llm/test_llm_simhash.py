import random
from itertools import combinations

import llm_cases as cases
import numpy as np
import pytest
import xxhash

from gridmart.llm import components, simhash as S


def brute_fingerprint(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in linked:
        parent[find(a)] = find(b)
    out = {}
    for n in nodes:
        out.setdefault(find(n), []).append(n)
    return out.values()


def brute(data, bits=3):
    fps = [brute_fingerprint(r[1]) for r in data]
    near = [(i, j) for i, j in combinations(range(len(data)), 2) if (fps[i] ^ fps[j]).bit_count() <= bits]
    out = []
    for group in roots(range(len(data)), near):
        ids = [data[i][0] for i in group if data[i][0] is not None]
        out += [(data[i][0], f"{fps[i]:016x}", min(ids, default=None)) for i in group]
    return sorted(out, key=str)


def varied(seed=0):
    rng, data = random.Random(seed), cases.rows(seed)
    base = cases.words(rng, 400).split()
    for i in range(60):                                   # near copies, a word changed
        w = list(base)
        w[rng.randrange(400)] = "zz"
        data.append((200 + i, " ".join(w), "en", "s0", 0))
    return data


def test_components_match_brute_force(spark):
    data = varied()
    got = S.near_duplicates(cases.frame(spark, data)).collect()
    assert sorted([(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got], key=str) == brute(data)
    by = {}
    for r in got:
        by.setdefault(r.component_id, []).append(r.kept)
    assert all(sum(k) == 1 for k in by.values())


def test_one_row_of_each_component_stays(spark):
    data = varied(1)
    df = cases.frame(spark, data)
    kept = S.keep_first(df)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect())
    assert ids == sorted({c for _, _, c in brute(data)})


def test_empty_table(spark):
    assert S.near_duplicates(cases.empty(spark)).collect() == []
    assert S.keep_first(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_links_lose_no_pair(spark, bits):
    rng, fps = random.Random(bits), set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(8):
            x = centre
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    got = [(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in S.links(df, bits).collect()]
    assert all(0 < (a ^ b).bit_count() <= bits for a, b in got)           # verified
    want = [(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= bits]
    assert sorted(map(sorted, roots(fps, got))) == sorted(map(sorted, roots(fps, want)))


def test_long_lists_are_enumerated_to_the_same_forest():
    mask, rng = sum(0xFF << 8 * i for i in (0, 2, 3, 5, 7)), np.random.default_rng(0)
    free = [b for b in range(64) if not mask >> b & 1]
    fps = np.unique([sum(1 << b for b in free if rng.random() < 0.12) for _ in range(500)]).astype(np.uint64)
    a = roots(fps.tolist(), [(int(x), int(y)) for x, y in S._compare(fps, 3)])
    b = roots(fps.tolist(), [(int(x), int(y)) for x, y in S._enumerate(fps, mask, 3)])
    assert sorted(map(sorted, a)) == sorted(map(sorted, b))


def test_components_of_paths_stars_and_rings(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    ring = [(200 + i, 200 + (i + 1) % 7) for i in range(7)]
    df = spark.createDataFrame(path + star + ring + [(5, 5), (101, 100)], "u long, v long")
    got = {r.node: r.root for r in components.connected(df).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)},
                   **{200 + i: 200 for i in range(1, 7)}}
    assert components.connected(df.limit(0)).collect() == []
