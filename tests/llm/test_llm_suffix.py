import hashlib
import random

import llm_cases as cases
import numpy as np
import pyarrow as pa
import pytest

from gridmart.llm import suffix_dedup as S


def brute(data, window=50):
    """Byte strings by plain dictionaries."""
    least = {}
    texts = [(r[1] or "").encode() for r in data]
    ranks = [S._LAST if r[0] is None else r[0] for r in data]
    for t, k in zip(texts, ranks):
        for i in range(len(t) - window + 1):
            w = t[i:i + window]
            least[w] = min(least.get(w, k), k)
    out = []
    for (doc_id, *_), t, k in zip(data, texts, ranks):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if least[t[i:i + window]] < k:
                gone[i:i + window] = b"\1" * window
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted(seed=0, n=120):
    rng = random.Random(seed)
    passages = [cases.words(rng, 20) for _ in range(4)]
    data = []
    for i in range(n):
        parts = [cases.words(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages)[rng.randint(0, 9):], cases.words(rng, rng.randint(0, 9))]
        data.append((i, " ".join(parts), None, None, 0))
    rng.shuffle(data)
    return data + [(n, "a" * 400, None, None, 0), (n + 1, "a" * 300, None, None, 0), (n + 2, "ab" * 200, None, None, 0),
                   (n + 3, "\0" * 200, None, None, 0), (n + 4, "\0" * 90 + "é" * 90, None, None, 0),
                   (n + 5, passages[0] + "\0" * 70, None, None, 0)]


def result(df):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()], key=str)


def test_removed_bytes_match_brute_force(spark):
    data = planted() + [r for r in cases.rows() if len(r[1] or "") < 50_000]
    assert result(S.remove_repeats(cases.frame(spark, data))) == brute(data)


@pytest.mark.parametrize("sizes", [
    dict(slice_bytes=600, bucket_bytes=400),                     # groups that cross many buckets
    dict(slice_bytes=4000, bucket_bytes=10_000, near_classes=0),  # single windows only
    dict(slice_bytes=1 << 20, near_classes=10**6),
])
def test_result_does_not_depend_on_sizes(spark, sizes):
    data = planted(1, 60)
    assert result(S.remove_repeats(cases.frame(spark, data), **sizes)) == brute(data)


def test_other_windows_and_outputs(spark):
    data = planted(2, 40)
    df = S.remove_repeats(cases.frame(spark, data), 30, ("spans", "kept"))
    assert result(df) == brute(data, 30)
    texts = {r[0]: r[1].encode() for r in data}
    for r in df.collect():
        t, at, kept = texts[r.doc_id], 0, b""
        for s in r.spans:
            kept += t[at:s.start]
            at = s.end
        assert kept + t[at:] == bytes(r.kept)


def test_long_copy_and_empty_table(spark):
    data = [r for r in cases.rows() if r[0] in (105, 106, 107)] + [(108, "x" * 80_000, None, None, 0)]
    got = {r.doc_id: r.n_removed for r in S.remove_repeats(cases.frame(spark, data)).collect()}
    assert got[105] == 0 and got[106] == len(data[0][1]) and got[107] == 0 and got[108] == 80_000
    assert S.remove_repeats(cases.empty(spark)).collect() == []


def test_multikey_order():
    rng = np.random.default_rng(0)
    a = [rng.integers(0, 4, 500).astype(np.uint64) for _ in range(3)]
    got = np.column_stack(a)[S.multikey_order(a)]
    assert got.tolist() == sorted(np.column_stack(a).tolist())


def test_equal_windows_sample_the_same_place():
    rng = random.Random(3)
    passage = cases.words(rng, 60).encode()
    found = []
    for pad in (0, 7, 31, 200):
        text = cases.words(rng, 99).encode()[:pad] + passage
        a = S.sample_suffixes([text], 50, S.LEAD)
        places = {}
        for at, first, last in zip(a.at, a.first, a.last):
            places.update({s: at - pad for s in range(first, last + 1)})
        assert sorted(places) == list(range(len(text) - 49))
        found.append([places[s + pad] for s in range(len(passage) - 49)])
    assert all(f == found[0] for f in found)


@pytest.mark.parametrize("piece_bytes", [64, 333])
def test_texts_longer_than_a_piece(spark, piece_bytes):
    data = planted(4, 60)
    df = S.remove_repeats(cases.frame(spark, data), slice_bytes=4000, piece_bytes=piece_bytes)
    assert result(df) == brute(data)


def test_places_far_inside_a_long_text():
    passage = cases.words(random.Random(5), 200).encode()
    far = (1 << 25) + 12_345
    text = np.random.default_rng(5).integers(0, 256, far, np.uint8).tobytes() + passage
    short = S._suffixes(S.Slice(0, [1], [passage]), 50)
    long = S._suffixes(S.Slice(0, [2, 3], [b"", text]), 50)
    assert set(long.text.tolist()) == {1}
    windows = {}
    for at, first, last, words in zip(long.at, long.first, long.last, long.words):
        if last >= far:
            windows.update({s - far: (at - far, *words) for s in range(max(first, far), last + 1)})
    assert windows == {s: (at, *words) for at, first, last, words in
                       zip(short.at, short.first, short.last, short.words) for s in range(first, last + 1)}
    assert (long.last - long.first).max() < 50 and (np.sum(long.last - long.first + 1) == len(text) - 49)


def test_slices_of_empty_texts_are_bounded():
    n = 150_000
    texts = [None if i % 2 else "" for i in range(n - 1)] + ["end"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()),
                                        pa.array(texts, pa.string())], names=["uid", "doc_id", "text"])
    for batches in ([batch], [batch.slice(i, 7001) for i in range(0, n, 7001)]):
        parts = list(S._slices(batches, 1 << 20))
        assert [(p.number, len(p.ids)) for p in parts] == [(0, 65_536), (65_536, 65_536), (131_072, n - 131_072)]
        assert [i for p in parts for i in p.ids] == list(range(n)) and parts[-1].texts[-1] == b"end"


def test_more_buckets_than_samples_make_no_false_groups(spark):
    """Every lead differs: no bucket is cut inside a group, none twice at a place."""
    import random

    from gridmart.llm import common, suffix_dedup as S
    rng = random.Random(8)
    docs = [(i, "".join(rng.choice("abcdefghijklmnop") for _ in range(2_000))) for i in range(60)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "monotonically_increasing_id() AS uid")
    common.ship(spark)
    few, many = (S._splitters(rows, 50, 4 << 20, 1 << 20, 120_000, n) for n in (40, 100_000))
    assert 30 <= len(few) <= 39
    assert len(many) > len(few) and all(bytes(k)[S.LEAD:].strip(b"\0") == b"" for k in many)
    assert [bytes(k) for k in many] == sorted({bytes(k) for k in many})


def test_a_group_larger_than_a_bucket_is_cut_inside():
    from gridmart.llm import suffix_dedup as S
    hot, cold = b"h" * S.LEAD, [bytes([c]) * S.LEAD for c in b"abc"]
    cuts = S.cut_keys([hot + bytes([i]) * 8 for i in range(1, 6)] + [c + b"12345678" for c in cold])
    keys = [bytes(k).ljust(S.LEAD + 8, b"\0") for k in cuts]
    assert [k for k in keys if k.startswith(hot) and k[S.LEAD:].strip(b"\0")] == \
        [hot + bytes([i]) * 8 for i in range(1, 6)]
    assert all(c + b"\0" * 8 in keys for c in [hot, *cold])


def test_windows_of_a_slice_are_one_row_each():
    import numpy as np

    from gridmart.llm import suffix_dedup as S
    rng = np.random.default_rng(3)
    n = 5_000
    one, two = rng.integers(0, 40, n), rng.integers(-2, 2, n)
    doc, start, ranks = rng.integers(0, 50, n).astype(np.int32), np.arange(n, dtype=np.int32), rng.permutation(50)
    want = {}
    for w, d, s in zip(zip(one.tolist(), two.tolist()), doc.tolist(), start.tolist()):
        want.setdefault(w, set()).add((int(ranks[d]), d, s))
    got = {}
    for batch in S._by_window(7, ranks.astype(np.int64), one, two, doc, start):
        for r in batch.to_pylist():
            places = {(r["rank"], r["doc"], r["start"])} | {tuple(m.values()) for m in r["more"] or []}
            assert (r["rank"], r["most"]) == (min(p[0] for p in places), max(p[0] for p in places))
            got[r["one"], r["two"]] = places
    assert got == want
