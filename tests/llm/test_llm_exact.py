import hashlib
import random
from collections import defaultdict

import llm_cases as cases
from hypothesis import given, settings
from hypothesis import strategies as st

from gridmart.llm import exact_dedup as X


def brute(data):
    groups = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(data):
        groups[(text or "").encode().lower()].append((doc_id is not None, doc_id or 0, -i, doc_id))
    out = []
    for key, held in groups.items():
        best = max(held)
        for row in held:
            out.append((row[3], best[3], len(held), row == best, hashlib.sha256(key).hexdigest()))
    return sorted(out, key=str)


def test_dedup_matches_brute_force(spark):
    data = cases.rows()
    df = X.dedup(cases.frame(spark, data))
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()]
    assert sorted(got, key=str) == brute(data)


def test_one_row_of_each_group_stays(spark):
    data = cases.rows() + [(104, cases.rows()[5][1], "en", "s0", 0)] * 3
    df = cases.frame(spark, data)
    kept = X.keep_latest(df)
    assert kept.columns == df.columns
    assert kept.count() == len({(r[1] or "").encode().lower() for r in data})


def test_empty_table(spark):
    assert X.dedup(cases.empty(spark)).collect() == []
    assert X.keep_latest(cases.empty(spark)).collect() == []


def test_deleted_texts_leave_the_index(spark):
    data = [(1, "Some text"), (2, "some TEXT"), (3, "other"), (4, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    gone = spark.createDataFrame([("SOME text",), ("never seen",)], "text string")
    got = {r.keep_id: r.group_size for r in X.build_index(docs, gone).collect()}
    assert got == {3: 1, 4: 1}


def test_hot_text_is_one_record_a_batch(spark):
    df = spark.range(5000).selectExpr("id doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) text")
    got = {(r.keep_id, r.group_size) for r in X.dedup(df).filter("text_sha256 = sha2('hot', 256)").collect()}
    assert got == {(4998, 1667)}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 400)), max_size=900))
def test_cuckoo_filter_never_forgets(ops):
    live, index = {}, X.LiveIndex()
    for add, k in ops:
        key, content = hashlib.sha256(str(k).encode()).digest(), str(k).encode()
        if add and k not in live:
            index.insert(key, content, k)
            live[k] = key
        elif not add:
            assert index.delete(key, content) == (live.pop(k, None) is not None)
    assert all(index.find(d, str(k).encode())[1] == k for k, d in live.items())
    assert index.filter.size == len(live)


def test_overflow_resizes_from_the_stored_keys():
    index, start = X.LiveIndex(), X.START_BUCKETS
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    for k in keys:
        index.insert(k, k, 0)
    assert index.filter.mask + 1 > start and all(k in index.filter for k in keys)
    wrong = sum(hashlib.md5(str(k).encode()).digest() in index.filter for k in range(20_000))
    assert wrong < 20          # a hit is only a candidate


def test_equal_digest_with_other_content_is_no_copy():
    index = X.LiveIndex()
    index.insert(b"d" * 32, b"one", 1)
    assert index.find(b"d" * 32, b"two") is None
    index.insert(b"d" * 32, b"two", 2)
    assert index.delete(b"d" * 32, b"one") and index.find(b"d" * 32, b"two")[1] == 2


def test_delete_of_a_random_half():
    rng = random.Random(1)
    f = X.CuckooFilter(1024)
    keys = [rng.randbytes(32) for _ in range(2000)]
    assert all(f.insert(k) for k in keys)
    for k in keys[:1000]:
        assert f.delete(k)
    assert all(k in f for k in keys[1000:]) and f.size == 1000


def test_partitions_of_the_index_follow_the_bytes(spark, monkeypatch):
    from gridmart.llm import exact_dedup
    df = spark.createDataFrame([(i, "x" * 1_000) for i in range(100)], "doc_id long, text string")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert exact_dedup._partitions(df) == least == exact_dedup._partitions(df.limit(0))
    monkeypatch.setattr(exact_dedup, "INDEX_BYTES", 2_000)
    assert exact_dedup._partitions(df) == 50
    assert exact_dedup.build_index(df).rdd.getNumPartitions() == 50
