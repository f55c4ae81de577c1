import base64
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import llm_cases as cases
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as P
from gridmart.llm import mixing as M
from test_llm_simhash import brute as near_groups
from test_llm_url_lang import BASES

ROOT = Path(__file__).resolve().parents[2]


def corpus():
    rng, data = random.Random(0), []
    for i in range(160):
        lang = rng.choice(["en", "fr"])
        data.append((i, cases.words(rng, rng.randint(20, 90), BASES[lang]), lang, f"s{i % 3}", 0))
    data += [(200 + i, data[i][1].upper() if i % 2 else data[i][1], data[i][2], "s0", 0) for i in range(30)]
    for i in range(20):
        w = data[50 + i][1].split()
        w[0] = "other"
        data.append((300 + i, " ".join(w), data[50 + i][2], "s1", 0))
    return data + [(400, None, "en", "s2", 0), (401, "99 !", "en", None, 0), (402, "", None, None, None)]


@pytest.fixture(scope="module")
def tables(spark):
    """Every stage's input and output."""
    docs, out = cases.frame(spark, corpus()), []
    for name, stage in P.STAGES:
        nxt = stage(spark, docs, "")
        if name != P.STAGES[-1][0]:
            assert nxt.columns == docs.columns, name
        out.append((name, [r.asDict() for r in docs.collect()], [r.asDict() for r in nxt.collect()]))
        docs = spark.createDataFrame(nxt.coalesce(1).rdd, nxt.schema).coalesce(1).cache()
    return {name: (a, b) for name, a, b in out}


def test_language_stage_keeps_clean_documents(tables):
    before, after = tables["language_id"]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {400, 401, 402}


def test_exact_stage_keeps_the_largest_id(tables):
    before, after = tables["exact_dedup"]
    best = {}
    for r in before:
        key = r["text"].encode().lower()
        best[key] = max(best.get(key, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(best.values())


def test_near_stage_keeps_one_of_each_component(tables):
    before, after = tables["simhash_near_dedup"]
    want = {c for *_, c in near_groups([(r["doc_id"], r["text"]) for r in before])}
    assert sorted(r["doc_id"] for r in after) == sorted(want)


def test_mix_stage_meets_its_targets(tables):
    before, after = tables["source_mix"]
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r["source"]] += len(r["text"].split())
    for r in after:
        taken[r["source"]] += len(r["text"].split())
    assert max(Counter(r["doc_id"] for r in after).values()) <= 2
    for s, t in M.targets(dict(sizes)).items():
        assert abs(taken[s] - t) <= 0.02 * t


def test_tokens_are_the_librarys(tables):
    before, after = tables["byte_bpe"]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((r["doc_id"], tuple(enc.encode_ordinary(r["text"]))) for r in before)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in after) == want


def test_run_over_a_stored_table_leaves_one_stage(spark, tmp_path):
    cases.frame(spark, corpus()).write.parquet(str(tmp_path / "documents.parquet"))
    out = P.run(spark, str(tmp_path))
    assert out.count() > 0 and "ids_sha256" in out.columns
    written = Path(out.inputFiles()[0].removeprefix("file://")).parents[1]
    assert [p.name for p in written.iterdir()] == [P.STAGES[-1][0]]


def test_empty_documents(spark, tmp_path):
    cases.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []


def test_entry_works_without_the_subpackage():
    code = ("import sys; sys.modules['gridmart.llm'] = None; import __spark_entry__ as e; q = e.queries(); "
            "assert q and not any(k.startswith('op') and k[2:3].isdigit() for k in q) and 'pipeline' not in q; "
            "assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_entry_registers_one_query_for_each_operator():
    import __spark_entry__ as e
    names = [k for k in e.queries() if k.startswith("op") and k[2].isdigit()]
    assert [int(k[2:].split("_")[0]) for k in names] == list(range(1, 11)) and "pipeline" in e.queries()
    assert set(e.oracle_sql()) <= set(e.queries())
