import hashlib

import llm_cases as cases
import pytest
from pyspark.sql import functions as F

from gridmart.llm import merkle
from gridmart.llm import queries as Q

OUT = ("leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(leaves):
    """The last node and each leaf's proof: all siblings, level by level."""
    nodes, at, proofs = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = place // 8 * 8
            proofs[i].append(("".join(nodes[run:place]), "".join(nodes[place + 1:run + 8])))
            at[i] = place // 8
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], proofs


def brute(rows, probed_text):
    """Every row's outputs; rows are (doc_id, text, lang, source, n_chars)."""
    made = sorted([(lang, doc_id, leaf(doc_id, source, lang, n, text), probed_text(doc_id, text), (doc_id, source, lang, n))
                   for doc_id, text, lang, source, n in rows],
                  key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    langs = sorted({r[0] for r in made}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([r[2] for r in made if r[0] == x]) for x in langs}
    root, above = tree([trees[x][0] for x in langs])
    out, seen = [], {x: 0 for x in langs}
    for lang, doc_id, own, probed, fields in made:
        proof = trees[lang][1][seen[lang]] + above[langs.index(lang)]
        seen[lang] += 1
        folded = own if probed is None else leaf(*fields, probed)
        for before, after in proof:
            folded = h(before, folded, after)
        out.append((doc_id, own, trees[lang][0], root, tuple(proof), h(*(s for p in proof for s in p)),
                    folded, folded == root))
    return out


def tamper(doc_id, text):
    if doc_id is None or text is None or cases.crc(doc_id) % 3:
        return None
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def collected(df):
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof), r.proof_sha256,
                    r.folded_root, r.verified) for r in df.collect()], key=str)


def probe():
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
                  F.translate("text", Q.UPPER, Q.LOWER))


@pytest.mark.parametrize("part_levels", [1, 4])
def test_awkward_rows_against_brute_force(spark, part_levels):
    rows = cases.rows() + [(200 + i, f"Text {i}", "zz", None, i) for i in range(9)]
    rows += [(300, "Alone", "aa", "s", 1), (301, "Upper É", "Ä", "s", 1), (302, "x", "", "s", 1)]
    got = collected(merkle.manifest(cases.frame(spark, rows), probe(), OUT, part_levels))
    want = sorted(brute(rows, tamper), key=str)
    assert got == want
    assert {r[-1] for r in got} == {True, False}


def test_ragged_trees_and_all_rounds(spark):
    """Partitions of eight leaves: trees up to three rounds, their last nodes short."""
    rows = [(i, f"T{i}", f"l{n}", "s", i) for n in (1, 2, 8, 9, 64, 65, 72, 73, 513, 577, 1100) for i in range(n)]
    got = collected(merkle.manifest(spark.createDataFrame(rows, cases.SCHEMA), None, OUT, 1))
    assert got == sorted(brute(rows, lambda *_: None), key=str)
    assert all(r[-1] for r in got)


def test_equal_rows_and_many_languages(spark):
    rows = [(None, "same", "en", "s", 4)] * 200 + [(i, "x", f"l{i % 100:02}", "s", 1) for i in range(300)]
    got = collected(merkle.manifest(spark.createDataFrame(rows, cases.SCHEMA).repartition(5), probe(), OUT, 1))
    assert got == sorted(brute(rows, tamper), key=str)


def test_a_round_sends_at_most_a_fanout_to_a_group(spark):
    """57 partitions: the last node of the second round holds one of eight."""
    parts = spark.createDataFrame([("t", i, 57, f"{i // 8:064x}") for i in range(57)],
                                  "tree string, part long, parts long, node string") \
        .withColumn("proof", F.array().cast(merkle.SIBLINGS))
    got = merkle.exchange(parts, 1).collect()
    assert sorted(r.part for r in got) == list(range(57)) and len({r.node for r in got}) == 1
    for r in got:
        assert len(r.proof[0].before) + len(r.proof[0].after) == 7 * 64


def test_changed_fields_do_not_verify(spark):
    rows = [(i, "Text", "en", "s", 4) for i in range(20)]
    df = merkle.manifest(spark.createDataFrame(rows, cases.SCHEMA), F.lit("text"), ("verified",))
    assert [r.verified for r in df.collect()] == [False] * 20


def test_empty_table_and_unknown_output(spark):
    assert merkle.manifest(cases.empty(spark)).collect() == []
    with pytest.raises(ValueError):
        merkle.manifest(cases.empty(spark), outputs=("height",))
