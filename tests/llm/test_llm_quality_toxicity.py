import random
import re
import zlib

import llm_cases as cases
import pytest

from gridmart.llm import quality as Q
from gridmart.llm import toxicity as T

BLANKS = re.compile("[ \t-\r]+")


def brute_measures(text):
    text = text or ""
    words = [w for w in BLANKS.split(text) if w]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if BLANKS.sub("", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def awkward():
    rng = random.Random(0)
    data = cases.rows()
    phrase = cases.words(rng, 7)
    for i in range(20):
        parts = [phrase if rng.random() < 0.4 else cases.words(rng, rng.randint(1, 9)) for _ in range(8)]
        data.append((300 + i, rng.choice([" ", "\n", " \t"]).join(parts), None, None, 0))
    data += [(400, "a a a a a a a a", None, None, 0), (401, "# % & | <> #\n#\n#\n\n \n \nx", None, None, 0),
             (402, "\x1c\x85\xa0x y\u2003z\x1f", None, None, 0), (403, "a b c d e a b c d e", None, None, 0),
             (404, "l one\r\nl one\r\nl one", None, None, 0), (405, "w " * 30_000, None, None, 0)]
    return data


def test_measures_match_brute_force(spark):
    data = awkward()
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in Q.measures(cases.frame(spark, data)).collect()]
    assert sorted(got, key=str) == sorted([(r[0], *brute_measures(r[1])) for r in data], key=str)


def test_base_rules_and_verdicts(spark):
    rng = random.Random(1)
    good = [(i, cases.words(rng, 80), None, None, 0) for i in range(200)]
    junk = [(1000 + i, "\n".join(["BUY!! NOW!! ### $$$"] * 15 + [cases.words(rng, 40)]), None, None, 0) for i in range(30)]
    got = {r.doc_id: r for r in Q.judge(cases.frame(spark, good + junk + [(2000, None, None, None, 0)])).collect()}
    assert all(got[i].kept for i, *_ in good)
    assert not any(got[i].kept for i, *_ in junk)
    assert got[2000].base_failed and not got[2000].kept
    for r in got.values():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_no_python_on_the_main_path(spark):
    plan = Q.measures(cases.frame(spark, awkward()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan.replace("Scan ExistingRDD", ""))


def test_empty_and_only_good_tables(spark):
    assert Q.judge(cases.empty(spark)).collect() == []
    rng = random.Random(2)
    one = cases.frame(spark, [(1, cases.words(rng, 60), None, None, 0)])
    assert [r.kept for r in Q.judge(one).collect()] == [True]


def test_estimation_recovers_planted_accuracies():
    rng, counts = random.Random(0), {}
    hits = [0.95, 0.9, 0.8, 0.7]
    for _ in range(40_000):
        good = rng.random() < 0.75
        votes = tuple(0 if rng.random() < 0.2 else (1 if good == (rng.random() < h) else -1) for h in hits)
        counts[votes] = counts.get(votes, 0) + 1
    model = Q.estimate(counts, 4)
    assert abs(model.prior - 0.75) < 0.06
    for (on_good, on_bad), h in zip(model.accuracy, hits):
        assert abs(on_good - h) < 0.05 and abs(on_bad - h) < 0.08
    assert model.posterior((1, 1, 1, 1)) > 0.95 > 0.05 > model.posterior((-1, -1, -1, -1))


# -- toxicity ------------------------------------------------------------------

def brute_segments(scores):
    """Ruzzo and Tompa's definition: the best segment, then left and right of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > 1e-12 and (best is None or s > best[2] + 1e-12 or
                              abs(s - best[2]) <= 1e-12 and j - i < best[1] - best[0]):
                best = (i, j, s)
    if best is None:
        return []
    i, j, _ = best
    return brute_segments(scores[:i]) + [best] + [(a + j, b + j, s) for a, b, s in brute_segments(scores[j:])]


def test_maximal_segments_match_their_definition():
    rng = random.Random(0)
    for _ in range(300):
        scores = [rng.choice([-3, -2, -1.5, -1, 1, 2, 3.25, 4]) + rng.random() / 97 for _ in range(rng.randint(0, 14))]
        got = T.maximal_segments(scores)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(got, want))


BAD = ["scumbag", "idiotic", "moronic", "trashing"]


def corpus(n=400, seed=0):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = cases.words(rng, rng.randint(20, 80)).split()
        for _ in range(rng.randint(2, 4) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(BAD))
        docs.append((i, " ".join(w), "en", None, 0))
        labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    train = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 5]
    train += [(None, 1, 1), (7, 1, None), (3, 0, 0), (3, 0, 0), (9999, 1, 1)]
    return T.learn(cases.frame(spark, docs), spark.createDataFrame(train, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark, model):
    docs, labels = corpus()
    truth = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    got = {r.doc_id: r for r in T.score(cases.frame(spark, docs), model).collect()}
    assert sum(got[i].predicted == t for i, t in truth.items()) >= 0.97 * len(truth)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    fresh_docs, fresh = corpus(200, seed=9)
    got = {r.doc_id: r.predicted for r in T.score(cases.frame(spark, fresh_docs), model).collect()}
    assert sum(got[i] == t for i, _, t in fresh) >= 0.97 * len(fresh)


def test_passages_hold_the_words(spark, model):
    rng = random.Random(4)
    text = cases.words(rng, 3000) + " Scumbag, idiotic moronic! " + cases.words(rng, 3000)
    [r] = T.score(cases.frame(spark, [(1, text, None, None, 0)]), model, passages=True).collect()
    [p] = r.passages
    assert text[p.start:p.end] == "Scumbag, idiotic moronic" and p.expected < T.MAX_E and r.predicted == 1


def test_defined_cases(spark, model):
    data = cases.rows()
    got = T.score(cases.frame(spark, data), model).collect()
    assert len(got) == len(data) and {r.predicted for r in got} == {0}
    assert len({r.score for r in got if r.doc_id in (100, 101, 102)}) == 1
    assert T.score(cases.empty(spark), model).collect() == []
    none = T.learn(cases.frame(spark, data), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {round(r.score, 9) for r in T.score(cases.frame(spark, data), none).collect()} == {0.0}
