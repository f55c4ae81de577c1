import base64
import hashlib

import llm_cases as cases
import public_tokenizers
import pytest
import tiktoken

from gridmart.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.read_ranks(PATH), PATTERN)


def test_every_text_as_the_library_would(spark, library):
    data = cases.rows()
    got = bpe.encode(cases.frame(spark, data), PATH, PATTERN, tuple(bpe.OUTPUTS)).collect()
    want = sorted([(r[0], r[1] or "") for r in data], key=str)
    have = sorted([(r.doc_id, bytes(r.decoded).decode()) for r in got], key=str)
    assert have == want                                    # exact round trip
    for r in got:
        ids = library.encode_ordinary(bytes(r.decoded).decode())
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(bytes(r.decoded)).hexdigest()


def test_decode_of_stored_ids(spark):
    df = cases.frame(spark, cases.rows())
    ids = bpe.encode(df, PATH, PATTERN, ("ids",))
    got = sorted([(r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode(ids, PATH, PATTERN).collect()], key=str)
    assert got == sorted([(r[0], r[1] or "") for r in cases.rows()], key=str)


def test_empty_table_and_null_ids(spark):
    assert bpe.encode(cases.empty(spark), PATH, PATTERN).collect() == []
    null = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(null, PATH, PATTERN).collect()] == [b""]


@pytest.mark.parametrize("text", [
    "word " * 30_000, "a1" * 60_000, "it's we'll " * 20_000, "\n" * 90_000 + "x", "x" + " " * 90_000 + "y",
    "!?" * 50_000, "é中1 " * 30_000, "'s" * 50_000, "  \x1c \x85x" * 15_000, "٣ⅷ²a" * 20_000,
])
def test_long_texts_split_at_safe_places(own, library, text):
    assert own.encode(text) == library.encode_ordinary(text)
    assert own.decode(own.encode(text)) == text.encode()


def test_parts_are_bounded_where_the_text_allows(own):
    parts = list(own.parts("some words, 12 of them; " * 20_000))
    assert "".join(p for p, _ in parts) == "some words, 12 of them; " * 20_000
    assert all(len(p) <= bpe.PART_CHARS and not unsplit for p, unsplit in parts)


def test_cut_id_lists_decode_to_raw_bytes(own):
    ids = own.encode("🙂🙂")
    assert b"".join(own.decode([i]) for i in ids) == "🙂🙂".encode()


def test_unknown_output_is_refused(spark):
    with pytest.raises(ValueError):
        bpe.encode(cases.empty(spark), PATH, PATTERN, ("token",))
