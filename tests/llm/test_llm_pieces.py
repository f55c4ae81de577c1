import hashlib
import random
import struct
from array import array

import llm_cases as cases
import public_tokenizers
import pytest
import sentencepiece

from gridmart.llm import piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return piece_bpe.Encoder(piece_bpe.read_model(PATH))


def ids_of(own, text):
    return [*own.begin, *array("I", b"".join(own.stretches(text))), *own.end]


def test_every_text_as_the_library_would(spark, library):
    data = cases.rows()
    got = piece_bpe.encode(cases.frame(spark, data), PATH, tuple(piece_bpe.OUTPUTS)).collect()
    want = []
    for r in data:
        ids = library.encode(r[1] or "", add_bos=True, add_eos=True)
        text = library.decode(ids)
        want.append((r[0], ids, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     text, hashlib.sha256(text.encode()).hexdigest()))
        assert text == (r[1] or "")
    have = [(r.doc_id, r.ids, r.n_tokens, r.ids_sha256, r.decoded, r.decoded_sha256) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


TEXTS = ["", " ", "a\x00b", "  a  b ", "▁ ▁▁x", "<s> </s> <unk> <0x41>", "\n\n a\t\tb\r\n", "ÄÖÜ ß é 中文 текст 🙂",
         "​﻿\x85�\U000e0001", " " * 40 + "x", "x" * 5000, "ab" * 3000, " " * 5000, "word " * 70_000,
         "中文" * 20_000 + " " + "a" * 3000, "\n" * 50_000, "a b" * 300 + "\n" + "▁" * 300]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_odd_and_long_texts(own, library, text):
    want = library.encode(text, add_bos=True, add_eos=True)
    row = piece_bpe._row(own, own.stretches(text), tuple(piece_bpe.OUTPUTS))
    assert row["ids"] == want and row["decoded"] == library.decode(want)
    assert row == piece_bpe._row(own, next(iter(own.batch([text]))), tuple(piece_bpe.OUTPUTS))


def test_random_texts(own, library):
    rng = random.Random(5)
    parts = [" ", "▁", "a", "the", "\n", "\r", "é", "ing", "0", ".", "中"]
    for _ in range(1500):
        text = "".join(rng.choice([*parts, chr(rng.randrange(1, 0xD800)), chr(rng.randrange(0xE000, 0x110000))])
                       for _ in range(rng.randint(0, 30)))
        assert ids_of(own, text) == library.encode(text, add_bos=True, add_eos=True)


def test_side_by_side_agendas_equal_single_ones(own):
    rng = random.Random(6)
    segments = list({"▁" * rng.randint(0, 3) + "".join(rng.choice("etaoinshé中\x01") for _ in range(rng.randint(1, 40)))
                     for _ in range(3000)})
    for segment, ids in own.encode_segments(segments).items():
        assert array("I", ids).tolist() == own.agenda(segment)


def test_results_do_not_depend_on_what_is_remembered(own, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 20)
    monkeypatch.setattr(piece_bpe, "STRETCH", 7)
    texts = [r[1] or "" for r in cases.rows()]
    for text, stretches in zip(texts, own.batch(texts)):
        row = piece_bpe._row(own, stretches, ("ids", "decoded"))
        assert row["ids"] == library.encode(text, add_bos=True, add_eos=True)
        assert row["decoded"] == text


def test_whole_texts_are_checked_where_no_character_stands_alone(library):
    enc = piece_bpe.Encoder(piece_bpe.read_model(PATH))
    enc.by_segment = False
    assert ids_of(enc, "some words\n") == library.encode("some words\n", add_bos=True, add_eos=True)
    enc.known = {}
    enc.v.pair_ranks *= -1                                  # the wrong order of merges
    with pytest.raises(ValueError, match="differ"):
        ids_of(enc, "international consideration of understanding")


def test_a_difference_raises():
    enc = piece_bpe.Encoder(piece_bpe.read_model(PATH))
    enc.v.pair_ranks *= -1
    with pytest.raises(ValueError, match="differ"):
        ids_of(enc, "international consideration of understanding")


def test_decode_of_stored_ids_and_null_ids(spark):
    df = cases.frame(spark, cases.rows())
    got = piece_bpe.decode(piece_bpe.encode(df, PATH, ("ids",)), PATH).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted([(r[0], r[1] or "") for r in cases.rows()], key=str)
    null = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [r.decoded for r in piece_bpe.decode(null, PATH).collect()] == [""]


def test_empty_table_and_unknown_output(spark):
    assert piece_bpe.encode(cases.empty(spark), PATH).collect() == []
    with pytest.raises(ValueError):
        piece_bpe.encode(cases.empty(spark), PATH, ("token",))


def test_other_model_types_are_refused():
    model = piece_bpe.read_model(PATH)
    with pytest.raises(ValueError, match="merge-type"):
        # a second trainer section names the unigram type; the last one counts
        piece_bpe.Vocabulary(model + b"\x12\x02\x18\x01")
