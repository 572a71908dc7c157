"""Encoding by the table of prefixes against the library, on documents, hard and drawn texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from conftest import TEXTS, hard_rows
from tidemark.llm import queries, sentence_pieces
from tidemark.llm.common import read_table

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return sentence_pieces.Encoder(file.read())


def drawn(encoder, count):
    draw, pieces = random.Random(3), sorted(encoder.ids)
    for _ in range(count):
        pool = draw.choice([
            "abcdefgh  ", "▁ ab", "日本the ing\n\t ", "éreiǹ ", "0123456789abcdef",
            [chr(draw.randrange(1, 0x2FFF)) for _ in range(50)], draw.sample(pieces, 20)])
        yield "".join(draw.choice(pool) for _ in range(draw.randrange(1, 80)))


def digests(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


@pytest.mark.parametrize("cut", [True, False])
def test_equals_the_library(library, encoder, cut):
    whole = sentence_pieces.Encoder(encoder.library.serialized_model_proto())
    if not cut:  # one table for the whole text
        whole.neighbours[:] = True
    special = ["\x00a\x00b", " " * 37 + "x" + " " * 100, "<s>[INST]</s><unk><0x41>", "﻿x",
               "aab" * 2000, "▁▁ a▁", "\U0001f600" * 3 + "é́"]
    for text in [t or "" for t in TEXTS] + special + [*drawn(encoder, 400)]:
        ids = whole.encode(text)
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True), text[:80]
        assert whole.decode(ids) == library.decode(ids.tolist())


def test_seams_by_growth_equal_merging_anew(encoder):
    """Pairs of tokens that are and are not neighbours in an encoding."""
    draw, pieces = random.Random(5), sorted(t for t in encoder.ids if len(t) < 6)
    answers = set()
    for _ in range(4000):
        pair = draw.choice(pieces), draw.choice(pieces)
        parts = [*(pair[0] + pair[1])]
        for _, parts in encoder.merged(pair[0] + pair[1]):
            pass
        if all(t in encoder.automaton for t in pair):
            assert encoder._seam_holds(*pair) == (parts == [*pair]), pair
            answers.add(parts == [*pair])
    assert answers == {True, False}


def test_kept_parts_stay_within_their_bound(library, encoder, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "KEPT_PARTS", 20)
    monkeypatch.setattr(sentence_pieces, "KEPT_PAIRS", 20)
    small = sentence_pieces.Encoder(encoder.library.serialized_model_proto())
    for text in drawn(encoder, 100):
        assert small.encode(text).tolist() == library.encode(text, add_bos=True, add_eos=True)
        assert len(small.parts) <= 20 and len(small.pairs) <= 20


def test_a_text_longer_than_a_piece(library, encoder, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "_PIECE", 7)
    for text in ["one two three four five  six " * 9, "sevenletters", "a", "", "1234567", "12345678"]:
        assert encoder.encode(text).tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_every_row_of_the_documents(spark, small, library):
    got = {tuple(r) for r in queries.all_queries()["op11_sentence_pieces"](spark, small).collect()}
    rows = read_table(spark, small, "documents").select("doc_id", "text").collect()
    assert got == {(r.doc_id, *digests(library, r.text)) for r in rows}


def test_hard_rows_repeated_rows_and_extra_columns(hard, library):
    extra = hard.withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    got = sorted(map(str, map(tuple, sentence_pieces.encoding_digests(extra, PATH).collect())))
    assert got == sorted(str((r[0], *digests(library, r[1]))) for r in hard_rows())


def test_encoded_texts_come_back(hard, library):
    rows = sentence_pieces.encoded(hard, PATH).collect()
    assert len(rows) == len(hard_rows())
    for row in rows:
        assert library.decode(row.ids) == row.decoded
        assert row.ids == library.encode(row.decoded, add_bos=True, add_eos=True)


def test_an_empty_table(none):
    assert sentence_pieces.encoding_digests(none, PATH).collect() == []
    assert sentence_pieces.encoded(none, PATH).collect() == []
