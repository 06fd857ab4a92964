import hashlib

import numpy as np
import pytest
from cases import LONG, ROWS, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from noticeworks.llm import bpe
from noticeworks.llm.queries import vocabulary_path

PATH = vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Encoder(bpe.Vocabulary(file.read()))


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def same(library, encoder, text):
    own = ids(encoder, text)
    assert own == library.encode(text, add_special_tokens=False).ids
    assert encoder.vocabulary.decode(np.array(own)) == library.decode(own, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_the_library_does(library, encoder, text):
    same(library, encoder, text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "the", "tion", "'s", "'ll", "<|endoftext|>", "é", "12", "!?", " "])))
def test_spaces_endings_and_special_tokens(library, encoder, parts):
    same(library, encoder, "".join(parts))


def test_long_runs_of_one_symbol(library, encoder):
    for text in ("a" * 3000, "\n" * 500, " " * 700 + "x", "ab" * 800, LONG[:20_000]):
        same(library, encoder, text)


def test_full_caches_change_nothing(library, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    for text in ("the ring of the ring and of rings the end", "a b c d e f g a b c"):
        same(library, encoder, text)


def test_unknown_bytes_become_the_replacement_character(encoder, library):
    broken = [encoder.vocabulary.first[0xE9], encoder.vocabulary.first[0x41]]
    assert encoder.vocabulary.decode(np.array(broken)) == library.decode(broken) == "�A"


def test_digests_of_odd_rows(spark, library):
    df = frame(spark, extra={"n_tokens": "x", "IDS_sha256": "y"})
    rows = bpe.digests(df, PATH).collect()
    assert len(rows) == len(ROWS)
    assert {c.lower() for c in bpe.digests(df, PATH).columns} == {c.lower() for c in df.columns} | set(bpe.DIGESTS)
    for row in rows:
        text = row["text"] or ""
        own = library.encode(text, add_special_tokens=False).ids
        assert row["n_tokens"] == len(own)
        assert row["ids_sha256"] == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_encode_then_decode(spark):
    encoded = bpe.encode(frame(spark), PATH)
    assert all(r["decodes"] and r["n_tokens"] == len(r["ids"]) for r in encoded.collect())
    assert all(r["decoded"] == (r["text"] or "") for r in bpe.decode(encoded, PATH).collect())


def test_empty_table(spark):
    assert bpe.digests(frame(spark, []), PATH).count() == 0


def test_a_vocabulary_over_the_bound_is_refused(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError):
        bpe.load(spark, PATH)


def test_an_encoder_keeps_no_more_words_than_it_may(library):
    with open(PATH, encoding="utf-8") as file:
        own = bpe.Encoder(bpe.Vocabulary(file.read()), 3)
    same(library, own, "the ring of the ring, of rings! the end 12 é " * 3)
    assert all(len(x) <= 3 and len(x.old) <= 3 for x in (own.words, own.tokens))
