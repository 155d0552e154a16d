import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import tokens
from corpusmill.llm.tokens import Coder

FILES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]
CODERS = {f: (Coder(public_tokenizers.path(f), p), tokenizers.Tokenizer.from_file(public_tokenizers.path(f))) for f, p in FILES}
PIECES = st.sampled_from(["the", "The", "don't", "we'll", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "é", "É", "ß", "é", "µ", "ª", "²", "12", "3", "_", "$$$", "...", "'", "'s", "<|endoftext|>", "<|startoftext|>", "日本", "Σας", "İ", "🙂", "​", " ", "﻿", "—", "“x”", "x" * 40])


@pytest.mark.parametrize("file", [f for f, _ in FILES])
@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=4)), max_size=14).map("".join))
def test_ids_are_the_librarys(file, text):
    mine, library = CODERS[file]
    assert np.frombuffer(mine.ids([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file", [f for f, _ in FILES])
def test_long_and_forgotten(file, monkeypatch):
    monkeypatch.setattr("corpusmill.llm.tokens.REMEMBERED", 50)
    mine, library = Coder(public_tokenizers.path(file), dict(FILES)[file]), CODERS[file][1]
    texts = [" ".join(f"word{i % 97} Thing{i}." for i in range(3000)), "", "a" * 100_000]
    assert [len(b) // 4 for b in mine.balanced(texts, [len(t.encode()) for t in texts], 1000)] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("file", [f for f, _ in FILES])
@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(PIECES, st.sampled_from(["a b", " c d", "12 x", " Ab 9"]), st.text(max_size=3)), max_size=40).map("".join))
def test_pieces_and_segments_are_safe_cuts(file, text):
    mine, library = CODERS[file]
    before = tokens.PIECE
    tokens.PIECE = 3
    try:
        assert "".join(mine.pieces(text)) == text
        assert np.frombuffer(mine.ids([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    finally:
        tokens.PIECE = before


@pytest.mark.parametrize("file", [f for f, _ in FILES])
def test_long_texts_with_odd_space_or_special_strings(file):
    mine, library = CODERS[file]
    for odd in ("\x85", "<|endoftext|>", "\u2028 ", "<|startoftext|>"):
        text = ("Some plain words in a row, 12 of them. " * 4000) + odd + (" and more words" * 4000)
        assert np.frombuffer(mine.ids([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(mine.pieces(text)) > 1


@pytest.mark.parametrize("file", [f for f, _ in FILES])
def test_words_of_letters_need_no_pattern(file, monkeypatch):
    """Plain words, with or without a mark after them, go to the model without being searched for; the ids are the library's."""
    mine, library = Coder(public_tokenizers.path(file), dict(FILES)[file]), CODERS[file][1]
    text = "Plain words, été; Straße: THE ªµº end! x " + "Ünï? " * 3 + "last."
    searched, words = [], mine._words
    monkeypatch.setattr(mine, "_words", lambda t: searched.append(t) or words(t))
    assert np.frombuffer(mine.ids([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert searched == (["Plain"] if mine.prefixed else [])
