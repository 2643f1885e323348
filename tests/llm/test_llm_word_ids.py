"""Word-by-word encoding gives the tokenizers' own ids."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txmill.llm import token_files, word_ids

NAMES = {"byte_bpe_50k.json": token_files.Encoder, "word_bpe_49k.json": word_ids.SpaceFreeEncoder}
COMMON = "abcXYZ '\"sdtrvml.,;:!?()-_/\\#0123456789 \t\n\r\x0b\x0c\x00\x1b\x7fàéîõüßÀÉÿñ"
UNCOMMON = COMMON + "\x1c\x1f\x85\xa0 　​×÷ªº²½İıſḰ̈Σςあ字한😀﻿\U00010400"

_codes = {}


def codes_of(name):
    path = pytest.importorskip("public_tokenizers").path(name)
    if name not in _codes:
        _codes[name] = NAMES[name](path)
        assert _codes[name].by_words
    return _codes[name]


def same(name, text):
    codes = codes_of(name)
    whole = codes.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(codes.encode(text), "<u4").tolist() == whole, repr(text)


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("alphabet", [COMMON, UNCOMMON, None])
def test_any_text(name, alphabet):
    texts = st.text(max_size=60) if alphabet is None else st.text(alphabet=alphabet, max_size=60)

    @settings(max_examples=400, deadline=None)
    @given(texts)
    def run(text):
        same(name, text)

    run()


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("text", ["", " ", "a<|endoftext|>b", "<|startoftext|> x", "word.\nWord, wörd's 12,5", "a " * 20_000])
def test_chosen_texts(name, text):
    same(name, text)


@pytest.mark.parametrize("name", NAMES)
def test_every_white_space_and_the_ends_of_planes(name):
    for k in [*(i for i in range(0x110000) if chr(i).isspace()), 0, 0x7F, 0xFF, 0x100, 0xFFFD, 0x10FFFF]:
        for text in (f"a{chr(k)}b", f"a {chr(k)} b", f"{chr(k)}a", f"a{chr(k)}"):
            same(name, text)


@pytest.mark.parametrize("name", NAMES)
def test_every_document(spark, sf_dir, name):
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        same(name, row.text or "")


def test_a_full_store_starts_anew_and_stays_right(monkeypatch):
    asked = []
    store = word_ids.Remembered(lambda k: asked.append(k) or k.encode(), 2)
    assert [store[k] for k in "abcab"] == [b"a", b"b", b"c", b"a", b"b"]
    assert len(store) <= 2 and asked == list("abcab")
    assert store["b"] == b"b" and len(asked) == 5
