"""Cutting texts into pieces against the tokenizers themselves."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tezgah.llm import tokens

FILES = [("word_bpe_49k.json", tokens.BARE), ("byte_bpe_50k.json", tokens.SPACED)]
PARTS = ["by-nc", "don't", "I'LL", "'s", "''s", " 's", "x's's", "('ve", "l'été", "'", "'re-", "42nd", "3.14", "²½", "_a_", "a_b", "…", "“q”", "€5", "Жук", "Ёлка", "ΣΑΣ", "é", "é", "İstanbul",
         "ſt", "K", "日本語", "한국", "😀", "👩‍👧", " ", " ", "\u0085", "\n", "\n\n", "\t", " ", "  ", "   ", "\r\n", "\x1f", "\x00", "<|endoftext|>", "<|startoftext|>", "<|endof", "ŉ", "ǅ", "ﬁ", "Ⅳ", "٣", "हिन्दी"]


@pytest.mark.parametrize(("name", "pieces"), FILES)
def test_any_mixture_of_signs_has_the_ids_of_the_whole_text(name, pieces, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 60)  # generations change often
    monkeypatch.setattr(tokens, "JOINED", 7)
    monkeypatch.setattr(tokens, "GATHERED", 11)
    monkeypatch.setattr(tokens, "CUT", 300)
    rng = random.Random(name)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(12))) for _ in range(3000)] + PARTS + ["", None, " ", "\n"]
    texts += ["".join(chr(rng.choice([rng.randrange(0x250), rng.randrange(0x2000, 0x2070), rng.randrange(0x370, 0x530)])) for _ in range(8)) for _ in range(2000)]
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    own = list(tokens.Encoder(public_tokenizers.path(name), pieces, "<u4").encode(texts))
    for text, ids in zip(texts, own, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize(("name", "pieces"), [(FILES[0][0], FILES[1][1]), (FILES[1][0], FILES[0][1])])
def test_a_tokenizer_that_cuts_otherwise_is_refused(name, pieces):
    with pytest.raises(ValueError, match="cuts texts"):
        tokens.Encoder(public_tokenizers.path(name), pieces, "<u4")
