"""What the packing encoder keeps, and how often it encodes a word."""
import random

from tessera.llm.packing import Encoder
from tessera.llm.queries import tokenizer_path


def test_a_word_is_encoded_once_with_all_its_marks(monkeypatch):
    learned = []
    piece = Encoder._piece
    monkeypatch.setattr(Encoder, "_piece", lambda self, p: learned.append(p) or piece(self, p))
    encoder = Encoder(tokenizer_path())
    learned.clear()
    texts = ["x Straße, Straße. Straße&&&", "x Straße Straße.\nUnd Straße", "x Straße,  Und"]
    for text, ids in zip(texts, encoder.ids(texts)):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(learned) == sorted([" Straße", ",", ".", "&&&", "Und"])
    # A word has one entry, and two words around a line break have none.
    assert "Straße" in encoder.parts and " Straße" not in encoder.words
    assert not any("\n" in key for key in encoder.parts)


def test_ids_of_odd_white_space_are_those_of_the_plain_call():
    rng, encoder = random.Random(7), Encoder(tokenizer_path())
    texts = ["a b ", "x y\n", "a  b c\t", " a", "a b\u00a0", "\u2003a b\u2003c d\x1c"]
    texts += ["".join(rng.choice("aBéß1.,&'_ \n\t\u00a0\u0301\u4e2d   ") for _ in range(rng.randrange(30)))
              for _ in range(3000)]
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
