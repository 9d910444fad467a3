"""Words of small Latin letters, and those with signs behind, don't pass all of the tokenizer's rules."""

from tidemark.llm import packing


def _tokenizer():
    return packing.WordTokenizer(packing.public_tokenizers.path(packing.TOKENIZER))


def test_plain_words_are_taken_by_the_model_alone(monkeypatch):
    t, asked = _tokenizer(), []
    parts = t._parts
    monkeypatch.setattr(t, "_parts", lambda own: asked.extend(own) or parts(own))
    texts = ["naïve eathha.%%% Reoush, échchque&&& straße ÿ øre", "eathha rock' (rock) reoush###"]
    got = t.encode(texts)
    assert set(asked) == {".%%%", ",", "&&&", "'", "(rock)", "###"}
    assert got == t._ids(texts)


def test_odd_words_have_the_ids_of_the_whole_text():
    letters = "".join(chr(k) for k in range(0xC0, 0x100))
    signs = "".join(chr(k) for k in range(0x21, 0x7F) if not chr(k).isalnum())
    words = [
        *letters, letters.lower(), *(f"ab{s}" for s in signs), *(f"é{s}{s}" for s in signs), f"x{signs}", "don't", "l'été.", "they'll's", "o'", "é.", "e.́", "≮", "a≮", "ªº.", "µ", "a\x01.", "\x01", "a\t.", "a .",
        "x1.", "<|endoftext|>", "a<|endoftext|>", "Ǆ.", "İ", "ſ.", "a" * 64 + ".", "b" * 65 + ".", "c" * 300, "d." + "!" * 200, "", ".", "...", "naïvë,", "ABC,", "ÀÉ!?", "K", "Å.",
    ]
    t = _tokenizer()
    texts = [*words, *(w.upper() for w in words), " ".join(words), "\n".join(words), "中 ABC, Àé. " + " ".join(words)]
    assert t.encode(texts) == t._ids(texts)
    t.older, t.kept = t.kept, {"": b""}
    assert t.encode(texts[::-1]) == t._ids(texts[::-1])
    assert all(len(p) <= 64 for p in t.kept) and all(len(p) <= 64 for p in t.stops)
