"""Features are looked up as chunk_features makes them."""

from opspulse.llm import features as fx


def test_lookup_finds_the_features_that_chunks_have():
    chunks = ["word", "WORD", "Words", "wordsmith", "WORDSMITHS", "a_b", "re-word!!", "İstanbul", "é", "ÉTÉS", "w" * 60, "12345678", "x", "", "word|", "word.", "Wörd,", "ÉTÉ!", "a,b", "?", "..", "word?!", "ΣΑΣ.", "CAPS:", "ΣΑΣ"]
    every = sorted({f for c in chunks for f in fx.chunk_features(c)})
    for features in (every, every[::2], every[1::2], []):
        index = {f: i for i, f in enumerate(features)}
        lookup = fx.Lookup(features)
        for c in chunks:
            assert sorted(memoryview(lookup(c)).cast("i")) == sorted(index[f] for f in fx.chunk_features(c) if f in index), c
