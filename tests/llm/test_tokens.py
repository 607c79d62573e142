"""Token ids of words that are new to a worker."""

import pyarrow as pa
import public_tokenizers

from ledgerloom.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [" ".join(f"{a}{b}word {a}{b}x7 {a.upper()}{b}." for b in "abcdefghij") for a in "klmnopqrst"] + ["", " "]


def test_new_words_are_encoded_in_turn(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "AT_ONCE", 16, raising=False)
    seen = []

    class Watched(tokens.Encoder):
        def _ids(self, texts):
            seen.append(sum(len(t.split()) for t in texts))
            return super()._ids(texts)

    ids, counts = Watched(PATH).encode(pa.array(TEXTS))
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(TEXTS, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert max(seen) <= 16
