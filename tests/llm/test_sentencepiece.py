import itertools
import random
from array import array

import sentencepiece

from sparkloom.llm import sentencepiece_viterbi as sp


def test_bpe_model_matches_the_library(corpus):
    path = sp.default_model_path()
    codec, library = sp.Codec(sp.Pieces.load(path)), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t or "" for _, t in corpus] + ["  two  spaces ", "日本語 😀 \x00\t", "x" * 500, "a\n\n b", "▁", "   "]
    assert codec.encode_all(texts) == [library.encode(t) for t in texts]
    assert [codec.decode(codec.encode(t)) for t in texts if "▁" not in t] == [t for t in texts if "▁" not in t]


def toy(pieces, **more):
    return sp.Codec(sp.Pieces([("<unk>", 0.0, sp.UNKNOWN), *[(t, s, sp.NORMAL) for t, s in pieces]], **more))


def test_unigram_viterbi_is_the_best_of_all_segmentations():
    rng = random.Random(3)
    alphabet = "ab▁"
    names = ["".join(x) for n in (1, 2, 3) for x in itertools.product(alphabet, repeat=n) if sp.SPACE not in "".join(x)[1:]]
    for _ in range(20):
        chosen = [(t, -rng.random() * 5) for t in rng.sample(names, 12)]
        codec, score = toy(chosen), dict(chosen)
        word = sp.SPACE + "".join(rng.choice("abc") for _ in range(7))
        into = {}
        codec.segment([word], into)
        unknown = codec.unknown_score

        def best(rest):
            if not rest:
                return 0.0
            one = [unknown + best(rest[1:])] if rest[0] not in score else []  # a character that is a piece is never unknown
            return max([score[rest[:n]] + best(rest[n:]) for n in (1, 2, 3) if rest[:n] in score] + one)

        got = sum(unknown if key == codec.unknown else codec.scores[key] for key in array("i", into[word]))
        assert abs(got - best(word)) < 1e-9


def test_cache_turns_over(monkeypatch, corpus):
    model = sp.Pieces.load(sp.default_model_path())
    texts = [t or "" for _, t in corpus]
    want = sp.Codec(model).encode_all(texts)
    monkeypatch.setattr(sp, "CACHE_WORDS", 5)
    monkeypatch.setattr(sp, "CACHE_PAIRS", 5)
    codec = sp.Codec(model)
    assert [codec.encode(t) for t in texts] == want == [codec.encode(t) for t in texts]
