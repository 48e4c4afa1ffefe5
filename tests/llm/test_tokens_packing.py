import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ackline.llm import packing, tokens

ODD = [
    None,
    "",
    " \t\n",
    "It's a DOG'S ''s life, isn't it?",
    "İstanbul ΣΑΣ naïve ÉCOLE",
    "a<|endoftext|>b <|x <|startoftext|>",
    "\x1ca\x1db\x1e",
    "½ x²y ª µm 12345",
    "nel\x85nbsp\xa0tab\tend",
    "\x00 zero \x00b",
    "word " * 3000,
    "unheardofwordthatislong" * 40,
    "汉字 mixed 한글 text",
]


def expected(vocabulary, text):
    return Tokenizer.from_file(vocabulary).encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(vocabulary):
    encode = tokens.encoder(vocabulary)
    for text in ODD:
        got = np.frombuffer(encode.ids(text or ""), "<u4").tolist()
        assert got == expected(vocabulary, text), text


def test_words_outside_latin_1_keep_the_shortcut_for_the_rest(vocabulary):
    """Any mix of words and white space gives the library's ids; one odd word does not send the text there whole."""
    rng = random.Random(5)
    words = ["it’s", "“DOG'S", "naïve", "e\u0301cole", "\u0301a", "ΣΑΣ", "İst", "Straße", "ŸÿŒ", "KK", "汉字", "한글", "ｶﾞ", "the", "It's", "½x²", "\u200bz"]
    words += ["a\ufeffb", "🙂🙂", "x" * 90, "字" * 90, "ﬁn", "\u0130", "ǅ", "1٣", "don’t—stop", "\u180ey", "क्षि"]
    gaps = [" ", "\n", "\t\r\n", "\xa0", "\x85", "\u1680", "\u2000", "\u2003", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "  "]
    encode = tokens.WordEncoder(vocabulary)
    whole = Tokenizer.from_file(vocabulary)
    for _ in range(600):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(1, 30)))
        assert np.frombuffer(encode.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text
    assert encode.words("the ‘odd’ word") == ["the", "‘odd’", "word"] and encode.words("\x1c ’") is None
    assert "the" in encode and "don’t—stop" in encode and "字" * 90 not in encode and "x" * 90 not in encode


def test_whole_tokens_are_proved(vocabulary):
    encode = tokens.encoder(vocabulary)
    assert len(encode.whole) > 30_000
    for word in list(encode.whole)[::997]:
        assert expected(vocabulary, word) == [int.from_bytes(encode.whole[word], "little")]


def test_latin_words_need_the_merges_alone(vocabulary, monkeypatch):
    """Every Latin-1 word is merged without the normaliser and pre-tokeniser, and gets the library's ids."""
    rng = random.Random(9)
    letters = [chr(i) for i in range(256)] + list("aeinorst") * 30 + ["'s", "é", "ß", "½"] * 8
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 15))) for _ in range(4000)]
    texts = [" ".join(words[i : i + 20]) for i in range(0, len(words), 20)]
    encode = tokens.WordEncoder(vocabulary)
    texts = [t for t in texts if encode.words(t) is not None] + [chr(i) for i in range(33, 256)]
    whole = [expected(vocabulary, t) for t in texts]

    class MergesOnly:
        model = encode.library.model

    monkeypatch.setattr(encode, "library", MergesOnly())
    assert [np.frombuffer(encode.ids(t), "<u4").tolist() for t in texts if encode.words(t) is not None] == whole


def test_counts(make, vocabulary):
    docs = make(enumerate([*ODD, ODD[3]]))
    rows = {r.doc_id: r for r in tokens.count_tokens(docs.withColumnRenamed("lang", "n_tokens"), vocabulary).collect()}
    for i, text in enumerate([*ODD, ODD[3]]):
        n = len(expected(vocabulary, text))
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len((text or "").encode()), n, n > 2048)
        assert rows[i].source == "s"
    assert tokens.token_count_digest(make([]), vocabulary).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_round_trip(make, vocabulary, rule):
    texts = [*ODD, "some words here " * 5000, *["short text"] * 30]
    docs = make(enumerate(texts))
    rows = packing.pack_documents(docs, vocabulary, packing.Capacities(rule=rule)).collect()
    ids = {i: [*expected(vocabulary, t), 1] for i, t in enumerate(texts)}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, all_ids in ids.items():
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert all(r.length == 4096 for r in parts[:-1]) and sum(r.length for r in parts) == len(all_ids)
        for r in parts:
            piece = np.array(all_ids[r.start : r.start + r.length], "<u4")
            assert len(piece) == r.length and r.ids_crc32 == zlib.crc32(piece.tobytes())
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    total = sum(map(len, ids.values()))
    assert len(by_sequence) <= -(-total // 4096) + 2


def test_every_capacity_holds():
    lengths = np.sort(np.random.default_rng(1).integers(1, 900, 500))[::-1]
    caps = packing.Capacities(tokens=1000, documents=3, attention=500_000)
    with pytest.raises(ValueError):
        packing.best_fit(lengths, caps)
    lengths = lengths[lengths <= 700]
    sequence, offset = packing.best_fit(lengths, caps)
    for s in np.unique(sequence):
        held = lengths[sequence == s]
        assert held.sum() <= 1000 and len(held) <= 3 and (held**2).sum() <= 500_000
        order = np.argsort(offset[sequence == s])
        assert (offset[sequence == s][order] == np.cumsum([0, *held[order][:-1]])).all()


def test_document_and_attention_capacities_decide():
    def sequences(lengths, **limits):
        return len(np.unique(packing.best_fit(np.array(lengths), packing.Capacities(**limits))[0]))

    # By tokens alone each list fits one sequence.
    assert sequences([1] * 12) == sequences([10] * 12) == 1
    assert sequences([1] * 12, documents=3) == 4
    assert sequences([10] * 12, attention=200) == 6


def test_nothing_to_pack(make, vocabulary):
    assert packing.pack_documents(make([]), vocabulary).collect() == []
    only = packing.pack_documents(make([(None, None)]), vocabulary).collect()
    assert [(r.doc_id, r.length, r.offset) for r in only] == [(None, 1, 0)]
