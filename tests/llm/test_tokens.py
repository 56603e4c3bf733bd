import copy
import json
import random

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from llm_fixtures import clashing, documents, frame

from lotmarket.llm import piece_transducer, token_count

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def odd_texts():
    rng = random.Random(1)
    out = ["", "aaaaaaa" * 50, "<|endoftext|> a<|endoftext|>b <|startoftext|>", "<s> a</s>b <unk> <0x0A>", "İstanbul ΣΑΣ ς ῼ", "日本語 テキスト　x",
           "a\x1cb\x85c\xa0d", "café", "x" * 4000, "don't I'LL we'Re", "😀👍🏽 x", "  lead   and  trail   ", "\n\n a\n b\t", "ㅤᄀ각"]
    out += ["".join(rng.choice("ab cdeéthein'!?<|>\n\t   ") for _ in range(rng.randrange(200))) for _ in range(300)]
    return out + ["".join(chr(rng.choice([rng.randrange(1, 0x300), rng.randrange(1, 0xd7ff), rng.randrange(0x1f300, 0x1f6ff)])) for _ in range(50)) for _ in range(200)]


def test_token_counts_equal_the_library(spark):
    rows = documents() + [(1000 + i, t, None, None, None) for i, t in enumerate(odd_texts())]
    library = tokenizers.Tokenizer.from_file(WORDS)
    got = token_count.counted(clashing(frame(spark, rows)), WORDS).collect()
    assert len(got) == len(rows)
    for r in got:
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((r["text"] or "").encode()), n > 2048)


def test_pieces_equal_the_library(spark):
    rows = documents() + [(1000 + i, t, None, None, None) for i, t in enumerate(odd_texts())]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    out = piece_transducer.encoded(clashing(frame(spark, rows)), PIECES)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["pieces"] == library.encode(r["text"] or "") and r["n_pieces"] == len(r["pieces"])
        assert r["round_trip"]
    for r in piece_transducer.decoded(out.select("text", "pieces"), PIECES).collect():
        assert r["decoded"] == (r["text"] or "")


def test_scores_give_the_shortest_path():
    """A unigram machine against all segmentations."""
    pieces = {"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4}
    scores = [-1.0, -1.5, -2.2, -1.1, -3.0]
    machine = piece_transducer.Machine(pieces, scores, list(range(256)), [p.encode() for p in pieces], False, False)

    def best(text):
        if not text:
            return 0.0
        return max(scores[k] + best(text[len(p):]) for p, k in pieces.items() if text.startswith(p))

    for n in range(1, 9):
        for bits in range(1 << n):
            text = "".join("ab"[bits >> i & 1] for i in range(n))
            assert sum(scores[k] for k in machine.encode(text)) == pytest.approx(best(text))


def test_empty(spark):
    assert token_count.counted(frame(spark, []), WORDS).collect() == []
    assert piece_transducer.encoded(frame(spark, []), PIECES).collect() == []


def test_vocabularies_of_another_kind_are_refused(spark, tmp_path):
    with open(WORDS, encoding="utf-8") as f:
        spec = json.load(f)
    token_count.check_kind(spec)

    def changed(change):
        other = copy.deepcopy({k: v for k, v in spec.items() if k != "model"}) | {"model": dict(spec["model"])}
        change(other)
        return other

    others = [changed(c) for c in (
        lambda x: x["normalizer"]["normalizers"].pop(), lambda x: x.update(normalizer=None), lambda x: x.update(pre_tokenizer=None),
        lambda x: x["pre_tokenizer"]["pretokenizers"][0].update(invert=False), lambda x: x["pre_tokenizer"]["pretokenizers"][1].update(add_prefix_space=True),
        lambda x: x["added_tokens"][0].update(lstrip=True), lambda x: x["model"].update(byte_fallback=True), lambda x: x["model"].update(type="WordPiece"),
        lambda x: x["model"].update(end_of_word_suffix=None), lambda x: x.update(truncation={"max_length": 3}))]
    for other in others:
        with pytest.raises(ValueError):
            token_count.check_kind(other)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(others[0]))
    with pytest.raises(ValueError):
        token_count.counted(frame(spark), str(path))


def test_the_vocabulary_is_not_read_in_the_tasks(spark, tmp_path):
    path = tmp_path / "words.json"
    with open(WORDS, "rb") as f:
        path.write_bytes(f.read())
    out = token_count.counted(frame(spark), str(path))
    path.unlink()
    rows = {(r["text"], r["n_tokens"]) for r in out.collect()}
    assert rows == {(r["text"], r["n_tokens"]) for r in token_count.counted(frame(spark), WORDS).collect()}


def test_texts_all_null(spark):
    rows = [(i, None, None, None, None) for i in range(5)]
    assert {(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_count.counted(frame(spark, rows), WORDS).collect()} == {(0, 0, False)}
