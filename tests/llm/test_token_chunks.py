"""Chunks that the token store tokenises one by one."""

import json
import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

import public_tokenizers
from strata.llm.queries import TOKENIZER
from strata.llm.token_store import ChunkTokenizer

PATH = public_tokenizers.path(TOKENIZER)


def _ids(own: ChunkTokenizer, texts) -> list[list[int]]:
    return [np.frombuffer(b, own.dtype).tolist() for b in own.encode(texts)]


def _plain(texts: list[str], path: str = PATH) -> list[list[int]]:
    return [e.ids for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]


def test_a_word_is_learned_once_whatever_mark_or_line_follows():
    own = ChunkTokenizer(PATH)
    texts = ["Zword, zword zword.\nZword zword; zword", "Zword zword)\nZword zword!", "a été, été été.\nété, слово; слово"]
    assert _ids(own, texts) == _plain(texts)
    learned = [k.decode() for k in own.known.keys.to_pylist()]
    assert [c for c in learned if "word" in c] == ["Zword", " zword"]
    assert sorted(c for c in learned if "ét" in c or "сл" in c) == [" été", " слово", "été"]


def test_odd_texts_give_the_ids_of_whole_texts():
    rng = random.Random(7)
    parts = [*"aBéçß×÷ªµЖяʰا日本ー한😀́1٣²½'’“—.,!()-_<|>#\x00\x7f\x1c\x1f\x85\xa0   　​\n\r\t\x0b",
             " ", " ", " ", " ", "  ", "'s", "'ll", "\n\n", " \n", "the", "<|endoftext|>", "x" * 70]
    own = ChunkTokenizer(PATH)
    for _ in range(40):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(50)]
        assert _ids(own, texts) == _plain(texts)
        assert _ids(own, pa.array(["zz.\n", *texts, "q "]).slice(1, 50)) == _plain(texts)  # shares its buffers


def test_every_short_letter_beside_blanks_marks_and_lines():
    own = ChunkTokenizer(PATH)
    texts = [t for c in map(chr, range(0x3001)) for t in (f"a{c}, {c}b", f"{c}1{c}.\n{c}", f"é{c}\n\n{c} {c}", f" {c} ")]
    assert _ids(own, texts) == _plain(texts)


def test_texts_stay_whole_for_a_tokenizer_of_another_pattern(tmp_path):
    other = Tokenizer.from_file(PATH)
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True, use_regex=False)
    other.save(path := str(tmp_path / "other.json"))
    assert json.loads(other.to_str())["pre_tokenizer"]["use_regex"] is False
    texts = ["", "one two, two", "one  two\n three", "the the the"]
    assert _ids(ChunkTokenizer(path), texts) == _plain(texts, path)


def test_ids_are_put_together_in_runs(monkeypatch):
    from strata.llm import token_store

    monkeypatch.setattr(token_store, "SPREAD_CHUNKS", 3)
    texts = ["", "a b c d e f", "", "g", "h, i", "", "j k l", "m"]
    assert _ids(ChunkTokenizer(PATH), texts) == _plain(texts)
    assert ChunkTokenizer(PATH).encode([]) == []
    assert ChunkTokenizer(PATH).encode(["", ""]) == [b"", b""]
