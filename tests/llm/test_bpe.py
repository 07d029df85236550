import base64
import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from trackweave.llm import bpe

PATH = P.path(bpe.VOCABULARY)
RAW = open(PATH, "rb").read()
REF = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())}, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(RAW, P.PATTERN)


def check(codec, texts):
    coded = codec.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in coded] == [REF.encode_ordinary(t) for t in texts]
    assert codec.decode(coded) == [t.encode() for t in texts]


def test_cases(codec):
    rng = random.Random(1)
    check(codec, ["", " ", "  a  b ", "it's we'll  'x", "a\n\n b\t c 　d\x1cx", "naïve 日本語 🙂🙂", "\x00\x01", "a" * 3000, "ab" * 700, "".join(rng.choice("abcdeéß") for _ in range(2500)), "1234567890" * 40, "!?" * 300, "a b" + " " * 200 + "c", "<|endoftext|>"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab 'sTé\n\t1.日 \x85"), max_size=40), max_size=5))
def test_against_library(codec, texts):
    check(codec, texts)


def test_table(spark):
    df = spark.createDataFrame([(1, None, 5), (None, "hello world", 6), (2, "x", 7), (2, "x", 7)], "doc_id long, text string, n_tokens int")
    rows = bpe.encode_documents(df, PATH, P.PATTERN, keep_ids=True).collect()
    assert len(rows) == 4
    for r in rows:
        text = {1: "", None: "hello world", 2: "x"}[r.doc_id]
        assert r.ids == REF.encode_ordinary(text) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode_documents(df.limit(0), PATH, P.PATTERN).count() == 0


@pytest.mark.parametrize("kind", ["random", "one", "two", "three letters", "syllables", "characters", "marks"])
def test_very_long_words(codec, kind):
    rng = random.Random(2)
    n = 100_000
    make = {"random": lambda: rng.choices("abcdefghijklmnopqrstuvwxyz", k=n), "one": lambda: "a" * n, "two": lambda: "ab" * (n // 2), "three letters": lambda: rng.choices("aes", k=n), "syllables": lambda: rng.choices(["the", "ing", "tion", "er", "s"], k=n // 3), "characters": lambda: map(chr, (rng.randint(0x4E00, 0x9FFF) for _ in range(n // 3))), "marks": lambda: rng.choices("-=_/.", k=n)}
    began = time.perf_counter()
    text = "".join(make[kind]())
    codec.encode([text])
    assert time.perf_counter() - began < 10
    check(codec, [text, "short words too"])


def test_both_forms_of_the_rule_agree(codec, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoinshrdlu'é日", k=rng.randint(2, 60))) for _ in range(300)]
    for longest in (1, 10**6):
        monkeypatch.setattr(bpe, "LONG", longest)
        codec.forget()
        check(codec, words)


def test_very_long_text_of_words(codec):
    rng = random.Random(5)
    check(codec, [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(200_000))])


SPACES = [chr(c) for c in range(0x110000) if regex.match(r"\s", chr(c)) or chr(c).isspace()]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from([*" " * 12, *"ab'sé日🙂.1ༀ‐", *SPACES]), max_size=30), min_size=1, max_size=6))
def test_cuts_beside_every_white_space(codec, texts):
    check(codec, texts)
    whole = pa.array(["front ", *texts, "", " back"])
    assert codec.encode(whole.slice(1, len(texts))) == codec.encode(texts)


def test_white_space_is_known_by_its_bytes():
    for space in SPACES:
        pieces, starts = bpe._pieces(pa.array([f"front a{space} b {space}c d back"]))
        assert pieces.to_pylist() == ["front", f" a{space} b {space}c", " d", " back"] and starts.tolist() == [0, 4]


def test_a_word_is_contracted_once_whatever_stands_beside_it(codec, monkeypatch):
    given_ = []
    words = codec._words
    monkeypatch.setattr(codec, "_words", lambda new: given_.extend(new) or words(new))
    codec.forget()
    check(codec, ["so zyxwvutsrq, so", "(zyxwvutsrq) zyxwvutsrq. so"])
    check(codec, ["so zyxwvutsrq! zyxwvutsrq: so"])
    assert given_.count(" zyxwvutsrq") == 1 and given_.count("zyxwvutsrq") == 1


def test_distinct_pieces_are_matched_as_one_text(codec, monkeypatch):
    calls = []

    class Counting:
        def findall(self, text):
            calls.append(text)
            return pattern.findall(text)

    pattern = codec.pattern
    codec.forget()
    monkeypatch.setattr(codec, "pattern", Counting())
    check(codec, [" ".join(f"w{k}x{k}," for k in range(5000)), "a few more"])
    assert len(calls) <= 5


def test_a_pattern_that_spans_cuts_is_refused():
    with pytest.raises(ValueError, match="span a cut"):
        bpe.Codec(RAW, r"\S+ \S+|\s+|\S+").encode(["one two three four five"])
