import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import tokens as tk

pytestmark = pytest.mark.skipif(not os.path.exists(tk.VOCABULARY), reason="vocabulary files are not installed")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tk.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def data():
    with open(tk.VOCABULARY, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def tiny(data):
    return tk.Encoder(data, fragment_bytes=1)


def test_cuts_are_certain(data, tiny):
    ranks = tk.load_ranks(data)
    inner = tk.inner_pairs(ranks)
    assert not (tiny.cuts & inner).any() and tiny.cuts[ord("a"), ord(" ")] and not tiny.cuts[ord(" "), ord("a")]
    assert tiny.fragments("ab cd  e  f") == ["ab", " cd", "  e  f"]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r'a1.!é日  　\u0085\x1c🚀<|>sledm"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_fragments_change_no_id(tiny, whole, text):
    assert tiny.encode(text).tolist() == whole(text)


def test_short_texts_are_cut_and_remembered(data, whole):
    encoder, text = tk.Encoder(data), "A short text, a short text of few words."
    assert len(encoder.fragments(text)) > 5 and encoder.encode(text).tolist() == whole(text)
    assert encoder.memory[b" short"] == whole(" short") and encoder.encode(text).tolist() == whole(text)


def test_whole_texts_and_special_strings(spark, whole):
    long = ("Sentence number one, don't stop. " * 4000) + "x" * 5_000 + "日本語" * 2000
    texts = [None, "", " ", "<|endoftext|> is text", long, "a", "a"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in tk.encode_corpus(df).collect()}
    assert got == {i: whole(t) if t else [] for i, t in enumerate(texts)}
    assert tk.encode_corpus(df.limit(0)).count() == 0
