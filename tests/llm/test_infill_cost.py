"""Fill-in-middle counts its units as the Split pre-tokenizer does, and takes no more of its offsets than the cuts need."""

import pytest

tokenizers = pytest.importorskip("tokenizers")

from siftwell.llm import infill

SPLIT = tokenizers.pre_tokenizers.Split(tokenizers.Regex(r"(?m:.)"), behavior="isolated")


def test_offsets_are_taken_for_the_blocks_of_the_cuts_alone(monkeypatch):
    taken, whole = [], tokenizers.PreTokenizedString

    class Recorded:
        def __init__(self, text):
            self.inner = whole(text)

        def get_splits(self, *kinds):
            taken.append(len(found := self.inner.get_splits(*kinds)))
            return found

    class Splitter:
        def pre_tokenize(self, block):
            SPLIT.pre_tokenize(block.inner)

        def pre_tokenize_str(self, text):
            taken.append(len(found := SPLIT.pre_tokenize_str(text)))
            return found

    monkeypatch.setattr(tokenizers, "PreTokenizedString", Recorded)
    monkeypatch.setattr(infill, "_splitter", Splitter)
    text = "née 😀\n" * 3000
    assert infill.cut(text, 5000, 13001) == (18000, text[:5000], text[5000:13001], text[13001:])
    assert 0 < sum(taken) <= 2 * infill.BLOCK


def test_counts_are_those_of_the_pre_tokenizer():
    width = infill.BLOCK
    for text in ("", "\n", "\r\n" * width, "é́" * (2 * width + 1), "x" * (width - 1) + "😀‍😀" + "\x00\x85 " * width, "你" * (3 * width)):
        blocks = [text[k : k + width] for k in range(0, len(text), width)]
        assert infill.lengths(text).tolist() == [len(SPLIT.pre_tokenize_str(block)) for block in blocks]
        assert [infill.offsets(text, k).tolist() for k in range(len(blocks))] == [[k * width + at for _, (at, _) in SPLIT.pre_tokenize_str(block)] for k, block in enumerate(blocks)]
        assert infill.lengths(text).sum() == len(text)
        for rank in range(0, len(text) + 1, 7):
            assert infill.cut(text, rank, len(text)) == (len(text), text[:rank], text[rank:], "")
