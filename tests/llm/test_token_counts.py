from __future__ import annotations

import random

import pytest

pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from lectern.llm.queries import tokenizer_json  # noqa: E402
from lectern.llm.token_counts import Counts, additive, token_counts  # noqa: E402

from .helpers import SF, awkward, frames, same_rows  # noqa: E402

SPEC = tokenizer_json()
PIECES = [" ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "\u180e", "\u200b", "a", "Bc", "12", "é", "’s", "'s", "'re", "...", "!?", "中文",
          "😀", "\u0558", "\U000107bb", "<|endoftext|>", "<|endof", "the", " \n", "\n "]


def whole(spec: str):
    t = Tokenizer.from_str(spec)
    return lambda text: len(t.encode(text or "", add_special_tokens=False))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_like_the_library(name):
    spec = tokenizer_json(name)
    want, counts, rnd = whole(spec), Counts(spec, {}), random.Random(1)
    assert additive(spec) == (name == "byte_bpe_50k.json")
    for _ in range(4000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 25)))
        assert counts.count(text) == want(text), repr(text)


def test_every_character_between_spaces():
    want, counts = whole(SPEC), Counts(SPEC, {})
    for start in range(0, 0x30000, 16):
        text = "".join(f"a {chr(c)}b {chr(c)} {chr(c)}\n{chr(c)}" for c in range(start, start + 16) if not 0xD800 <= c < 0xE000)
        assert counts.count(text) == want(text), hex(start)


def test_awkward_rows(spark):
    docs, clashing, empty = frames(spark)
    count = whole(SPEC)
    want = [(i, len((t or "").encode()), count(t)) for i, t, *_ in awkward()]
    assert same_rows(want, [tuple(r) for r in token_counts(docs, SPEC).collect()])
    assert same_rows(want, [tuple(r) for r in token_counts(clashing, SPEC, table_size=3).collect()])
    assert token_counts(empty, SPEC).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    count = whole(SPEC)
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, SPEC).collect()}
    assert got == {r.doc_id: count(r.text) for r in docs.select("doc_id", "text").collect()}
