"""Token files: grammar round trips, random access, ids against the tokenizers library."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import token_files
from riskloom.llm.bpe import SPACE, is_latin, tokenizer
from riskloom.plans.lineage import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, base long, part int, seq int, ids string, h long, r long"


def written(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 1, 1, 1, "x", 1, 1) for i, t in rows], DOCS)
    return token_files.write(docs, scratch_path(spark, "test"), VOCABULARY, **options)


def library(text):
    return tokenizer(VOCABULARY).encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(0, 400), st.integers(0, 400))
def test_grammar_round_trip_and_random_access(ids, low, high):
    ids = np.array(ids, np.uint32)
    raw = token_files.packed(ids, 6)
    first, rules, lengths, seq = token_files.unpacked(raw)
    assert token_files.expanded(seq, rules, first).tolist() == ids.tolist()
    for rule, length in zip(rules, lengths):
        assert len(token_files.expanded(rule, rules, first)) == length
    assert token_files.ids_between(raw, low, high).tolist() == ids[low:high].tolist()


def test_grammar_shrinks_repeats_and_keeps_rules_apart():
    rng = np.random.default_rng(3)
    phrase = rng.integers(0, 1000, 50)
    ids = np.concatenate([phrase if rng.random() < 0.5 else rng.integers(0, 1000, 50) for _ in range(400)]).astype(np.uint32)
    rules, _, seq = token_files.grammar(ids, 1000)
    assert len(seq) + 2 * len(rules) < 0.65 * len(ids)
    assert token_files.expanded(seq, rules, 1000).tolist() == ids.tolist()
    assert len({tuple(r) for r in rules.tolist()}) == len(rules)


def test_wide_symbols():
    ids = np.tile(np.array([70_000, 80_000, 3], np.uint32), 50)
    raw = token_files.packed(ids, 90_000)
    assert raw[4] == 4 and token_files.ids_between(raw, 10, 100).tolist() == ids[10:100].tolist()


TEXTS = [
    "Plain words, repeated words, plain words.", "Ünïcode ÀÉ straße ﬁ ① don't we'll IT'S", "中文 日本語のテキスト emoji 😀😀",
    "tabs\tand\nlines\r\n\x85\xa0 end", "control\x1cinside\x1f it", "<|endoftext|> x<|startoftext|>y <| endoftext |>",
    "é combining İ", "", None, "   ", "ªº µ x² 1234 12.5", "word." * 30, "a" * 500,
]


@pytest.mark.parametrize("shard", [1, 37, 1 << 20])
def test_documents_equal_the_library_for_any_shard_size(spark, shard):
    rng = random.Random(shard)
    rows = [(i, rng.choice(TEXTS) if i % 3 else " ".join(rng.choice("ab cd Ef, gh. é".split()) for _ in range(i))) for i in range(80)]
    rng.shuffle(rows)
    files = written(spark, rows, shard_ids=shard)
    start = 0
    got = {r.doc_id: r for r in token_files.documents(files).collect()}
    flat = []
    for i, text in sorted(rows):
        ids = library(text)
        assert (got[i].start, got[i].n_tokens) == (start, len(ids))
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids
        start += len(ids)
        flat += ids
    for low, high in ((0, 5), (start // 2, start // 2 + 60), (start - 3, start + 9), (7, 7)):
        parts = sorted(token_files.between(files, low, high).collect())
        assert [x for p in parts for x in np.frombuffer(p.ids, "<u4").tolist()] == flat[low:high]


def test_null_and_repeated_ids_and_an_empty_table(spark):
    rows = [(None, "b b"), (None, None), (4, "same"), (4, "same"), (4, "other words"), (-2, "first")]
    got = sorted(token_files.documents(written(spark, rows)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, -2, 4, 4, 4]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert sorted(zlib.crc32(r.ids) for r in got) == sorted(zlib.crc32(np.array(library(t), "<u4").tobytes()) for _, t in rows)
    assert token_files.documents(written(spark, [])).count() == 0


def test_words_held_are_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "WORDS_HELD", 3)
    words = token_files.WordIds(VOCABULARY, 1)
    for text in ("one two three four five", "six seven", "one two", ""):
        assert words.encoded([text])[0].tolist() == library(text)
    assert len(words.number) <= 3 + 2


LETTERS = "ab9Z_\xdf\xf7\xf6\xe9\x20\xb5\xb2\xf1.,!?;:'-<|\x1cx\n"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(LETTERS), max_size=30), max_size=6))
def test_parts_of_texts(texts):
    """The parts are those of a pattern run over each text, but for white space the tokenizer drops."""
    closing = re.compile("([0-9a-z\xdf-\xf6\xf8-\xff])([.,!?;:])")

    def parts(text):
        if "<|" not in text and is_latin(text):
            text = closing.sub(r"\1 \2", text.lower())
        return [w for w in SPACE.split(text) if w]

    got = [[w for part in some for w in SPACE.split(part) if w] for some in token_files.cut(texts).to_pylist()]
    assert got == [parts(t) for t in texts]


def test_long_sequences_look_rules_up():
    """A sequence longer than its rules is expanded by one lookup per symbol."""
    rng = np.random.default_rng(5)
    ids = np.tile(rng.integers(0, 50, 300), 40).astype(np.uint32)
    ids[rng.integers(0, len(ids), 900)] = 7
    rules, lengths, seq = token_files.grammar(ids, 50)
    body = [token_files.expanded(rule, rules, 50) for rule in rules]
    assert [len(b) for b in body] == lengths.tolist()
    long = np.tile(seq, 5 + 4 * len(rules) // len(seq))
    flat = np.concatenate([body[s - 50] if s >= 50 else [s] for s in long.tolist()])
    assert len(long) > 4 * len(rules) and token_files.expanded(long, rules, 50).tolist() == flat.tolist()
    flat, stop = token_files.gathered(np.array([5, 6, 7, 8], np.uint32), np.array([2, 0, 1, 1]), np.array([2, 0, 1, 0]))
    assert flat.tolist() == [7, 5, 6, 5, 6] and stop.tolist() == [1, 3, 3, 5]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(LETTERS + "\xa0\x85​"), max_size=20), max_size=5))
def test_parts_do_not_depend_on_the_other_texts(texts):
    assert token_files.cut(texts).to_pylist() == [token_files.cut([t]).to_pylist()[0] for t in texts]
