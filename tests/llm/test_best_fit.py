"""Best-fit packing against a plain search of all open bins, and ids against the tokenizer."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landfall.llm import word_tokens
from landfall.llm.best_fit import OpenBins, pack_best_fit
from landfall.llm.queries import op13_best_fit
from conftest import SMALL
from llm.test_llm_units import LONG, empty, frame, odd, small, texts_of

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(word_tokens.TOKENIZER_FILE))
ODD_TEXTS = [
    "", " ", "\n", "a'S 'll it's I'VE <|endoftext|> x<|startoftext|>y < |", "é é É İ ß ẞ Σ ΣΑΣ",
    "a\tb\r\nc\xa0d e\x1cf\x85g", "日本語、テスト。漢字！12a", "ab12cd_34-5*×÷", "́a ́",
    "´`¨ ª º µ Å K", "naïve-Ünïcode​ zero", "x\n\n\ny  z ", "힣가", "ﬁ ſ ŉ", "WORD word, Word. ÀÉß×Ö",
]


def ids_of(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def encoded(texts):
    found = word_tokens.word_encoder().encode(texts)
    return [[int(i) for part in parts for i in part] for parts in found]


def test_ids_equal_those_of_the_tokenizer(spark):
    texts = [*ODD_TEXTS, LONG, *(text for _, text in texts_of(small(spark)))]
    assert encoded(texts) == [ids_of(text) for text in texts]


def test_texts_cut_at_borders_keep_their_ids():
    rng = random.Random(1)
    letters = "ab cZ'stl\n09<|>éßÀ .,-_!日、\t\x00\x1f\x7f\xadKİẞ\U0001f600"
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 14)))
        parts = list(word_tokens.spans(text, 4))
        assert "".join(parts) == text
        assert sum(encoded(parts), []) == ids_of(text), text


def test_long_texts_and_forgotten_runs_change_nothing(monkeypatch):
    monkeypatch.setattr(word_tokens, "SPAN", 1000)
    monkeypatch.setattr(word_tokens, "REMEMBERED", 50)
    texts = ["short", LONG, "deadbeef0" * 2000, "", "漢字。" * 900, "x" * 5000]
    assert encoded(texts) == [ids_of(text) for text in texts]


class Searched:
    """Best fit by looking at every open bin."""

    def __init__(self, capacity, limit):
        self.capacity, self.limit, self.open, self.next = capacity, limit, [], 0

    def place(self, size):
        fitting = [b for b in self.open if b[0] >= size]
        if fitting:
            chosen = min(fitting, key=lambda b: (b[0], -b[2]))
        else:
            if len(self.open) == self.limit:
                self.open.remove(min(self.open, key=lambda b: (b[0], -b[2])))
            chosen = [self.capacity, self.next, 0]
            self.next += 1
            self.open.append(chosen)
        offset = self.capacity - chosen[0]
        chosen[0] -= size
        self.clock = getattr(self, "clock", 0) + 1
        chosen[2] = self.clock
        if not chosen[0]:
            self.open.remove(chosen)
        return chosen[1], offset


@pytest.mark.parametrize("limit", [1, 2, 7, 1000])
def test_bins_agree_with_a_search_of_all_open_bins(limit):
    rng = random.Random(limit)
    fast, slow = OpenBins(64, limit), Searched(64, limit)
    for _ in range(3000):
        size = rng.randint(1, 64)
        assert fast.place(size) == slow.place(size)


def check_pieces(found, texts, tokens=2048):
    """Documents are whole where they fit, and sequences have no gap and no overlap."""
    wanted, places = {}, {}
    for doc, text in texts:
        ids = [*ids_of(text or ""), 0]
        for piece, start in enumerate(range(0, len(ids), tokens)):
            data = tuple(ids[start : start + tokens])
            wanted.setdefault((doc, piece, start, data), []).append(0)
    for r in found:
        key = (r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist()))
        assert r.length == len(key[-1])
        wanted[key].pop()
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert not any(wanted.values())
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens
    return places


def test_odd_documents_are_packed_whole(spark):
    docs = odd(spark)
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check_pieces(pack_best_fit(docs).collect(), texts)
    check_pieces(pack_best_fit(docs, tokens=7, open_sequences=3, lookahead=1).collect(), texts, 7)
    assert pack_best_fit(empty(spark)).collect() == []


def test_little_is_padded_and_a_repeated_run_agrees(spark):
    docs = small(spark).coalesce(1)
    found = pack_best_fit(docs).collect()
    places = check_pieces(found, texts_of(docs))
    total = sum(length for parts in places.values() for _, length in parts)
    assert len(places) <= 1.02 * total / 2048 + 1
    assert sorted(found) == sorted(pack_best_fit(docs).collect())


def test_the_query_returns_the_digest_of_each_piece(spark):
    found = op13_best_fit(spark, SMALL)
    assert found.columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ]
    pieces = pack_best_fit(small(spark)).withColumn("ids_crc32", F.crc32("ids"))
    assert sorted(found.collect()) == sorted(pieces.select(*found.columns).collect())
