"""Packing: ids against the tokenizers library, bins valid and few, the search only improving."""

import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from lakevault.llm import packing as op
from lakevault.llm import tokens

SCHEMA = "doc_id long, text string, piece string, start int"


def _texts():
    rng = random.Random(4)
    odd = ["", " ", "\n\n  x", "don't", "été ñandú größe", "x" * 30_000, " " * 9000 + "z", "<|endoftext|>", "a<|endoftext|>b", "\U0001f600 ok", "12345 6,7", "\x00\x7f", "日本語テキスト"]
    return odd + ["".join(rng.choice(["the ", "Thing", " ", "\n", "7", "é", "'s ", "-", "<|"]) for _ in range(rng.randint(1, 3000))) for _ in range(60)]


def test_ids_equal_those_of_tokenizers():
    encode, slow = tokens.encoder(), Tokenizer.from_file(tokens.default_path())
    for text in _texts():
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_pieces_and_places(spark):
    slow = Tokenizer.from_file(tokens.default_path())
    rows = [(i, t, "x", 1) for i, t in enumerate(_texts())] + [(900, None, None, None), (None, "no id", "x", 1), (3, "don't", "x", 1), (901, "word " * 50_000, "x", 1)]
    got = op.pack_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        want[doc_id].append(slow.encode(text or "", add_special_tokens=False).ids + [0])
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    for doc_id, all_ids in want.items():
        expected = []
        for ids in all_ids:
            first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
            cuts = [0, *range(first, len(ids) + 1, 2048)]
            expected += [(i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(by_doc[doc_id]) == sorted(expected)
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) + 2
    with_ids = op.document_pieces(spark.createDataFrame(rows[:3], SCHEMA), with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in with_ids)


def test_search_raises_squared_fill_and_saves_bins():
    rng = np.random.default_rng(0)
    for low, high in ((1, 2049), (300, 1100), (600, 1500)):
        lengths = rng.integers(low, high, 3000)
        first = op.best_fit(lengths, 2048)
        better = op.improve([list(b) for b in first], lengths, 2048)
        fill = lambda bins: [int(lengths[b].sum()) for b in bins]
        assert sorted(i for b in better for i in b) == list(range(3000)) and max(fill(better)) <= 2048
        assert len(better) <= len(first) and sum(f * f for f in fill(better)) >= sum(f * f for f in fill(first))
    # best fit leaves three bins here, an exchange empties one
    lengths = np.array([6, 5, 5, 4, 4, 4, 2])
    assert len(op.improve([[0, 2], [1, 3], [4, 5, 6]], lengths, 15)) == 2


def test_empty_table(spark):
    assert op.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []
