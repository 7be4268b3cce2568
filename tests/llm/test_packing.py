import random
import zlib

import numpy as np
from public_tokenizers import path
from tokenizers import Tokenizer

from venuelens.llm import packing
from venuelens.llm.encoding import Encoder

VOCABULARY = path("byte_bpe_50k.json")


def library_ids(name, texts):
    tokenizer = Tokenizer.from_file(path(name))
    tokenizer.encode_special_tokens = True
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def odd_texts():
    rng = random.Random(5)
    texts = [
        "", " ", "  a", "a  b", "a \n b", "\n\n x", "don't 's 'S we'LL", "x\xa0y \xa0z\xa0 ", "naïve Œuvre ŉ ǅ İstanbul", "“q” – — … €5 ½ ²x",
        "日本 語", "é é", "<|endoftext|> <|startoftext|>", "\x1c a\x85b", "a\tb\r\nc  \n\n d ", "ȺȾ ſ K", "A" * 5000, " " * 300 + "x",
    ]
    return texts + ["".join(rng.choice("abAB01  \n\t'sé\xa0-.,²<|>ßŠ") for _ in range(rng.randrange(1, 60))) for _ in range(2000)]


def test_looked_up_ids_are_those_of_the_library():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        coder = Encoder(path(name))
        texts = odd_texts()
        assert coder.by_word
        for _ in range(2):
            assert [coder.ids(t) for t in texts] == library_ids(name, texts)


def check(rows, placed):
    ids = library_ids("byte_bpe_50k.json", [t or "" for _, t in rows])
    want = {}
    for (d, _), raw in zip(rows, ids):
        want.setdefault(d, []).append(raw + b"\0\0\0\0")
    got = {}
    for r in placed:
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == set(want)
    for d, raws in want.items():
        if len(raws) > 1:
            continue
        at = 0
        for i, r in enumerate(sorted(got[d], key=lambda r: r.piece)):
            raw = raws[0][4 * at : 4 * (at + r.length)]
            assert (r.piece, r.start, r.ids_crc32) == (i, at, zlib.crc32(raw))
            assert r.length == 2048 or len(raws[0]) // 4 <= 2048 or i == 0
            at += r.length
        assert at == len(raws[0]) // 4
    bins = {}
    for r in placed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    return len(bins), sum(r.length for r in placed)


def test_pieces_bins_and_ids(documents, spark):
    rng = random.Random(8)
    rows = [(d, " ".join("word%d" % rng.randrange(9999) for _ in range(int(rng.lognormvariate(4.5, 1.2))))) for d in range(1200)]
    rows += [(-1, None), (-2, ""), (7, rows[7][1]), (None, "x"), (-3, "long words " * 9000)]
    df = documents(rows).repartition(6).withColumnRenamed("lang", "piece")
    placed = packing.pack(df, VOCABULARY, keep_ids=True)
    n, total = check(rows, placed.collect())
    assert n <= 1.02 * total / 2048 + 1
    whole = packing.sequences(placed).collect()
    assert all(len(r.ids) == 4 * r.length <= 4 * 2048 for r in whole) and sum(r.length for r in whole) == total


def test_few_open_bins(documents):
    rows = [(d, "a b c " * (d % 97)) for d in range(400)]
    placed = packing.pack(documents(rows), VOCABULARY, bins=4).collect()
    check(rows, placed)


def test_empty_table(documents):
    assert packing.pack(documents([]), VOCABULARY).count() == 0


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    packer = packing.BestFit(10, 2)
    assert packer.add(6, "a") is None and packer.add(5, "b") is None
    assert packer.add(4, "c") == [(6, "a"), (4, "c")]
    assert packer.add(8, "d") is None
    assert packer.add(9, "e") == [(8, "d")]
    assert sorted(packer.rest()) == [[(5, "b")], [(9, "e")]]
