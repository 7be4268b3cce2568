import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from venuelens.llm import token_files as tf

VOCABULARY = path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=700), st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_blocks_round_trip(ids, percentile):
    packed, start = tf.pack_blocks(np.array(ids, np.uint32), percentile)
    assert tf.unpack_blocks(np.frombuffer(packed, np.uint8), start).tolist() == ids


def test_outliers_go_to_exceptions():
    ids = np.arange(128, dtype=np.uint32) % 8
    ids[5] = 40000
    assert len(tf.pack_blocks(ids)[0]) == 8 + 3 * 16 + 5


def test_file_round_trip_over_several_runs(monkeypatch):
    monkeypatch.setattr(tf, "_RUN", 256)
    rng = random.Random(1)
    docs = [(rng.choice([None, rng.randrange(-5, 10**12)]), np.array([rng.randrange(50000) for _ in range(rng.choice([0, 1, 127, 128, 129, 900]))], "<u4").tobytes()) for _ in range(40)]
    sink = io.BytesIO()
    writer = tf.FileWriter(sink)
    for doc in docs:
        writer.add(*doc)
    writer.close()
    got = list(tf.read_file(pa.BufferReader(sink.getvalue())))
    assert [(d, raw) for d, _, raw in got] == docs
    assert [s for _, s, _ in got] == [sum(len(r) // 4 for _, r in docs[:i]) for i in range(len(docs))]
    with pytest.raises(ValueError):
        list(tf.read_file(pa.BufferReader(b"x" * 64)))


def test_table_round_trip(documents):
    rng = random.Random(3)
    rows = [(d, " ".join("Word%d," % rng.randrange(999) for _ in range(rng.randrange(200)))) for d in rng.sample(range(-500, 2000), 300)]
    rows += [(5000, None), (5001, ""), (5002, "long " * 50000), (None, "x"), (7000, "a"), (7000, "a"), (7000, "b c")]
    df = documents(rows).withColumnRenamed("lang", "start").repartition(5)
    got = sorted(tf.read_files(tf.write_files(df, VOCABULARY)).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    ids = {}
    for d, text in rows:
        ids.setdefault(d, []).append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in {(len(x) // 4, zlib.crc32(x)) for x in ids[r.doc_id]}
        at += r.n_tokens


def test_empty_table(documents):
    assert tf.read_files(tf.write_files(documents([]), VOCABULARY)).count() == 0
