import random

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from venuelens.llm import token_counts as tc
from venuelens.llm.encoding import Encoder

VOCABULARY = path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder():
    return Encoder(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def noise(rng, n, letters="ab1'st  \n\n\t.,é\xa0"):
    return "".join(rng.choice(letters) for _ in range(n))


def apply(text, edits):
    for start, end, new in edits:
        start = max(0, min(start, len(text)))
        end = max(start, min(end, len(text)))
        text = text[:start] + new + text[end:]
    return text


@pytest.mark.parametrize("block", [1, 3, 64])
def test_counts_after_edits_are_those_of_the_whole_text(coder, library, monkeypatch, block):
    monkeypatch.setattr(tc, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(120):
        text = noise(rng, rng.choice([0, 1, 5, 60, 400]))
        tree = tc.CountTree(text, coder)
        for _ in range(12):
            start = rng.randrange(-2, len(text) + 3)
            edit = (start, start + rng.choice([0, 0, 1, 2, 9, 80]), noise(rng, rng.choice([0, 1, 2, 7, 40])) + rng.choice(["", "", "", "日"]) * (rng.random() < 0.1))
            text = apply(text, [edit])
            tree.edit(*edit)
            assert tree.text() == text and tree.length == len(text)
            assert tree.total == library(text), (text, edit)


def test_only_the_edit_is_encoded_again(coder, library):
    text = "The quick brown fox jumps over the lazy dog. " * 4000
    tree = tc.CountTree(text, coder)
    before = tree.encoded
    tree.edit(90000, 90005, "slow")
    assert tree.encoded - before < 60
    assert tree.total == library(apply(text, [(90000, 90005, "slow")]))


def test_many_inserts_in_one_place_keep_the_shape(coder, library):
    tree, text = tc.CountTree("start end", coder), "start end"
    for i in range(200):
        edit = (5, 5, " more words, %d" % i * 8)
        tree.edit(*edit)
        text = apply(text, [edit])
    assert tree.total == library(text) and max(map(len, tree.blocks)) <= 17 * tc.BLOCK


def test_table_with_and_without_stored_trees(documents, library):
    rng = random.Random(9)
    rows = [(d, noise(rng, rng.randrange(300))) for d in range(60)] + [(100, None), (101, ""), (102, "日本 x"), (103, "long text " * 9000), (5, "again"), (None, "x y")]
    df = documents(rows).withColumnRenamed("lang", "tree")
    edits = F.array(
        F.struct(F.lit(2).alias("start"), F.lit(7).alias("end"), F.lit("new one").alias("new")), F.lit(None),
        F.struct(F.lit(50).alias("start"), F.lit(10).alias("end"), F.lit(None).cast("string").alias("new")),
    )
    got = tc.counts(df, VOCABULARY, edits=edits, keep_trees=True).collect()
    want = sorted(((d, library(t or ""), 2, library(apply(t or "", [(2, 7, "new one"), (50, 10, "")]))) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_edited) for r in got), key=str) == want
    trees = tc.counts(df, VOCABULARY, keep_trees=True).select("doc_id", F.col("tree").alias("kept")).filter("doc_id <> 5")
    again = tc.counts(df.join(trees, "doc_id"), VOCABULARY, edits=edits, stored=F.col("kept")).collect()
    plain = {r.doc_id: r for r in got}
    assert all((r.n_tokens, r.n_tokens_edited, r.encoded_again) == (plain[r.doc_id].n_tokens, plain[r.doc_id].n_tokens_edited, plain[r.doc_id].encoded_again) for r in again)


def test_empty_table(documents):
    assert tc.counts(documents([]), VOCABULARY).count() == 0


SCRIPTS = "aé Ωμέγα кот 日本語 กขค نص \U0001f600\U0001f468‍\U0001f469 é 　\x85​ 1٣½ '.,\n\t "


def test_every_script_has_a_tree(coder, library):
    rng = random.Random(77)
    for _ in range(150):
        text = noise(rng, rng.choice([1, 9, 80, 500]), SCRIPTS)
        tree = tc.CountTree(text, coder)
        assert not tree.whole
        for _ in range(10):
            start = rng.randrange(-2, len(text) + 3)
            edit = (start, start + rng.choice([0, 0, 1, 2, 9, 80]), noise(rng, rng.choice([0, 1, 2, 7, 40]), rng.choice([SCRIPTS, "ab c1'"])))
            text = apply(text, [edit])
            tree.edit(*edit)
            assert tree.text() == text and tree.total == library(text), (text, edit)


@pytest.mark.parametrize("sentence,new", [("Το γρήγορο καφέ αλεπού πηδά. ", "σκύλος"), ("words and \U0001f600 faces here. ", "\U0001f680 up"), ("日本語の文章です。 ", "東京")])
def test_only_the_edit_is_encoded_again_in_any_script(coder, library, sentence, new):
    text = sentence * 4000
    tree = tc.CountTree(text, coder)
    before = tree.encoded
    tree.edit(60000, 60003, new)
    assert tree.encoded - before < 120
    assert tree.total == library(apply(text, [(60000, 60003, new)]))
