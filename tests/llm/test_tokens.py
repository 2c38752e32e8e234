from __future__ import annotations

import random

import pytest

from fathomgrid.llm import tokens


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.vocabulary(tokens.TOKENIZERS))


def texts() -> list[str]:
    r = random.Random(3)
    parts = ["'", "ll", "s", " ", "  ", "\n", "\r\n", "a", "word", "1", "é", "ก", "字", "!", "?!", "👩‍💻", "'ve", "t ", "<|endoftext|>", " ", "\t\t"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(400)] + ["a" * 3000, " " * 3000, "", "x y " * 2000]


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 50])
def test_tree_gives_the_ids_of_the_whole_text(encoder, leaf):
    for t in texts():
        if len(t) < 700 or leaf >= 7:
            assert tokens.tree(t, encoder.core.encode_ordinary, encoder.split, leaf) == encoder.core.encode_ordinary(t)


def test_round_trip_and_other_library(encoder):
    library = pytest.importorskip("tokenizers")
    other = library.Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    for t in texts():
        assert encoder.text(encoder.ids(t)) == t
        assert encoder.ids(t) == other.encode(t, add_special_tokens=False).ids


def test_rows(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "y"), (3, "", "z"), (3, "", "z"), (4, " ", "w")], "doc_id long, text string, ids string")
    got = sorted((r.doc_id, list(r.ids)) for r in tokens.encode(df).collect())
    assert [g[0] for g in got] == [1, 2, 3, 3, 4] and got[1][1] == got[2][1] == [] and len(got[0][1]) == 2 and got[4][1] == [220]
    assert tokens.encode(df.where("false")).count() == 0
