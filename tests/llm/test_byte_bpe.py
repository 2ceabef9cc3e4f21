import base64
import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimforge.llm import byte_bpe as b
from dimforge.llm import queries

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    tokens = b.read_ranks(RANKS)
    return b.ByteBpe(tokens, b.last_merges(tokens), P.PATTERN, b.patterns(P.PATTERN))


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.rank_of, special_tokens={})


def ids(bpe, text):
    return np.frombuffer(bpe.encode(text), "<u4").tolist()


@given(st.text())
@settings(max_examples=500, deadline=None)
def test_any_text(bpe, library, text):
    assert ids(bpe, text) == library.encode_ordinary(text)
    assert bpe.decode(bpe.encode(text)) == text.encode()


@pytest.mark.parametrize("letters", ["ab", "aab ", "theingandofor ", " \n\t\r\x0b\x1c a", "0123 ²½Ⅷ一", "'sreLL ", "éßаяש漢字ひ _-"])
def test_texts_of_few_letters(bpe, library, letters):
    rnd = random.Random(letters)
    for _ in range(800):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(70)))
        assert ids(bpe, text) == library.encode_ordinary(text)


def test_every_character_is_told_as_the_library_does(bpe, library):
    every = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x110000))]
    text = "".join(f"a{c} {c}1{c}-{c}" for c in every)
    assert ids(bpe, text) == library.encode_ordinary(text)


def test_pairs_of_tokens_as_the_merges_by_definition(bpe):
    rnd = random.Random(7)
    for _ in range(4000):
        data = b"".join(rnd.choices(bpe.tokens, k=rnd.randrange(1, 4)))
        assert [bpe.tokens[t] for t in bpe.backtrack(data)] == b.merge_all(data, bpe.rank_of)[0]


def test_long_pieces_take_linear_time(bpe):
    for letters in ("a", "ab", "abcde"):
        took = []
        for n in (50_000, 400_000):
            text = "".join(random.Random(1).choices(letters, k=n))
            start = time.perf_counter()
            assert bpe.decode(bpe.encode(text)) == text.encode()
            took.append(time.perf_counter() - start)
        assert took[1] < 30 * took[0] + 0.5


def test_long_texts_in_parts(bpe, library, monkeypatch):
    monkeypatch.setattr(b, "PART_CHARACTERS", 40)
    monkeypatch.setattr(b, "KEPT_PIECES", 5)
    monkeypatch.setattr(b, "FITTING_PAIRS", 5)
    text = "  The quick brown fox's déjà vu  \n\n jumps over 12 345 lazy dogs... " * 30
    assert ids(bpe, text) == library.encode_ordinary(text)


def test_another_pattern_and_vocabulary(tmp_path):
    pieces = [bytes([i]) for i in range(256)] + [b"aa", b"ab", b"aab", b"aaa", b"zq"]
    path = tmp_path / "r.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(pieces)))
    tokens = b.read_ranks(str(path))
    pattern = r"(?:\p{Lu}|\p{L})+|[^\p{L}]"
    own = b.ByteBpe(tokens, b.last_merges(tokens), pattern, b.patterns(pattern))
    library = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=own.rank_of, special_tokens={})
    for k in range(300):
        text = "".join(random.Random(k).choices("aabzq é.", k=k % 40))
        assert ids(own, text) == library.encode_ordinary(text)


def test_rank_files_out_of_order_are_refused():
    single = [bytes([i]) for i in range(256)]
    with pytest.raises(ValueError, match="every byte"):
        b.last_merges(single[1:])
    with pytest.raises(ValueError, match="behind"):
        b.last_merges([*single, b"abc", b"ab"])


def test_query_with_odd_rows(spark, library, tmp_path):
    rows = [(1, "Hello world's"), (2, None), (3, ""), (1, "Hello world's"), (None, "naïve 漢字 \x1c"), (4, "x" * 300_000), (5, " \n" * 9)]
    (spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("a"))
     .write.parquet(f"{tmp_path}/documents.parquet"))
    got = sorted((tuple(r) for r in queries.op11_byte_bpe(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t in rows:
        x = library.encode_ordinary(t or "")
        want.append((i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert b.decode(b.encode(df, RANKS, P.PATTERN), RANKS).collect() == []
