import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from panelkit.llm import bpe
from panelkit.llm.batches import text_pieces

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DATA = bpe.read_vocabulary(PATH)
HARD = ["", " ", "a", "'s", "''s", " 's", "it's we'll I'm they've 'rest you'd'd", "x  y   z", "tab\t\tx\r\n\r\n y", "\n", " \n", "a \n b", "１２３ 4½ ⅷ", "中文字 한국어",
        "é̀ a", "  x 　 y", "\x1c\x1d x", "🙂🙂 ok", "'ll'LL'Ll", "a'", "'", "'r'v'l're", "\x00\x00a"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(DATA), special_tokens={})


def _encode(texts):
    out = []
    for part in text_pieces(pa.array(texts), 300):
        flat, bounds, *_ = bpe.codec(DATA).encode_chunk(part)
        out += [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    return out


def test_ids_equal_the_library(reference):
    random.seed(5)
    letters = "ab'strevlmd  \n\t\r1２９é中!?.'_　\x1cX'"
    texts = HARD + ["".join(random.choice(letters) for _ in range(random.randint(0, 50))) for _ in range(4000)]
    assert _encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_very_long_slices(reference):
    texts = ["ab" * 20_000, " " * 5_000 + "x", "'s" * 3_000, "é" * 4_000, "1" * 9_999]
    got = _encode(texts)
    assert got == [reference.encode_ordinary(t) for t in texts]
    assert [bpe.codec(DATA).decode(i) for i in got] == [t.encode() for t in texts]


def test_scan_of_blocks_has_no_seams():
    cut = bpe.PreTokenizer()
    assert cut.size < 64
    import numpy as np

    text = "word " * 2_000 + "\n"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    assert len(cut.bounds(codes, np.array([len(codes) - 1]))) == 2_002


def test_column_with_nulls_repeats_and_clashing_names(texts_frame, reference):
    rows = [(1, "it's here  now"), (2, None), (3, ""), (1, "it's here  now"), (None, "x")]
    out = texts_frame(rows).select("*", bpe.encode("text", DATA).alias("c"), bpe.round_trip("text", DATA).alias("r")).collect()
    for r in out:
        text = r.text or ""
        assert list(r.c.ids) == reference.encode_ordinary(text) == list(r.r.ids)
        assert bytes(r.r.decoded) == text.encode()
        starts = [*r.c.slice_starts, len(text)]
        firsts = [*r.c.slice_ids, len(r.c.ids)]
        for a, b, i, j in zip(starts, starts[1:], firsts, firsts[1:]):
            assert bpe.codec(DATA).decode(r.c.ids[i:j]).decode() == text[a:b]
    assert len(out) == len(rows)


def test_decode_column_and_empty_table(texts_frame, spark):
    back = spark.createDataFrame([([0, 1],), (None,), ([],)], "ids array<int>").select(bpe.decode("ids", DATA).alias("b")).collect()
    assert [len(r.b) for r in back] == [2, 0, 0]
    assert texts_frame([]).select(bpe.round_trip("text", DATA)).where(F.lit(True)).count() == 0
