import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from playstream.llm.packing import _Encoder, op7_best_fit_packing, packed, pack, plan
from tests.llm.util import EDGE, SF001, docs_of

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_pieces(rows, length=2048):
    tok = Tokenizer.from_file(PATH)
    out = []
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), length)):
            part = ids[at:at + length]
            out.append((d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check_layout(rows, length=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return len(by)


def test_query_equals_whole_text_tokens(spark):
    got = op7_best_fit_packing(spark, SF001).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert sorted(tuple(r)[:5] for r in got) == sorted(plain_pieces(rows))
    bins = check_layout(got)
    least = -(-sum(r.length for r in got) // 2048)
    assert bins <= 1.02 * least + 1


def test_edge_rows(spark):
    got = packed(docs_of(spark, EDGE), length=64).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(plain_pieces(EDGE, 64), key=str)
    check_layout(got, 64)


def test_special_white_space_and_marks(spark):
    texts = ["it's a'll\x1cb c d", "x́ ́y É", "<|endoftext|> a<|startoftext|>b", "ΑΣ ΟΔΟΣ.", "日本語 text٣"]
    rows = list(enumerate(texts))
    got = packed(docs_of(spark, rows)).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(plain_pieces(rows))


def test_random_texts_of_odd_characters():
    """Control, mark, combining, cased and blank characters, alone and in the tokeniser's own strings."""
    encode = _Encoder(PATH)
    rng = np.random.default_rng(7)
    parts = np.array([chr(c) for c in range(0x80)] + list("éÉßñÇ\x80\x85\xa0\xad¼²ªµ×ÿŁłſǅɏ\u0308\u0327\u0301İıΣσς漢字Ａａ\u2163\U0001f600\u200b\u200d\u2028\u3000\ufb01\ufeff")
                     + ["'s", "'T", "'re", "T\u0308", "H\u0331", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "</w>", "a\x00.", "x\x1f.", "a\x07!", "end\x7f."])
    texts = ["".join(rng.choice(parts, n)) for n in rng.integers(0, 12, 20000)]
    tok = Tokenizer.from_file(PATH)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    got = [ids.tolist() for at in range(0, len(texts), 500) for ids in encode(texts[at:at + 500])]
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []


def test_empty_table(spark):
    assert packed(docs_of(spark, [])).collect() == []


def test_salted_numbers(spark):
    rows = [(i, 0, 0, random.Random(i).choice([5, 5, 5, 7, 11]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = pack(df, 32, salt_rows=16).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(rows)
    check_layout(got, 32)


def test_plan_replaces_the_smallest():
    # greedy fills 10 = 6 + 3 and leaves 1; the 3 gives way to 2 + 2, which fit its gap tightly
    assert plan({6: 1, 3: 1, 2: 2}, 10)[0] == ((6, 2, 2), 1)


def test_plan_uses_every_piece():
    rng = random.Random(5)
    for _ in range(50):
        counts = {rng.randint(1, 40): rng.randint(1, 30) for _ in range(15)}
        used = {}
        for pattern, times in plan(counts, 40):
            assert sum(pattern) <= 40 and times > 0
            for n in pattern:
                used[n] = used.get(n, 0) + times
        assert used == counts
