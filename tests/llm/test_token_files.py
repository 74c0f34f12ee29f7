import json
import random
import zlib

import numpy as np
import pytest

from cratedig.llm import rans, token_files
from cratedig.llm.token_files import read_token_files, write_token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
SCHEMA = "doc_id long, text string, ids string, TH int"
PARTS = ["the", "Straße", "naïve,", "don't", "X1-y2", "…", "<|startoftext|>", "<|endo", "é", "ﬁ", "İstanbul", "日本語", "\x1c", " ", "á", "\n", "\t", "  ", "word.", "(word)", "it's", "12 345", "_", "́b", "ǅ", "ª", "²", "x" * 300, "😀", " "]


def texts():
    rnd = random.Random(7)
    out = ["".join(rnd.choice(PARTS) + rnd.choice(["", " ", " ", "\n"]) for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    return [*out, "", None, " ", "word " * 90_000, "no_blank" * 20_000]


def encoded(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_files_give_back_what_the_tokenizer_says(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(token_files, "GROUP", 4 * rans.BLOCK)
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
    rows = [(i * 7 % 160, t, "x", 1) for i, t in enumerate(texts())]
    rows += [(3, rows[3][1], "x", 1)] * 5 + [(None, "nobody", "x", 1), (-9, "first", "x", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    write_token_files(frame, str(tmp_path / "out"), public_tokenizers.path(name), end_id=1)
    got = read_token_files(spark, str(tmp_path / "out"), ids=True).orderBy("start").collect()
    assert sorted((repr(r.doc_id), r.ids) for r in got) == sorted((repr(i), encoded(tokenizer, t)) for i, t, *_ in rows)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: (x is not None, x or 0))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    short = read_token_files(spark, str(tmp_path / "out"))
    assert short.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert short.count() == len(rows)


def test_damage_is_found(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"some words {i}", "x", 1) for i in range(50)], SCHEMA).coalesce(1)
    path = tmp_path / "out"
    write_token_files(frame, str(path), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    file = next(path.glob("*.tok"))
    data = bytearray(file.read_bytes())
    data[600] ^= 1
    file.write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        read_token_files(spark, str(path)).collect()


def test_empty(spark, tmp_path):
    write_token_files(spark.createDataFrame([], SCHEMA), str(tmp_path / "out"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    assert read_token_files(spark, str(tmp_path / "out"), ids=True).count() == 0


@pytest.mark.parametrize("n", [1, 63, 64, 65, rans.BLOCK, rans.BLOCK + 1, 3 * rans.BLOCK + 77])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, 40_000).astype(np.uint32)
    coder = rans.Coder(rans.quantised(np.bincount(ids, minlength=50_000)))
    blocks = coder.encode(ids)
    sizes = [min(rans.BLOCK, n - i) for i in range(0, n, rans.BLOCK)]
    assert coder.decode(blocks, sizes).tolist() == ids.tolist()
    for i, b in enumerate(blocks):  # each block alone
        assert coder.decode([b], [sizes[i]]).tolist() == ids[i * rans.BLOCK :][: sizes[i]].tolist()
    p = np.bincount(ids) / n
    bits = -(p[p > 0] * np.log2(p[p > 0])).sum() * n
    if n >= rans.BLOCK:
        assert sum(map(len, blocks)) * 8 < 1.03 * bits + len(blocks) * 64 * rans.LANES * 1.1


def test_frequencies_fill_the_range():
    for counts in ([5], [1, 0, 10**12], [1] * 1000, list(range(3000))):
        f = rans.quantised(np.array(counts), 14)
        assert f.sum() == 1 << 14
        assert ((f > 0) == (np.array(counts) > 0)).all()
    assert rans.quantised(np.zeros(4)).sum() == 0


def test_words_taken_apart_here_have_the_tokenizers_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, spec = tokenizers.Tokenizer.from_file(path), open(path, encoding="utf-8").read()
    assert token_files._splits(json.loads(spec))
    rng, letters = random.Random(5), "abZ'stvemlrd09.,<|>_-~!ÀÖ×ß÷øÿĀİıŉſƀéµªº́\xa0\x0b\x1f\x7f’Σς漢\ufb1d\u0958"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(5000)]
    texts += ["I'LL don't 's''s <|endoftext|> x<|startoftext|>y", *map(chr, range(1, 0x250)), "", " \n\t "]
    for kind in ("<u2", "<u4"):
        encode = token_files._encoder(spec, kind)
        for part in (texts, [" ".join(texts[i : i + 7]) for i in range(0, len(texts), 7)]):
            want = [e.ids for e in tokenizer.encode_batch(part, add_special_tokens=False)]
            assert [np.frombuffer(x, kind).tolist() for x in encode(part)] == want
