import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from departure_risk.llm import files, simple8b, tokens
from llm.conftest import sentence, table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 239, 240, 241, simple8b.BLOCK, simple8b.BLOCK + 1, 30_000])
@pytest.mark.parametrize("bits", [0, 1, 5, 17, 31, 33, 60, 63])
def test_any_values_come_back(n, bits):
    rng = np.random.default_rng(n + bits)
    values = rng.integers(0, 1 << bits, n, dtype=np.uint64, endpoint=True)
    values[rng.random(n) < 0.4] = 0
    words, per_block, escaped, escaped_per_block = simple8b.pack(values)
    lengths = np.diff([*range(0, n, simple8b.BLOCK), n])
    assert (simple8b.unpack(words, per_block, escaped, escaped_per_block, lengths) == values).all()
    assert len(escaped) == (values >= 1 << 60).sum()
    if n > 1 and len(per_block) > 1:  # the second block alone
        a, b = per_block[0], escaped_per_block[0]
        second = simple8b.unpack(words[a:a + per_block[1]], per_block[1:2], escaped[b:b + escaped_per_block[1]], escaped_per_block[1:2], lengths[1:2])
        assert (second == values[simple8b.BLOCK:2 * simple8b.BLOCK]).all()


def test_small_values_take_little_room():
    assert len(simple8b.pack(np.zeros(4800, np.uint64))[0]) <= 21
    assert len(simple8b.pack(np.full(4096, 50_000, np.uint64))[0]) == -(-4096 // 3)


ODD = ["", " ", "  two  spaces ", "a", " lead", "trail ", "tab\tand\nline", "x \n y", "it's we'll", "<|endoftext|>", "x <|endoftext|> y",
       "é à ü ß 東京 🙂 🙂", "nb space   em", "a\u0085b \x1c c", "1 22  333", "\n\n\n", "a. b, c! (d)"]


def test_pieces_give_the_ids_of_whole_texts():
    plain = Tokenizer.from_file(PATH)
    rng = np.random.default_rng(5)
    texts = ODD + ["".join(rng.choice([" ", "a", "bc", "\n", ".", "é", "  "], 60)) for _ in range(200)] + [sentence(rng, 40) for _ in range(50)]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = tokens.Encoder(PATH, kept=20)  # what is known is forgotten again and again
    for size in (1, 7, len(texts)):
        got = [np.frombuffer(e, "<u4").tolist() for at in range(0, len(texts), size) for e in encoder.encode(pa.array(texts[at:at + size]))]
        assert got == want


def test_pieces_met_last_stay_known():
    encoder = tokens.Encoder(PATH, kept=4)
    for text in ("start aa bb cc dd", "start aa ee ff gg", "start aa hh ii jj", "start aa kk ll mm"):
        encoder.encode(pa.array([text]))
        assert len(encoder.pieces) <= 8 and "aa" in encoder.pieces.to_pylist()
        assert len(encoder.pool) == encoder.lengths.sum() and len(encoder.lengths) == len(encoder.pieces)


def test_files_hold_all_documents_in_order(spark):
    rng = np.random.default_rng(6)
    rows = [(i * 3 % 101, sentence(rng, int(n))) for i, n in enumerate(rng.integers(0, 300, 101))]
    rows += [(500, None), (501, ""), (7, "again"), (7, "again"), (None, "no id"), (None, None), (900, sentence(rng, 40_000))] + [(600 + i, t) for i, t in enumerate(ODD)]
    written = tokens.write_tokens(table(spark, rows).repartition(5), PATH)
    plain, start = Tokenizer.from_file(PATH), 0
    got = sorted(tokens.read_tokens(written).collect(), key=lambda r: r.start)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(rows)
    for row, (doc, text) in zip(got, ordered):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        assert (row.doc_id, row.start, row.n_tokens) == (doc, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert sum(len(a) for f in written.collect() for a in tokens.read_ids(f.uri)) == start


def test_an_empty_table_has_no_file(spark):
    written = tokens.write_tokens(table(spark, []), PATH)
    assert written.isEmpty() and tokens.read_tokens(written).isEmpty()


def test_a_damaged_file_is_an_error(tmp_path):
    with files.written(f"{tmp_path}/sub/x.s8b") as stream:
        stream.write(b"half a file")
    with pytest.raises(ValueError, match="not a complete"):
        list(tokens.read_ids(f"{tmp_path}/sub/x.s8b"))
    assert [p.name for p in (tmp_path / "sub").iterdir()] == ["x.s8b"]
