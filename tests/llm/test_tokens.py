import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lexharbor.llm import tokens
from lexharbor.session import scratch_path

ODD = ["", "it's we'll <|endoftext|> <|ENDOFTEXT|> 'S", "ÉCOLE İstanbul ΣΣ x y ﬁ ŉ",
       "12a3.4,5 --x--y&& «.a».", "CafÉ!!\x1cq ́z", "漢字kana", "A" * 3000, "Å Å\tÅ"]


def expected(texts, end=2):
    t = Tokenizer.from_file(tokens.default_tokenizer())
    return [e.ids + [end] for e in t.encode_batch(texts, add_special_tokens=False)]


def test_pieces_give_the_ids_of_whole_texts():
    for by_piece in (True, False):
        encoder = tokens.Encoder(tokens.default_tokenizer(), by_piece)
        for _ in range(2):     # the second time from what is known
            ids, counts = encoder(pa.array(ODD), 2)
            assert ids.tolist() == [i for e in expected(ODD) for i in e]
            assert counts.tolist() == [len(e) for e in expected(ODD)]
    encoder.by_piece, ids = True, encoder(pa.array([], pa.string()), 2)[0]
    assert len(ids) == 0


def test_round_trip(spark, make, mixed_rows):
    docs = make(mixed_rows)
    manifest = tokens.write_tokens(docs, scratch_path(spark, "t"), shard_bytes=6000)
    assert manifest.count() > 2
    rows = tokens.read_tokens(manifest, ids=True).orderBy("start").collect()
    want = sorted(((d is not None, d or 0, t or "") for d, t in mixed_rows))
    texts = expected([t for *_, t in want])
    assert [r.ids for r in rows] == texts
    assert [r.doc_id for r in rows] == [d if known else None for known, d, _ in want]
    assert [r.start for r in rows] == np.cumsum([0] + [len(t) for t in texts])[:-1].tolist()
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(np.array(t, "<u4").tobytes()) for t in texts]
    assert [r.n_tokens for r in rows] == [len(t) for t in texts]


def test_empty_table(spark, make):
    assert tokens.tokenised(spark, make([])).collect() == []


class Source:
    def __init__(self, data):
        self.data, self.read = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.read += n
        return self.data[at:at + n]


def test_reader_opens_only_the_wanted_frames():
    sink = io.BytesIO()
    each = np.arange(40000, dtype="<u2")
    tokens.write_shard(sink, [(np.arange(30), np.tile(each, 30), np.full(30, 40000))], 2)
    data = sink.getvalue()
    source = Source(data)
    shard = tokens.Shard(source)
    assert len(shard.seek) > 5
    before = source.read
    got = list(shard.documents({17}))
    assert got[0][0] == 17 and (got[0][1] == each).all() and len(got) == 1
    assert source.read - before == int(shard.seek[shard.index["frame"][17]][0])
    import zstandard
    plain = zstandard.ZstdDecompressor().decompress(data[:int(shard.at[1])], max_output_size=1 << 20)
    assert plain == shard.frame(0).tobytes()


def test_checksum_finds_damage():
    sink = io.BytesIO()
    tokens.write_shard(sink, [(np.array([1]), np.arange(9, dtype="<u2"), np.array([9]))], 2)
    shard = tokens.Shard(Source(sink.getvalue()))
    shard.seek = shard.seek.copy()
    shard.seek[0, 2] ^= 1
    with pytest.raises(ValueError):
        shard.frame(0)
