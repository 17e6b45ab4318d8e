import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skyledger.llm import wavelet
from skyledger.llm.tokens import ID, Encoder
from tests.llm.samples import documents, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [1, 7, 70_000])
def test_questions_to_one_file(tmp_path, n):
    rnd = np.random.default_rng(n)
    ids = rnd.choice([0, 3, 9, 50_000], n, p=[0.1, 0.5, 0.399, 0.001]).astype(ID)
    with wavelet.WholeFile(str(tmp_path / "a.wm")) as out:
        wavelet.write_shard(out, ids, np.array([n]), [None], 16)
    shard = wavelet.WaveletFile(str(tmp_path / "a.wm"))
    assert (shard.ids() == ids).all() and shard.doc_ids == [None]
    for i in {0, n // 2, n - 1}:
        assert shard.access(i) == ids[i]
    for token in (0, 3, 50_000, 4):
        places = np.flatnonzero(ids == token)
        assert shard.count(token) == len(places)
        assert shard.count(token, n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()
        for k in {0, len(places) // 2, len(places) - 1} if len(places) else ():
            assert shard.select(token, k) == places[k]
        with pytest.raises(IndexError):
            shard.select(token, len(places))
    assert list(shard.occurrences(50_000)) == np.flatnonzero(ids == 50_000).tolist()
    with pytest.raises(IndexError):
        shard.access(n)


def test_a_cut_file_is_refused(tmp_path):
    with wavelet.WholeFile(str(tmp_path / "a.wm")) as out:
        wavelet.write_shard(out, np.arange(9).astype(ID), np.array([9]), [1], 4)
    raw = (tmp_path / "a.wm").read_bytes()
    (tmp_path / "b.wm").write_bytes(raw[:-20] + raw[-19:])
    with pytest.raises(ValueError):
        wavelet.WaveletFile(str(tmp_path / "b.wm"))


@pytest.mark.parametrize("shard_tokens", [50, wavelet.SHARD_TOKENS])
def test_documents_come_back_in_order(spark, shard_tokens):
    manifest = wavelet.write_shards(frame(spark), PATH, 0, shard_tokens)
    found = wavelet.read_shards(manifest).orderBy("start").collect()
    tokens = Encoder(PATH)
    wanted = sorted(
        ((d, t or "") for d, t, *_ in documents()), key=lambda x: (x[0] is not None, x[0] or 0)
    )
    assert [r.doc_id for r in found] == [d for d, _ in wanted]
    at = 0
    for row, (_, text) in zip(found, wanted):
        assert np.frombuffer(row.ids, ID).tolist() == [*tokens.ids(text).tolist(), 0]
        assert row.start == at
        at += row.n_tokens
    assert (manifest.count() > 3) == (shard_tokens == 50)


def test_empty_table(spark):
    manifest = wavelet.write_shards(frame(spark, []), PATH)
    assert manifest.count() == 0 and wavelet.read_shards(manifest).select(F.crc32("ids")).collect() == []
