import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layerflow.llm import token_store as m
from layerflow.session import shared_dir
from tests.llm.cases import LONG, corpus, frame

PATH = P.path("word_bpe_49k.json")
ODD = ["", "  a", "don't. he's, 'll", "<|endoftext|>x <|ENDOFTEXT|>", "á ́b", "ΑΣ. ß, İ", "x.,y ,. ... 1. 12, 3.5", "\x1c\x85a",
       "日本語。テスト", "I'M I'Ll 'S", "a.b,c. d,", LONG]


def test_chunks_give_the_library_ids():
    t, enc = Tokenizer.from_file(PATH), m.ChunkEncoder(PATH)
    for text in ODD:
        want = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text.encode()), enc.dtype).tolist() == want
        assert np.frombuffer(enc.encode(text.encode()), enc.dtype).tolist() == want  # from the kept chunks


def test_few_kept_chunks_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(m, "KNOWN_CHUNKS", 20)
    enc, other = m.ChunkEncoder(PATH), m.ChunkEncoder(PATH)
    for _, text, *_ in corpus():
        assert enc.encode((text or "").encode()) == b"".join(other.encode(c) for c in (text or "").encode().split())


def test_perfect_hash_is_minimal_and_tells_strangers(tmp_path):
    keys = [m.key_hash(i, 0) for i in range(5000)]
    _, slots = m.build_index(np.array(keys, np.uint64))
    assert sorted(slots) == list(range(5000))
    payloads = [np.arange(i % 7, dtype="<u2").tobytes() for i in range(5000)]
    path = tmp_path / "x.bin"
    path.write_bytes(m.shard_bytes(keys, payloads, np.dtype("<u2")))
    shard = m.Shard(fs.LocalFileSystem().open_input_file(str(path)))
    found = shard.slots(np.array(keys, np.uint64))
    assert [shard.ids(s).tobytes() for s in found] == payloads
    strangers = shard.slots(np.array([m.key_hash(i, 1) for i in range(5000)], np.uint64))
    assert (strangers >= 0).sum() == 0
    with pytest.raises(ValueError):
        path.write_bytes(b"something else")
        m.Shard(fs.LocalFileSystem().open_input_file(str(path)))


@pytest.mark.parametrize("shard_ids", [1, 50, m.SHARD_IDS])
def test_round_trip(spark, shard_ids):
    rows = [r[:2] for r in corpus() if r[1] != LONG]
    docs = frame(spark, rows).withColumn("k", F.lit(1)).withColumn("shard", F.lit(2)).withColumn("ids", F.lit(3))
    folder = shared_dir(spark, "tokens-test")
    manifest = m.write_store(docs, folder, PATH, shard_ids=shard_ids)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["ids"]) for r in m.read_store(docs, manifest, folder).collect())
    t = Tokenizer.from_file(PATH)
    start, want = 0, []
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((d is not None, d or 0, start, ids))
        start += len(ids)
    assert got == want
    assert manifest.agg(F.sum("ids")).first()[0] == start and manifest.agg(F.sum("docs")).first()[0] == len(rows)


def test_missing_key_is_an_error_and_empty_table_has_no_shards(spark):
    folder = shared_dir(spark, "tokens-test")
    docs = frame(spark, [(1, "a"), (2, "b")])
    manifest = m.write_store(docs, folder, PATH)
    with pytest.raises(Exception, match="missing"):
        m.read_store(frame(spark, [(5, "")]), manifest, folder).collect()
    empty = shared_dir(spark, "tokens-test")
    none = m.write_store(docs.limit(0), empty, PATH)
    assert none.count() == 0 and m.read_store(docs.limit(0), none, empty).count() == 0


def test_query_digest(spark, sf_dir):
    import __spark_entry__ as E

    t = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: r for r in E.queries()["op8_token_store"](spark, sf_dir).collect()}
    start = 0
    for r in sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        ids = np.array(t.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_blocks_hold_every_text(monkeypatch):
    enc, t = m.ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    texts = pa.array([x.encode() for x in ODD * 3], pa.binary())
    for most in (1, 30, 1 << 20):
        got = []
        for block in m.blocks_of(texts, most):
            tokens, places = enc.encode_block(block)
            got += [tokens[a:b].tolist() for a, b in zip(places, places[1:])]
        assert got == [t.encode(x, add_special_tokens=False).ids for x in ODD * 3]


def test_an_id_with_most_rows_spreads_over_tasks(spark):
    rows = [(5, f"text {i % 3} of a hot id") for i in range(300)] + [(5, None)] * 60 + [(None, "n")] * 40 + [(i, f"alone {i}") for i in range(40) if i != 5]
    folder = shared_dir(spark, "tokens-test")
    docs = frame(spark, rows).repartition(7)
    manifest = m.write_store(docs, folder, PATH, shard_ids=100)
    assert manifest.where("first_id = 5").select("part").distinct().count() > 2
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["ids"]) for r in m.read_store(docs, manifest, folder).collect())
    t = Tokenizer.from_file(PATH)
    start, want = 0, []
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((d is not None, d or 0, start, ids))
        start += len(ids)
    assert got == want
