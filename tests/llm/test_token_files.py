"""Token ids in binary files (op13): exact round trip, damage, edge cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinloom.llm import token_files as tf
from kinloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tf.default_path())


def brute_force(rows, library):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_ids_are_those_of_the_library(library):
    draw = random.Random(5)
    parts = ["a", " the", "é", "中", "'s", " 12", "\n", "  ", " ", "\t", "\x1f", " ", "͸", "<|endoftext|>", "ſ", "aaaa"]
    coder = tf.tokenizer(tf.default_path())
    for _ in range(2000):
        text = "".join(draw.choices(parts, k=draw.randrange(40)))
        assert np.frombuffer(coder.ids(text), coder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_stretches_of_a_long_text_join_up(library, monkeypatch):
    monkeypatch.setattr(tf, "STRETCH", 50)
    text = "<|endoftext|> one two  three\n four five's ͸ six " * 40
    coder = tf.tokenizer(tf.default_path())
    assert np.frombuffer(coder.ids(text), coder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [1, 2, 15, 16, 17, 1000, 40_000])
def test_blocks_round_trip_from_every_checkpoint(size):
    draw = np.random.default_rng(size)
    ids = draw.zipf(1.3, size).clip(max=60_000).astype("<u4")
    table = tf.Table.of(ids)
    block = tf.encode_block(ids, table.encoder(), lanes=16, every=32)
    points = tf.checkpoints(block)
    assert len(points) == 1 + (size - 1) // min(16, max(1, size >> 4)) // 32
    for number, at in enumerate(points):
        assert np.array_equal(tf.decode_block(block, table.decoder(), number), ids[at:])


def test_skewed_table_gives_each_id_a_share():
    ids = np.concatenate((np.zeros(3_000_000, np.int64), np.arange(400_000)))
    table = tf.Table.of(ids)
    assert table.frequencies.min() == 1 and int(table.frequencies.sum()) == 1 << table.scale


def test_damage_is_noticed():
    ids = np.arange(5000) % 700
    table = tf.Table.of(ids)
    block = tf.encode_block(ids, table.encoder())
    for bad in (block[:-1], block[:40], b"", block[:99] + bytes([block[99] ^ 1]) + block[100:]):
        with pytest.raises(ValueError):
            tf.decode_block(bad, table.decoder())


def test_edge_cases_against_brute_force(spark, library):
    rows = [(5, None), (3, ""), (None, "no id"), (9, "b b"), (9, "b b"), (7, "word " * 30_000), (-4, "é\n\n中 <|endoftext|> x")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"part": F.lit("x"), "_h": F.lit(1), "start": F.lit(None)})
    groups = tf.write(docs, group=1000, block=300)
    found = sorted(map(tuple, tf.digests(groups).collect()), key=lambda r: r[1])
    assert found == brute_force(rows, library)
    ids = {r.start: r.ids for r in tf.read(groups).collect()}
    assert ids[found[2][1]] == [*library.encode(rows[1][1], add_special_tokens=False).ids, 0]
    assert all(len(ids[start]) == n for _, start, n, _ in found)


def test_empty_table(spark):
    groups = tf.write(spark.createDataFrame([], SCHEMA))
    assert tf.digests(groups).collect() == [] and tf.read(groups).collect() == []


def test_query_against_brute_force(spark, sf_dir, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = sorted(map(tuple, QUERIES["op13_token_files"](spark, sf_dir).collect()))
    assert found == sorted(brute_force(rows, library))
