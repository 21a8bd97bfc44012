import zlib

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from rollcall.llm import tokenids
from rollcall.llm.tokenids import END, Encoder, build_index, default_tokenizer, fetch_ids, find_slots, look_up, token_digests, write_tokens

SCHEMA = "doc_id long, text string, shard string, at string"
TEXTS = [
    "Plain words, and more: don't we'll 12 3.4 x_y.",
    None,
    "",
    " \t\n",
    "ÀÉ ß ŉ µ ² ½ İI Σας ΑΣ é ́x",
    "a <|endoftext|> b<|startoftext|>c <| x",
    "\x1c a\x1db \x85 c\xa0d ​ ﻿  ",
    "汉字 русский हिन्दी 😀👍🏽 '''s 'RE",
    "THE%%% the*** The&&&",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def expected(library, rows):
    out, start = [], 0
    signed = lambda text: (xxhash.xxh64_intdigest((text or "").encode(), 42) + 2**63) % 2**64
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1]))):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, END], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_encoder_equals_the_library(library):
    encode = Encoder(default_tokenizer())
    for _ in range(2):
        for text in TEXTS:
            ids = np.frombuffer(encode(text), encode.kind).tolist()
            assert ids == [*library.encode(text or "", add_special_tokens=False).ids, END]


def test_long_texts_go_in_parts(library, monkeypatch):
    monkeypatch.setattr(tokenids, "PART_CHARS", 16)
    encode = Encoder(default_tokenizer())
    texts = [*TEXTS, " ".join(t or "" for t in TEXTS) * 3, "x" * 50, "word " * 30 + "\n" * 40]
    for text, raw in zip(texts, encode.many(texts), strict=True):
        assert np.frombuffer(raw, encode.kind).tolist() == [*library.encode(text or "", add_special_tokens=False).ids, END]


def test_round_trip(spark, library):
    rows = [(7 * i % 1000, f"{TEXTS[i % len(TEXTS)] or ''} {i}") for i in range(1000)] + [(2000, None), (2001, ""), (None, "no id"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA).repartition(5)
    got = token_digests(docs, shard_bytes=5000, index_keys=100)
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1]) == expected(library, rows)


def test_rows_without_id_are_spread_over_shards(spark, library):
    rows = [(None if i % 3 else i, f"text number {i % 400}") for i in range(1500)] + [(9999, "last")] * 300
    docs = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA).repartition(4)
    tokens = write_tokens(docs, shard_bytes=2000, index_keys=300)
    sizes = [r["docs"] for r in tokens.shards.collect()]
    assert len(sizes) > 5 and max(sizes) < 600
    keys = [(r["doc_id"], r["copy"]) for r in tokens.keys.collect()]
    assert sorted(c for i, c in keys if i is None) == list(range(1000)) and sorted(c for i, c in keys if i == 9999) == list(range(300))
    places = look_up(tokens, tokens.keys.select("doc_id", "copy"))
    got = tokenids.read_ids(tokens, places).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(library, rows)


def test_keyed_access(spark, library):
    docs = spark.createDataFrame([(i, f"document {i} of many", "", "") for i in range(500)], SCHEMA)
    tokens = write_tokens(docs, shard_bytes=1000, index_keys=64)
    wanted = spark.createDataFrame([(3, 0), (499, 0), (3, 1), (777, 0)], "doc_id long, copy long")
    found = {r["doc_id"]: r["ids"] for r in fetch_ids(tokens, wanted).collect()}
    assert found == {i: [*library.encode(f"document {i} of many", add_special_tokens=False).ids, END] for i in (3, 499)}
    strangers = spark.range(10_000, 60_000).selectExpr("id AS doc_id", "0L AS copy")
    assert look_up(tokens, strangers).count() <= 1


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 5000])
def test_index_is_minimal_and_perfect(n):
    draw = np.random.default_rng(n)
    h1, h2 = (draw.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) for _ in range(2))
    displacement, slots = build_index(h1, h2)
    assert sorted(slots.tolist()) == list(range(n))
    assert (find_slots(displacement, n, h1, h2) == slots).all()


def test_empty_table(spark):
    assert token_digests(spark.createDataFrame([], SCHEMA)).collect() == []
