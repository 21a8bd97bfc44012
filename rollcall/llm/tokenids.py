"""Token ids of documents in raw binary shards, with a minimal perfect hash index over the document keys.

A written set is a folder of

- ``ids-<shard>-<attempt>``: a header of 16 bytes (magic, bytes per id) and the raw little-endian ids of the shard's documents,
  each ending with the end id. Documents ascend by id within a shard and from shard to shard;
- ``keys``: a Parquet table (doc_id, copy, shard, file, at, n): what each shard holds, ``at`` in ids from the shard's start;
- ``shards``: a Parquet table (shard, file, start, ids, docs), ``start`` the number of ids in all shards before;
- ``index-<part>-<attempt>``: a minimal perfect hash of the keys with that part of the key hash, and ``index``, a Parquet
  table (part, file, keys).

The index is hash and displace: keys fall into small groups, and each group has a displacement that sends its keys to free
slots; groups of one key name their slot. n keys fill n slots of (fingerprint, shard, at, n), so a lookup reads one displacement
and one slot, and the stored fingerprint of 32 bits tells foreign keys apart. Tasks write files under names of their own
attempt; only names that reach the tables count, so a lost or repeated task leaves nothing that is read.

Ids come from a ``tokenizers`` file. Text splits at white space, chunks into the tokenizer's own pieces, and the ids of pieces and
chunks are kept; text of rarer characters goes through the library as it is.

Defined results: null and empty texts have the end id only; null ids come first; rows of equal ids are told apart by
``copy``, from 0 in the order of a hash of their texts, and may lie in several shards; an empty table gives empty tables. Only ``doc_id`` and ``text`` are read, of a
table whose rows come in the same order whenever a task is repeated, as files do.
"""

from __future__ import annotations

import json
import math
import os
import re
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rollcall.llm.common import stored, to_python
from rollcall.scratch import scratch_path

END = 1
SHARD_TEXT_BYTES = 32 << 20
SHARD_ROWS = 200_000
INDEX_KEYS = 50_000
#: Pieces and chunks a worker keeps the ids of, each.
CACHED = 500_000
#: Characters that are taken apart at once.
PART_CHARS = 1 << 20
IDS_MAGIC, INDEX_MAGIC = b"rcids001", b"rcmph001"
SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u8")])
_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

# Fixed value: how the word vocabulary's file splits text, as JSON writes it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# Pieces of lower-case text as the word vocabulary's file splits it, for the characters outside _RARE.
_PIECE = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_RARE = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e]")
# White space to Python but not to the tokenizer, and the start of the strings of special tokens.
_WHOLE = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _kept_in_worker(key: str, make: Callable):
    """One object per Python worker, however many tasks it runs."""
    home = sys.modules.setdefault("rollcall_worker", types.ModuleType("rollcall_worker")).__dict__
    if key not in home:
        home[key] = make()
    return home[key]


class Encoder:
    """Text to little-endian ids of ``width`` bytes, equal to those of the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if max([END, *vocabulary.values()]) < 1 << 16 else "<u4")
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.last[i] = token.endswith("</w>")
        # Pieces are known where the file splits by SPLIT, and told apart in a list of ids where last tokens are marked.
        told = json.loads(self.tokenizer.to_str())
        self.marked = told["model"].get("end_of_word_suffix") == "</w>" and SPLIT in json.dumps(told["pre_tokenizer"])
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.end = np.array([END], self.kind).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        plain, split, rare = {}, {}, []
        for c in chunks:
            if c.isascii() and c.isalpha():
                plain[c] = c.lower()
            elif _RARE.search(c):
                rare.append(c)
            else:
                split[c] = _PIECE.findall(c.lower())
        known = self.pieces
        new = list({p for p in [*plain.values(), *chain.from_iterable(split.values())] if p not in known})
        if new:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, self.kind)
            cuts = ((np.flatnonzero(self.last[ids]) + 1) * self.kind.itemsize).tolist()
            if len(cuts) != len(new):
                raise ValueError("the vocabulary does not mark the ends of pieces")
            raw = ids.tobytes()
            known.update(zip(new, [raw[a:b] for a, b in zip([0, *cuts], cuts)], strict=True))
        self.chunks.update((c, known[p]) for c, p in plain.items())
        self.chunks.update((c, b"".join([known[p] for p in pieces])) for c, pieces in split.items())
        self.chunks.update((c, self.whole(c)) for c in rare)

    def _parts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of bounded length; what is new in all of them is learnt at once."""
        split = [None if not self.marked or any(w in t for w in _WHOLE) else t.split() for t in texts]
        new = set().union(*(c for c in split if c)) - self.chunks.keys()
        if len(self.chunks) + len(new) > CACHED:
            self.chunks.clear()
            new = set().union(*(c for c in split if c))
        if len(self.pieces) > CACHED:
            self.pieces.clear()
        if new:
            self._learn(list(new))
        known = self.chunks
        return [self.whole(t) if c is None else b"".join([known[x] for x in c]) for t, c in zip(texts, split, strict=True)]

    def many(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text and the end id. Long texts are taken in parts that end at a blank."""
        given, size = [], 0
        for text in texts:
            given.append(text or "")
            size += len(given[-1])
            if size > PART_CHARS:
                yield from self._bounded(given)
                given, size = [], 0
        yield from self._bounded(given)

    def _bounded(self, texts: list[str]) -> Iterator[bytes]:
        if texts and len(texts[-1]) > PART_CHARS:
            yield from self._bounded(texts[:-1])
            yield b"".join(self._parts([part])[0] for part in _cut(texts[-1])) + self.end
        else:
            yield from (ids + self.end for ids in self._parts(texts))

    def __call__(self, text: str | None) -> bytes:
        return next(self.many([text]))


def _cut(text: str) -> Iterator[str]:
    """Parts of at least PART_CHARS, each but the last ending before a blank or line feed; both always stand between chunks."""
    low = 0
    while low < len(text):
        high = low + PART_CHARS
        ends = [at for at in (text.find(" ", high), text.find("\n", high)) if at >= 0]
        high = min(ends, default=len(text))
        yield text[low:high]
        low = high


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


@dataclass
class TokenSet:
    """A written set: its folder and its tables."""

    path: str
    keys: DataFrame
    shards: DataFrame
    index: DataFrame


def _hash1() -> Column:
    return F.xxhash64("doc_id", "copy")


def _hash2() -> Column:
    return F.xxhash64("copy", "doc_id", F.lit("displace"))


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64(_hash1()), F.lit(parts)).cast("int")


def _mixed(h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """64 mixed bits of hashes and displacements."""
    with np.errstate(over="ignore"):
        z = h + d.astype(np.uint64) * np.uint64(_GOLDEN)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def build_index(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements by group, and the slot of each key, for distinct pairs of 64-bit hashes."""
    n = len(h1)
    groups = max(1, n // 3)
    group = (h1 % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    displacement = np.zeros(groups, np.int64)
    slots = np.full(n, -1, np.int64)
    taken = bytearray(n)
    tries = np.arange(64, dtype=np.uint64)
    for g in np.argsort(-sizes, kind="stable"):
        if sizes[g] < 2:
            break
        keys = order[starts[g] : starts[g + 1]]
        low = 0
        while True:
            options = (_mixed(h2[keys][:, None], tries[None, :] + np.uint64(low)) % np.uint64(n)).T.tolist()
            hit = next((i for i, o in enumerate(options) if not any(taken[s] for s in o) and len(set(o)) == len(o)), None)
            if hit is not None:
                break
            low += len(tries)
            if low > 1 << 26:
                raise ValueError("two keys have equal hashes")
        displacement[g] = low + hit
        slots[keys] = options[hit]
        for s in options[hit]:
            taken[s] = 1
    free = (s for s in range(n) if not taken[s])
    for g in np.flatnonzero(sizes == 1):
        slot = next(free)
        displacement[g] = -slot - 1
        slots[order[starts[g]]] = slot
    return displacement, slots


def find_slots(displacement: np.ndarray, keys: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The slot each pair of hashes would have."""
    d = displacement[(h1 % np.uint64(len(displacement))).astype(np.int64)]
    return np.where(d < 0, -d - 1, (_mixed(h2, np.maximum(d, 0)) % np.uint64(max(1, keys))).astype(np.int64))


def _print(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return ((h1 ^ (h2 >> np.uint64(7))) >> np.uint64(32)).astype(np.uint32)


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _with_whole_copies(placed: DataFrame) -> DataFrame:
    """``placed`` with ``copy`` counted over all shards: rows of one id may end one shard, fill others and begin one more.

    Only the first id of a shard can have rows before it, and they end the shard before, so one row a shard tells how many.
    """
    ends = placed.groupBy("shard").agg(F.min_by(F.struct("doc_id"), "line").alias("first"), F.max_by(F.struct("doc_id", "copy"), "line").alias("end"))
    ends = ends.select("shard", F.col("first.doc_id").alias("first_id"), F.col("end.doc_id").alias("last_id"), (F.col("end.copy") + 1).alias("many"))
    upto = F.sum("many").over(Window.partitionBy("last_id").orderBy("shard"))
    previous = F.lag(F.struct("last_id", "upto")).over(Window.orderBy("shard"))
    carried = ends.withColumn("upto", upto).withColumn("previous", previous)
    same = F.col("previous").isNotNull() & F.col("previous.last_id").eqNullSafe(F.col("first_id"))
    carried = carried.where(same).select("shard", "first_id", F.col("previous.upto").alias("carried"))
    adds = F.when(F.col("carried").isNotNull() & F.col("doc_id").eqNullSafe(F.col("first_id")), F.col("carried")).otherwise(0)
    return placed.join(carried, "shard", "left").withColumn("copy", F.col("copy") + adds)


def write_tokens(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, shard_bytes: int = SHARD_TEXT_BYTES, index_keys: int = INDEX_KEYS) -> TokenSet:
    """Encodes ``docs`` and writes the set below ``path``, by default a folder in the shared scratch space."""
    spark = docs.sparkSession
    path, tokenizer = path or scratch_path(spark, "tokens"), tokenizer or default_tokenizer()
    kind = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", "text")
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))).first()
    shards = max(1, math.ceil((size or 0) / shard_bytes), math.ceil(n / SHARD_ROWS))
    # Rows of one id spread by their texts, and rows that are equal by their places in the table.
    order = [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))), F.col("row")]
    ranges = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = _kept_in_worker(tokenizer, lambda: Encoder(tokenizer))
        width, shard, name = encode.kind.itemsize, TaskContext.get().partitionId(), ""
        out, at, line, last, copy = None, 0, 0, None, 0
        try:
            for batch in batches:
                if out is None and batch.num_rows:
                    name = f"ids-{shard}-{uuid.uuid4().hex}"
                    files, root = _filesystem(path)
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(f"{root}/{name}")
                    out.write(IDS_MAGIC + struct.pack("<Q", width))
                ids = batch.column("doc_id").to_pylist()
                lengths, copies = [], []
                for doc_id, raw in zip(ids, encode.many(batch.column("text").to_pylist()), strict=True):
                    out.write(raw)
                    lengths.append(len(raw) // width)
                    copy = copy + 1 if (doc_id,) == last else 0
                    last = (doc_id,)
                    copies.append(copy)
                places = at + np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
                lines = line + np.arange(len(ids), dtype=np.int64)
                at, line = int(places[-1]), line + len(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(copies, pa.int64()), pa.array([shard] * len(ids), pa.int32()), pa.array([name] * len(ids), pa.string()), pa.array(places[:-1]), pa.array(lengths, pa.int64()), pa.array(lines)],
                    names=["doc_id", "copy", "shard", "file", "at", "n", "line"],
                )
        finally:
            if out is not None:
                out.close()

    fields = [T.StructField("doc_id", kind), T.StructField("copy", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("file", T.StringType()), T.StructField("at", T.LongType()), T.StructField("n", T.LongType())]
    placed = stored(to_python(ranges).mapInArrow(write, T.StructType([*fields, T.StructField("line", T.LongType())])), "token-keys")
    _with_whole_copies(placed).select(*[f.name for f in fields]).write.parquet(f"{path}/keys")
    keys = spark.read.schema(T.StructType(fields)).parquet(f"{path}/keys")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    table = keys.groupBy("shard", "file").agg(F.sum("n").alias("ids"), F.count(F.lit(1)).alias("docs")).withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    table.write.parquet(f"{path}/shards")

    parts = max(1, math.ceil(n / index_keys))

    def build(group: pa.Table) -> pa.Table:
        h1, h2 = _unsigned(group["h1"]), _unsigned(group["h2"])
        displacement, slots = build_index(h1, h2)
        filled = np.zeros(len(h1), SLOT)
        filled["print"][slots] = _print(h1, h2)
        for column in ("shard", "at", "n"):
            filled[column][slots] = group[column].to_numpy()
        part = group["part"][0].as_py()
        name = f"index-{part}-{uuid.uuid4().hex}"
        files, root = _filesystem(path)
        with files.open_output_stream(f"{root}/{name}") as out:
            out.write(INDEX_MAGIC + struct.pack("<QQ", len(h1), len(displacement)) + displacement.astype("<i8").tobytes() + filled.tobytes())
        return pa.table({"part": pa.array([part], pa.int32()), "file": [name], "keys": pa.array([len(h1)], pa.int64())})

    hashed = keys.select(_part(parts).alias("part"), _hash1().alias("h1"), _hash2().alias("h2"), "shard", "at", "n")
    hashed.groupBy("part").applyInArrow(build, "part int, file string, keys long").write.parquet(f"{path}/index")
    return read_set(spark, path)


def read_set(spark: SparkSession, path: str) -> TokenSet:
    """The tables of a written set."""
    return TokenSet(path, *(spark.read.parquet(f"{path}/{name}") for name in ("keys", "shards", "index")))


def look_up(tokens: TokenSet, wanted: DataFrame) -> DataFrame:
    """(doc_id, copy, shard, at, n) by the index for rows (doc_id, copy). Keys that the set lacks give no row."""
    path = tokens.path
    parts = tokens.index.agg(F.max("part")).first()[0]
    kind = wanted.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, copy long, shard int, at long, n long"
    asked = wanted.select("doc_id", F.col("copy").cast("long").alias("copy"), _hash1().alias("h1"), _hash2().alias("h2"), _part((parts or 0) + 1).alias("part"))

    def find(group: pa.Table) -> pa.Table:
        files, root = _filesystem(path)
        with files.open_input_file(f"{root}/{group['file'][0].as_py()}") as source:
            magic, keys, groups = struct.unpack("<8sQQ", source.read(24))
            if magic != INDEX_MAGIC:
                raise ValueError("no index file")
            displacement = np.frombuffer(source.read(8 * groups), "<i8")
            slots = np.frombuffer(source.read(SLOT.itemsize * keys), SLOT)
        h1, h2 = _unsigned(group["h1"]), _unsigned(group["h2"])
        found = slots[find_slots(displacement, keys, h1, h2)]
        same = found["print"] == _print(h1, h2)
        out = group.select(["doc_id", "copy"]).filter(pa.array(same))
        for name, to in (("shard", np.int32), ("at", np.int64), ("n", np.int64)):
            out = out.append_column(name, pa.array(found[name][same].astype(to)))
        return out

    # Both sides are cut into parts of a bounded number of keys; the index has one row for each.
    named = asked.join(tokens.index.select("part", "file"), "part")
    return named.groupBy("part").applyInArrow(find, schema)


def read_ids(tokens: TokenSet, places: DataFrame) -> DataFrame:
    """(doc_id, copy, start, n_tokens, ids_crc32) of rows (doc_id, copy, shard, at, n); the sum is that of 32-bit ids."""
    path = tokens.path
    kind = places.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(path)
        name, source, width = None, None, 0
        for batch in batches:
            crcs = []
            for file, at, n in zip(batch.column("file").to_pylist(), batch.column("at").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, files.open_input_file(f"{root}/{file}")
                    magic, width = struct.unpack("<8sQ", source.read(16))
                    if magic != IDS_MAGIC:
                        raise ValueError("no file of ids")
                source.seek(16 + at * width)
                crc = 0
                for low in range(0, n, 1 << 20):
                    raw = source.read(min(n - low, 1 << 20) * width)
                    crc = zlib.crc32(np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes(), crc)
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("copy"), batch.column("start"), batch.column("n"), pa.array(crcs, pa.int64())], names=["doc_id", "copy", "start", "n_tokens", "ids_crc32"])
        if source is not None:
            source.close()

    located = places.join(tokens.shards.select("shard", "file", F.col("start").alias("base")), "shard")
    by_file = located.select("doc_id", "copy", "file", "at", "n", (F.col("base") + F.col("at")).alias("start")).repartition("file").sortWithinPartitions("file", "at")
    return by_file.mapInArrow(read, f"doc_id {kind}, copy long, start long, n_tokens long, ids_crc32 long")


def fetch_ids(tokens: TokenSet, wanted: DataFrame) -> DataFrame:
    """(doc_id, copy, ids): the ids of rows (doc_id, copy), each fetched from its place in the shards."""
    path = tokens.path
    kind = wanted.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(path)
        for batch in batches:
            ids = []
            for file, at, n in zip(batch.column("file").to_pylist(), batch.column("at").to_pylist(), batch.column("n").to_pylist(), strict=True):
                with files.open_input_file(f"{root}/{file}") as source:
                    width = struct.unpack("<8sQ", source.read(16))[1]
                    source.seek(16 + at * width)
                    ids.append(np.frombuffer(source.read(n * width), f"<u{width}").astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("copy"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "copy", "ids"])

    located = look_up(tokens, wanted).join(tokens.shards.select("shard", "file"), "shard")
    return located.select("doc_id", "copy", "file", "at", "n").mapInArrow(read, f"doc_id {kind}, copy long, ids array<int>")


def token_digests(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) for every row of ``docs``: written, looked up by key and read back."""
    tokens = write_tokens(docs, **options)
    places = stored(look_up(tokens, tokens.keys.select("doc_id", "copy")), "token-places")
    return read_ids(tokens, places).select("doc_id", "start", "n_tokens", "ids_crc32")
