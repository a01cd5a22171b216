"""Token-ID output: frequency-ranked ids in byte-aligned variable-length coding.

File format (version 1), a folder with two tables of binary blocks that
Spark's committed writers make, so a task that runs twice or an executor that
is lost leaves no half-written file, on any file system Spark can write to:

* ``ranks``: one row, ``ids`` = all ids that occur, most frequent first (ties:
  smaller id first), little-endian unsigned 32-bit. Rank r stands for ids[r].
* ``blocks``: ``shard``, ``block`` (order of the documents: shard, then block,
  then place in the block), ``doc_ids`` (little-endian 64-bit; ``null_ids``
  one byte each, 1 for a null id), ``counts`` (little-endian unsigned 32-bit
  ids per document), ``control`` and ``data``. Each rank takes 1 to 4 bytes of
  ``data``, little-endian without leading zero bytes; ``control`` has two bits
  for each rank, four ranks a byte, lowest bits first: the length less one.
  The last control byte of a block is padded with zero bits.

Documents are written in ascending id order (null ids first; equal ids by
their encoded ids, so the order never depends on the input's). A null or
empty text has the end id alone. The number of ids in a block is about
BLOCK_IDS; one longer document makes a longer block.
"""
from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetyard.llm.frames import column, map_batches, map_stream, remove, scratch, texts
from fleetyard.llm.word_memo import WordMemo
from fleetyard.llm.words import chunks, split_pieces, split_words

BLOCK_IDS = 1 << 18

# --- the codec -------------------------------------------------------------

_LENGTHS = (np.arange(256)[:, None] >> (2 * np.arange(4)) & 3) + 1   # control byte -> 4 lengths
_MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of the ranks (unsigned, below 2**32)."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[:len(ranks)] = size - 1
    quad = codes.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    keep = np.arange(4) < size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of a block: lengths come from a table by control byte."""
    size = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8).astype(np.uint32)
    if n == 0:
        return np.zeros(0, dtype=np.uint32)
    word = raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16 | raw[at + 3] << 24
    return word & _MASKS[size - 1]


# --- tokenizing ------------------------------------------------------------

_MEMO: dict[str, WordMemo] = {}


def _memo(path: str) -> WordMemo:
    if path not in _MEMO:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        _MEMO[path] = WordMemo(lambda words: [e.ids for e in tok.encode_batch_fast(
            words, add_special_tokens=False)])
    return _MEMO[path]


def _pieces(buf: np.ndarray, bounds: np.ndarray):
    special = bool(((buf[:-1] == 0x3C) & (buf[1:] == 0x7C)).any())     # "<|"
    return (split_words if special else split_pieces)(buf, bounds)


def id_type(tokenizer: str, end_id: int) -> str:
    """numpy type that holds every id between the stages: 2 bytes where they do."""
    from tokenizers import Tokenizer

    top = max(end_id, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values())
    return "<u2" if top < 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, kind: str = "<u4") -> DataFrame:
    """(doc_id, ids binary of type ``kind``) of every whole text, the end id appended.

    ``tokenizer`` is the path of a tokenizers file on every machine (installed
    with the vocabulary package, not data). It must lower-case, drop white
    space and split letters from signs, so that no piece crosses those borders
    and A-Z encode as a-z: words are then encoded one by one. A chunk in which
    a special token's string may occur is cut at white space alone.
    """

    def encode(batch: pa.RecordBatch):
        memo = _memo(tokenizer)
        out = []
        for c in chunks(column(batch, "text"), lower=True, split=_pieces):
            ids, ends = memo.texts(c)
            ids = ids.astype(kind)
            end = np.array([end_id], dtype=kind).tobytes()
            out += [ids[a:b].tobytes() + end for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(out, type=pa.binary())],
                                          names=["doc_id", "ids"])

    return map_batches(texts(docs), encode, "doc_id long, ids binary")


def id_ranks(tokens: DataFrame, kind: str = "<u4") -> np.ndarray:
    """All ids that occur, most frequent first: at most the vocabulary's size."""

    def count(batches):
        total: np.ndarray = np.zeros(0, dtype=np.int64)
        for b in batches:
            for raw in column(b, "ids").to_pylist():
                c = np.bincount(np.frombuffer(raw, dtype=kind))
                if len(c) > len(total):
                    total, c = c, total
                total[:len(c)] += c
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    rows = (tokens.select("ids").transform(map_stream, count, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").collect())
    return np.array([r["id"] for r in rows], dtype=np.int64)


# --- writing and reading ---------------------------------------------------

BLOCK_SCHEMA = ("shard int, block int, doc_ids binary, null_ids binary, counts binary, "
                "control binary, data binary, n_ids long")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Tokenize every document and write the files, in ascending id order."""
    spark = docs.sparkSession
    raw, kind = scratch(spark, "tokens"), id_type(tokenizer, end_id)
    tokenize(docs, tokenizer, end_id, kind).write.option("compression", "zstd").parquet(raw)
    tokens = spark.read.schema("doc_id long, ids binary").parquet(raw)
    ids = id_ranks(tokens, kind)
    spark.createDataFrame([(bytearray(ids.astype("<u4").tobytes()),)], "ids binary").write.parquet(f"{folder}/ranks")
    rank = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype="<u4")
    rank[ids] = np.arange(len(ids))
    ranked = spark.sparkContext.broadcast(rank)   # vocabulary-sized

    def blocks(batches):
        shard, block, doc, runs, held = TaskContext.get().partitionId(), 0, [], [], 0

        def flush():
            ranks = ranked.value[np.concatenate(runs)] if runs else np.zeros(0, "<u4")
            control, data = encode_ranks(ranks)
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                "doc_ids": pa.array([np.array([d or 0 for d in doc], dtype="<i8").tobytes()], pa.binary()),
                "null_ids": pa.array([bytes(d is None for d in doc)], pa.binary()),
                "counts": pa.array([np.array([len(r) for r in runs], dtype="<u4").tobytes()], pa.binary()),
                "control": pa.array([control], pa.binary()), "data": pa.array([data], pa.binary()),
                "n_ids": pa.array([len(ranks)], pa.int64())})

        for b in batches:
            for d, v in zip(column(b, "doc_id").to_pylist(), column(b, "ids")):
                doc.append(d)
                runs.append(np.frombuffer(v.as_buffer(), dtype=kind))
                held += len(runs[-1])
                if held >= BLOCK_IDS:
                    yield flush()
                    block, doc, runs, held = block + 1, [], [], 0
        if doc:
            yield flush()

    (tokens.repartitionByRange("doc_id").sortWithinPartitions(F.asc_nulls_first("doc_id"), "ids")
     .transform(map_stream, blocks, BLOCK_SCHEMA).write.parquet(f"{folder}/blocks"))
    remove(spark, [raw])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, block, place, doc_id, ids binary) of every document, decoded."""
    ids = np.frombuffer(bytes(spark.read.schema("ids binary").parquet(f"{folder}/ranks").first()["ids"]), dtype="<u4")
    table = spark.sparkContext.broadcast(ids)   # vocabulary-sized

    def decode(batches):
        for b in batches:
            for r in range(b.num_rows):
                get = lambda name: column(b, name)[r].as_py()  # noqa: B023,E731
                counts = np.frombuffer(get("counts"), dtype="<u4").astype(np.int64)
                n = int(counts.sum())
                flat = table.value[decode_ranks(get("control"), get("data"), n)]
                ends = np.cumsum(counts)
                doc = np.frombuffer(get("doc_ids"), dtype="<i8")
                null = np.frombuffer(get("null_ids"), dtype=np.uint8).astype(bool)
                k = len(doc)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(np.full(k, get("shard"), np.int32)),
                    "block": pa.array(np.full(k, get("block"), np.int32)),
                    "place": pa.array(np.arange(k, dtype=np.int32)),
                    "first": pa.array(ends - counts),
                    "doc_id": pa.array(doc, mask=null),
                    "ids": pa.array([flat[e - c:e].tobytes() for e, c in zip(ends.tolist(), counts.tolist())], pa.binary())})

    return (spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
            .transform(map_stream, decode, "shard int, block int, place int, first long, doc_id long, ids binary"))


def document_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, block, before): ids in the file before each block; one small row a block."""
    sizes = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks").select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("in_shard"))
    lead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)     # one row a shard
    shards = shards.select("shard", F.coalesce(F.sum("in_shard").over(lead), F.lit(0)).alias("before_shard"))
    inner = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("before_block", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)))
            .join(shards, "shard")
            .select("shard", "block", (F.col("before_shard") + F.col("before_block")).alias("before")))


def token_file_digest(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the files, read them back: doc_id, start, n_tokens, ids_crc32 of every row.

    Repeated rows each have a row; a null id stays null and comes first.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "token-files")
    write_token_files(docs, folder, tokenizer, end_id)

    def digest(batch: pa.RecordBatch):
        raw = [v.as_buffer() for v in column(batch, "ids")]
        return pa.RecordBatch.from_arrays(
            [column(batch, n) for n in ("shard", "block", "first", "doc_id")]
            + [pa.array([len(v) // 4 for v in raw], pa.int64()),
               pa.array([zlib.crc32(v) for v in raw], pa.int64())],
            names=["shard", "block", "first", "doc_id", "n_tokens", "ids_crc32"])

    rows = map_batches(read_token_files(spark, folder).drop("place"), digest,
                       "shard int, block int, first long, doc_id long, n_tokens long, ids_crc32 long")
    starts = document_starts(spark, folder)
    return (rows.join(starts, ["shard", "block"])
            .select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))
