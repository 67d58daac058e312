"""Training-order materialisation of token ids as fixed-stride binary records.

Texts are tokenised and packed, split by split, into sequences of ``length``
token ids (an end-of-text id follows every document; only the last sequence of
a split is padded).  Sequences are numbered 0 .. N-1 by (split, place).  A keyed
Feistel network over the next power of four, walked along its cycles until the
value is below N, permutes these numbers: the result is the global slot, a
position in training order that any process can compute from the key alone.
Records of equal size go to range partitions of ``per_shard`` slots, so a slot's
shard and byte offset follow by division and reading resumes at any slot.
``materialise`` writes the shards and returns what it reads back from them.

Record (little endian): slot int64, ordinal int64, first and last doc_id int64
(smallest int64: null), number of tokens int32, CRC-32 of the ids int32, then
``length`` ids as uint16.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custvalue.llm.common import scratch_path, written

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public pre-tokenisation pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
LENGTH, PER_SHARD, KEY = 2048, 4096, 0x5EED
HEADER = np.dtype([("slot", "<i8"), ("ordinal", "<i8"), ("doc", "<i8"), ("last", "<i8"), ("n", "<i4"), ("crc", "<u4")])
NO_DOC = -(1 << 63)
ROUNDS = 6


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def feistel_slots(ordinals: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Keyed permutation of 0 .. n-1, applied to ``ordinals``."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right ^ k) & mask)
        return (left << shift) | right

    x = once(ordinals.astype(np.uint64))
    while (out := x >= n).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


def tokenizer(vocabulary: bytes):
    """Encoder of a vocabulary file (base64 token and rank per line)."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pack_sequences(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """(split, place, first_doc_id, last_doc_id, n_tokens, ids): packed sequences, written once."""
    with open(vocabulary, "rb") as f:                            # about 1 MB, read where the driver runs
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "split int, place bigint, first_doc_id bigint, last_doc_id bigint, n_tokens int, ids binary"
    types = pa.schema([("split", pa.int32()), ("place", pa.int64()), ("first_doc_id", pa.int64()),
                       ("last_doc_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(shared.value).encode_to_numpy
        split, place = TaskContext.get().partitionId(), 0
        have = np.zeros(0, np.uint16)                            # ids not yet emitted, below one sequence
        owners: list[tuple[int, int | None]] = []                # (ids of it in have, doc_id), in order
        rows: list[tuple] = []

        def emit(ids: np.ndarray, first, last) -> None:
            nonlocal place
            full = ids if len(ids) == length else np.concatenate((ids, np.full(length - len(ids), END, np.uint16)))
            rows.append((split, place, first, last, len(ids), full.tobytes()))
            place += 1

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), types)], schema=types)
            rows.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), END).astype(np.uint16)
                have = np.concatenate((have, ids))
                owners.append((len(ids), doc))
                at = 0
                while len(have) - at >= length:
                    first, left = owners[0][1], length
                    while left:
                        n, last = owners[0]
                        if n <= left:
                            owners.pop(0)
                            left -= n
                        else:
                            owners[0] = (n - left, last)
                            left = 0
                    emit(have[at:at + length], first, last)
                    at += length
                    if len(rows) >= 512:
                        yield flush()
                have = have[at:]
        if len(have):
            emit(have, owners[0][1], owners[-1][1])
        if rows:
            yield flush()

    return written(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(pack, schema), "token-sequences")


def training_records(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH,
                     per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """Fixed-stride records in range partitions of slots, in slot order within each partition.

    Columns: ``slot, shard, offset, ordinal, first_doc_id, last_doc_id, n_tokens, record``.

    * null and empty texts are one end-of-text id;
    * a null doc_id is null in the row and ``NO_DOC`` in the record's header;
    * repeated rows are written as often as they come; further columns are ignored;
    * an empty table gives an empty result; a text of any length spans as many
      sequences as it needs.
    """
    seqs = pack_sequences(docs, vocabulary, length)
    spark = docs.sparkSession
    counts = {r["split"]: r["n"] for r in seqs.groupBy("split").agg(F.count("*").alias("n")).collect()}  # one row per input split
    base, total = {}, 0
    for split in sorted(counts):
        base[split], total = total, total + counts[split]
    shared = spark.sparkContext.broadcast(base)
    stride = HEADER.itemsize + 2 * length
    schema = ("slot bigint, shard int, offset bigint, ordinal bigint, first_doc_id bigint, "
              "last_doc_id bigint, n_tokens int, record binary")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = pa.Codec("zstd").compress                      # 0.88 instead of 1.02 times the input to shuffle
        for b in batches:
            if not b.num_rows:
                continue
            start = np.array([shared.value[s] for s in b.column("split").to_pylist()], np.int64)
            ordinal = start + b.column("place").to_numpy()
            slot = feistel_slots(ordinal, total, key)
            head = np.zeros(len(slot), HEADER)
            ids = b.column("ids").to_pylist()
            head["slot"], head["ordinal"], head["n"] = slot, ordinal, b.column("n_tokens").to_numpy()
            for field, doc in (("doc", "first_doc_id"), ("last", "last_doc_id")):
                head[field] = [NO_DOC if d is None else d for d in b.column(doc).to_pylist()]
            head["crc"] = [zlib.crc32(i) for i in ids]
            yield pa.RecordBatch.from_pydict({
                "slot": slot, "shard": (slot // per_shard).astype(np.int32), "offset": slot % per_shard * stride,
                "ordinal": ordinal, "first_doc_id": b.column("first_doc_id"), "last_doc_id": b.column("last_doc_id"),
                "n_tokens": b.column("n_tokens"), "record": pa.array([h.tobytes() + squeeze(i, asbytes=True) for h, i in zip(head, ids)], pa.binary())})

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, at = pa.Codec("zstd"), HEADER.itemsize
        for b in batches:
            whole = [r[:at] + codec.decompress(r[at:], 2 * length, asbytes=True) for r in b.column("record").to_pylist()]
            yield b.set_column(b.schema.get_field_index("record"), "record", pa.array(whole, pa.binary()))

    n_shards = max(1, -(-total // per_shard))
    return (seqs.mapInArrow(records, schema).repartitionById(n_shards, F.col("shard"))
            .mapInArrow(unpacked, schema).sortWithinPartitions("shard", "slot"))


def write_shards(records: DataFrame, path: str) -> None:
    """Write the records as raw files, one per shard, below ``path/shard=K/``.

    Each record is followed by one newline byte, so record ``i`` of a shard
    starts at ``i * (stride + 1)``.  Any store that Spark writes to will do; a
    task that is run again replaces its own file.
    """
    (records.select("shard", F.col("record").cast("string").alias("value"))
     .write.partitionBy("shard").option("compression", "none").text(path))


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, per_shard: int = PER_SHARD,
                bytes_out: bool = True) -> DataFrame:
    """The records of the shard files below ``path``, in slot order within each shard.

    Columns: ``slot, shard, offset, ordinal, first_doc_id, last_doc_id, n_tokens,
    crc`` and, with ``bytes_out``, ``record``.  ``offset`` is the record's first
    byte in its file.  Every record's place and ids are checked; a damaged file
    is an error.  A task holds a few files of ``per_shard`` records.
    """
    stride = HEADER.itemsize + 2 * length
    schema = ("slot bigint, shard int, offset bigint, ordinal bigint, first_doc_id bigint, "
              "last_doc_id bigint, n_tokens int, crc bigint" + (", record binary" if bytes_out else ""))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = np.frombuffer(content.as_buffer(), np.uint8)
                if len(rows) % (stride + 1):
                    raise ValueError(f"{len(rows)} bytes are not whole records of {stride + 1}")
                rows = rows.reshape(-1, stride + 1)
                for at in range(0, len(rows), 512):
                    part = rows[at:at + 512]
                    head = np.ascontiguousarray(part[:, :HEADER.itemsize]).view(HEADER)[:, 0]
                    crc = np.array([zlib.crc32(np.ascontiguousarray(r[HEADER.itemsize:stride])) for r in part], np.uint32)
                    bad = (crc != head["crc"]) | (head["slot"] % per_shard != np.arange(at, at + len(part)))
                    if bad.any():
                        raise ValueError(f"record of slot {head['slot'][bad][0]} is damaged")
                    docs = {c: pa.array(np.ascontiguousarray(head[f]), mask=head[f] == NO_DOC)
                            for c, f in (("first_doc_id", "doc"), ("last_doc_id", "last"))}
                    slot = np.ascontiguousarray(head["slot"])
                    yield pa.RecordBatch.from_pydict({
                        "slot": slot, "shard": (slot // per_shard).astype(np.int32), "offset": slot % per_shard * (stride + 1),
                        "ordinal": np.ascontiguousarray(head["ordinal"]), **docs, "n_tokens": np.ascontiguousarray(head["n"]),
                        "crc": crc.astype(np.int64),
                        **({"record": pa.array([r[:stride].tobytes() for r in part], pa.binary())} if bytes_out else {})})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(records, schema)


def materialise(docs: DataFrame, path: str | None = None, vocabulary: str = VOCABULARY, length: int = LENGTH,
                per_shard: int = PER_SHARD, key: int = KEY, bytes_out: bool = False) -> DataFrame:
    """Write the shards of ``training_records`` and return their manifest, one row per record, read from the files.

    ``path`` is a folder that does not exist yet (default: a fresh one below the
    shared checkpoint folder; ``inputFiles()`` of the result names the files).
    Columns as in ``read_shards``.
    """
    path = path or scratch_path(docs.sparkSession, "token-shards")
    write_shards(training_records(docs, vocabulary, length, per_shard, key), path)
    return read_shards(docs.sparkSession, path, length, per_shard, bytes_out)


def read_record(record: bytes) -> tuple[np.void, np.ndarray]:
    """Header and the token ids of one record; raises if the ids are damaged."""
    head = np.frombuffer(record[:HEADER.itemsize], HEADER)[0]
    body = record[HEADER.itemsize:]
    if zlib.crc32(body) != head["crc"]:
        raise ValueError(f"record of slot {head['slot']} is damaged")
    return head, np.frombuffer(body, "<u2")[:head["n"]]
