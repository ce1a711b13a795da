"""Token ids on disk: one file per shard, as blocks of wavelet matrices.

Documents are range-partitioned and sorted by id; each task encodes its rows and
writes one Parquet file (zstd) whose rows are blocks. A block holds whole
documents of about ``block_tokens`` ids: the bit planes of a wavelet matrix,
their rank samples, and the documents' ids and lengths. One block answers token
access, counts of a token in a range and places of its occurrences without
decoding the rest; files are written and read through Spark, on any store.
"""
from __future__ import annotations

import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepwise.session import scratch_path, ship_package

_SAMPLE = 512
_SCHEMA = ("shard int, block int, n_tokens long, bits int, planes binary, ranks binary, zeros array<long>, "
           "doc_ids array<long>, doc_tokens array<long>")


class WaveletMatrix:
    """A sequence of non-negative ints as succinct bit planes, highest bit first."""

    def __init__(self, n: int, bits: int, planes: bytes, ranks: bytes, zeros: list[int]):
        self.n, self.bits, self.zeros = n, bits, zeros
        self.planes = np.frombuffer(planes, np.uint8).reshape(bits, -1)
        self.ranks = np.frombuffer(ranks, np.uint32).reshape(bits, -1)

    @classmethod
    def build(cls, values: np.ndarray) -> WaveletMatrix:
        n = len(values)
        bits = max(1, int(values.max(initial=0)).bit_length())
        width = (n + _SAMPLE - 1) // _SAMPLE * _SAMPLE // 8
        planes, zeros, ranks = np.zeros((bits, width), np.uint8), [], np.zeros((bits, width * 8 // _SAMPLE + 1), np.uint32)
        values = values.astype(np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits):
            ones = (values & (1 << (bits - 1 - level))).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            planes[level, :len(packed)] = packed
            ranks[level, 1:] = np.cumsum(np.bitwise_count(planes[level]).reshape(-1, _SAMPLE // 8).sum(axis=1, dtype=np.uint32))
            values = np.concatenate([values[~ones], values[ones]])
            zeros.append(n - int(np.count_nonzero(ones)))
        return cls(n, bits, planes.tobytes(), ranks.tobytes(), zeros)

    def _ones(self, level: int, i: int) -> int:
        """Ones before place i of a plane."""
        at = i // _SAMPLE
        part = self.planes[level, at * _SAMPLE // 8: i // 8]
        rest = int(self.planes[level, i // 8]) & ((1 << (i % 8)) - 1) if i % 8 else 0
        return int(self.ranks[level, at]) + int(np.bitwise_count(part).sum()) + rest.bit_count()

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            bit = int(self.planes[level, i // 8]) >> (i % 8) & 1
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if not 0 <= token < 1 << self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in places lo to hi."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) zero or one of a plane."""
        places = np.arange(len(self.ranks[level]), dtype=np.int64) * _SAMPLE
        upto = self.ranks[level].astype(np.int64) if bit else places - self.ranks[level]
        at = int(np.searchsorted(upto, k, side="right")) - 1
        part = np.unpackbits(self.planes[level, at * _SAMPLE // 8:(at + 1) * _SAMPLE // 8], bitorder="little")
        return at * _SAMPLE + int(np.flatnonzero(part == bit)[k - int(upto[at])])

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for level in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def values(self) -> np.ndarray:
        """All values in order: the stable partitions undone from the last plane to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for level in reversed(range(self.bits)):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            before = np.empty(self.n, kind)
            before[~ones] = out[:self.zeros[level]]
            before[ones] = out[self.zeros[level]:] | kind(1 << (self.bits - 1 - level))
            out = before
        return out.astype(np.uint32)


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


class _Numbers(dict):
    """Part -> its number; a part not met before gets the next number and is noted in ``new``."""

    def __init__(self, parts=()):
        super().__init__((part, n) for n, part in enumerate(parts))
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.new.append(part)
        return number


class Encoder:
    """Ids of whole texts from a tokenizers file, with a bounded memory of text parts already encoded.

    Texts are cut before a single blank between printable ASCII or Latin letters: byte-level
    pre-tokenisation always cuts there, so the parts' ids in a row are the text's ids. A part
    is remembered with its leading blank. When the memory is full, parts met once are forgotten."""

    _EDGE = "!-~À-ɏ"
    _MOST_PARTS, _MOST_CHARS = 1_000_000, 1 << 25
    _TOGETHER = 256  # new plain parts encoded as one text

    def __init__(self, path: str):
        # Spark's tasks are the parallelism
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cut = re.compile(f"(?<=[{self._EDGE}]) (?=[{self._EDGE}])")
        # words after a blank that a text may always be cut before and behind
        self.plain = re.compile(f" [{self._EDGE}](?:[^ ]*[{self._EDGE}])?").fullmatch
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.blank_first = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank_first[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.ids, self.begin, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        self._remember([], np.empty(0, np.int64))

    def _remember(self, parts: list[str], old: np.ndarray) -> None:
        """Start the memory anew with ``parts``, whose numbers were ``old``."""
        ids = [self.ids[self.begin[i]:self.begin[i] + self.size[i]] for i in old.tolist()]
        self.number, self.chars = _Numbers(parts), sum(map(len, parts))
        self.ids = np.concatenate([np.empty(0, np.uint32), *ids])
        self.size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.begin = np.cumsum(self.size) - self.size
        self.odd = np.fromiter((not self.plain(p) for p in parts), bool, len(parts))
        self.again = np.zeros(len(parts), bool)

    def _forget(self) -> None:
        keep = np.flatnonzero(self.again)
        parts = list(self.number)
        chosen = [parts[i] for i in keep.tolist()]
        if 2 * len(chosen) > self._MOST_PARTS or 2 * sum(map(len, chosen)) > self._MOST_CHARS:
            chosen, keep = [], keep[:0]
        self._remember(chosen, keep)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Encode new parts. Plain ones have one blank each, at their start, so they are encoded
        together and their ids told apart by the tokens that begin with a blank."""
        odd = np.fromiter((not self.plain(p) for p in new), bool, len(new))
        plain, others = [p for p, o in zip(new, odd) if not o], [p for p, o in zip(new, odd) if o]
        together = self._ids(["".join(plain[at:at + self._TOGETHER]) for at in range(0, len(plain), self._TOGETHER)])
        flat = np.concatenate([np.empty(0, np.uint32), *together])
        begin = np.flatnonzero(self.blank_first[flat])
        if len(begin) != len(plain):
            raise ValueError("not a byte-level vocabulary: its tokens do not tell where a word begins")
        alone = self._ids(others)
        alone_size = np.fromiter(map(len, alone), np.int64, len(alone))
        size, start = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        size[~odd], size[odd] = np.diff(begin, append=len(flat)), alone_size
        start[~odd], start[odd] = begin, len(flat) + np.cumsum(alone_size) - alone_size
        self.begin = np.concatenate([self.begin, start + len(self.ids)])
        self.size = np.concatenate([self.size, size])
        self.odd = np.concatenate([self.odd, odd])
        self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        self.ids = np.concatenate([self.ids, flat, *alone])
        self.chars += sum(map(len, new))

    def _numbers(self, parts: list[str]) -> np.ndarray:
        known = len(self.number)
        at = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        self.again[at[at < known]] = True
        if self.number.new:
            new, self.number.new = self.number.new, []
            self._learn(new)
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text); a null text is empty."""
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if len(self.number) > self._MOST_PARTS or self.chars > self._MOST_CHARS:
            self._forget()
        texts = texts.fill_null("")
        words = pc.split_pattern(texts, " ")
        begin = words.offsets.to_numpy()[:-1]
        coded = words.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        at = self._numbers(_strings(pc.binary_join_element_wise(" ", coded.dictionary, "")))[which]
        count = np.diff(begin, append=len(at))
        # the first part of a text has no blank before it
        firsts = _strings(coded.dictionary.take(pa.array(which[begin])))
        uncut = np.flatnonzero(np.logical_or.reduceat(self.odd[at], begin)).tolist()
        if uncut:
            rows = np.split(at, begin[1:])
            for i in uncut:
                firsts[i], *rest = self.cut.split(texts[i].as_py())
                rows[i] = np.append(0, self._numbers([" " + p for p in rest]))
            at, count = np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows))
            begin = np.cumsum(count) - count
        at[begin] = self._numbers(firsts)
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.begin[at] - (ends - sizes), sizes)
        return self.ids[places], np.add.reduceat(sizes, begin)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _block(shard: int, block: int, doc_ids: list, parts: list[np.ndarray]) -> pa.RecordBatch:
    matrix = WaveletMatrix.build(np.concatenate(parts))
    values = [[shard], [block], [matrix.n], [matrix.bits], [matrix.planes.tobytes()], [matrix.ranks.tobytes()], [matrix.zeros],
              [doc_ids], [[len(p) for p in parts]]]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in _SCHEMA.split(", ")])


def _pieces(batch: pa.RecordBatch, most_bytes: int):
    """The rows of a batch in order, in slices of about ``most_bytes`` of text."""
    length = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(length, dtype=np.int64) // most_bytes
    edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def _encoded(path: str, end_id: int, block_tokens: int, piece_bytes: int = 1 << 22):
    def run(batches):
        encoder, shard, block = _encoder(path), TaskContext.get().partitionId(), 0
        ids, parts, held = [], [], 0
        for batch in batches:
            for piece in _pieces(batch, piece_bytes):
                tokens, sizes = encoder.encode(piece.column(1))
                ends = np.cumsum(sizes)
                for doc_id, a, b in zip(piece.column(0).to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                    ids.append(doc_id)
                    parts.append(np.append(tokens[a:b], np.uint32(end_id)))
                    held += len(parts[-1])
                    if held >= block_tokens:
                        yield _block(shard, block, ids, parts)
                        ids, parts, held, block = [], [], 0, block + 1
        if ids:
            yield _block(shard, block, ids, parts)
    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2, block_tokens: int = 1 << 20) -> str:
    """Encode every whole text (null: empty) with its end id in ascending id order; returns ``path``.

    Null ids come first; repeated rows are written as often as they occur, next
    to each other. ``tokenizer_path`` must exist on every worker. A document is
    never split over blocks, so a block is as large as ``block_tokens`` or its
    longest document. An empty table writes no block.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    (texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(_encoded(tokenizer_path, end_id, block_tokens), _SCHEMA)
     .write.option("compression", "zstd").parquet(path))
    return path


def _digests(batches):
    for batch in batches:
        for row in batch.to_pylist():
            values = WaveletMatrix(row["n_tokens"], row["bits"], row["planes"], row["ranks"], row["zeros"]).values().astype("<u4")
            sizes = np.array(row["doc_tokens"], np.int64)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            crcs = [zlib.crc32(values[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[k]] * len(sizes), pa.int32()) for k in ("shard", "block")]
                + [pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())],
                names=["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    blocks = spark.read.schema(_SCHEMA).parquet(path)
    sizes = blocks.select("shard", "block", "n_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(base, "shard")
               .select("shard", "block", (F.col("base") + F.col("inside")).alias("offset")))
    return (blocks.mapInArrow(_digests, "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")
            .join(offsets, ["shard", "block"])
            .select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Per block: shard, block, occurrences of a token, from the planes' ranks."""
    @F.udf("long", useArrow=True)
    def occurrences(n, bits, planes, ranks, zeros):
        return WaveletMatrix(n, bits, planes, ranks, list(zeros)).count(token)

    return spark.read.schema(_SCHEMA).parquet(path).select(
        "shard", "block", occurrences("n_tokens", "bits", "planes", "ranks", "zeros").alias("occurrences"))


def token_digests(docs: DataFrame, tokenizer_path: str, path: str | None = None, **settings) -> DataFrame:
    """Write the token files (a new folder in the shared scratch folder unless named) and read their digests back."""
    path = path or scratch_path(docs.sparkSession, f"tokens-{uuid.uuid4().hex[:12]}")
    return read_digests(docs.sparkSession, write_tokens(docs, tokenizer_path, path, **settings))
