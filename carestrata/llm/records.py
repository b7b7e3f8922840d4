"""Token ids as length-delimited binary records with masked checksums, and a separate offset index.

A data shard is a run of frames: length (u64), masked CRC-32C of the length (u32), payload, masked CRC-32C of the
payload (u32), all little-endian. A payload is doc_id (i64) and the ids, two bytes each if the vocabulary fits and four
if not. Shards hold ascending ranges of doc_id, so shard order and record order give document order. The index shard
beside it has one fixed entry per record: doc_id (i64), byte offset (u64), number of ids (u64), so a shuffled reader can
fetch any record with one seek.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carestrata.llm.common import claim_folder, open_store, stage, write_file

END_ID = 2
#: text bytes a data shard aims at
SHARD_BYTES = 8 << 20
#: distinct words a worker remembers with their ids, half of it for words met in two calls, of which those not met since
#: the last turn are forgotten beyond it, and half for all others, which are forgotten together
REMEMBERED_WORDS = 1_200_000
#: texts encoded together, and bytes beyond which fewer are: a word that several of them hold is looked up once
TEXTS, TEXT_BYTES = 4096, 5 << 20

INDEX_ENTRY = "<qQQ"
_HEAD = "<QI"
_CHECK = "<I"


#: bytes whose checksum contributions are looked up side by side
_BLOCK = 256


@functools.cache
def _crc_tables() -> np.ndarray:
    """``[d, b]``: what byte ``b`` adds to a CRC-32C register when ``d`` bytes follow it."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(0x82F63B78), first >> 1).astype(np.uint32)
    tables = [first]
    for _ in range(_BLOCK + 3):
        tables.append(first[tables[-1] & 0xFF] ^ (tables[-1] >> 8))
    return np.stack(tables)


def crc32c(messages: list[bytes]) -> np.ndarray:
    """CRC-32C (Castagnoli) of every message, all at once.

    The checksum is linear, so blocks of all messages are summed by table side by side; then each message's blocks are
    joined from the left. Zeros before a message change nothing once the initial register is folded into its first bytes.
    """
    tables = _crc_tables()
    sizes = np.array([len(m) for m in messages], dtype=np.int64)
    blocks = np.maximum(1, -(-sizes // _BLOCK))
    starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(blocks)))
    data = bytearray(int(starts[-1]) * _BLOCK)
    for m, end in zip(messages, (starts[1:] * _BLOCK).tolist()):
        data[end - len(m) : end] = m
    flat = np.frombuffer(data, dtype=np.uint8)
    heads = (starts[1:] * _BLOCK - sizes)[sizes >= 4]
    for k in range(4):
        flat[heads + k] ^= 0xFF
    rows = flat.reshape(-1, _BLOCK)
    sums = np.zeros(len(rows), dtype=np.uint32)
    for begin in range(0, len(rows), 4096):
        part = np.ascontiguousarray(rows[begin : begin + 4096].T)
        for j in range(_BLOCK):
            sums[begin : begin + 4096] ^= tables[_BLOCK - 1 - j][part[j]]
    out = np.zeros(len(messages), dtype=np.uint32)
    by_size = np.argsort(-blocks, kind="stable")
    active = len(messages)
    for k in range(int(blocks.max(initial=0))):
        while active and blocks[by_size[active - 1]] <= k:
            active -= 1
        at = by_size[:active]
        old = out[at]
        for byte in range(4):  # the register's own bytes, followed by a whole block
            sums[starts[at] + k] ^= tables[_BLOCK - 1 - byte][(old >> np.uint32(8 * byte)) & np.uint32(0xFF)]
        out[at] = sums[starts[at] + k]
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes < 4).tolist():
        state = 0xFFFFFFFF
        for byte in messages[i]:
            state = int(tables[0][(state ^ byte) & 0xFF]) ^ (state >> 8)
        out[i] = state ^ 0xFFFFFFFF
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def frames(payloads: list[bytes]) -> list[bytes]:
    """Every payload framed by its length and the masked checksums of both."""
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    checks = masked(crc32c(lengths + payloads)).astype("<u4").tobytes()
    n = 4 * len(payloads)
    return [
        b"".join((length, checks[4 * i : 4 * i + 4], payload, checks[n + 4 * i : n + 4 * i + 4]))
        for i, (length, payload) in enumerate(zip(lengths, payloads))
    ]


def read_frames(data: bytes) -> list[tuple[int, bytes]]:
    """``(offset, payload)`` of every frame; raises on a truncated frame or a wrong checksum."""
    at, found, wanted = 0, [], []
    while at < len(data):
        if at + struct.calcsize(_HEAD) > len(data):
            raise ValueError(f"truncated frame at {at}")
        length, check = struct.unpack_from(_HEAD, data, at)
        end = at + struct.calcsize(_HEAD) + length
        if end + 4 > len(data):
            raise ValueError(f"truncated frame or wrong length at {at}")
        found.append((at, data[at + struct.calcsize(_HEAD) : end]))
        wanted.append((check, struct.unpack_from(_CHECK, data, end)[0]))
        at = end + 4
    for start in range(0, len(found), 512):
        part = found[start : start + 512]
        got = masked(crc32c([data[o : o + 8] for o, _ in part] + [p for _, p in part])).reshape(2, -1).T
        wrong = np.flatnonzero((got != np.array(wanted[start : start + 512], dtype=np.uint32)).any(axis=1))
        if len(wrong):
            raise ValueError(f"wrong checksum at {part[wrong[0]][0]}")
    return found


_MARKS = "!#$%&()*+,-./:;<=>?@[]^_{|}~"
#: the end of a word whose marks behind it are tokens of their own
_WORD_END = r"[\pL\pN]\z"
#: what a text of words between single spaces and single line ends does not match: no text, white space at an end, two in a
#: row, or any other white space (the characters of ``str.isspace``)
_OTHER_SPACE = (
    r"\A\z|\A[ \n]|[ \n]\z|[ \n][ \n]|"
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _listed(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Whole-text ids of a byte-level BPE whose words start at a space, with a bounded memory of words.

    Such a tokenizer never joins a word with what stands before its space or line end. In a text whose white space is
    only single spaces and single line ends, the ids are therefore those of its words one after another, each with the
    space or line end before it; any other text, and one that may hold a special token, is encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.often, self.often_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.met = np.zeros(0, dtype=bool)  # of the words met often: since some were last forgotten
        getattr(self.tokenizer.model, "_resize_cache", lambda n: None)(0)  # words are remembered here instead
        self.starts = {}  # by space and line end: is an id's token one that starts with it?
        vocabulary = self.tokenizer.get_vocab()
        for between in " \n":
            first = self.tokenizer.encode(between).tokens[0]
            self.starts[between] = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            self.starts[between][[i for t, i in vocabulary.items() if t.startswith(first)]] = True
        self.line_end = self.whole(["\n"])[0]
        self.tails: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        parts = (texts[i : i + 8] for i in range(0, len(texts), 8))  # few at once, as the library's results are large
        found = (e for part in parts for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False))
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _apart(self, words: list[str], between: str) -> list[bytes]:
        """Ids of every word after ``between``, or of words that start with it, encoded together and cut where it starts."""
        lead = between if words[0][0] != between else ""
        runs = [lead + lead.join(words[i : i + 500]) for i in range(0, len(words), 500)]
        ids = np.frombuffer(b"".join(self.whole(runs)), self.dtype)
        cuts = np.append(np.flatnonzero(self.starts[between][ids]), len(ids))
        if len(cuts) != len(words) + 1:
            raise ValueError(f"this tokenizer does not cut words at {between!r}")
        offsets = pa.py_buffer(cuts * ids.itemsize)
        return _listed(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, offsets, pa.py_buffer(ids)]))

    def _learn(self, words: list[str]) -> list[bytes]:
        """Remember the ids of words after a space, and of words that start a line together with the line end.

        Marks after a letter or digit are tokens of their own, so only the word before them has to be encoded.
        """
        known = self.known
        column = pa.array(words, pa.large_string())
        bases = pc.utf8_rtrim(column, _MARKS)
        shorter = pc.less(pc.binary_length(bases), pc.binary_length(column))
        cut = pc.and_(shorter, pc.match_substring_regex(bases, _WORD_END))
        marked, bases = _listed(column.filter(cut)), _listed(bases.filter(cut))
        plain = set(_listed(column.filter(pc.invert(cut))))
        plain.update(base for base in bases if base not in known)
        lines = [w for w in plain if w[0] == "\n"]
        for between, part in (("\n", lines), (" ", list(plain.difference(lines)))):
            if part:
                known.update(zip(part, self._apart(part, between)))
        ends = [w[len(base) :] for w, base in zip(marked, bases)]
        tails = list(set(ends).difference(self.tails))
        self.tails.update(zip(tails, self.whole(tails)))
        known.update(zip(marked, [known[base] + self.tails[end] for base, end in zip(bases, ends)]))
        return list(map(known.__getitem__, words))

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words. Those met in two calls are kept as Arrow columns and found there without Python objects."""
        if len(self.known) > REMEMBERED_WORDS // 2:
            self.known, self.tails = {}, {}
        if len(self.often) > REMEMBERED_WORDS // 2:
            self.often, self.often_ids = self.often.filter(pa.array(self.met)), self.often_ids.filter(pa.array(self.met))
            self.met = np.zeros(len(self.often), dtype=bool)
        place = pc.index_in(words, value_set=self.often).fill_null(-1).to_numpy().astype(np.int64)
        missing = place < 0
        self.met[place[~missing]] = True
        rest = words.filter(pa.array(missing))
        listed = _listed(rest)
        ids_of = list(map(self.known.get, listed))
        again = [i for i, ids in enumerate(ids_of) if ids is not None]
        if len(again) < len(ids_of):
            lacking = [i for i, ids in enumerate(ids_of) if ids is None]
            for i, ids in zip(lacking, self._learn([listed[i] for i in lacking])):
                ids_of[i] = ids
        place[missing] = np.arange(len(self.often), len(self.often) + len(listed))
        rest_ids = pa.array(ids_of, pa.large_binary())
        out = pa.concat_arrays([self.often_ids, rest_ids]).take(pa.array(place))
        if again:
            moved = pa.array(again, pa.int64())
            self.often = pa.concat_arrays([self.often, rest.take(moved)])
            self.often_ids = pa.concat_arrays([self.often_ids, rest_ids.take(moved)])
            self.met = np.append(self.met, np.ones(len(again), dtype=bool))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text; Arrow cuts the texts and looks at repeated words, and each distinct word is looked up once."""
        kind = pa.large_string()
        column = pa.array(texts, kind)
        irregular = pc.match_substring_regex(column, _OTHER_SPACE)
        for special in self.special:
            irregular = pc.or_(irregular, pc.match_substring(column, special))
        whole = np.flatnonzero(irregular.to_numpy(zero_copy_only=False)).tolist()
        out: list[bytes | None] = [None] * len(texts)
        for i, ids in zip(whole, self.whole([texts[i] for i in whole])):
            out[i] = ids
        if len(whole) == len(texts):
            return out
        lines = pc.replace_substring(column.filter(pc.invert(irregular)), "\n", " \n")
        # the first word of a text is looked up as one that starts a line, whose line end is left out again
        pieces = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\n", kind), lines, pa.scalar("", kind)), " ")
        found = pieces.flatten().dictionary_encode()
        run = self._ids_of(found.dictionary).take(found.indices)
        ends = np.frombuffer(run.buffers()[1], np.int64)[run.offset : run.offset + len(run) + 1][pieces.offsets.to_numpy()].tolist()
        data, skipped = memoryview(run.buffers()[2]), len(self.line_end)
        parts = iter(zip(ends[:-1], ends[1:]))
        for i in range(len(out)):
            if out[i] is None:
                begin, end = next(parts)
                out[i] = bytes(data[begin + skipped : end])
        return out


def _groups(texts: pa.Array) -> list[tuple[int, int]]:
    """``(start, count)`` of neighbouring texts that are encoded together."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    turns = np.flatnonzero(np.diff(sizes // TEXT_BYTES, prepend=0) + np.diff(np.arange(len(sizes)) // TEXTS, prepend=0)).tolist()
    starts = sorted({0, *turns}) if len(sizes) else []
    return [(start, end - start) for start, end in zip(starts, [*starts[1:], len(sizes)])]


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _shards(docs: DataFrame, shard_bytes: int) -> DataFrame:
    """Rows dealt by ascending doc_id over as many partitions as the text needs; null ids come first."""
    total = docs.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))))).first()[0] or 0
    count = max(1, -(-total // shard_bytes))
    return docs.repartitionByRange(count, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )


def write_records(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> str:
    """Encode every row of ``docs (doc_id, text, ...)`` and write data and index shards; returns their folder.

    A null text counts as empty and gives only the end id. A null doc_id is written as the smallest 64-bit number and
    comes first. Repeated rows give repeated records. Other columns are ignored. An empty table writes no shard.
    A task writes its shard under a name of its own and renames it when complete, so repeated tasks leave one copy.
    """
    folder = claim_folder(docs.sparkSession, "records")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        from pyspark import TaskContext

        encoder = _encoder(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        shard, index, count = TaskContext.get().partitionId(), [], 0

        def shard_frames():
            at = 0
            for batch in batches:
                for start, count in _groups(batch["text"]):
                    part = batch.slice(start, count).to_pydict()
                    keys = [-(2**63) if doc is None else doc for doc in part["doc_id"]]
                    tokens = [ids + end for ids in encoder.encode([text or "" for text in part["text"]])]
                    for key, ids, out in zip(keys, tokens, frames([struct.pack("<q", k) + t for k, t in zip(keys, tokens)])):
                        index.append(struct.pack(INDEX_ENTRY, key, at, len(ids) // encoder.dtype.itemsize))
                        at += len(out)
                        yield out

        first = next(stream := shard_frames(), None)
        if first is not None:
            write_file(folder, f"data-{shard:06d}.rec", (x for part in ((first,), stream) for x in part))
            write_file(folder, f"data-{shard:06d}.idx", index)
            count = len(index)
        pa.default_memory_pool().release_unused()  # the worker stays, and other stages need the executor's memory
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([count], pa.int64())], ["shard", "records"])

    done = stage(_shards(chosen, shard_bytes).mapInArrow(run, "shard int, records long"), "records-shards")
    if done.where("records > 0").isEmpty():
        open_store(folder)[0].create_dir(open_store(folder)[1], recursive=True)
    return folder


def read_records(spark: SparkSession, folder: str, wide: bool = False, with_ids: bool = True) -> DataFrame:
    """``(shard, place, doc_id, n_tokens, ids_crc32, ids)`` of every record, checksums verified.

    ``ids`` is the array of token ids, left out without ``with_ids``. ``wide`` tells that ids take four bytes.
    """
    dtype = np.dtype("<u4" if wide else "<u2")
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.schema(schema).format("binaryFile").option("pathGlobFilter", "data-*.rec").load(folder)

    def run(batches):
        kinds = pa.schema([(n, pa.int32() if n == "shard" else pa.int64()) for n in names[:5]])
        if with_ids:
            kinds = kinds.append(pa.field("ids", pa.list_(pa.int64())))
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                shard = int(re.search(r"data-(\d+)\.rec$", path.as_py())[1])
                found = read_frames(content.as_py())
                for start in range(0, len(found), 500):
                    rows = []
                    for place, (_, payload) in enumerate(found[start : start + 500], start):
                        doc = struct.unpack_from("<q", payload)[0]
                        ids = np.frombuffer(payload, dtype, offset=8).astype("<u4")
                        row = (shard, place, None if doc == -(2**63) else doc, len(ids), zlib.crc32(ids.tobytes()))
                        rows.append((*row, ids.astype(np.int64)) if with_ids else row)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)

    names = ["shard", "place", "doc_id", "n_tokens", "ids_crc32", "ids"]
    types = "shard int, place long, doc_id long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return files.select("path", "content").mapInArrow(run, types)


#: files a shuffled reader keeps open in a task
_OPEN_FILES = 64


def read_shuffled(spark: SparkSession, folder: str, seed: int = 0, wide: bool = False) -> DataFrame:
    """``(place, doc_id, ids)`` of every record in an order that ``seed`` fixes; ``place`` ascends in that order.

    Only the index shards are read to plan the order: an entry's place is a hash of seed, shard and offset, and ranges of
    places are dealt to tasks. A task then fetches each of its records with one seek, and verifies its checksums.
    """
    dtype = np.dtype("<u4" if wide else "<u2")
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.schema(schema).format("binaryFile").option("pathGlobFilter", "data-*.idx").load(folder)

    def entries(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(content.as_py(), np.dtype("<i8,<u8,<u8"))
                for part in (found[i : i + 65536] for i in range(0, len(found), 65536)):
                    columns = [pa.array([path] * len(part)), pa.array(part["f1"].astype(np.int64)), pa.array(part["f2"].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "at", "n"])

    planned = files.select("path", "content").mapInArrow(entries, "path string, at long, n long")
    shard = F.regexp_extract("path", r"data-(\d+)\.idx$", 1)
    placed = planned.withColumn("place", F.xxhash64(F.lit(seed).cast("long"), shard, "at"))
    dealt = placed.repartitionByRange("place", "path", "at").sortWithinPartitions("place", "path", "at")

    def fetch(batches):
        held: dict = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = []
                for path, at, n, place in zip(*(c.to_pylist() for c in batch.slice(begin, 256).columns)):
                    if path not in held:
                        if len(held) >= _OPEN_FILES:
                            held.pop(next(iter(held))).close()
                        store, name = open_store(path.removesuffix(".idx") + ".rec")
                        held[path] = store.open_input_file(name)
                    held[path].seek(at)
                    frame = held[path].read(struct.calcsize(_HEAD) + 8 + n * dtype.itemsize + 4)
                    (_, payload), = read_frames(frame)
                    doc = struct.unpack_from("<q", payload)[0]
                    rows.append((place, None if doc == -(2**63) else doc, np.frombuffer(payload, dtype, offset=8).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["place", "doc_id", "ids"])
        for file in held.values():
            file.close()

    types = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return dealt.mapInArrow(fetch, "place long, doc_id long, ids array<long>")


def document_digests(records: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``; ``start`` counts the ids of all records before, in file order.

    Sums of whole shards are one row per shard and are added up first; within a shard the running sum is a window over
    that shard's records, whose number the shard size bounds.
    """
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    digests = stage(records.select("shard", "place", "doc_id", "n_tokens", "ids_crc32"), "records-digests")
    totals = digests.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", F.coalesce(F.sum("n").over(earlier(Window.orderBy("shard"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_tokens").over(earlier(Window.partitionBy("shard").orderBy("place"))), F.lit(0))
    return digests.withColumn("inside", inside).join(before, "shard").select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )

