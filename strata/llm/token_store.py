"""Token ids in a static range asymmetric numeral system (rANS) store.

Documents are range-partitioned and sorted by doc_id, tokenised (by chunks that a worker remembers),
and put into blocks of whole documents. One pass over all blocks counts the ids; from the counts
comes one shared frequency table (2^20 slots, every id that occurs has one at least). Each block is
then coded by itself: ``lanes`` interleaved 64-bit states that give off 32-bit words, a checkpoint
(word position and all states) every ``STEP`` steps, a CRC of the coded bytes and one of the ids. A
reader opens any block alone, and within a block decodes all checkpoints side by side.

Store folder: ``frequencies`` (id, slots) and ``blocks`` (part, block, n_tokens, doc_ids, lengths,
payload), both Parquet, so any cluster store works; the payload format is given at ``encode_block``.

Defined cases: null and empty texts give only the end id; null doc_ids come first; repeated rows are
written once each, rows with one doc_id in the order of their texts; a document longer than a block
is a block of its own; an empty table writes an empty store that reads back as no rows; other columns
are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain, compress
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Shared, arrow_schema, gathered, give_back, parts_for, small_batches, text_bytes, to_batch

PART_BYTES = 16 << 20
BLOCK_TOKENS = 1 << 18
SCALE, LOW = np.uint64(20), np.uint64(1 << 31)
MAX_LANES, STEP = 1024, 128
WORD = np.uint64(32)
#: Chunks in each of the two generations that a worker remembers, and the bytes of the longest remembered.
KNOWN_CHUNKS, LONG_CHUNK = 600_000, 64
#: Bytes of text that are tokenised at a time, and how many chunks' ids are put together at a time.
ENCODE_BYTES, SPREAD_CHUNKS = 16 << 20, 1 << 18


# -- tokenising ---------------------------------------------------------------------------

def _kinds() -> np.ndarray:
    """Of each byte: LETTER (A-Z, a-z), MARK (other printable ASCII), SPACE (ASCII that Python or Unicode count as
    white space); 0 for the rest."""
    kinds = np.zeros(256, np.uint8)
    for c in range(128):
        kinds[c] = SPACE if chr(c).isspace() else LETTER if chr(c).isalpha() else MARK if 0x20 < c < 0x7F else 0
    return kinds


LETTER, MARK, SPACE = 1, 2, 4
_KINDS = _kinds()
#: Whether the characters of two bytes are letters.
_LETTERS = np.array([category(chr(c))[0] == "L" for c in range(0x800)])
#: A blank or none, and letters of one or two bytes: one piece, whatever stands around it.
_WORD = re.compile(" ?[" + "".join(map(chr, np.flatnonzero(_LETTERS))) + "]+").fullmatch
#: Beginnings of the wide white space, as the first three bytes (the third is 0 after two).
_WIDE = np.array([int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in range(0x80, 0x3001) if chr(c).isspace()])
_WIDE_LEADS = np.isin(np.arange(256), _WIDE >> 16)


def _no_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether no white space begins at these places of a text (its end counts as none)."""
    padded = lambda k: data[np.minimum(at + k, len(data) - 1)].astype(np.int64)
    lead = padded(0)
    out = _KINDS[lead] != SPACE
    wide = np.flatnonzero(_WIDE_LEADS[lead])
    if len(wide):
        at = at[wide]
        out[wide] = ~np.isin(lead[wide] << 16 | padded(1) << 8 | np.where(lead[wide] < 0xE0, 0, padded(2)), _WIDE)
    return out


def cut(texts: pa.Array, whole: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """Cut texts into chunks that the tokenizer's pattern never joins, so that they can be tokenised one by one;
    the chunks as bytes, and how many there are up to the end of each text. ``whole``: texts not to be cut.

    The pattern is that of byte-level BPE: contractions, ``_?L+``, ``_?N+``, ``_?[^sLN]+`` (a blank, then letters,
    numbers, or others), white space but the last before a non-space, white space. A new piece starts, whatever
    stands before or after,
    - at a blank that a non-space follows,
    - at a mark or digit after a letter: only a letter continues a piece that ends with one,
    - at a line feed after a mark, digit or letter, and after it if a non-space follows.
    What stands before such a place does not end with white space, or is white space that matches alike at the end
    of a text. Places missed (letters of three bytes and more) make chunks longer, not wrong."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    offsets, first = offsets - offsets[0], offsets[0]
    n = int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first:first + n] if n else np.zeros(0, np.uint8)
    starts = np.zeros(n + 1, bool)
    if n:
        ends = offsets[1:][np.diff(offsets) > 0] - 1
        kinds = _KINDS[data]
        blanks = data == 0x20
        blanks[ends] = False
        at = np.flatnonzero(blanks)
        starts[at[_no_space(data, at + 1)]] = True
        marks = kinds[1:] == MARK
        starts[1:n] |= marks & (kinds[:-1] == LETTER)
        at = np.flatnonzero(marks[1:] & (data[1:-1] >= 0x80)) + 2  # marks after the second byte of a character or a later one
        lead = data[at - 2].astype(np.int64)
        at, lead = at[lead >> 5 == 6], lead[lead >> 5 == 6]
        starts[at[_LETTERS[(lead & 0x1F) << 6 | data[at - 1] & 0x3F]]] = True
        at = np.flatnonzero((data[1:] == 0x0A) & (kinds[:-1] & (LETTER | MARK) > 0)) + 1
        starts[at] = True
        at = at[at < n - 1]
        starts[at[_no_space(data, at + 1)] + 1] = True
        for k in () if whole is None else np.flatnonzero(whole):
            starts[offsets[k]:offsets[k + 1]] = False
    starts[offsets] = True
    places = np.flatnonzero(starts).astype(np.int32)
    if not n:
        places = np.zeros(1, np.int32)
    chunks = pa.Array.from_buffers(
        pa.binary(), len(places) - 1, [None, pa.py_buffer(places + first), texts.buffers()[2] or pa.py_buffer(b"")])
    return chunks, np.searchsorted(places, offsets[1:])


def _byte_alphabet() -> dict[int, str]:
    """What byte-level tokenizers write for each byte: itself if it prints, else a character from U+0100 on. Line
    feeds stay, to separate words."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(0x100 + k) for k, b in enumerate(rest) if b != 0x0A}


class Known:
    """Chunks and their ids: ``ids[ends[k]:ends[k + 1]]`` are those of ``keys[k]``. Flat arrays, some 30 bytes a
    chunk, which Arrow searches many chunks at a time."""

    def __init__(self, keys: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        self.keys, self.ids, self.ends = keys, ids, ends

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, wanted: pa.Array) -> np.ndarray:
        """Places of the wanted chunks, -1 for those that are not here."""
        if not len(self):
            return np.full(len(wanted), -1)
        return pc.fill_null(pc.index_in(wanted, value_set=self.keys), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def pick(self, places: np.ndarray) -> Known:
        ids, counts = spread(self.ids, self.ends[places], np.diff(self.ends)[places])
        return Known(self.keys.take(pa.array(places)), ids, np.append(0, np.cumsum(counts)))

    @staticmethod
    def joined(parts: list[Known]) -> Known:
        counts = np.concatenate([np.diff(p.ends) for p in parts])
        return Known(pa.concat_arrays([p.keys for p in parts]), np.concatenate([p.ids for p in parts]),
                     np.append(0, np.cumsum(counts)))


def spread(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``counts`` ids from each of ``starts``, one stretch after the other; and the counts."""
    stops = np.cumsum(counts)
    at = np.repeat(starts - (stops - counts), counts)
    at += np.arange(len(at))
    return ids[at], counts


class ChunkTokenizer:
    """Tokenises by chunks and remembers them: natural text repeats its words. All ids come
    from the tokenizer, which gets each new chunk as a text of its own."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.size = max(self.tokenizer.get_vocab().values()) + 1
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        config = json.loads(self.tokenizer.to_str())
        before = config["pre_tokenizer"] or {}
        #: Whether the tokenizer has the pattern that ``cut`` knows; texts of others stay whole.
        self.cuts = (config["normalizer"] is None and before.get("type") == "ByteLevel"
                     and before.get("use_regex", True) and not before.get("add_prefix_space"))
        self.alphabet = _byte_alphabet()
        self.known = self.older = self._none()

    def _none(self) -> Known:
        return Known(pa.array([], pa.binary()), np.zeros(0, self.dtype), np.zeros(1, np.int64))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of a few thousand chunks. Words go to the tokenizer's model as they are, in its byte alphabet: its
        pattern would leave them whole. All others go the whole way."""
        words = [bool(self.cuts and _WORD(t)) for t in texts]
        rest = self.tokenizer.encode_batch_fast(
            [t for t, word in zip(texts, words) if not word], add_special_tokens=False)
        out, rest = [], iter(rest)
        written = iter("\n".join(compress(texts, words)).encode().decode("latin-1").translate(self.alphabet).split("\n"))
        model = self.tokenizer.model.tokenize
        for word in words:
            out.append([t.id for t in model(next(written))] if word else next(rest).ids)
        return out

    def _learn(self, new: pa.Array) -> Known:
        ids, counts = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for at in range(0, len(new), 4096):
            own = self._ids([c.decode() for c in new.slice(at, 4096).to_pylist()])
            counts.append(np.fromiter(map(len, own), np.int64, len(own)))
            ids.append(np.fromiter(chain.from_iterable(own), self.dtype, int(counts[-1].sum())))
        return Known(new, np.concatenate(ids), np.append(0, np.cumsum(np.concatenate(counts))))

    def _look_up(self, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each wanted chunk start and how many they are."""
        if len(self.known) > KNOWN_CHUNKS:  # what is in use comes back from the older generation
            self.known, self.older = self._none(), self.known
        place = self.known.find(wanted)
        missing = np.flatnonzero(place < 0)
        older = self.older.find(wanted.take(pa.array(missing)))
        back, new = missing[older >= 0], missing[older < 0]
        parts = [self.known, self.older.pick(older[older >= 0]), self._learn(wanted.take(pa.array(new)))]
        place[back] = len(parts[0]) + np.arange(len(back))
        place[new] = len(parts[0]) + len(back) + np.arange(len(new))
        every = Known.joined(parts)
        long = pc.greater(pc.binary_length(every.keys), LONG_CHUNK).to_numpy(zero_copy_only=False)
        self.known = every.pick(np.flatnonzero(~long)) if long.any() else every
        return every.ids, every.ends[place], np.diff(every.ends)[place]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text, as little-endian bytes."""
        texts = pc.fill_null(texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        whole = np.full(len(texts), not self.cuts)
        for content in self.added:  # found before the pattern applies, and may cross its pieces
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        chunks, ends = cut(texts, whole)
        coded = chunks.dictionary_encode()
        of = coded.indices.to_numpy(zero_copy_only=False)
        ids, starts, counts = self._look_up(coded.dictionary)
        ends, lo, out = np.append(0, ends), 0, []
        while lo < len(texts):  # bounds what is spread at once
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + SPREAD_CHUNKS, side="right")) - 1)
            some = of[ends[lo]:ends[hi]]
            flat, each = spread(ids, starts[some], counts[some])
            raw = memoryview(flat.view(np.uint8))
            bounds = (np.append(0, np.cumsum(each))[ends[lo:hi + 1] - ends[lo]] * flat.itemsize).tolist()
            out += [bytes(raw[s:e]) for s, e in zip(bounds, bounds[1:])]
            lo = hi
        return out


def _tokenizer(path: str) -> ChunkTokenizer:
    """One per worker process, for all tasks that run in it."""
    held = sys.modules.setdefault("_worker_tokenizers", types.ModuleType("_worker_tokenizers"))
    if path not in held.__dict__:
        held.__dict__[path] = ChunkTokenizer(path)
    return held.__dict__[path]


#: A part's last row has block -1 and, in ``counts``, its ids and how often each occurs.
_BLOCKS = "part int, block int, doc_ids array<long>, lengths array<long>, ids binary, counts binary"


def token_blocks(
    docs: DataFrame, path: str, end_id: int, block_tokens: int = BLOCK_TOKENS, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Blocks of whole documents in ascending doc_id order; ids as little-endian integers.

    A part has about ``part_bytes`` of text. The ranges go by doc_id and the beginning of the text, which keeps
    the order and splits an id (or the null id) that many rows share."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = parts_for(text_bytes(docs), part_bytes)
    dealt = docs.repartitionByRange(parts, "doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    target = arrow_schema(_BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        end = np.array([end_id], tokenizer.dtype).tobytes()
        width = len(end)
        part, block = TaskContext.get().partitionId(), 0
        ids, lengths, held, size = [], [], [], 0
        counts = np.zeros(tokenizer.size, np.int64)

        def row() -> pa.RecordBatch:
            nonlocal counts
            joined = b"".join(held)
            own = np.bincount(np.frombuffer(joined, tokenizer.dtype), minlength=len(counts))
            counts = own + np.pad(counts, (0, len(own) - len(counts)))
            return to_batch({"part": [part], "block": [block], "doc_ids": [ids], "lengths": [lengths],
                             "ids": [joined], "counts": [None]}, target)

        for some in gathered(batches, "text", ENCODE_BYTES):
            docs = pa.Table.from_batches(some)
            coded = tokenizer.encode(pa.concat_arrays(docs.column("text").chunks))
            for doc, own in zip(docs.column("doc_id").to_pylist(), coded):
                n = len(own) // width + 1
                if size and size + n > block_tokens:
                    yield row()
                    ids, lengths, held, size, block = [], [], [], 0, block + 1
                ids.append(doc)
                lengths.append(n)
                held += [own, end]
                size += n
        if ids:
            yield row()
            used = np.flatnonzero(counts)
            packed = np.concatenate([used, counts[used]]).astype("<i8").tobytes()
            yield to_batch({"part": [part], "block": [-1], "doc_ids": [[]], "lengths": [[]], "ids": [b""],
                            "counts": [packed]}, target)
        give_back()

    small_batches(docs.sparkSession)
    return dealt.mapInArrow(run, _BLOCKS)


# -- rANS ------------------------------------------------------------------------------------


class Frequencies:
    """Slots per id out of 2^20, shared by all blocks."""

    def __init__(self, ids: list[int], slots: list[int]) -> None:
        size = max(ids, default=0) + 1
        self.slots = np.zeros(size, np.uint64)
        self.slots[ids] = slots
        self.first = np.concatenate(([0], np.cumsum(self.slots)[:-1])).astype(np.uint64)
        self.id_of = np.repeat(np.arange(size, dtype=np.uint32), self.slots.astype(np.int64))

    @staticmethod
    def share(ids: list[int], counts: list[int]) -> list[int]:
        """Slots in proportion to the counts, one at least, 2^20 in all."""
        if not ids:
            return []
        total, room = sum(counts), 1 << int(SCALE)
        if len(ids) > room:
            raise ValueError("more distinct ids than slots")
        slots = [max(1, n * room // total) for n in counts]
        over = sum(slots) - room
        order = sorted(range(len(slots)), key=lambda k: (-slots[k], ids[k]))
        if over < 0:
            slots[order[0]] -= over
        while over > 0:
            for k in order:
                take = min(over, slots[k] - 1, max(1, slots[k] // 8))
                slots[k] -= take
                over -= take
                if not over:
                    break
        return slots


_HEAD = "<4sIIIII"  # magic, lanes, checkpoints, ids, words, CRC of the ids


def encode_block(ids: np.ndarray, table: Frequencies) -> bytes:
    """Payload: header; per checkpoint its word position (u64) and ``lanes`` states (u64); the
    words (u32, read forwards); CRC of all that (u32). Id i is coded by lane i mod lanes in step
    i // lanes; checkpoint k holds the reader's state before step k * STEP."""
    n = len(ids)
    lanes = int(max(1, min(MAX_LANES, n // 64)))
    steps = -(-n // lanes)
    slots = np.ones(steps * lanes, np.uint64)
    first = np.zeros(steps * lanes, np.uint64)
    slots[:n], first[:n] = table.slots[ids], table.first[ids]
    slots, first = slots.reshape(steps, lanes), first.reshape(steps, lanes)
    limit = slots << np.uint64(63 - int(SCALE))
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    for t in range(steps - 1, -1, -1):
        live = n - t * lanes if t == steps - 1 else lanes
        x, f = state[:live], slots[t, :live]
        full = x >= limit[t, :live]
        if full.any():
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> WORD, x)
        q = x // f
        state[:live] = (q << SCALE) + (x - q * f) + first[t, :live]
        if t % STEP == 0:
            marks.append((len(words), state.copy()))
    sizes = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    total = int(sizes[-1])
    body = [struct.pack(_HEAD, b"rANS", lanes, len(marks), n, total, zlib.crc32(np.ascontiguousarray(ids, "<u4")))]
    for given, own in reversed(marks):
        body += [struct.pack("<Q", total - int(sizes[given])), own.astype("<u8").tobytes()]
    body += [w.tobytes() for w in reversed(words)]
    out = b"".join(body)
    return out + struct.pack("<I", zlib.crc32(out))


def decode_block(payload: bytes, table: Frequencies) -> np.ndarray:
    """Ids of a block; all stretches between checkpoints are decoded side by side."""
    if zlib.crc32(payload[:-4]) != struct.unpack("<I", payload[-4:])[0]:
        raise ValueError("a block of the token store is damaged")
    magic, lanes, marks, n, n_words, crc = struct.unpack_from(_HEAD, payload)
    if magic != b"rANS":
        raise ValueError("not a block of the token store")
    if not n:
        return np.empty(0, np.uint32)
    each = np.frombuffer(payload, "<u8", marks * (lanes + 1), struct.calcsize(_HEAD)).reshape(marks, lanes + 1)
    at, state = each[:, 0].astype(np.int64), each[:, 1:].astype(np.uint64)
    words = np.frombuffer(payload, "<u4", n_words, struct.calcsize(_HEAD) + each.nbytes).astype(np.uint64)
    words = np.append(words, np.zeros(lanes + 1, np.uint64))
    steps = -(-n // lanes)
    out = np.empty((marks * STEP, lanes), np.uint32)
    mask = np.uint64((1 << int(SCALE)) - 1)
    for t in range(min(STEP, steps)):
        live = int(np.searchsorted(np.arange(marks) * STEP + t, steps))  # stretches that have this step
        x = state[:live]
        slot = x & mask
        ids = table.id_of[slot]
        out[np.arange(live) * STEP + t] = ids
        x = table.slots[ids] * (x >> SCALE) + slot - table.first[ids]
        low = x < LOW
        if (live - 1) * STEP + t == steps - 1:  # the last step may not fill all lanes
            low[live - 1, n - (steps - 1) * lanes:] = False
        place = at[:live, None] + np.cumsum(low, axis=1) - 1
        state[:live] = np.where(low, (x << WORD) | words[np.maximum(place, 0)], x)
        at[:live] += low.sum(axis=1)
    ids = out.reshape(-1)[:n]
    if zlib.crc32(np.ascontiguousarray(ids, "<u4")) != crc:
        raise ValueError("a block of the token store decodes to other ids")
    return ids


# -- the store -----------------------------------------------------------------------------------


def _counts(blocks: DataFrame) -> DataFrame:
    """(id, n) over all parts; reads nothing but their rows of counts, and a task gives each id once."""
    target = arrow_schema("id int, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for packed in batch.column("counts").to_pylist():
                used, n = np.frombuffer(packed, "<i8").reshape(2, -1)
                if used[-1] >= len(total):
                    total = np.pad(total, (0, int(used[-1]) + 1 - len(total)))
                total[used] += n
        used = np.flatnonzero(total)
        yield to_batch({"id": used.astype(np.int32), "n": total[used]}, target)

    return blocks.filter("block = -1").select("counts").mapInArrow(run, "id int, n long").groupBy("id").agg(
        F.sum("n").alias("n"))


_STORED = "part int, block int, n_tokens long, doc_ids array<long>, lengths array<long>, payload binary"


def write_tokens(
    docs: DataFrame, path: str, scratch: str, tokenizer: str, end_id: int, block_tokens: int = BLOCK_TOKENS,
    part_bytes: int = PART_BYTES,
) -> None:
    """Tokenise ``docs`` and write the store at ``path``; ``scratch`` holds the plain ids meanwhile."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    token_blocks(docs, tokenizer, end_id, block_tokens, part_bytes).write.option("compression", "zstd").parquet(scratch)
    blocks = spark.read.schema(_BLOCKS).parquet(scratch)
    dtype = "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    counted = _counts(blocks).orderBy("id").collect()  # the vocabulary at most
    ids = [r["id"] for r in counted]
    slots = Frequencies.share(ids, [r["n"] for r in counted])
    spark.createDataFrame(list(zip(ids, slots)), "id int, slots int").coalesce(1).write.parquet(f"{path}/frequencies")
    shared = Shared(spark, Frequencies(ids, slots))
    target = arrow_schema(_STORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.get()
        for batch in batches:
            for k in range(batch.num_rows):
                own = np.frombuffer(batch.column("ids")[k].as_buffer(), dtype)
                row = batch.slice(k, 1)
                yield to_batch({
                    "part": row.column("part"), "block": row.column("block"), "n_tokens": [len(own)],
                    "doc_ids": row.column("doc_ids"), "lengths": row.column("lengths"),
                    "payload": [encode_block(own, table)]}, target)
        give_back()

    blocks.filter("block >= 0").drop("counts").mapInArrow(run, _STORED).write.parquet(f"{path}/blocks")


def _starts(blocks: DataFrame) -> DataFrame:
    """(part, block, start): ids before each block. Sums run within a part, then over groups of
    1,000 parts, then over the groups, so no window holds more than the parts of a group."""
    def before(value: str, *by: str, order: str) -> F.Column:
        window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        return F.coalesce(F.sum(value).over(window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    sizes = blocks.select("part", "block", "n_tokens", F.expr("part div 1000").alias("g"))
    parts = sizes.groupBy("g", "part").agg(F.sum("n_tokens").alias("n"))
    groups = parts.groupBy("g").agg(F.sum("n").alias("n")).select("g", before("n", order="g").alias("s"))
    of_part = parts.withColumn("p", before("n", "g", order="part")).join(groups, "g").select(
        "part", (F.col("p") + F.col("s")).alias("p"))
    return sizes.withColumn("b", before("n_tokens", "part", order="block")).join(of_part, "part").select(
        "part", "block", (F.col("p") + F.col("b")).alias("start"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document of a store."""
    rows = spark.read.parquet(f"{path}/frequencies").collect()  # the vocabulary at most
    shared = Shared(spark, Frequencies([r["id"] for r in rows], [r["slots"] for r in rows]))
    blocks = spark.read.schema(_STORED).parquet(f"{path}/blocks")
    schema = "part int, block int, doc_id long, offset long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.get()
        for batch in batches:
            for r in range(batch.num_rows):
                ids = decode_block(batch.column("payload")[r].as_py(), table).astype("<u4")
                lengths = np.array(batch.column("lengths")[r].as_py(), np.int64)
                ends = np.cumsum(lengths)
                if len(ids) != (ends[-1] if len(ends) else 0):
                    raise ValueError("a block of the token store has other lengths")
                spans = list(zip((ends - lengths).tolist(), ends.tolist()))
                out = {"part": [batch.column("part")[r].as_py()] * len(spans),
                       "block": [batch.column("block")[r].as_py()] * len(spans),
                       "doc_id": batch.column("doc_ids")[r].as_py(), "offset": ends - lengths,
                       "n_tokens": lengths, "ids_crc32": [zlib.crc32(ids[s:e]) for s, e in spans]}
                if with_ids:
                    out["ids"] = [ids[s:e].astype(np.int32) for s, e in spans]
                yield to_batch(out, target)
        give_back()

    docs = blocks.select("part", "block", "doc_ids", "lengths", "payload").mapInArrow(run, schema)
    more = ["ids"] if with_ids else []
    return docs.join(_starts(blocks), ["part", "block"]).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *more)
