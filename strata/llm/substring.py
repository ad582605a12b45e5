"""Repeated passages across documents: fingerprint, confirm, compile automata, stream.

1. Every window of ``size`` words of every document is hashed. Each task sends, per hash and
   block of documents, the smallest document only, packed by hash range (shard).
2. A shard sorts its hashes. A window that starts in two different documents is confirmed; the
   smallest document owns it. Every block that holds a later copy gets (hash, owner).
3. Documents meet their block's confirmed windows. Runs of windows with one owner form the
   passages; their texts are compiled into Aho-Corasick automata (pyahocorasick, sharded so
   that each stays small), the block's documents are streamed through them, and every
   occurrence is found and removed word by word where its owner is a smaller document.

The automaton holds anchors: grams of 7 words (for windows of 13) at every seventh place of a
passage, so that each window contains exactly one whole; a hit is extended to both sides by
comparing words. So an automaton has about as many nodes as its passages have words.

Only hashes travel between blocks; two different windows with equal 64-bit hashes are taken for
one (chance about n^2 / 2^65 for n windows). Inside a block words are compared.

Defined cases: null and empty texts have no words (n_words 0, hash of the empty string);
documents shorter than a window keep all words; repeated rows with one doc_id do not remove each
other (no id is smaller) but are judged against smaller ids each; rows with a null doc_id own
nothing and keep all words; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    Vocabulary, arrow_schema, blank_words, give_back, map_rows, parts_for, text_bytes, window_hashes,
)

#: Text bytes per shard of hashes and per block of documents.
SHARD_BYTES, BLOCK_BYTES = 8 << 20, 8 << 20
#: Text bytes whose hashes are sorted and packed together; larger packs better.
SLICE_BYTES = 12 << 20
#: Anchors of one automaton.
AUTOMATON_ANCHORS = 100_000


def _prime_from(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def pack(columns: list[np.ndarray]) -> bytes:
    """Sorted integers as compressed byte planes; equal high bytes cost next to nothing."""
    planes = b"".join(c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(blob: bytes, n: int, n_columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(n_columns, 8, n)
    return [np.ascontiguousarray(p.T).view("<u8").reshape(n) for p in planes]


def _coded(words: list[list[bytes]]) -> tuple[list[np.ndarray], Vocabulary]:
    vocabulary = Vocabulary()
    return [vocabulary.encode(w) for w in words], vocabulary


def _spread(coded: list[np.ndarray], vocabulary: Vocabulary, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document index and start (in the joined words) of every window of the documents."""
    lengths = np.array([len(c) for c in coded], np.int64)
    joined = np.concatenate(coded) if coded else np.empty(0, np.int64)
    hashes = window_hashes(vocabulary.hashes()[joined] if len(joined) else np.empty(0, np.uint64), size)
    of = np.repeat(np.arange(len(coded)), lengths)[: len(hashes)]
    ends = np.cumsum(lengths)
    start = np.arange(len(hashes))
    whole = start + size <= ends[of] if len(hashes) else np.empty(0, bool)
    return hashes[whole], of[whole], start[whole]


def _hash_rows(size: int, n_shards: int, n_blocks: int):
    def run(rows: dict[str, list]) -> dict[str, list]:
        keyed = sorted((i % n_blocks, i, k) for k, i in enumerate(rows["doc_id"]) if i is not None)
        ids = np.array([i for _, i, _ in keyed], np.int64)
        hashes, of, _ = _spread(*_coded([blank_words(rows["text"][k]) for _, _, k in keyed]), size)
        order = np.argsort(hashes, kind="stable")  # within a hash: by block, then by document
        hashes, docs = hashes[order], ids[of[order]]
        block = docs % n_blocks
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hashes)) - 1
        several = docs[last] != docs[first]  # sorted by document within the group
        hashes, docs = hashes[first], docs[first]
        shard = _shard_of(hashes, n_shards)
        cuts = np.flatnonzero(np.diff(shard)) + 1
        out: dict[str, list] = {k: [] for k in ("shard", "n", "blob")}
        for part in np.split(np.arange(len(hashes)), cuts) if len(hashes) else ():
            out["shard"].append(int(shard[part[0]]))
            out["n"].append(len(part))
            out["blob"].append(pack([hashes[part], docs[part].view(np.uint64), several[part]]))
        return out

    return run


def _shard_of(hashes: np.ndarray, n_shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n_shards)) >> np.uint64(32)


def _confirm(n_blocks: int):
    """A shard's confirmed windows: (hash, owner) for each block with a copy behind the owner's."""
    target = arrow_schema("block long, n long, blob binary")

    def run(group: pa.Table) -> pa.Table:
        parts = [unpack(b, n, 3) for n, b in zip(group["n"].to_pylist(), group["blob"].to_pylist())]
        hashes, docs, several = (np.concatenate([p[k] for p in parts]) for k in range(3))
        docs = docs.view(np.int64)
        order = np.lexsort((docs, hashes))
        hashes, docs, several = hashes[order], docs[order], several[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        owner = np.repeat(docs[first], np.diff(np.append(first, len(hashes))))
        later = (docs != owner) | (several > 0)
        hashes, owner, block = hashes[later], owner[later], (docs % n_blocks)[later]
        order = np.lexsort((hashes, block))
        hashes, owner, block = hashes[order], owner[order], block[order]
        keep = np.append(True, (hashes[1:] != hashes[:-1]) | (block[1:] != block[:-1]))[: len(hashes)]
        hashes, owner, block = hashes[keep], owner[keep], block[keep]
        out: dict[str, list] = {"block": [], "n": [], "blob": []}
        for part in np.split(np.arange(len(hashes)), np.flatnonzero(np.diff(block)) + 1) if len(hashes) else ():
            out["block"].append(int(block[part[0]]))
            out["n"].append(len(part))
            out["blob"].append(pack([hashes[part], owner[part].view(np.uint64)]))
        give_back()
        return pa.table([pa.array(out[f.name], f.type) for f in target], schema=target)

    return run


class Passages:
    """Joined words of a block's documents with the confirmed passages found in them."""

    def __init__(self, ids: np.ndarray, coded: list[np.ndarray], size: int) -> None:
        self.size, self.gram = size, (size + 1) // 2
        self.reach = size - self.gram  # words on either side that a hit is extended by
        pad = [-1] * self.reach
        pieces, self.start, at = [np.array(pad, np.int64)], [], len(pad)
        for k, w in enumerate(coded):
            self.start.append(at)
            pieces += [w, np.array([-2 - k], np.int64)]
            at += len(w) + 1
        pieces.append(np.array(pad, np.int64))
        self.codes = np.concatenate(pieces)
        self.start = np.array(self.start, np.int64)
        self.length = np.array([len(w) for w in coded], np.int64)
        self.doc = np.repeat(ids, self.length + 1)
        self.doc = np.concatenate([np.full(len(pad), -1), self.doc, np.full(len(pad), -1)])

    def passages(self, starts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, end, owner) of runs of neighbouring windows with one owner."""
        if not len(starts):
            return starts, starts, owners
        cut = np.append(True, (np.diff(starts) != 1) | (owners[1:] != owners[:-1]))
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(starts)) - 1
        return starts[first], starts[last] + self.size, owners[first]

    def anchors(self, first: np.ndarray, end: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Rows (place, left bound, right bound, owner): every window of a passage contains
        exactly one anchor whole."""
        stride = self.size - self.gram + 1
        count = (end - first - self.gram) // stride + 1
        passage = np.repeat(np.arange(len(first)), count)
        nth = np.arange(len(passage)) - np.repeat(np.cumsum(count) - count, count)
        place = first[passage] + nth * stride
        return np.stack([place, first[passage], end[passage], owner[passage]], axis=1)

    def _letters(self, used: np.ndarray) -> tuple[str, np.ndarray]:
        """The words as text, and where each word's letters start. A used word is three letters of
        three small alphabets (so no match can start inside a word, and no node of the automaton
        has many children), any other word is one letter that no gram has."""
        base = max(2, round(len(used) ** (1 / 3)) + 1)
        rank = np.searchsorted(used, self.codes)
        known = used[np.minimum(rank, len(used) - 1)] == self.codes
        first = np.concatenate(([0], np.cumsum(np.where(known, 3, 1))))
        line = np.zeros(first[-1], "<u4")
        at, rank = first[:-1][known], rank[known]
        line[at] = 1 + rank // (base * base)
        line[at + 1] = 1 + 2 * base + rank // base % base
        line[at + 2] = 1 + 4 * base + rank % base
        return line.tobytes().decode("utf-32-le"), first

    def occurrences(self, anchors: np.ndarray) -> np.ndarray:
        """Which words are covered by an occurrence behind its owner, by one automaton."""
        text, first_letter = self._letters(np.unique(self.codes[(anchors[:, :1] + np.arange(self.gram)).ravel()]))
        word_of = np.repeat(np.arange(len(self.codes)), np.diff(first_letter))
        groups: dict[str, dict] = {}
        for row, (place, low, high, owner) in enumerate(anchors.tolist()):
            around = self.codes[max(low, place - self.reach):min(high, place + self.gram + self.reach)]
            key = (around.tobytes(), place - low if place - low < self.reach else self.reach, owner)
            groups.setdefault(text[first_letter[place]:first_letter[place + self.gram]], {}).setdefault(key, row)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        members: list[int] = []
        first = [0]
        for n, (gram, rows) in enumerate(groups.items()):
            automaton.add_word(gram, n)
            members += rows.values()
            first.append(len(members))
        automaton.make_automaton()
        found = np.array([x for hit in automaton.iter(text) for x in hit], np.int64).reshape(-1, 2)
        change = np.zeros(len(self.codes) + 1, np.int32)
        first_of, member = np.array(first), np.array(members)
        count = first_of[found[:, 1] + 1] - first_of[found[:, 1]]
        for part in np.array_split(np.arange(len(found)), max(1, int(count.sum()) >> 20)):
            own = np.repeat(part, count[part])
            nth = np.arange(len(own)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
            row = anchors[member[first_of[found[own, 1]] + nth]]
            self._extend(word_of[found[own, 0]] - self.gram + 1, row, change)
        return np.cumsum(change[:-1]) > 0

    def _extend(self, at: np.ndarray, row: np.ndarray, change: np.ndarray) -> None:
        place, low, high, owner = row.T
        left, go = np.zeros(len(at), np.int64), np.ones(len(at), bool)
        for k in range(1, self.reach + 1):
            go = go & (place - k >= low)
            go = go & (self.codes[at - k] == self.codes[np.maximum(place - k, 0)])
            left += go
        right, go = np.zeros(len(at), np.int64), np.ones(len(at), bool)
        for k in range(self.reach):
            go = go & (place + self.gram + k < high)
            there = np.minimum(place + self.gram + k, len(self.codes) - 1)
            go = go & (self.codes[np.minimum(at + self.gram + k, len(self.codes) - 1)] == self.codes[there])
            right += go
        hit = (left + right + self.gram >= self.size) & (owner < self.doc[at])
        np.add.at(change, (at - left)[hit], 1)
        np.add.at(change, (at + self.gram + right)[hit], -1)


_OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _remove(size: int):
    target = arrow_schema(_OUT)

    def run(docs: pa.Table, confirmed: pa.Table) -> pa.Table:
        rows = docs.select(["doc_id", "text"]).to_pylist()
        words = [blank_words(r["text"]) for r in rows]
        gone: list[np.ndarray | None] = [None] * len(rows)
        known = [k for k, r in enumerate(rows) if r["doc_id"] is not None]
        if confirmed.num_rows and known:
            known.sort(key=lambda k: rows[k]["doc_id"])
            parts = [unpack(b, n, 2) for n, b in zip(confirmed["n"].to_pylist(), confirmed["blob"].to_pylist())]
            hashes, owner = (np.concatenate([p[k] for p in parts]) for k in range(2))
            order = np.argsort(hashes)
            hashes, owner = hashes[order], owner[order].view(np.int64)
            ids = np.array([rows[k]["doc_id"] for k in known], np.int64)
            coded, vocabulary = _coded([words[k] for k in known])
            block = Passages(ids, coded, size)
            found, of, start = _spread(coded, vocabulary, size)
            slot = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            at = np.flatnonzero(hashes[slot] == found)
            _, once = np.unique(slot[at], return_index=True)  # one text of each confirmed window
            at = np.sort(at[once])
            starts = start[at] + of[at] + block.reach  # a separator stands after each document
            anchors = block.anchors(*block.passages(starts, owner[slot[at]]))
            covered = np.zeros(len(block.codes), bool)
            for k in range(0, len(anchors), AUTOMATON_ANCHORS):
                covered |= block.occurrences(anchors[k:k + AUTOMATON_ANCHORS])
            for k, s, n in zip(known, block.start, block.length):
                gone[k] = covered[s:s + n]
        out: dict[str, list] = {f.name: [] for f in target}
        for r, own, mask in zip(rows, words, gone):
            kept = own if mask is None or not mask.any() else [w for w, g in zip(own, mask.tolist()) if not g]
            out["doc_id"].append(r["doc_id"])
            out["n_words"].append(len(own))
            out["n_removed"].append(len(own) - len(kept))
            out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        give_back()
        return pa.table([pa.array(out[f.name], f.type) for f in target], schema=target)

    return run


def remove_repeats(docs: DataFrame, size: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_bytes = text_bytes(docs)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_shards = parts_for(n_bytes, SHARD_BYTES, least)
    n_blocks = _prime_from(parts_for(n_bytes, BLOCK_BYTES, 2))
    packed = map_rows(docs, _hash_rows(size, n_shards, n_blocks), "shard long, n long, blob binary",
                      slice_bytes=SLICE_BYTES)
    # Dealt out over as many partitions as there are shards and blocks, however many the session's default is.
    confirmed = packed.repartition(n_shards, "shard").groupBy("shard").applyInArrow(
        _confirm(n_blocks), "block long, n long, blob binary").repartition(n_blocks, "block")
    known = docs.filter("doc_id IS NOT NULL").withColumn("block", F.expr(f"pmod(doc_id, {n_blocks})"))
    kept = known.repartition(n_blocks, "block").groupBy("block").cogroup(confirmed.groupBy("block")).applyInArrow(
        _remove(size), _OUT)
    # Rows without an id are not later than any document: nothing is removed, nobody waits for them.
    return kept.unionByName(map_rows(docs.filter("doc_id IS NULL"), _untouched, _OUT))


def _untouched(rows: dict[str, list]) -> dict[str, list]:
    words = [blank_words(t) for t in rows["text"]]
    return {"doc_id": rows["doc_id"], "n_words": [len(w) for w in words], "n_removed": [0] * len(words),
            "kept_sha256": [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]}
