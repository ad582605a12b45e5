"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item becomes windows of ``size`` consecutive words (a shorter item is one
window). A window is contained in a document only if all its words are there, so the prefix
that must match (length minus overlap plus one) is one word: its rarest, by the document
frequency of the window's words over all documents. Documents are probed with these prefix
words only; the word's place in the window bounds where the window may lie (positional
filter) and its length must fit in the document (length filter). Survivors are compared by a
hash of the item-sized window of the document and then word by word.

Benchmark windows are handled in blocks of at most ``block_windows``, which bounds what is
sent to the executors; any number of blocks gives the same rows.

Defined cases: null and empty texts have no words (n_words 0, not contaminated); items without
words never occur; items with equal text all count; repeated document rows come back once
each; words of items without an id are hit, the id is not counted; null doc ids keep their rows; an empty benchmark marks
nothing; an empty document table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    Shared, Vocabulary, alnum_words, map_rows, mix64, parts_for, stage,
)

#: Windows sent to the executors at a time (about 100 bytes each).
BLOCK_WINDOWS = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """(window, item_ids): each distinct window with the sorted ids of its items; an item without an id
    gives windows, but no id."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        ids, windows = [], []
        for item, text in zip(rows["item_id"], rows["text"]):
            words = alnum_words(text)
            own = {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else ()
            windows += own
            ids += [item] * len(own)
        return {"item_id": ids, "window": windows}

    plain = items.select(F.col("item_id").cast("string").alias("item_id"),
                         F.col("text").cast("string").alias("text"))
    pairs = map_rows(plain, run, "item_id string, window binary")
    return pairs.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


class Block:
    """A block of windows, made ready for probing; travels as one broadcast."""

    def __init__(self, windows: list[bytes], ids: list[list[str]], frequency: dict[bytes, int]) -> None:
        import xxhash

        self.windows, self.ids = windows, ids
        split = [w.split(b" ") for w in windows]
        self.length = np.array([len(s) for s in split], np.int64)
        #: Place of the rarest word; ties go to the smaller word, then the first place.
        self.place = np.array(
            [min(range(len(s)), key=lambda k: (frequency.get(s[k], 0), s[k], k)) for s in split], np.int64)
        prefix: dict[bytes, list[int]] = {}
        for i, s in enumerate(split):
            prefix.setdefault(s[self.place[i]], []).append(i)
        self.prefix = {w: n for n, w in enumerate(prefix)}
        counts = [len(v) for v in prefix.values()]
        self.first = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        self.members = np.array([i for v in prefix.values() for i in v], np.int64)
        word_hash = {w: xxhash.xxh3_64_intdigest(w) for s in split for w in s}
        self.hash = np.array([self._of(np.array([word_hash[w] for w in s], np.uint64)) for s in split], np.uint64)

    @staticmethod
    def _of(word_hash: np.ndarray) -> np.uint64:
        acc = np.uint64(0)
        with np.errstate(over="ignore"):
            for h in word_hash:
                acc = acc * _STEP + h
        return mix64(np.array([acc]))[0]

    def find(self, words: list[bytes], codes: np.ndarray, hashes: np.ndarray, prefix_of: np.ndarray,
             ) -> tuple[np.ndarray, np.ndarray]:
        """(start, window) of every occurrence in one document."""
        at = np.flatnonzero(prefix_of[codes] >= 0)
        if not len(at):
            return at, at
        token = prefix_of[codes[at]]
        count = self.first[token + 1] - self.first[token]
        where = np.repeat(at, count)
        offset = np.arange(len(where)) - np.repeat(np.cumsum(count) - count, count)
        window = self.members[np.repeat(self.first[token], count) + offset]
        start = where - self.place[window]
        fits = (start >= 0) & (start + self.length[window] <= len(words))
        start, window = start[fits], window[fits]
        keep = np.zeros(len(start), bool)
        for size in np.unique(self.length[window]):
            of = np.flatnonzero(self.length[window] == size)
            acc = np.zeros(len(of), np.uint64)
            for k in range(size):
                acc = acc * _STEP + hashes[codes[start[of] + k]]
            keep[of] = mix64(acc) == self.hash[window[of]]
        for i in np.flatnonzero(keep):  # word by word
            s, w = start[i], window[i]
            keep[i] = b" ".join(words[s:s + self.length[w]]) == self.windows[w]
        return start[keep], window[keep]


def _document_frequency(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of the block's windows occurs; at most one row per word
    and task is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def run(rows: dict[str, list]) -> dict[str, list]:
        seen: dict[bytes, int] = {}
        for text in rows["text"]:
            for w in shared.value.intersection(alnum_words(text)):
                seen[w] = seen.get(w, 0) + 1
        return {"word": list(seen), "n": list(seen.values())}

    counted = map_rows(docs.select("text"), run, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


_HITS = "doc_id long, text_key binary, n_words long, hit array<long>, items array<string>, copy long"


def _probe(docs: DataFrame, block: Block, all_rows: bool, keyed: bool) -> DataFrame:
    """Hit word positions (as [start, end) pairs, flattened) and item ids of each document."""
    shared = Shared(docs.sparkSession, block)

    def run(rows: dict[str, list]) -> dict[str, list]:
        own: Block = shared.get()
        vocabulary = Vocabulary()
        split = [alnum_words(t) for t in rows["text"]]
        probe = own.prefix.keys()
        coded = [vocabulary.encode(w) if not probe.isdisjoint(w) else None for w in split]
        hashes = vocabulary.hashes()
        prefix_of = np.fromiter((own.prefix.get(w, -1) for w in vocabulary.codes), np.int64, len(vocabulary.codes))
        out: dict[str, list] = {k: [] for k in ("doc_id", "text_key", "n_words", "hit", "items", "copy")}
        for doc, text, words, codes in zip(rows["doc_id"], rows["text"], split, coded):
            start, window = own.find(words, codes, hashes, prefix_of) if codes is not None else ((), ())
            if not (all_rows or len(start)):
                continue
            spans: list[int] = []
            for s, e in sorted(zip(start, start + own.length[window])) if len(start) else ():
                if spans and s <= spans[-1]:
                    spans[-1] = max(spans[-1], int(e))
                else:
                    spans += [int(s), int(e)]
            out["doc_id"].append(doc)
            out["text_key"].append(hashlib.md5(b" ".join(words)).digest() if keyed else None)
            out["n_words"].append(len(words))
            out["hit"].append(spans)
            out["copy"].append(int(all_rows))
            out["items"].append(sorted({i for w in np.unique(window) for i in own.ids[w]}) if len(start) else [])
        return out

    return map_rows(docs, run, _HITS)


def _finish(hits: DataFrame) -> DataFrame:
    def run(rows: dict[str, list]) -> dict[str, list]:
        n_hit, n_items, digest = [], [], []
        for spans, items in zip(rows["hit"], rows["items"]):
            total, end = 0, 0
            for s, e in sorted(zip(spans[::2], spans[1::2])):
                total += max(0, e - max(s, end))
                end = max(end, e)
            own = sorted(set(items))
            n_hit.append(total)
            n_items.append(len(own))
            digest.append(hashlib.sha256(",".join(own).encode()).hexdigest())
        return {"doc_id": rows["doc_id"], "n_words": rows["n_words"], "n_hit": n_hit,
                "n_items": n_items, "items_sha256": digest}

    out = map_rows(hits.withColumn("size", F.lit("")), run,
                   "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string", text="size")
    return out.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def decontaminate(
    docs: DataFrame, items: DataFrame, size: int = 13, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    windows = stage(item_windows(items, size), "windows")
    n_blocks = parts_for(windows.count(), block_windows)
    blocks = windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(n_blocks)))
    hits = None
    for n in range(n_blocks):
        rows = blocks.filter(F.col("block") == n).collect()  # about block_windows rows
        texts = [bytes(r["window"]) for r in rows]
        frequency = _document_frequency(docs, {w for t in texts for w in t.split(b" ")}) if texts else {}
        # Written before the next Python step: a task never holds two workers, whose memory adds up.
        found = stage(_probe(docs, Block(texts, [r["item_ids"] for r in rows], frequency),
                             all_rows=n == 0, keyed=n_blocks > 1), "hits")
        if n_blocks == 1:
            return _finish(found)
        hits = found if hits is None else hits.unionByName(found)
    return _merge(hits)


def _merge(hits: DataFrame) -> DataFrame:
    """Union of the blocks' hits. Rows of the first block stand for the documents, rows of later
    blocks only add hits; equal rows (same id, same words) are merged and counted, then repeated."""
    merged = hits.groupBy("doc_id", "text_key", "n_words").agg(
        F.flatten(F.collect_set("hit")).alias("hit"), F.flatten(F.collect_set("items")).alias("items"),
        F.sum("copy").alias("copies"))
    return _finish(merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
