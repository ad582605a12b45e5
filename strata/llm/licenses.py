"""License scans: MinHash bands over overlapping text windows, verified by shingle containment.

Templates and documents become shingles of five words (letters and digits, A-Z lower-cased). A
template of m shingles is looked for in windows of w shingles, the smallest power of two with
m <= w / 2 + 1, that start every w / 2 shingles (every shingle for w = 1), so some window holds any
copy whole. Windows get ``HASHES`` MinHash values; each is a band of one row. If a window holds a
copy with the required containment c, its Jaccard similarity is at least c * m / (w + m - c * m) >= 0.14
and a window is retrieved with probability 1 - (1 - J)^HASHES > 0.999; for w = 1 and for exact copies
the figures are higher. Retrieved pairs are verified exactly: the share of the template's distinct
shingles found in the document's words around the window must reach ``containment``.

Window minima are built from halves (the minima of w from those of w / 2), so all sizes together
cost about two values per shingle and hash.

A template of fewer than five words is one shingle of all its words, found by the hash of every run
of so many words and compared word by word.

Defined cases: null and empty texts match nothing (nor do templates without words, which are left
out); a text of fewer than five words can only hold such short templates; a template found in several places of a
document gives one row with the best place; repeated document rows give their rows once each; null
doc_ids keep their rows; templates with one id are alternatives, the best counts; empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, Vocabulary, alnum_words, map_rows, mix64, parts_for, window_hashes
from .license_templates import TEMPLATES, registered

SHINGLE, HASHES, CONTAINMENT = 5, 48, 0.8
#: Templates sent to the executors at a time, by their words.
BLOCK_WORDS = 500_000

_SEEDS = mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def window_size(m: int) -> int:
    """Shingles of the windows in which a template of m shingles is looked for."""
    w = 1
    while m > w / 2 + 1 and not (w == 1 and m == 1):
        w *= 2
    return w


def minhashes(hashes: np.ndarray, k: int) -> np.ndarray:
    return mix64(hashes * _SEEDS[k])


class Lookup:
    """Sorted 64-bit values with the templates of each. A bit table of their low bits sorts out
    nearly all other values before the binary search."""

    def __init__(self, of: dict[int, list[int]]) -> None:
        self.known = np.array(sorted(of), np.uint64)
        self.templates = [of[v] for v in sorted(of)]
        self.low = np.zeros(1 << 16, bool)
        self.low[self.known & np.uint64(0xFFFF)] = True

    def find(self, values: np.ndarray) -> list[tuple[int, int]]:
        """(place in ``values``, template) of every value that is known."""
        at = np.flatnonzero(self.low[values & np.uint64(0xFFFF)])
        slot = np.minimum(np.searchsorted(self.known, values[at]), len(self.known) - 1)
        same = self.known[slot] == values[at]
        return [(int(a), t) for a, s in zip(at[same], slot[same]) for t in self.templates[s]]


class Index:
    """Bands of a block of templates, by window size."""

    def __init__(self, templates: list[tuple[str, str]]) -> None:
        import xxhash

        self.names: list[str] = []
        self.shingles: list[frozenset[bytes]] = []
        self.size: list[int] = []  # words of a shingle
        short: dict[int, dict[int, list[int]]] = {}
        bands: dict[int, dict[int, dict[int, list[int]]]] = {}
        for name, text in templates:
            words = alnum_words(text)
            if not words:
                continue
            size = min(SHINGLE, len(words))
            own = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
            n = len(self.names)
            self.names.append(name)
            self.shingles.append(frozenset(own))
            self.size.append(size)
            word_hash = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
            hashes = window_hashes(word_hash, size)
            if size < SHINGLE:
                short.setdefault(size, defaultdict(list))[int(hashes[0])].append(n)
                continue
            w = window_size(len(own))
            for k in range(HASHES if w > 1 else 1):
                value = int(minhashes(hashes, k).min())
                bands.setdefault(w, {}).setdefault(k, defaultdict(list))[value].append(n)
        #: window size -> a lookup per hash
        self.bands = {w: [Lookup(of) for _, of in sorted(by.items())] for w, by in bands.items()}
        #: words -> lookup of the short templates by the hash of all their words
        self.short = {size: Lookup(of) for size, of in sorted(short.items())}

    def retrieve_short(self, word_hash: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, word, 1) of every run of words with the hash of a short template."""
        return [(t, at, 1) for size, lookup in self.short.items()
                for at, t in lookup.find(window_hashes(word_hash, size))]

    def retrieve(self, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, first shingle, window size) of every window that shares a band."""
        found: set[tuple[int, int, int]] = set()

        def look(values: np.ndarray, w: int, k: int, step: int) -> None:
            found.update((t, at * step, w) for at, t in self.bands[w][k].find(values))

        sizes = [w for w in self.bands if w > 1]
        if 1 in self.bands:
            look(minhashes(hashes, 0), 1, 0, 1)
        if not sizes:
            return sorted(found)
        for k in range(HASHES):
            level, size = minhashes(hashes, k), 1  # minima of blocks of `size` shingles
            while size < max(sizes):
                if len(level) % 2:
                    level = np.append(level, np.uint64(0xFFFFFFFFFFFFFFFF))
                window = np.minimum(level, np.append(level[1:], np.uint64(0xFFFFFFFFFFFFFFFF)))
                if 2 * size in self.bands:
                    look(window, 2 * size, k, size)
                level, size = window[::2], 2 * size
        return sorted(found)


def _verify(index: Index, words: list[bytes], found: list[tuple[int, int, int]], containment: float,
            ) -> dict[str, tuple[float, int, int]]:
    """license -> (containment, first word, words) of the best place in one document."""
    best: dict[str, tuple[float, int, int]] = {}
    for t, start, w in found:
        own, size = index.shingles[t], index.size[t]
        n = len(words) - size + 1
        places = [i for i in range(start, min(start + w, n)) if b" ".join(words[i:i + size]) in own]
        seen = {b" ".join(words[i:i + size]) for i in places}
        share = len(seen) / len(own)
        if share >= containment:
            row = (share, -places[0], places[-1] + size - places[0])
            if row > best.get(index.names[t], (0.0, 0, 0)):
                best[index.names[t]] = row
    return best


_OUT = "doc_id long, license string, containment double, first_word long, n_words long"


def _scan(docs: DataFrame, index: Index, containment: float) -> DataFrame:
    shared = Shared(docs.sparkSession, index)

    def run(rows: dict[str, list]) -> dict[str, list]:
        own: Index = shared.get()
        out: dict[str, list] = {c: [] for c in ("doc_id", "license", "containment", "first_word", "n_words")}
        vocabulary = Vocabulary()
        split = [alnum_words(t) for t in rows["text"]]
        coded = [vocabulary.encode(w) for w in split]
        lengths = np.array([len(c) for c in coded], np.int64)
        word_hash = vocabulary.hashes()[np.concatenate(coded)] if lengths.sum() else np.empty(0, np.uint64)
        hashes = window_hashes(word_hash, SHINGLE)  # of the joined words: shingles across two
        first = np.cumsum(lengths) - lengths        # documents only cost candidates, see below
        by_doc: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        found = own.retrieve(hashes) if len(hashes) else []
        for t, start, w in found + own.retrieve_short(word_hash):
            a = int(np.searchsorted(first + lengths, start, side="right"))
            while a < len(split) and first[a] < start + w:  # a window may lie over several documents
                by_doc[a].append((t, max(0, start - int(first[a])), w - max(0, int(first[a]) - start)))
                a += 1
        for k in sorted(by_doc):
            for name, (share, place, n) in sorted(_verify(own, split[k], by_doc[k], containment).items()):
                out["doc_id"].append(rows["doc_id"][k])
                out["license"].append(name)
                out["containment"].append(share)
                out["first_word"].append(-place)
                out["n_words"].append(n)
        return out

    return map_rows(docs, run, _OUT)


def scan_licenses(docs: DataFrame, templates: DataFrame | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, containment, first_word, n_words: a row for each license of a document.

    ``templates`` has columns license and text; without it, the registered
    table (``license_templates``) is used. Templates are handled in blocks of about BLOCK_WORDS words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if templates is None:
        return _scan(docs, Index(registered()), containment)
    own = templates.select("license", "text").filter("license is not null and text is not null").distinct()
    n_bytes = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = parts_for(n_bytes, BLOCK_WORDS * 6)
    # a license's templates stay in one block, so that its best place is found there
    blocks = own.withColumn("block", F.pmod(F.xxhash64("license"), F.lit(n_blocks)))
    out = None
    for n in range(n_blocks):
        rows = blocks.filter(F.col("block") == n).orderBy("license", "text").collect()  # about BLOCK_WORDS
        found = _scan(docs, Index([(r["license"], r["text"]) for r in rows]), containment)
        out = found if out is None else out.unionByName(found)
    return out
