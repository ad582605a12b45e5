"""Numeric statistics of whole texts, one row per document (shared by the rule operators).

Exact base counts: n_words (blank-separated), word_chars (code points in words), n_symbols
(characters of ``[#*$%&|<>]``), n_dup_lines (lines with a word that equal an earlier line),
n_repeat_words (words inside 5-word windows found twice or more in the text). The other columns
are shares derived from the text. Null and empty texts count 0 everywhere.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank_words, map_rows

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features of the models; each is defined for every text.
FEATURES = [
    "log_words", "word_len", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
    "digit_share", "punct_share", "bang_share", "pipe_share", "stop_share", "distinct_share",
    "top_share", "line_words", "same_next_share",
]
_SYMBOLS = b"#*$%&|<>"
_PUNCT = b".,;:?\"'()-"
_BLANKS = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGIT = bytes(range(0x30, 0x3A))
_CONTINUED = bytes(range(0x80, 0xC0))


def repeated_words(codes: np.ndarray, size: int = 5) -> int:
    """How many words lie in a window of ``size`` words that occurs twice or more (exact)."""
    n = len(codes) - size + 1
    if n < 2:
        return 0
    key = codes[:n]
    for k in range(1, size):  # windows of k + 1 words get the rank of (window of k, next word)
        key = key * (int(codes.max()) + 1) + codes[k:k + n]
        if k < size - 1 and int(key.max()) > (1 << 62) // (int(codes.max()) + 2):
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    often = np.zeros(n, bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    change = np.zeros(len(codes) + 1, np.int64)
    at = np.flatnonzero(often)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    return int((np.cumsum(change)[:-1] > 0).sum())


def _count(raw: bytes, kinds: bytes) -> int:
    return len(raw) - len(raw.translate(None, kinds))


def text_stats(text: str | None) -> list[float]:
    """BASE then FEATURES of one text."""
    words = blank_words(text)
    if not words:
        raw = (text or "").encode("utf-8", "surrogatepass")
        return [0, 0, _count(raw, _SYMBOLS), 0, 0] + [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    n = len(words)
    code: dict[bytes, int] = {}
    codes = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, n)
    counts = np.bincount(codes)
    word_chars = len(raw) - _count(raw, _CONTINUED) - _count(raw, _BLANKS)
    symbols = _count(raw, _SYMBOLS)
    seen: set[bytes] = set()
    lines = dup_lines = 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            if line in seen:
                dup_lines += 1
            seen.add(line)
    repeats = repeated_words(codes)
    upper, lower = _count(raw, _UPPER), _count(raw, _LOWER)
    lengths = np.fromiter(map(len, code), np.int64, len(code))
    return [
        n, word_chars, symbols, dup_lines, repeats,
        float(np.log1p(n)), word_chars / n, symbols / n, dup_lines / lines, repeats / n,
        upper / max(1, upper + lower), _count(raw, _DIGIT) / word_chars, _count(raw, _PUNCT) / n,
        raw.count(b"!") / n, raw.count(b"|") / n, float(counts[lengths <= 3].sum()) / n,
        len(code) / n, float(counts.max()) / n, n / lines,
        float((codes[1:] == codes[:-1]).sum()) / n,
    ]


def with_stats(docs: DataFrame) -> DataFrame:
    """doc_id with BASE and FEATURES for every row of ``docs``."""
    def run(rows: dict[str, list]) -> dict[str, list]:
        stats = [text_stats(t) for t in rows["text"]]
        out: dict[str, list] = {"doc_id": rows["doc_id"]}
        for k, name in enumerate(BASE + FEATURES):
            out[name] = [s[k] for s in stats]
        return out

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in BASE), *(f"{c} double" for c in FEATURES)])
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(plain, run, schema)


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of every labelled document; contradicting labels count as the larger."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def labelled_sample(labels: DataFrame, label: str, learns: F.Column, rows: int) -> DataFrame:
    """(doc_id, label) of about ``rows`` labelled documents at most, chosen by a hash of the id:
    the same rows on every run. ``learns`` says which ids may be learned from."""
    return labelled(labels.filter(learns), label).orderBy(F.xxhash64(F.lit("sample"), "doc_id")).limit(rows)
