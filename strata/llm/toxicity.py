"""Toxicity: a sparse linear classifier, regularised by counterfactual identity swaps.

Features are the distinct lower-cased words of a text and their prefixes of 4 and 5 characters.
The logistic model is fitted on a bounded, labelled sample with an L1 penalty (proximal gradient)
and a counterfactual penalty: in every labelled sentence that mentions a group, the group's term is
swapped for another one; to documents that mention none a term is added, as a neutral mention would.
The squared change of the score under these swaps, meaned over the swaps of a document and then
over documents, is part of the loss, so terms for groups get no weight of
their own and neutral mentions are not taken for abuse.

Defined cases: null and empty texts have no features and get the score of the intercept; without
labelled rows the score is 0.5, with one class only the smoothed share; repeated rows come back
once each; rows with a null doc_id are scored, never learned from, and have a null held_out; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, crc_fold, map_rows

#: Labelled rows per class, and hashed features.
CLASS_ROWS, MAX_SENTENCES, SPACE = 4000, 64, 1 << 20

#: Terms that name groups of people, by the kind of group; swapped within a kind.
IDENTITY_TERMS = {
    "religion": ["muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "protestant", "atheist",
                 "musulmán", "cristiano", "judío", "musulman", "chrétien", "juif", "muslimisch", "christlich", "jüdisch"],
    "people": ["black", "white", "asian", "african", "european", "american", "mexican", "arab", "indian",
               "chinese", "german", "french", "spanish", "turkish", "polish", "russian"],
    "gender": ["women", "men", "woman", "man", "female", "male", "transgender", "mujeres", "hombres",
               "femmes", "hommes", "frauen", "männer"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "heterosexual", "homosexual", "queer"],
    "ability": ["deaf", "blind", "disabled", "autistic"],
    "age": ["old", "young", "elderly", "teenage"],
}
_KIND = {t: (k, n) for k, terms in IDENTITY_TERMS.items() for n, t in enumerate(terms)}
_TERMS = [t for terms in IDENTITY_TERMS.values() for t in terms]
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def features(word: str) -> list[int]:
    """Hashed features of one word: itself and its prefixes."""
    parts = {"w" + word, "4" + word[:4], "5" + word[:5]}
    return sorted(zlib.crc32(p.encode("utf-8", "surrogatepass")) % SPACE for p in parts)


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def swap(sentence: str, pick: int) -> tuple[list[str], list[str]]:
    """Words that leave and that enter when identity terms are swapped, or one is added."""
    found = [w for w in words(sentence) if w in _KIND]
    if not found:
        return [], [_TERMS[pick % len(_TERMS)]]
    new = []
    for w in found:
        kind, n = _KIND[w]
        terms = IDENTITY_TERMS[kind]
        new.append(terms[(n + 1 + pick % (len(terms) - 1)) % len(terms)])
    return found, new


def _pick(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def _sample(docs: DataFrame, labels: DataFrame, learns: F.Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of up to ``per_class`` documents of each class by a hash of the id, and how
    many labelled documents each class has."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learns).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = F.xxhash64(F.lit("sample"), "doc_id")
    picks = [known.filter(F.col("label") == y).orderBy(order).limit(per_class) for y in (0, 1)]
    return picks[0].unionByName(picks[1]), counts


def _training_rows(docs: DataFrame, marked: DataFrame, max_sentences: int = MAX_SENTENCES) -> DataFrame:
    """Features of the sampled documents, and the features that each swap removes and adds: one swap
    for every sentence that names a group, for the ``max_sentences`` of a document with the smallest hashes
    if it has more. What a swap takes and gives follows from the sentence alone. Of rows that share an id the
    text with the smallest hash counts."""
    def run(rows: dict[str, list]) -> dict[str, list]:
        own, gone, new = [], [], []
        packed = lambda fs: np.array(fs, "<i4").tobytes()
        for text in rows["text"]:
            own.append(packed(sorted({f for w in words(text) for f in features(w)})))
            sentences = [s for s in _SENTENCE.split((text or "").lower()) if s.strip()]
            named = [s for s in sentences if any(t in _KIND for t in words(s))]
            if len(named) > max_sentences:
                named = sorted(named, key=lambda s: (_pick(s), s))[:max_sentences]
            swaps = [swap(s, _pick(s)) for s in named] or [swap("", _pick(text or ""))]
            gone.append([packed([f for w in old for f in features(w)]) for old, _ in swaps])
            new.append([packed([f for w in fresh for f in features(w)]) for _, fresh in swaps])
        return {"doc_id": rows["doc_id"], "label": rows["label"], "own": own, "gone": gone, "new": new}

    joined = docs.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "label").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))
    return map_rows(joined.select("doc_id", "label", "text"), run,
                    "doc_id long, label int, own binary, gone array<binary>, new array<binary>")


def _sparse(lists: list, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the entries whose feature is in the model."""
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    cols = place[np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(rows) else np.zeros(0, np.int64)]
    return rows[cols >= 0], cols[cols >= 0]


def train(
    own: list, label: np.ndarray, gone: list, new: list, prior: float,
    penalty: float = 0.0001, counterfactual: float = 1.0, rounds: int = 400, of: np.ndarray | None = None,
) -> tuple[float, dict[int, float]]:
    """Intercept and weights of the features that matter; ``prior`` is the share of label 1. ``of``
    names the row of each swap in ``gone`` and ``new`` (one swap a row without it); the swaps of a
    row share its weight."""
    n = len(label)
    if n == 0:
        return 0.0, {}
    if label.min() == label.max():
        return float(np.log(prior / (1 - prior))), {}
    flat = np.concatenate([np.asarray(x, np.int64) for x in own])
    y_of = np.repeat(label, [len(x) for x in own])
    ones, all_ = np.bincount(flat[y_of == 1], minlength=SPACE), np.bincount(flat, minlength=SPACE)
    share = label.mean()
    z = (ones - all_ * share) / np.sqrt(np.maximum(all_ * share * (1 - share), 1e-9))
    chosen = np.flatnonzero((all_ >= 2) & (np.abs(z) > 3.0))
    place = np.full(SPACE, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    row, col = _sparse(own, place)
    out_row, out_col = _sparse(gone, place)
    in_row, in_col = _sparse(new, place)
    d_row, d_col = np.concatenate([out_row, in_row]), np.concatenate([out_col, in_col])
    sign = np.concatenate([-np.ones(len(out_row)), np.ones(len(in_row))])
    weight = np.where(label == 1, prior / share, (1 - prior) / (1 - share)) / n  # classes as in the labels
    k = len(chosen)
    of = np.arange(n) if of is None else of
    part = 1.0 / np.bincount(of, minlength=n)[of]  # of a row's weight, by swap
    # Step from row-sum bounds on the curvature of both parts of the loss.
    load = weight * (np.bincount(row, minlength=n) + 1.0)
    curve = 0.25 * max(load.sum(), np.bincount(col, load[row], k).max(initial=0.0))
    moved = part * np.bincount(d_row, minlength=len(of))
    curve += 2 * counterfactual / n * np.bincount(d_col, moved[d_row], k).max(initial=0.0)
    step = 1.0 / max(curve, 1e-6)
    w, v, b, vb, t = np.zeros(k), np.zeros(k), 0.0, 0.0, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, v[col], n) + vb, -30, 30)))
        miss = weight * (p - label)
        slope = np.bincount(col, miss[row], k)
        if len(d_row):
            change = part * np.bincount(d_row, sign * v[d_col], len(of))
            slope = slope + 2 * counterfactual / n * np.bincount(d_col, sign * change[d_row], k)
        new_w = v - step * slope
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
        new_b = vb - step * miss.sum()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new_w + (before - 1) / t * (new_w - w), new_w
        vb, b = new_b + (before - 1) / t * (new_b - b), new_b
    kept = np.flatnonzero(w)
    return float(b), dict(zip(chosen[kept].tolist(), w[kept].tolist()))


class Scorer:
    """Scores texts word by word; a word's weights are summed once per slice."""

    def __init__(self, base: float, weights: dict[int, float]) -> None:
        self.base, self.weights = base, weights

    def scores(self, texts: list[str | None]) -> list[float]:
        known: dict[str, tuple[int, ...]] = {}
        out = []
        for text in texts:
            hit: set[int] = set()
            for w in words(text):
                if (own := known.get(w)) is None:
                    own = known[w] = tuple(f for f in features(w) if f in self.weights)
                if own:
                    hit.update(own)
            total = self.base + sum(self.weights[f] for f in sorted(hit))
            out.append(float(1 / (1 + np.exp(-np.clip(total, -30, 30)))))
        return out


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, per_class: int = CLASS_ROWS, counterfactual: float = 1.0,
    max_sentences: int = MAX_SENTENCES,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``. The model is fitted on up to ``per_class``
    labelled documents of each class and ``max_sentences`` swapped sentences of each document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked, counts = _sample(docs, labels, crc_fold("doc_id", 5) != 0, per_class)
    known = sorted(_training_rows(docs, marked, max_sentences).collect(), key=lambda r: r["doc_id"])  # 2 * per_class rows
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    own = [np.frombuffer(r["own"], "<i4") for r in known]
    gone, new = ([np.frombuffer(x, "<i4") for r in known for x in r[c]] for c in ("gone", "new"))
    of = np.repeat(np.arange(len(known)), [len(r["gone"]) for r in known])
    base, weights = train(own, np.array([r["label"] for r in known], float), gone, new, prior,
                          counterfactual=counterfactual, of=of)
    shared = Shared(docs.sparkSession, Scorer(base, weights))

    def run(rows: dict[str, list]) -> dict[str, list]:
        return {"doc_id": rows["doc_id"], "score": shared.get().scores(rows["text"])}

    return map_rows(docs, run, "doc_id long, score double").select(
        "doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
