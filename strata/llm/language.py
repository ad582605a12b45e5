"""Language ID in two steps: the family first, then the languages within it.

A text is a vector of hashed character trigrams (letters only, lower case). Linear support vector
machines (squared hinge, dual coordinate descent) tell families apart one-versus-one; within the
family that wins, one-versus-one machines vote on the language. Margins become probabilities by a
logistic curve fitted per machine, and the score is the family's times the language's.

The machines are fitted on a bounded sample of rows (``per_lang`` for each language, ``max_rows`` in all).

Defined cases: a text that is null or has no letter is ``und`` with score 0; without rows to learn
from every text is ``und``; with one language every text with a letter gets it with score 1; ties go
to the name that sorts first; repeated rows come back once each; null doc_ids are predicted, never
learned from, and have a null held_out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, crc_fold, has_letter, map_rows, stage

#: Families of the languages that may be close to each other (ISO 639-1); any other code is a
#: family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "lb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}
FAMILY_OF = {lang: f for f, langs in FAMILIES.items() for lang in langs}
SPACE, PER_LANG, MAX_ROWS = 4096, 1000, 6000
#: Non-letters of one byte; a text's other bytes are kept.
_BLANK = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def vector(text: str) -> np.ndarray:
    """Square roots of trigram counts, scaled to length 1."""
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_BLANK)
    a = np.frombuffer(b" " + b" ".join(raw.split()) + b" ", np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(SPACE, np.float32)
    key = (a[:-2] * np.uint32(65536) + a[1:-1] * np.uint32(256) + a[2:]) * np.uint32(2654435761)
    counts = np.sqrt(np.bincount(key >> np.uint32(20), minlength=SPACE)).astype(np.float32)
    return counts / np.linalg.norm(counts)


def svm(x: np.ndarray, y: np.ndarray, cost: float = 5.0, rounds: int = 15, seed: int = 42) -> tuple[np.ndarray, float]:
    """Weights (last one: bias) by dual coordinate descent, and the slope of the logistic curve."""
    rng = np.random.default_rng(seed)
    x = np.hstack([x, np.full((len(x), 1), 0.3, np.float32)])
    w, alpha = np.zeros(x.shape[1], np.float32), np.zeros(len(x))
    norm = (x * x).sum(axis=1) + 0.5 / cost
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(x)):
            slope = y[i] * float(x[i] @ w) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - slope / norm[i], 0.0)
            if abs(new - alpha[i]) > 1e-6:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    m = y * (x @ w)
    slope = 2.0
    for _ in range(30):  # logistic curve through 0: one slope, kept within bounds
        p = 1 / (1 + np.exp(np.clip(slope * m, -30, 30)))
        slope = float(np.clip(slope + ((m * p).sum() - 1e-3 * slope) / ((m * m * p * (1 - p)).sum() + 1e-3), 1.0, 8.0))
    return w, slope


class Machines:
    """One-versus-one machines between the names of one level."""

    def __init__(self, x: np.ndarray, names: np.ndarray) -> None:
        self.names = sorted(set(names.tolist()))
        self.pairs = list(combinations(range(len(self.names)), 2))
        fitted = []
        for a, b in self.pairs:
            own = np.isin(names, (self.names[a], self.names[b]))
            fitted.append(svm(x[own], np.where(names[own] == self.names[a], 1.0, -1.0)))
        self.w = np.array([w for w, _ in fitted], np.float32).reshape(len(self.pairs), SPACE + 1)
        self.slope = np.array([s for _, s in fitted])

    def choose(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and probability of the winner of each row."""
        if not self.pairs:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        m = x @ self.w[:, :-1].T + 0.3 * self.w[:, -1]
        p = 1 / (1 + np.exp(-np.clip(m * self.slope, -30, 30)))
        votes = np.zeros((len(x), len(self.names)))
        log = np.zeros((len(x), len(self.names)))
        for k, (a, b) in enumerate(self.pairs):
            votes[:, a] += p[:, k] >= 0.5
            votes[:, b] += p[:, k] < 0.5
            log[:, a] += np.log(p[:, k])
            log[:, b] += np.log1p(-p[:, k])
        share = np.exp(log - log.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = np.argmax(votes + share / 2, axis=1)
        return best, share[np.arange(len(x)), best]


def pack(x: np.ndarray) -> bytes:
    """A vector's places and values; at most 6 bytes for each of its dimensions."""
    at = np.flatnonzero(x)
    return at.astype("<u2").tobytes() + x[at].astype("<f4").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    x = np.zeros(SPACE, np.float32)
    x[np.frombuffer(raw, "<u2", n)] = np.frombuffer(raw, "<f4", n, 2 * n)
    return x


class LanguageModel:
    def __init__(self, vectors: list[np.ndarray], langs: list[str]) -> None:
        x, own = np.array(vectors, np.float32).reshape(-1, SPACE), np.array(langs, object)
        family = np.array([FAMILY_OF.get(n, f"={n}") for n in langs], object)
        self.families = Machines(x, family)
        self.within = [Machines(x[family == f], own[family == f]) for f in self.families.names]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        known = [k for k, t in enumerate(texts) if has_letter(t)]
        if not known or not self.families.names:
            return langs, scores
        for at in range(0, len(known), 512):
            some = known[at:at + 512]
            x = np.array([vector(texts[k]) for k in some], np.float32)
            family, p = self.families.choose(x)
            for f in np.unique(family):
                rows = np.flatnonzero(family == f)
                lang, q = self.within[f].choose(x[rows])
                for r, n, share in zip(rows, lang, q):
                    langs[some[r]] = self.within[f].names[n]
                    scores[some[r]] = float(p[r] * share)
        return langs, scores


def fit(
    docs: DataFrame, learns: F.Column, per_lang: int = PER_LANG, max_rows: int = MAX_ROWS,
) -> LanguageModel:
    """A model from up to ``per_lang`` rows of each language, ``max_rows`` in all and at least one of each:
    more languages than ``max_rows`` are an error."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & learns).select(
        "doc_id", "lang", "text")
    order = F.xxhash64(F.lit("sample"), "doc_id")
    # Candidates by a threshold on the hash, so that no language is ranked whole in one task.
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(3.0 * per_lang) / F.col("n"))
    shares = stage(counts.select("lang", share.alias("share")), "languages")
    n_langs = shares.count()
    if n_langs > max_rows:
        raise ValueError(f"{n_langs} languages, but a model may learn from {max_rows} rows only")
    some = rows.join(F.broadcast(shares), "lang").filter(  # max_rows names at most
        F.pmod(order, F.lit(1 << 20)) < F.col("share") * (1 << 20))

    def run(part: dict[str, list]) -> dict[str, list]:
        return {"place": part["place"], "doc_id": part["doc_id"], "lang": part["lang"],
                "x": [pack(vector(t)) for t in part["text"]]}

    plain = some.select(order.alias("place"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    vectors = map_rows(plain, run, "place long, doc_id long, lang string, x binary")
    by_lang = Window.partitionBy("lang").orderBy("place", "doc_id", "x")
    ranked = vectors.withColumn("rank", F.row_number().over(by_lang)).filter(F.col("rank") <= per_lang)
    found = ranked.orderBy("rank", "lang").limit(max_rows).select("rank", "lang", "x").collect()
    found.sort(key=lambda r: (r["rank"], r["lang"]))
    return LanguageModel([unpack(r["x"]) for r in found], [r["lang"] for r in found])


def detect(docs: DataFrame, per_lang: int = PER_LANG, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` with held_out, lang_pred and score for every row."""
    model = fit(docs.filter(F.col("doc_id").isNotNull()), crc_fold("doc_id", 3) != 1, per_lang, max_rows)
    return predict(docs, model)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    shared = Shared(docs.sparkSession, model)

    def run(rows: dict[str, list]) -> dict[str, list]:
        langs, scores = shared.get().predict(rows["text"])
        return {"doc_id": rows["doc_id"], "lang_pred": langs, "score": scores}

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(plain, run, "doc_id long, lang_pred string, score double").select(
        "doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def keep_known(
    docs: DataFrame, min_score: float, per_lang: int = PER_LANG, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Rows of ``docs`` whose language is known with at least ``min_score``; columns unchanged."""
    model = fit(docs.filter(F.col("doc_id").isNotNull()), crc_fold("doc_id", 3) != 1, per_lang, max_rows)
    shared = Shared(docs.sparkSession, model)

    @F.pandas_udf("boolean")
    def known(texts):
        import pandas as pd

        langs, scores = shared.get().predict([t if isinstance(t, str) else None for t in texts])
        return pd.Series([n != "und" and s >= min_score for n, s in zip(langs, scores)], dtype=bool)

    return docs.filter(known(F.col("text").cast("string")))
