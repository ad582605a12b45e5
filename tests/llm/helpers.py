"""Small fixtures and brute-force versions for the text operators."""

from __future__ import annotations

import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def docs(spark, rows, extra=True):
    """rows: (doc_id, text) pairs; ``extra`` adds columns whose names operators use inside."""
    full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    if extra:
        df = df.selectExpr("*", "1 as key", "'x' as label", "2 as block", "3 as n_words", "4 as fp", "5 as epoch",
                           "'z' as window", "6 as mask", "0.5 as score")
    return df


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def corpus(seed=7, n=60):
    """Documents with exact and near copies, shared passages, nulls, odd white space, junk."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["Ähre", "naïve", "日本語", "x y", " z"]
    passage = sentence(rng, 30, words)
    rows = []
    for i in range(n):
        text = sentence(rng, rng.randint(1, 120), words)
        kind = i % 12
        if kind == 1 and rows:
            text = rows[i // 2][1] or ""
        elif kind == 2 and rows:
            own = (rows[i - 2][1] or "").split(" ")
            own[len(own) // 2] = "changed"
            text = " ".join(own)
        elif kind == 3:
            text = text + "\n" + passage + "\t\t" + text
        elif kind == 4:
            text = "  " + text.replace(" ", "  \n", 3) + " \t"
        elif kind == 5:
            text = " ".join(["same"] * rng.randint(1, 60))
        elif kind == 6:
            text = passage.upper() if i % 24 == 6 else " ".join(passage.split()[3:20])
        rows.append((i, text))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "!!! ... 123"), (n + 4, "word " * 5000),
             (5, rows[5][1]), (7, "another text under a known id"), (None, passage), (None, None)]
    return rows
