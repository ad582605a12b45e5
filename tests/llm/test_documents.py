"""Operators with exact contracts against brute force, with all odd inputs in one corpus."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
import xxhash

from strata.llm import decontaminate, simhash, substring, token_store
from strata.llm.decontaminate import decontaminate as decontaminate_docs
from tests.llm.helpers import ALNUM, BLANK, corpus, docs

ROWS = corpus()


def _sorted(rows):
    return sorted(rows, key=repr)


def _removed(rows, size=13):
    starts = {}
    split = [(i, BLANK.findall((t or "").encode())) for i, t in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - size + 1):
                x = tuple(w[k:k + size])
                starts[x] = min(i, starts.get(x, i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and starts[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("size", [13, 4])
def test_remove_repeats_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 4000)
    got = substring.remove_repeats(docs(spark, ROWS), size).collect()
    assert _sorted(tuple(r) for r in got) == _sorted(_removed(ROWS, size))


def test_remove_repeats_splits_the_automata(monkeypatch):
    rows = [(i, t) for i, t in ROWS if i is not None]
    ids = np.array([i for i, _ in sorted(rows, key=lambda r: r[0])], np.int64)
    words = [BLANK.findall((t or "").encode()) for _, t in sorted(rows, key=lambda r: r[0])]
    block = substring.Passages(ids, substring._coded(words)[0], 13)
    first = np.array([s for s, n in zip(block.start, block.length) if n >= 13])
    end = np.array([s + n for s, n in zip(block.start, block.length) if n >= 13])
    owner = block.doc[first]
    anchors = block.anchors(first, end, owner)
    whole = block.occurrences(anchors)
    parts = np.logical_or.reduce([block.occurrences(anchors[k:k + 7]) for k in range(0, len(anchors), 7)])
    assert (whole == parts).all() and whole.any()


def _fingerprint(text):
    w = BLANK.findall((text or "").encode().lower())
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def _components(fps, ids, radius=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= radius:
                parent[find(a)] = find(b)
    least = {}
    for k in range(len(fps)):
        if ids[k] is not None:
            least[find(k)] = min(ids[k], least.get(find(k), ids[k]))
    return [least.get(find(k)) for k in range(len(fps))]


def test_simhash_equals_brute_force(spark):
    got = simhash.simhash_near_dups(docs(spark, ROWS)).collect()
    fps = [_fingerprint(t) for _, t in ROWS]
    want = [(i, f"{f:016x}", c) for (i, _), f, c in zip(ROWS, fps, _components(fps, [i for i, _ in ROWS]))]
    assert _sorted(tuple(r) for r in got) == _sorted(want)


def test_covering_masks_miss_no_pair():
    rng = np.random.default_rng(1)
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(4)]
    assert len(masks) == 31
    for _ in range(3000):
        d = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not d & m for m in masks)
        hit = next(m for m in masks if not d & m)
        finer = [m & (1 << 64) - 1 for m in simhash._finer(hit, 4)]
        assert any(not d & m for m in finer)


def test_large_buckets_are_split_and_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(1, 1 << 62))
    fps = {base}
    while len(fps) < 150:  # a dense ball, and chains leaving it
        at = int(rng.choice(sorted(fps)[:20] if len(fps) < 100 else sorted(fps)))
        for b in rng.choice(63, int(rng.integers(1, 5)), replace=False):
            at ^= 1 << int(b)
        fps.add(at)
    own = sorted(fps)
    nodes = spark.createDataFrame([(f,) for f in own], "fp long")
    from strata.llm.graph import components

    links = simhash.near_links(nodes, 4, limit=10)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    want = _components(own, own)
    assert [roots.get(f, f) for f in own] == want


def _contaminated(rows, items, size=13):
    windows = {}
    for item, text in items:
        w = ALNUM.findall((text or "").encode().lower())
        for k in range(max(1, len(w) - size + 1)) if w else ():  # without an id: words are hit, no id counts
            windows.setdefault(tuple(w[k:k + size]), set()).update([] if item is None else [str(item)])
    out = []
    for i, t in rows:
        w = ALNUM.findall((t or "").encode().lower())
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_windows", [decontaminate.BLOCK_WINDOWS, 7])
def test_decontaminate_equals_brute_force(spark, block_windows):
    items = [(k, ROWS[k][1]) for k in (0, 3, 6, 9, 14)] + [
        (100, "same"), (101, "SAME same same"), (102, ""), (103, None), (104, ROWS[3][1]), (105, "日本語"),
        (None, "w1 w2"), (9, "w1 w2 w3"), (106, "!!"), (11, ROWS[6][1][:60]), (None, ROWS[20][1]), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as n", "2 as window")
    got = decontaminate_docs(docs(spark, ROWS), bench, block_windows=block_windows).collect()
    assert _sorted(tuple(r) for r in got) == _sorted(_contaminated(ROWS, items))


def _tokens(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, start, out = Tokenizer.from_file(path), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return path, out


def test_token_store_round_trip(spark, tmp_path):
    path, want = _tokens(ROWS)
    token_store.write_tokens(docs(spark, ROWS), f"{tmp_path}/store", f"{tmp_path}/ids", path, 2, block_tokens=900)
    got = token_store.read_tokens(spark, f"{tmp_path}/store", with_ids=True).collect()
    assert _sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == _sorted(want)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)


def test_rans_blocks_of_every_size_and_damage():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 63, 64, 65, 1000, 16384, 70001, 140000):
        ids = rng.zipf(1.3, n).clip(0, 50256).astype(np.uint32)
        used, counts = np.unique(ids, return_counts=True)
        slots = token_store.Frequencies.share(used.tolist(), counts.tolist())
        assert sum(slots) in (0, 1 << 20)
        table = token_store.Frequencies(used.tolist(), slots)
        payload = token_store.encode_block(ids, table)
        assert (token_store.decode_block(payload, table) == ids).all()
        if n > 10:
            bad = bytearray(payload)
            bad[len(bad) // 2] ^= 1
            with pytest.raises(ValueError):
                token_store.decode_block(bytes(bad), table)


def test_chunks_join_to_the_same_ids():
    path, _ = _tokens([])
    own = token_store.ChunkTokenizer(path)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    texts = ["", " ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "a b  c", "it's 'll  x\t y", "\n\n a \r\n b",
             "x" * 500 + " y", "日本 語   z", "1 23 4,5 !!", "a \x1c b", "é ́x"]
    got = own.encode(texts)
    assert [np.frombuffer(b, own.dtype).tolist() for b in got] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_chunks_outlive_the_generations_of_the_cache(monkeypatch):
    monkeypatch.setattr(token_store, "KNOWN_CHUNKS", 5)
    path, _ = _tokens([])
    own = token_store.ChunkTokenizer(path)
    rng = np.random.default_rng(6)
    for _ in range(40):
        texts = [" ".join(rng.choice(["a", "bb", "ccc", "dd ", "x" * 90, "é", "f.g", "1,2"], 6)) for _ in range(2)]
        assert [np.frombuffer(b, own.dtype).tolist() for b in own.encode(texts)] == [
            own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(own.known) <= 5 + 16 and len(own.older) <= 5 + 16


@pytest.mark.parametrize("run", [
    substring.remove_repeats, simhash.simhash_near_dups, lambda d: decontaminate_docs(d, d.selectExpr("doc_id as item_id", "text"))])
def test_empty_tables(spark, run):
    assert run(docs(spark, [])).collect() == []


def test_empty_token_store(spark, tmp_path):
    path, _ = _tokens([])
    token_store.write_tokens(docs(spark, []), f"{tmp_path}/store", f"{tmp_path}/ids", path, 2)
    assert token_store.read_tokens(spark, f"{tmp_path}/store").collect() == []


def test_empty_benchmark(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate_docs(docs(spark, ROWS[:4]), bench).collect()
    assert len(got) == 4 and not any(r.contaminated for r in got)
