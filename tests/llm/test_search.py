"""Lexical search, hard negatives and BPE against brute force and the tokenizers library."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loanweave.llm import bpe, hard_negatives, lexical_search

from .fixtures import awkward, frame, prose, rows_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_search(documents, items, k=10):
    """Ranked lists by the formula alone, over Python integers."""
    terms = lambda text: TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    bags = [(doc_id, Counter(words), len(words)) for doc_id, words in ((d, terms(t)) for d, t in documents) if words]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(term for _, bag, _ in bags for term in bag)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item_id, text in items:
        asked = Counter(terms(text))
        found = []
        for doc_id, bag, n in bags:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(q * weight[t] * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t, q in asked.items() if t in bag)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return sorted(out, key=repr)


def search_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "x1"]
    text = lambda n: " ".join(words[min(int(rng.expovariate(0.08)), 61)] for _ in range(n))
    documents = [(100 + i, text(rng.randint(1, 60)), None, None, None) for i in range(300)]
    documents += documents[:20] + [(7000 - i, "rare w1, W1!", None, None, None) for i in range(15)] + [(None, "rare w1 w1", None, None, None)]
    return awkward() + documents


ITEMS = [(1, "w0 w1 w1 rare"), (2, "W3-w50_w59 Ünï"), (3, ""), (4, None), (5, "absent"), (1, "w0 w1 w1 rare"), (None, "one two x1"), (6, prose(1, 80))]


@pytest.mark.parametrize("block_chars", [1 << 24, 20])
def test_search(spark, block_chars):
    rows = search_rows()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = lexical_search.search(frame(spark, rows, extra=True).repartition(5), items, block_chars=block_chars)
    assert rows_of(found) == brute_search([r[:2] for r in rows], ITEMS)


def test_search_of_empty_tables(spark):
    items, none = spark.createDataFrame(ITEMS, "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert lexical_search.search(frame(spark, []), items).count() == 0
    assert lexical_search.search(frame(spark), none).count() == 0


@pytest.mark.parametrize("window,share", [(16, 0.3), (64, 0.0), (32, 2.0)])
def test_windows_and_accumulators(monkeypatch, window, share):
    """Skipping never loses a result, whichever lists count as short."""
    monkeypatch.setattr(lexical_search, "WINDOW", window)
    monkeypatch.setattr(lexical_search, "SHORT", share)
    rng = np.random.default_rng(window)
    for _ in range(30):
        n, vocabulary = int(rng.integers(1, 300)), 12
        bags = [np.unique(np.minimum(rng.geometric(0.25, rng.integers(1, 9)), vocabulary) - 1) for _ in range(n)]
        counts = [rng.integers(1, 5, len(b)) for b in bags]
        lengths = np.array([c.sum() for c in counts])
        batch = pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(rng.integers(0, 50, n)),
                "n": pa.array(lengths),
                "terms": pa.array([b.tolist() for b in bags], pa.list_(pa.int32())),
                "counts": pa.array([c.tolist() for c in counts], pa.list_(pa.int32())),
            }
        )
        weights = rng.integers(1, 4000, vocabulary)
        query = lexical_search.Query(list(range(vocabulary)), weights.tolist())
        half = n // 2
        for part in (batch.slice(0, half), batch.slice(half)):
            if len(part):
                lexical_search.Chunk([part], n, int(lengths.sum())).run(query, 10)
        m = 25 + (75 * lengths * n) // lengths.sum()
        score = [sum(int(weights[t]) * ((10**9 * int(c)) // (1000 * int(c) + 8 * int(m[i]))) for t, c in zip(b, cs)) for i, (b, cs) in enumerate(zip(bags, counts))]
        want = sorted((-s, d) for s, d in zip(score, batch.column("doc_id").to_pylist()))[:10]
        assert list(zip((-query.score).tolist(), query.doc_id.tolist())) == want


def test_product_is_exact():
    rng = np.random.default_rng(1)
    for m, k, n in [(1, 1, 1), (17, 33, 19), (100, 64, 70), (65, 65, 65), (40, 0, 40)]:
        left, right = rng.integers(-(2**60), 2**60, (m, k)), rng.integers(-(2**60), 2**60, (k, n))
        assert (hard_negatives.product(left, right) == left @ right).all()


def brute_mine(rows):
    """Over Python integers; a row's place stands for the row."""
    taking = [
        (at, vec_id, label, [math.floor(256 * x) for x in vector], anchor)
        for at, (vec_id, label, vector, anchor) in enumerate(rows)
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) and abs(x) < 4096 for x in vector)
    ]
    key = lambda pair: (-pair[0], pair[1] is None, pair[1] or 0)
    out = []
    for at, anchor_id, label, vector, is_anchor in taking:
        if not is_anchor:
            continue
        scored = [(sum(a * b for a, b in zip(vector, other)), i, kind) for place, i, kind, other, _ in taking if place != at]
        for positive, positive_id in sorted([s[:2] for s in scored if s[2] == label], key=key)[:5]:
            fits = [s[:2] for s in scored if s[2] != label and 50 * positive <= 100 * s[0] <= 95 * positive]
            out += [(anchor_id, positive_id, r, n[1], positive, n[0]) for r, n in enumerate(sorted(fits, key=key)[:3], 1)]
    return sorted(out, key=repr)


SCHEMA = "vec_id long, label int, vector array<float>, is_anchor boolean, row long, score string"


def mining_rows():
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 4)), (rng.integers(-3, 4, 6) / 8).tolist(), i % 9 == 0) for i in range(150)]
    rows += rows[:25] + [(None, 1, [0.5] * 6, None), (None, 1, [0.5] * 6, True), (901, None, [0.5] * 6, True), (902, 1, None, True)]
    rows += [(903, 1, [float("nan")] * 6, True), (904, 2, [0.5, None], True), (905, 2, [float("inf")], True), (906, 3, [], True), (907, 2, [0.5, 0.25], True)]
    return rows + [(908, 2, [1e30] * 6, True), (909, 8, [0.5] * 6, True)]


@pytest.mark.parametrize("block_bytes", [1 << 25, 300])
def test_hard_negatives(spark, block_bytes):
    rows = mining_rows()
    found = hard_negatives.mine(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4), block_bytes=block_bytes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert rows_of(found) == brute_mine(rows)
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tiles_and_strips(monkeypatch):
    """Results do not depend on where tiles end, negative scores included."""
    rng = np.random.default_rng(4)
    n = 120
    batch = pa.RecordBatch.from_pydict(
        {
            "row": pa.array(np.arange(n)),
            "vec_id": pa.array(rng.permutation(n)),
            "label": pa.array(rng.integers(0, 3, n)),
            "vector": pa.array(rng.integers(-4, 5, (n, 20)).tolist(), pa.list_(pa.int64())),
        }
    )
    rows = hard_negatives.Rows.of(batch, 20)
    low, high = np.tile(np.array([[-50, 10, 5]]), (n, 1)), np.tile(np.array([[20, 40, -5]]), (n, 1))
    seen = []
    for tile, strip in ((4096, 1024), (7, 5)):
        monkeypatch.setattr(hard_negatives, "TILE", tile)
        monkeypatch.setattr(hard_negatives, "STRIP", strip)
        parts = [batch.slice(i, 13) for i in range(0, n, 13)]
        best = hard_negatives.best_of_label(rows, iter(parts), 5)
        windows = hard_negatives.best_in_windows(rows, low, high, iter(parts), 3)
        seen.append([np.where(h.held, h.row, -1) for h in (best, windows)])
    assert all((a == b).all() for a, b in zip(*seen))
    assert not (seen[0][1].reshape(n, 3, 3)[:, 2] >= 0).any()


ODD = [
    "a  <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> ", "x\n\n\ny  z", "don't 'sun!'s  I'LL we'll", "ࡰࡱa ࡰ b",
    "é ﬁ \U0001f600‍\U0001f600　  x", "a" * 50_000, " " * 3000 + "b", "͸x <|endoftext|> ͸", "12ab34 ½²", "\x00\x01\x1c\x1d\x85",
]


def test_bpe_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = awkward() + [(100 + i, text, None, None, None) for i, text in enumerate(ODD)]
    wanted = []
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        wanted.append((doc_id, np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)))
    for size in (bpe.BLOCK_CHARS, 500):
        found = bpe.round_trip(frame(spark, rows, extra=True).repartition(3), block_chars=size)
        assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in found.collect()), key=repr) == sorted(wanted, key=repr)
    assert bpe.round_trip(frame(spark, [])).count() == 0


def test_bpe_decodes_any_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(2)
    rows = [(i % 40, rng.integers(0, 50_300, rng.integers(0, 40)).tolist()) for i in range(120)] + [(None, None), (1, [])]
    found = bpe.decode(spark.createDataFrame(rows, "key int, ids array<int>"))
    wanted = [(key, tokenizer.decode(ids or [], skip_special_tokens=False)) for key, ids in rows]
    assert rows_of(found.select("key", "decoded")) == sorted(wanted, key=repr)
