"""Ranked search, centroid clustering and best-fit packing against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chronogeo.llm import best_fit, byte_bpe, orchard, ranked_search

PATH = public_tokenizers.path("byte_bpe_50k.json")
CLASHING = "doc_id long, text string, n long, ord long, terms string, unit int, key string, size int, score long"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in ("An", "ti", "öß", "x7", "é", "東") for b in ("", "er", "Ing", "9")]
    prose = lambda n: " ".join(rng.choice(vocabulary[: rng.choice([3, 24])]) + rng.choice(["", ".", ", it's"]) for _ in range(n))
    out = [(i, prose(rng.randint(1, 60))) for i in range(1, 120)]
    same = prose(30)
    out += [(i, same) for i in range(200, 260)]  # ties
    out += [(300, None), (301, ""), (302, " .,\n"), (303, "an " * 9000), (304, "A" * 5000), (None, same), (None, "ti ti"), (7, "ti x7")]
    return out + [(200, same), (5, "an ti"), (5, "an ti")]  # repeated ids and rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, 2, "x", 3, "k", 4, 5) for i, t in texts()]
    return spark.createDataFrame(rows, CLASHING).repartition(7).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASHING)


def ranked(docs, items, k):
    rows = [(i if i is not None else 1 << 62, i, Counter(words(t))) for i, t in docs]
    filled = [r for r in rows if r[2]]
    n_docs, tokens = len(filled), sum(sum(c.values()) for _, _, c in filled)
    df = Counter(t for _, _, c in filled for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for ord_, i, c in filled:
            m = 50 + (50 * sum(c.values()) * n_docs) // tokens
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(words(text)) if c[t])
            if score > 0:
                scored.append((-score, ord_, i))
        for rank, (score, _, i) in enumerate(sorted(scored, key=lambda r: r[:2])[:k], 1):
            out[item, rank, i, -score] += 1
    return out


@pytest.mark.parametrize("block, most, tasks, k", [(ranked_search.BLOCK, ranked_search.MOST_TERMS, 1000, 50), (40, 60, 2, 3)])
def test_ranked_search(spark, docs, empty, monkeypatch, block, most, tasks, k):
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    monkeypatch.setattr(ranked_search, "TASKS", tasks)
    items = [("a", "AN tiing öß x7"), ("b", "an"), ("c", None), ("d", "never seen"), ("a", "an ti"), (None, "東 é9 x7er x7er an ti ti anIng öß9"), ("b", "an"), ("e", "!?")]
    items += [(f"q{i}", t) for i, t in texts()[:20]]
    bench = spark.createDataFrame([(i, t, 5, "z") for i, t in items], "item_id string, text string, rank int, doc_id string")
    out = ranked_search.search(docs, bench, k, most)
    assert Counter(tuple(r) for r in out.select("item_id", "rank", "doc_id", "score").collect()) == ranked(texts(), items, k)
    assert ranked_search.search(empty, bench).count() == 0
    assert ranked_search.search(docs, bench.limit(0)).count() == 0


def test_survivors_are_exact_and_accumulators_limited():
    """A frequent term of little weight makes no accumulators, and its share of the survivors' scores is whole."""
    rng = np.random.default_rng(4)
    n = rng.integers(20, 40, 3000)
    lists = [np.unique(np.append(rng.choice([0, 1, 2], 1, p=[0.02, 0.18, 0.8]), 2)) for _ in n]
    sizes = np.array([len(x) for x in lists])
    index = ranked_search.Index(n, sizes, np.concatenate(lists), np.ones(sizes.sum(), np.int64), np.array([9000, 2000, 3]), 3000, int(n.sum()))
    row, score = index.search(np.array([0, 1, 2]), 10, 0)
    assert 10 <= len(row) < 100  # the others hold 1 or 2 only
    whole = np.zeros(3000, np.int64)
    np.add.at(whole, index.row, index.adds)
    assert (whole[row] == score).all() and np.sort(whole)[-10] == np.sort(score)[-10]
    assert len(index.search(np.array([1, 2]), 10, int(whole.max()))[0]) == 0


def clustered(rows, k, rounds, dims, scale=64):
    kept = [(i, [math.floor(scale * float(v)) for v in x]) for i, x in rows if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x)]
    seeds = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [x for _, x in seeds[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    for step in range(rounds + 1):
        at = [min((far(x, c), n) for n, c in enumerate(centres)) for _, x in kept]
        if step < rounds:
            for n in range(len(centres)):
                own = [x for (_, x), (_, m) in zip(kept, at) if m == n]
                if own:
                    centres[n] = [sum(v) // len(own) for v in zip(*own)]
    inertia = Counter()
    for d, n in at:
        inertia[n] += d
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return Counter((i, n, d, inertia[n], sum(inertia.values()), sha(centres[n])) for (i, _), (d, n) in zip(kept, at))


@pytest.mark.parametrize("dims, k, rounds", [(2, 16, 3), (5, 4, 2), (1, 7, 1)])
def test_clustering(spark, dims, k, rounds):
    rng = random.Random(dims)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.015625, 0.3, 1.0]) for _ in range(dims)]) for i in range(150)]  # many ties
    rows += [(i, [0.3] * dims) for i in range(200, 300)]
    rows += [(400, None), (401, []), (402, [0.1] * (dims + 1)), (403, [None] * dims), (404, [float("nan")] * dims), (405, [float("inf")] * dims),
             (406, [-1e-9] * dims), (None, [0.25] * dims), (3, rows[3][1]), (3, [2.5] * dims)]
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, distance int, x string").repartition(5)
    as_floats = [(i, None if x is None else [None if v is None else float(np.float32(v)) for v in x]) for i, x in rows]
    out = orchard.cluster(table, k, rounds, dims)
    assert Counter(tuple(r) for r in out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()) == clustered(as_floats, k, rounds, dims)


def test_clustering_of_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    assert orchard.cluster(spark.createDataFrame([], schema)).count() == 0
    assert orchard.cluster(spark.createDataFrame([(1, [0.5])], schema)).count() == 0
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0])]
    out = orchard.cluster(spark.createDataFrame(rows, schema), dims=2).collect()
    assert {(r.vec_id, r.cluster, r.inertia) for r in out} == {(1, 0, 0), (2, 0, 0)}
    with pytest.raises(Exception, match="64-bit"):
        orchard.cluster(spark.createDataFrame([(1, [1e30, 0.0])], schema), dims=2).collect()


def test_the_search_ends_early_and_is_exact():
    rng = np.random.default_rng(2)
    centres = rng.integers(-4, 5, (40, 3)) * 10
    x = centres[rng.integers(0, 40, 3000)] + rng.integers(-2, 3, (3000, 3))
    at, dist = orchard.nearest(x, centres)
    every = ((x[:, None] - centres[None]) ** 2).sum(2)
    assert (at == every.argmin(1)).all() and (dist == every.min(1)).all()
    gap, near = orchard.neighbours(centres)
    assert near.shape == (40, 39) and all((np.diff(gap[c][near[c]]) >= 0).all() and c not in near[c] for c in range(40))


ODD = ["", " ", "it's I'LL 'll  we'd\n\n  x", "a<|endoftext|>b", "<|endoftext|>", "ab" * 3000, " " * 3000 + "x", "x" + "\n \t" * 900, "\u0085a᠎ b​c　d\xa0e",
       "naïve Straße 東京 ١٢٣ ½ ² Ⅷ", "👍🏽 emoji 𝒳 \U0001fae8", "\x1ca\x1d b\x00c", "a﻿b �", "ﬁ ǅ ʰ é", "!?" * 700, "1" * 1000, "퟿", "Ა ᏸ ꟲ Ɤ"]


def test_ids_are_the_tokenizers(docs):
    coder, full = byte_bpe.Encoder(PATH), Tokenizer.from_file(PATH)
    own = ODD + [t or "" for _, t in texts()]
    for text, ids in zip(own, coder.encode(own)):
        assert ids.tolist() == full.encode(text, add_special_tokens=False).ids, text[:60]
    assert coder.encode([]) == [] and sum(coder._plain(t) for t in own) > 150


def check_packing(rows, size):
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id] and r.length > 0
        at[r.sequence_id] += r.length
    assert max(at.values(), default=0) <= size
    return len(at)


@pytest.mark.parametrize("span", [best_fit.RANGE, 40])
def test_best_fit_packing(spark, docs, empty, monkeypatch, span):
    monkeypatch.setattr(best_fit, "RANGE", span)
    full = Tokenizer.from_file(PATH)
    for size in (64, 1024)[: 1 + (span == 40)]:
        rows = best_fit.pack(docs, PATH, size, 2, with_ids=True).collect()
        found, want = Counter(), Counter()
        for r in rows:
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
            found[r.doc_id, r.piece, r.start, tuple(r.ids)] += 1
        for i, t in texts():
            ids = [*full.encode(t or "", add_special_tokens=False).ids, 2]
            head = len(ids) % size or size
            cuts = [0, *range(head, len(ids), size), len(ids)]
            for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                want[i, piece, a, tuple(ids[a:b])] += 1
        assert found == want
        bound = best_fit.least_sequences(np.bincount([r.length for r in rows], minlength=size + 1), size)
        assert check_packing(rows, size) <= 1.05 * bound + 2
    assert best_fit.pack(empty, PATH).count() == 0


def sequential(lengths, size):
    """Sequences that best fit takes, the longest piece first."""
    rooms = []
    for x in sorted(lengths.tolist(), reverse=True):
        fit = min((i for i, r in enumerate(rooms) if r >= x), key=lambda i: rooms[i], default=None)
        if fit is None:
            rooms.append(size - x)
        else:
            rooms[fit] -= x
    return len(rooms)


@pytest.mark.parametrize("kind, span", [("even", best_fit.RANGE), ("small", 150), ("thirds", 150)])
def test_rounds_of_best_fit(spark, monkeypatch, kind, span):
    """Units alone: all placed, as few sequences as one after the other, and far fewer rounds than pieces."""
    monkeypatch.setattr(best_fit, "RANGE", span)
    rng = np.random.default_rng(7)
    n, size = 1000, 1024
    length = {"even": rng.integers(1, 1025, n), "small": rng.integers(100, 130, n), "thirds": np.where(rng.random(n) < 0.35, 300, rng.integers(1, 1025, n))}[kind]
    rounds = []
    one = best_fit._round
    monkeypatch.setattr(best_fit, "_round", lambda *a: rounds.append(a[2]) or one(*a))
    found = spark.createDataFrame([(i, int(x)) for i, x in enumerate(length)], "unit long, unit_length int")
    rows = best_fit.lay_out(found, size).collect()
    assert sorted(r.unit for r in rows) == list(range(n))
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += int(length[r.unit])
    assert max(at.values()) <= size and len(at) <= 1.01 * sequential(length, size) + 1 and len(rounds) <= 15


def test_the_bound_is_never_above_a_packing():
    rng = np.random.default_rng(1)
    for _ in range(200):
        size = int(rng.integers(5, 40))
        lengths = rng.integers(1, size + 1, rng.integers(1, 60))
        rooms = []
        for x in sorted(lengths.tolist(), reverse=True):
            fit = [i for i, r in enumerate(rooms) if r >= x]
            if fit:
                rooms[min(fit, key=lambda i: rooms[i])] -= x
            else:
                rooms.append(size - x)
        assert best_fit.least_sequences(np.bincount(lengths, minlength=size + 1), size) <= len(rooms)
    assert best_fit.least_sequences(np.bincount([300] * 9, minlength=1025), 1024) == 3
