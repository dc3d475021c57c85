"""Each corpus operator against a brute-force version on one hard little table, and on an empty one."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronogeo.llm import (
    arrays, boosting, chat, decontaminate, exact, jaccard, line_dedup, packing, quality, queries, sharding, stock, substring, token_counts, tokens,
    trie)

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash long, kept string, n long, part long, score_ double, row int"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["an", "Er", "ti", "öß", "x", "7"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, shared = prose(120), prose(60)
    out: list[tuple[int | None, str | None]] = [(1, base), (2, base), (3, base.replace(" ", "\t", 7)), (40, None), (41, ""), (42, " \n\t "), (43, "one"), (44, "one two")]
    for i in range(10, 30):
        own = prose(rng.randint(5, 200)).split(" ")
        if i % 3 == 0:
            own[3:3] = shared.split(" ")
        if i % 4 == 0:
            own = base.split(" ")
            for k in rng.sample(range(len(own)), i // 4 - 2):
                own[k] = word()
        out.append((i, " ".join(own)))
    lines = [prose(4) for _ in range(6)]
    out += [(50, "\n".join(lines)), (51, "\n".join(["first", *lines[2:5], "", "last"])), (52, "\n".join([lines[0], " ", lines[1]])), (53, "ha\n" * 40 + "\nha\nha")]
    out += [(60, "ha " * 500), (61, "ha " * 130 + "ho " + "ha hi " * 90), (62, "long " + prose(4000)), (None, base), (None, shared), (63, "<|endoftext|> a <|ENDOFTEXT|> it's .'s \"% İ ΑΣ é fin..,")]
    return out + [(2, base), (60, "ha " * 500)]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None, len(t or ""), 1, "x", 2, 3, 0.5, 4) for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def order(i):
    return i if i is not None else 1 << 63


def test_line_dedup(docs, empty):
    seen, want = {}, Counter()
    for i, t in sorted(set(texts()), key=lambda x: order(x[0])):
        lines = (t or "").split("\n")
        filled = [k for k, x in enumerate(lines) if not re.fullmatch(r"[\x20\x09-\x0D]*", x)]
        for a, b in zip(filled, filled[1:]):
            place = (order(i), a, b)
            seen[lines[a], lines[b]] = min(seen.get((lines[a], lines[b]), place), place)
    for i, t in texts():
        lines = (t or "").split("\n")
        filled = [k for k, x in enumerate(lines) if not re.fullmatch(r"[\x20\x09-\x0D]*", x)]
        gone = {k for a, b in zip(filled, filled[1:]) if seen[lines[a], lines[b]] < (order(i), a, b) for k in (a, b)}
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        want[i, None if t is None else kept, 0 if t is None else len(lines), len(gone)] += 1
    out = line_dedup.remove_lines(docs, 2, stats=True)
    assert got(out, "doc_id", "text", "n_lines", "n_removed") == want
    assert line_dedup.remove_lines(docs, 2).columns == docs.columns
    assert line_dedup.remove_lines(empty).count() == 0
    assert got(line_dedup.remove_lines(docs, 4, stats=True).filter("doc_id = 51"), "n_removed") == Counter([(0,)])


def test_selected_lines(spark):
    """Every window selects its last smallest hash, each selected line is one row, and longer runs go as in a plain search."""
    rng = random.Random(8)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "d", "", "e e"]) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = dict(spark.createDataFrame([(x,) for x in ("a", "b", "c", "d", "e e")], "t string").select("t", F.xxhash64("t")).collect())
    for run in (1, 2, 3, 5):
        picked, seen, gone = Counter(), {}, {}
        for i, t in rows:
            filled = [(k, x) for k, x in enumerate(t.split("\n")) if x]
            lows = [min(filled[p:p + run], key=lambda c: (prints[c[1]], -c[0]))[0] for p in range(len(filled) - run + 1)]
            picked.update((i, at, n + run - 1) for at, n in Counter(lows).items())
            for p in range(len(lows)):
                if seen.setdefault(tuple(x for _, x in filled[p:p + run]), (i, p)) != (i, p):
                    gone.setdefault(i, set()).update(k for k, _ in filled[p:p + run])
        keyed = line_dedup.with_key(docs)
        assert got(line_dedup.selected_lines(keyed, run).select("ord", "at", F.size("around")), *["ord", "at", "size(around)"]) == picked
        out = line_dedup.remove_lines(docs, run, stats=True)
        assert got(out, "doc_id", "n_removed") == Counter((i, len(gone.get(i, ()))) for i, _ in rows)


def test_sharding(spark, docs, empty):
    for limit in (100, 600, 3000, 1 << 30):
        rows = sharding.assign_shards(docs, limit).collect()
        assert Counter((r.doc_id, r.n_bytes) for r in rows) == Counter((i, len((t or "").encode())) for i, t in texts())
        load, count = Counter(), Counter()
        for r in rows:
            load[r.shard, r.part] += r.n_bytes
            count[r.shard, r.part] += 1
        assert all(n <= limit or count[k] == 1 for k, n in load.items())
        bits = {i: f"{int(hashlib.md5(f'{'' if i is None else i}:{t or ""}'.encode()).hexdigest()[:15], 16):060b}" for i, t in texts() if i}
        for r in rows:
            assert r.doc_id is None or bits[r.doc_id].startswith(r.shard)
            parent = [x for x in rows if x.shard[: r.depth - 1] == r.shard[: r.depth - 1]]
            assert not r.depth or sum(x.n_bytes for x in parent) > limit  # nothing was split in vain
    same = spark.createDataFrame([(1, "x" * 10)] * 25, "doc_id long, text string")
    assert sorted(Counter(r.part for r in sharding.assign_shards(same, 40).collect()).values()) == [1, 4, 4, 4, 4, 4, 4]
    assert sharding.assign_shards(empty, 10).count() == 0


def test_write_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, 2000, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert got(back, "doc_id", "text") == Counter(texts())


def test_substring(docs, empty):
    for size in (50, 40):
        first = {}
        for i, t in texts():
            ws = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            for s in range(len(ws) - size + 1):
                first[tuple(ws[s:s + size])] = min(first.get(tuple(ws[s:s + size]), order(i)), order(i))
        want = Counter()
        for i, t in texts():
            ws = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            gone = {k for s in range(len(ws) - size + 1) if first[tuple(ws[s:s + size])] < order(i) for k in range(s, s + size)}
            want[i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)] += 1
        assert got(substring.remove_repeats(docs, size), "doc_id", "n_words", "n_removed", "kept") == want
    assert substring.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        substring.remove_repeats(docs, 10)


def test_symbols_are_the_same_in_every_context():
    rng = np.random.default_rng(3)
    for _ in range(200):
        inner = rng.integers(0, 4, 50).astype(np.uint64)
        found = []
        for _ in range(2):
            left, right = (rng.integers(0, 4, rng.integers(0, 30)).astype(np.uint64) for _ in range(2))
            name, at = substring.recompress(arrays.mix(np.concatenate([left, inner, right])), np.zeros(len(left) + 50 + len(right), int))
            at = at - len(left)
            sure = (at >= substring.SPAN) & (at <= 50 - 2 * substring.SPAN)
            assert sure.any() and np.diff(at).max(initial=0) <= substring.SPAN
            found.append(list(zip(name[sure].tolist(), at[sure].tolist())))
        assert found[0] == found[1]


def test_exact(docs, empty):
    groups = {}
    for i, t in texts():
        groups.setdefault(t or "", []).append(i)
    for keep, pick in (("largest", max), ("smallest", min)):
        best = {t: pick((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
        want = Counter((i, best[t or ""], len(groups[t or ""]), i == best[t or ""], sha(t or "")) for i, t in texts())
        for hash_of in (exact.content_hash, lambda c: F.length(c) % 3):  # the second collides all the time
            out = exact.mark_copies(docs, keep, hash_of)
            assert got(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    assert exact.mark_copies(empty).count() == 0


@pytest.mark.parametrize("block", [100_000, 7])
def test_decontamination(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    base = texts()[0][1]
    items = [(1, " ".join(base.split(" ")[30:60])), (2, "ONE, two!"), (3, ""), (4, None), (5, "an"), (None, "one two"), (6, "never there at all"), (1, "ha ha ha"), (10, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {(i, tuple(w[s:s + 13])) for i, t in items if (w := words(t)) for s in range(max(1, len(w) - 12))}
    want = Counter()
    for i, t in texts():
        w, hit, found = words(t), set(), set()
        for item, x in windows:
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s:s + len(x)]) == x:
                    hit |= set(range(s, s + len(x)))
                    found |= {str(item)} if item is not None else set()
        want[i, len(w), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    out = decontaminate.report(docs, bench).withColumn("items", F.array_join("items", ","))
    assert got(out, "doc_id", "n_words", "n_hit", "items", "contaminated") == want
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(k[0] for k in want.elements() if not k[4])
    spans = decontaminate.decontaminate(docs, bench, "spans")
    assert spans.count() == docs.count() and decontaminate.report(spans.filter("doc_id = 44"), bench).first().n_words == 0
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("block, kinds", [(jaccard.BLOCK, ((3, 90), (1, 80))), (500, ((1, 80),))])
def test_jaccard(docs, empty, block, kinds):
    for size, percent in kinds:
        sets = []
        for i, t in texts():
            w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
            sets.append((order(i), {tuple(w[s:s + size]) for s in range(max(1, len(w) - size + 1))} if w else set()))
        low = {i: i for i, _ in sets}
        for _ in range(len(sets)):
            for i, a in sets:
                for j, b in sets:
                    if a and b and 100 * len(a & b) >= percent * len(a | b):
                        low[i] = low[j] = min(low[i], low[j])
        want = Counter((i if i < 1 << 63 else None, len(s), low[i] if low[i] < 1 << 63 else None) for i, s in sets)
        assert got(jaccard.link_components(docs, size, percent, block), "doc_id", "n_shingles", "component_id") == want
    assert jaccard.link_components(empty).count() == 0
    with pytest.raises(ValueError):
        jaccard.link_components(docs, 1, 40)


def test_an_id_with_several_texts_connects_them(spark):
    rows = [(2, "a b c d"), (3, "k l m n"), (5, "a b c d"), (5, "k l m n"), (6, "q r s t")]
    out = jaccard.link_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in out.collect()} == {(2, 2), (3, 2), (5, 2), (6, 6)}


def brute_links(sets, percent):
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def test_trie_joins():
    """Families of sets with shared beginnings, sizes from 1 to 300, chance overlaps in all of them."""
    rng = np.random.default_rng(6)
    common = rng.integers(1, 1 << 60, 40).astype(np.uint64)
    for percent in (50, 80, 90):
        sets = [np.unique(rng.choice(common, rng.integers(1, 30)))]
        for _ in range(12):
            base = np.unique(np.append(rng.integers(1, 1 << 60, rng.integers(1, 300)).astype(np.uint64), rng.choice(common, rng.integers(0, 30))))
            for _ in range(rng.integers(1, 9)):
                keep = base[rng.random(len(base)) > rng.random() * 0.3]
                sets.append(np.unique(np.append(keep, rng.integers(1, 1 << 60, rng.integers(1, 2 + len(base) // 8)).astype(np.uint64))))
        plain = [set(s.tolist()) for s in sets]
        want = brute_links(plain, percent)
        assert trie.link_sets(sets, percent, np.arange(len(sets))).tolist() == want
        known = np.array([min(j for j, r in enumerate(want) if r == w) if i % 3 else i for i, w in enumerate(want)])
        assert trie.link_sets(sets, percent, known).tolist() == want
        tree = trie.Trie(sets, percent)
        for x in range(len(sets)):
            open_ = np.arange(len(sets)) != x
            found = {j for j, s in enumerate(plain) if j != x and 100 * len(plain[x] & s) >= percent * len(plain[x] | s)}
            assert set(tree.join(x, open_).tolist()) == found
    same = [np.arange(100, dtype=np.uint64)] * 5
    assert [len(level.above) for level in trie.Trie(same, 90).levels] == [1] * 7  # one path for all


def test_words_of_regular_letters_differ(spark):
    """Thue-Morse words and their complements, whose sums of powers are equal modulo 2**64 for every odd base."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"w{i}" for i in range(120))
    rows = [(1, f"{word} {tail}"), (2, f"{other} {tail}"), (3, word), (4, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring.remove_repeats(docs).collect()} == {1: 0, 2: 120, 3: 0, 4: 0}
    assert {r.component_id for r in jaccard.link_components(docs, 1).filter("doc_id > 2").collect()} == {3, 4}
    data = [x.encode() for x in (word, other, word)]
    coder = tokens.Encoder(PATH, True)
    ids, first = coder.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    for k, text in enumerate((word, other, word)):
        assert ids[first[k]:first[k + 1]].tolist() == ids_of(text)


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(arrays, "word_hash", lambda data, start, end: (end - start).astype(np.uint64))
    text = b"ab cd ab ef gh cd"
    ids, _ = tokens.Encoder(PATH, True).encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert ids.tolist() == ids_of(text.decode())


def test_settings_of_the_session_stay(spark, docs):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")}
    packing.pack(docs, PATH).count()
    jaccard.link_components(docs.limit(5)).count()
    assert {k: spark.conf.get(k, None) for k in before} == before


def test_jaccard_finds_every_link_at_the_threshold(spark):
    rng = random.Random(8)
    rows = []
    for k in range(120):
        own = [f"w{rng.randrange(10**9)}" for _ in range(rng.randint(5, 120))]
        rows.append((2 * k, " ".join(own)))
        n = len(own)
        drop = set(rng.sample(range(n), n // 10 - (n // 10 and rng.randint(0, 1))))
        rows.append((2 * k + 1, " ".join(w for i, w in enumerate(own) if i not in drop)))
    out = {r.doc_id: r.component_id for r in jaccard.link_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 90).collect()}
    words = {i: set(t.split()) for i, t in rows}
    for k in range(120):
        a, b = words[2 * k], words[2 * k + 1]
        assert out[2 * k + 1] == (2 * k if 100 * len(a & b) >= 90 * len(a | b) else 2 * k + 1)


def ids_of(text, specials=True):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = not specials
    return t.encode(text or "", add_special_tokens=False).ids


def test_packing(docs, empty):
    ids = Counter()
    for r in packing.pack(docs, PATH, with_ids=True).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
        ids[r.doc_id, r.start, tuple(r.ids), r.doc_tokens] += 1
    want = Counter()
    for i, t in texts():
        x = [*ids_of(t), 1]
        for s in range(0, len(x), 2048):
            want[i, s, tuple(x[s:s + 2048]), len(x)] += 1
    assert ids == want
    at = {}
    for r in packing.pack(docs, PATH).orderBy("sequence_id", "offset").collect():
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048 and len(at) <= -(-sum(at.values()) // 2048) + 1
    assert packing.pack(empty, PATH).count() == 0


def test_stock_covers_all_pieces():
    rng = np.random.default_rng(0)
    for n in (1, 40, 5000):
        demand = np.bincount(rng.integers(0, 64, n), minlength=64)
        held, bins = np.zeros(64, int), 0
        for times, pattern in stock.plan(demand):
            assert sum(s * k for s, k in pattern.items()) <= 64
            bins += times
            for s, k in pattern.items():
                held[s - 1] += times * k
        assert (held == demand).all()
    lower = -(-(demand * np.arange(1, 65)).sum() // 64)
    assert bins <= 1.1 * lower + 1


def test_token_counts(spark, docs, empty, tmp_path):
    token_counts.write_token_files(docs, PATH, 49407, str(tmp_path / "t"))
    out = token_counts.count_tokens(spark, str(tmp_path / "t"), 49407)
    want = Counter(len(ids_of(t, False)) for _, t in texts())
    assert Counter(r.n_tokens for r in out.collect()) == want
    for block in (1, 7, 64):  # blocks that begin and end everywhere
        small = token_counts.count_tokens(spark, str(tmp_path / "t"), 49407, block)
        assert got(small, *small.columns) == got(out, *out.columns)
    token_counts.write_token_files(empty, PATH, 49407, str(tmp_path / "none"))
    assert token_counts.count_tokens(spark, str(tmp_path / "none"), 49407).count() == 0
    (tmp_path / "flat").mkdir()
    np.array([5, 9, 9, 6, 7], "<u2").tofile(tmp_path / "flat/a.bin")
    rows = token_counts.count_tokens(spark, str(tmp_path / "flat"), 9, 2).orderBy("doc").collect()
    assert [(r.doc, r.start, r.n_tokens, r.closed) for r in rows] == [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 2, False)]
    (tmp_path / "flat/b.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole ids"):
        token_counts.count_tokens(spark, str(tmp_path / "flat"), 9).collect()


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (60, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in texts())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(empty, labels).count() == 0
    assert quality.keep_accepted(docs, labels).columns == docs.columns


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(scored) > 50 and sum(r.predicted == r.quality for r in scored) >= 0.95 * len(scored)


def test_trees():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = boosting.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.98
    assert model.score(x[:0]).shape == (0,) and boosting.fit(x[:5], y[:5] * 0).score(x).max() < 0.1


def test_chat(spark):
    bad = "\\### </turn>\n<turn assistant> \\\\<\\"
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, 0, None, None), (None, 5, "as>s\\<", "x"), (3, None, "assistant", "ü")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(turns)
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] if r[1] is not None else -1, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    size = {r.conv_id: r.n for r in formatted.groupBy("conv_id").agg(F.sum(F.char_length("formatted")).alias("n")).collect()}
    for r in chat.read_back(formatted).collect():
        own = want.pop(r.conv_id)
        loss = "".join(t for role, t in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{a}\n{b}\n" for a, b in own)))
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(loss), sha(loss), size[r.conv_id])
    assert not want
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


def test_chat_layouts(spark):
    records = ['{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":null}]}', '{"id":7,"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
               '{"role":"human","content":"x"}', '{"prompt":"q","response":"a"}', '{"instruction":"q","input":"i","output":"a"}', '{"what":1}', "no json", None, '{"messages":[]}']
    rows = spark.createDataFrame([(i, 0, r) for i, r in enumerate(records)], "conv_id long, turn long, record string")
    out = {}
    for r in chat.canonical_turns(rows).orderBy("conv_id", "turn").collect():
        out.setdefault(r.conv_id, []).append((r.role, r.text) if r.unknown is None else "unknown")
    qa = [("user", "q"), ("assistant", "a")]
    assert out == {0: [("user", "q"), ("assistant", "")], 1: qa, 2: [("human", "x")], 3: qa, 4: [("user", "q\n\ni"), ("assistant", "a")],
                   5: ["unknown"], 6: ["unknown"], 7: ["unknown"]}


def test_roles_of_conversations_stay(spark, tmp_path):
    """The query feeds several layouts; roles that some layouts rename come back as they were."""
    rows = [(c, t, role, f"text {c} {t}") for c in range(12) for t, role in enumerate(("human", "gpt", "assistant", "tool"))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    out = {r.conv_id: r for r in queries.op9_chat_formatting(spark, str(tmp_path)).collect()}
    assert set(out) == {-7, *range(12)}
    for c in range(12):
        own = [r for r in rows if r[0] == c]
        assert out[c].turns_sha256 == sha("".join(f"{r[2]}\n{r[3]}\n" for r in own)) and out[c].loss_sha256 == sha(f"text {c} 2")


def test_pipeline(spark, docs):
    import corpus_pipeline

    sf, kept = "/root/testdata/sf0.001", docs
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, kept, sf)
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.collect()} <= {i for i, _ in texts()}
        kept = out
    ids = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, sf).collect()}
    assert 1 in ids and not ids & {2, 3} and {40, 41, 42} <= ids
    assert corpus_pipeline.STAGES[4][1](spark, docs.limit(0), sf).count() == 0


def test_pipeline_near_copies_take_five_words(spark):
    """0.811 of the five-word and 0.885 of the three-word shingles are shared: one of the two stays."""
    import corpus_pipeline

    words = [f"w{i}" for i in range(100)]
    other = [w + "x" * (i in (30, 70)) for i, w in enumerate(words)]
    far = [w + "x" * (i in (30, 50, 70)) for i, w in enumerate(words[::-1])]
    rows = [(5, " ".join(words)), (9, " ".join(other)), (11, " ".join(far)), (12, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()} == {5, 11, 12}


def test_jaccard_of_very_short_sets(spark):
    """Sets of 1 to 14 words, many of which fill few subtrees; copies have words swapped, added or left out."""
    rng = random.Random(5)
    sets = [[f"w{rng.randrange(5000)}" for _ in range(rng.randrange(1, 15))] for _ in range(1500)]
    for i in range(0, 1500, 2):
        words = list(sets[i])
        for _ in range(rng.randrange(1, 3)):
            if rng.random() < 0.5:
                words.append(f"w{rng.randrange(5000)}")
            else:
                words.pop(rng.randrange(len(words)))
            words = words or ["w"]
        sets.append(words)
    docs = spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(sets)], "doc_id long, text string")
    root = list(range(len(sets)))
    holders: dict[str, list[int]] = {}
    for i, s in enumerate(sets):
        own = set(s)
        for j in sorted({j for w in own for j in holders.get(w, [])}):
            other = set(sets[j])
            if 100 * len(own & other) >= 80 * len(own | other):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root] if a != b else root
        for w in own:
            holders.setdefault(w, []).append(i)
    got = {r.doc_id: r.component_id for r in jaccard.link_components(docs, 1, 80).collect()}
    assert got == dict(enumerate(root))
    assert sum(r != i for i, r in enumerate(root)) > 200


def test_words_are_split_as_they_are_matched(spark):
    texts = ["", " ", "One two", "  One,TWO  3-four_", "Äpfel ÀB straße İI", "日本 x", "a\u0000B\u007fC\u0080D", "...", "ǅ K\u212a end.", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    both = df.select(decontaminate.word_list(F.col("text")).alias("a"), F.transform(
        decontaminate.any_case_words(F.col("text")), decontaminate.small_letters).alias("b")).collect()
    assert all(r.a == r.b for r in both)


def test_only_ids_of_contaminated_documents_meet_the_rows(spark):
    """What is contaminated is stored first: as a small table it is broadcast, and no text is shuffled."""
    item = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, item.upper()), (2, "w1 w2"), (2, item), (None, None)], "doc_id long, text string")
    out = decontaminate.decontaminate(docs, spark.createDataFrame([("b", item)], "item_id string, text string"))
    assert sorted((tuple(r) for r in out.collect()), key=str) == [(2, "w1 w2"), (None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "ObjectHashAggregate" not in plan and "hashpartitioning" not in plan
