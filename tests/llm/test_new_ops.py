"""Packing, clustering and resampling: against plain loops, on odd inputs, and their trees, programs and pieces by themselves."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeloom.llm import dual_tree, near_dedup, packing, resample, token_ids

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# --- packing


def laid_out(counts, length):
    """A plan's pieces, checked: each item whole once, sequences without gaps and not too long. Returns sequence sizes and cuts."""
    plan = packing.Plan(dict(counts), length)
    sizes = np.concatenate([np.full(n, s) for s, n in counts.items()]).astype(np.int64)
    ranks = np.concatenate([np.arange(n) for n in counts.values()]).astype(np.int64)
    row, start, size, seq, offset = plan.places(sizes, ranks)
    items, sequences = defaultdict(list), defaultdict(list)
    for r, s, n, q, o in zip(*(z.tolist() for z in (row, start, size, seq, offset)), strict=True):
        items[r].append((s, n))
        sequences[q].append((o, n))
    for i, want in enumerate(sizes.tolist()):
        assert [s for s, _ in sorted(items[i])] == list(itertools.accumulate([0, *[n for _, n in sorted(items[i])][:-1]])) and sum(n for _, n in items[i]) == want
    for q in sequences.values():
        q.sort()
        assert [o for o, _ in q] == list(itertools.accumulate([0, *[n for _, n in q][:-1]]))
    filled = [sum(n for _, n in q) for q in sequences.values()]
    assert max(filled) <= length and len(filled) == plan.sequences and plan.padding == sum(length - f for f in filled)
    return filled, len(row) - len(sizes)


@pytest.mark.parametrize("name", ["uniform", "hot", "large", "small", "one", "thirds"])
def test_plans_waste_little_and_lose_nothing(name):
    rng = np.random.default_rng(5)
    items = {
        "uniform": rng.integers(1, 1024, 20_000), "hot": np.r_[rng.integers(1, 1024, 5_000), np.full(9_000, 600)], "large": rng.integers(700, 1024, 5_000),
        "small": np.minimum(1023, rng.geometric(1 / 50, 5_000)), "one": np.array([485]), "thirds": np.full(999, 341),
    }[name]
    filled, cuts = laid_out(Counter(items.tolist()), 1024)
    assert sum(1024 - f for f in filled) <= 1023 + 0.005 * items.sum()
    assert cuts <= {"uniform": 1500, "thirds": 0, "one": 0}.get(name, len(filled))


def test_plans_of_all_small_problems():
    rng = random.Random(2)
    for _ in range(200):
        length = rng.choice([4, 7, 16])
        laid_out(Counter(rng.randint(1, length - 1) for _ in range(rng.randint(1, 40))), length)


def test_linear_program_reaches_the_optimum(monkeypatch):
    monkeypatch.setattr(packing, "GAP", 0.0)
    # three items of 5 fill 15 of 16, and 11 + 5 fills 16: ten 11s take ten 5s, the other 20 go by threes
    master = packing.Master({11: 10, 5: 30}, 16)
    master.solve()
    assert master.x.sum() == pytest.approx(10 + 20 / 3)
    rng = np.random.default_rng(1)
    for _ in range(20):
        counts = Counter(rng.integers(1, 12, 30).tolist())
        master = packing.Master(counts, 12)
        master.solve()
        value = np.full(13, -np.inf)
        value[master.sizes] = master.y
        assert packing.knapsack(value, 12)[0][12] <= 1 + 1e-6  # no pattern improves: the duals prove it
        assert all(sum(s * n for s, n in uses.items()) <= 12 for uses in master.basis)


def test_knapsack_against_all_multisets():
    value = np.array([-np.inf, 0.2, -np.inf, 0.75, 0.9, -np.inf, -np.inf])
    best, took = packing.knapsack(value, 6)
    for c in range(7):
        want = max(0.2 * a + 0.75 * b + 0.9 * d for a in range(7) for b in range(3) for d in range(2) if a + 3 * b + 4 * d <= c)
        uses = packing.filled(took, c, {})
        assert best[c] == pytest.approx(want) == pytest.approx(sum(value[s] * n for s, n in uses.items())) and sum(s * n for s, n in uses.items()) <= c


def test_pack_returns_every_id_once(spark, odd_docs, no_docs):
    got = [r.asDict() for r in packing.pack(odd_docs, VOCABULARY, length=64).collect()]
    encoder = token_ids.token_ids(VOCABULARY)
    want = Counter((r.doc_id, (encoder.by_library([r.text or ""])[0] + b"\0" * 4)) for r in odd_docs.collect())
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] <= 256
        parts[r["doc_id"], r["doc_tokens"]].append((r["start"], r["ids"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for (doc, ids), n in want.items():
        mine = sorted(parts[doc, len(ids) // 4])
        if n == 1:
            assert b"".join(x for _, x in mine) == ids
        else:
            assert sum(len(x) for _, x in mine) == n * len(ids)
    for q in sequences.values():
        q.sort()
        assert [o for o, _ in q] == list(itertools.accumulate([0, *[n for _, n in q][:-1]])) and sum(n for _, n in q) <= 64
    assert sum(64 - sum(n for _, n in q) for q in sequences.values()) < 64 + 0.01 * sum(r["length"] for r in got)
    assert packing.pack(no_docs, VOCABULARY).count() == 0
    digest = packing.piece_digests(packing.pack(odd_docs.where("doc_id = 1"), VOCABULARY)).collect()
    (ids,) = encoder.by_library([odd_docs.where("doc_id = 1").first().text])
    assert [r.ids_crc32 for r in digest] == [zlib.crc32(ids + b"\0" * 4)]


def test_token_ids_are_the_librarys():
    encoder = token_ids.token_ids(VOCABULARY)
    assert encoder.fast is not None
    # every code point, as letter, number, space or neither: between letters, digits, marks and spaces
    for lo in [*range(0, 0x3000, 512), *range(0x3000, 0x110000, 8192)]:
        chars = [chr(c) for c in range(lo, lo + 512) if not 0xD800 <= c < 0xE000]
        texts = [f"a{c}a 1{c}1 !{c}! {c} {c}x{c}\n\n{c}{c} z" for c in chars]
        assert [encoder.by_ranks(t) for t in texts] == encoder.by_library(texts)
    rng = random.Random(3)
    parts = [" ", "  ", "\n", " \n", "\t", "é", "word", "don't", "'s", "12", "!", "...", "<|endoftext|>", "\x1c", "日本", "​", "🙂", "á", "\r\n", "²", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    assert encoder.encode(texts) == encoder.by_library(texts)


# --- clustering


def plain_lloyd(rows, k, rounds, dimensions):
    """rows: (id, vector) as kept."""
    pts = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    cents = [v for _, v in sorted(pts, key=lambda p: (hashlib.sha256(f"3:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(cents))
    for _ in range(rounds):
        by = defaultdict(list)
        for _, v in pts:
            by[near(v)[1]].append(v)
        cents = [[sum(col) // len(by[i]) for col in zip(*by[i], strict=True)] if by[i] else c for i, c in enumerate(cents)]
    got = [(i, *near(v)[::-1]) for i, v in pts]
    inertia = Counter()
    for _, c, d in got:
        inertia[c] += d
    return Counter((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for i, c, d in got)


def test_clusters_match_plain_rounds(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (5, 3))
    rows = [(i, [float(x) for x in centres[i % 5] + rng.normal(0, 0.2, 3)]) for i in range(300)]
    rows += [(300 + i, [0.5, 0.25, -1.0]) for i in range(40)]  # equal vectors
    rows += [(1, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0]), (None, None), (900, []), (901, [1.0, 2.0]), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0]), (904, [float("inf"), 1.0, 2.0]), (905, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("_id", "_v", "cluster", "distance", "tree")})
    for k, rounds in ((5, 3), (1, 2), (400, 1)):
        got = Counter(tuple(r) for r in dual_tree.cluster_report(df.repartition(3), k=k, rounds=rounds, dimensions=3).collect())
        assert got == plain_lloyd(rows, k, rounds, 3)
    assert dual_tree.cluster_report(df.limit(0), dimensions=3).count() == 0


def test_clusters_of_large_numbers(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([(1e6, 0), (1e6, 1), (-1e6, 0), (0, 0), (0, 1e-3), (3e5, 2e5)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(tuple(r) for r in dual_tree.cluster_report(df, k=2, rounds=2, dimensions=2).collect())
    assert got == plain_lloyd(rows, 2, 2, 2)
    wide = spark.createDataFrame([(1, [1e15, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert {(r.distance, r.inertia) for r in dual_tree.cluster_report(wide, k=1, rounds=0, dimensions=2).collect()} == {(0, None), (None, None)}


def test_cover_trees_cover(monkeypatch):
    rng = np.random.default_rng(6)
    for n, dim, spread in ((1, 2, 1), (50, 2, 10), (300, 8, 1000), (120, 3, 2)):
        x = rng.integers(-spread, spread + 1, (n, dim)).astype(np.int64)
        tree = dual_tree.Tree(x, leaf=4)
        assert sorted(tree.order.tolist()) == list(range(n)) and (tree.lo[0], tree.hi[0]) == (0, n)
        p = x[tree.order]
        for i in range(len(tree.lo)):
            assert tree.lo[i] <= tree.centre[i] < tree.hi[i]
            assert (np.sqrt(((p[tree.lo[i] : tree.hi[i]] - p[tree.centre[i]]) ** 2).sum(1)) <= tree.reach[i] + 1e-9).all()
            if tree.kids[i]:
                kids = range(tree.first[i], tree.first[i] + tree.kids[i])
                assert [tree.lo[k] for k in kids] == [tree.lo[i], *[tree.hi[k] for k in kids][:-1]] and tree.hi[kids[-1]] == tree.hi[i]
                assert tree.centre[i] in [tree.centre[k] for k in kids]
        back = dual_tree.Tree.unpacked(tree.packed())
        assert all((getattr(back, f) == getattr(tree, f)).all() for f in ("lo", "hi", "centre", "first", "kids", "reach"))


def test_dual_traversal_is_exact_and_prunes():
    rng = np.random.default_rng(7)
    for _ in range(150):
        n, dim, k = int(rng.integers(1, 150)), int(rng.integers(1, 5)), int(rng.integers(1, 30))
        p = rng.integers(-5, 6, (n, dim)) * int(rng.choice([1, 1000, 2**24]))
        c = rng.integers(-5, 6, (k, dim)) * int(rng.choice([1, 1000, 2**24]))
        tree = dual_tree.Tree(p, leaf=int(rng.integers(1, 6)))
        q = p[tree.order]
        assert (dual_tree.nearest(q, tree, c) == ((q[:, None] - c[None]) ** 2).sum(-1).argmin(1)).all()
    far = np.concatenate([rng.integers(0, 50, (200, 4)) + 10_000 * i for i in range(4)])
    tree, seen = dual_tree.Tree(far), {}
    dual_tree.nearest(far[tree.order], tree, np.array([[25] * 4, [10_025] * 4, [20_025] * 4, [30_025] * 4]), seen)
    assert seen == {"unseen": 800}


# --- resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return w, w + [f"{a} {b}" for a, b in itertools.pairwise(w)]


def plain_resample(docs, target, percent=25, buckets=10_000):
    s, t = Counter(), Counter()
    for texts, to in (([x for _, x in docs], s), (target, t)):
        for x in texts:
            to.update(zlib.crc32(f.encode()) % buckets for f in plain_features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        w, f = plain_features(x)
        g = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in (zlib.crc32(y.encode()) % buckets for y in f)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    ok = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    ranks = {id(r): n for n, r in enumerate(ok[: percent * len(ok) // 100], 1)}
    return Counter((r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in out)


def test_resample_matches_plain_loops(spark, odd_docs, no_docs, monkeypatch):
    rng = random.Random(9)
    words = "the of a river Moon étoile ночь x1 2 under_score".split()
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(150)] + [(7, docs_text := "Moon river " * 15), (7, docs_text), (None, docs_text), (None, docs_text), (200, None), (201, "")]
    target = ["the moon of the river", "river moon", None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("score", "rank", "_id", "n_words", "sums")}).repartition(3)
    tg = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    want = plain_resample(docs, target)
    for size in (resample.SLICE_BYTES, 60):  # 60: long texts come in pieces
        monkeypatch.setattr(resample, "SLICE_BYTES", size)
        assert Counter(tuple(r) for r in resample.resample(df, tg).collect()) == want
        monkeypatch.undo()
    assert Counter(tuple(r) for r in resample.resample(df, tg, percent=0).collect()) == plain_resample(docs, target, 0)
    assert resample.resample(no_docs, tg).count() == 0
    assert Counter(tuple(r) for r in resample.resample(df, tg.limit(0)).collect()) == plain_resample(docs, [])
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter(tuple(r) for r in resample.resample(odd_docs, tg, percent=100).collect()) == plain_resample(odd, target, 100)


def test_long_pieces_join_to_the_whole():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice(["a", "B", "é", " ", "\n", "_", "9", "-", "日"]) for _ in range(rng.randint(0, 80)))
        for size in (1, 5, 30):
            pieces = list(resample.long_pieces(text, size))
            assert "".join(p for _, p in pieces) == text
            features = Counter()
            for carry, piece in pieces:
                w, f = plain_features(piece)
                features.update(f)
                if carry and w:
                    features[f"{carry} {w[0]}"] += 1
            assert features == Counter(plain_features(text)[1])


def test_crc_is_zlibs():
    texts = ["", "a", "é b", "日本 語" * 50]
    assert resample.crc32_of(pa.array(texts)).to_pylist() == [zlib.crc32(t.encode()) for t in texts]


def test_ranks_over_ranges(spark):
    rows = spark.range(5000).selectExpr("id", "hash(id) % 50 AS s").repartition(7)
    got = {r.id: r["rank"] for r in resample._ranked(rows, [F.desc("s"), F.asc("id")]).collect()}
    want = {r.id: n for n, r in enumerate(sorted(rows.collect(), key=lambda r: (-r.s, r.id)), 1)}
    assert got == want


# --- near duplicates under repeated and null ids


def test_unrelated_texts_under_one_id_stay(spark):
    words = [f"w{i}" for i in range(60)]
    a, near, other = " ".join(words), " ".join([*words[:-1], "end"]), " ".join(f"z{i}" for i in range(40))
    rows = [(3, near), (5, a), (5, other)]
    for order in itertools.permutations(rows):
        df = spark.createDataFrame(list(order), "doc_id long, text string").coalesce(1)
        kept = sorted(map(tuple, near_dedup.keep_one(df).collect()))
        assert kept == [(3, near), (5, other)]
        got = sorted((r.doc_id, r.class_id, r.class_size, r.kept) for r in near_dedup.near_classes(df).collect())
        assert got == [(3, 3, 2, True), (5, 3, 2, False), (5, 5, 1, True)]


def test_rows_without_id_are_compared(spark):
    words = [f"w{i}" for i in range(60)]
    a, near = " ".join(words), " ".join([*words[:-1], "end"])
    df = spark.createDataFrame([(None, a), (4, near), (None, near), (None, ""), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.class_id, r.class_size, r.kept) for r in near_dedup.near_classes(df).collect()), key=str)
    assert got == sorted([(0, 4, 3, False), (4, 4, 3, True), (0, 4, 3, False), (0, None, 1, True), (0, None, 1, True)], key=str)
    only = spark.createDataFrame([(None, a), (None, near)], "doc_id long, text string")
    assert near_dedup.keep_one(only).count() == 1


# --- pages


def test_deep_lists_keep_their_depth():
    from citeloom.llm import html_text

    page = "<ul><li>x" * 300 + "</li></ul>" * 300
    lines = html_text.render(page).split("\n")
    assert len(lines) == 300 and [len(x) - len(x.lstrip(" -")) for x in lines] == [2 * (i + 1) for i in range(300)]
    assert max(map(len, html_text.render(page, max_indent=50).split("\n"))) <= 52


# --- chat formatting


def test_long_conversations_and_clashing_columns(spark):
    from citeloom.llm import chat_format

    turns = [(1, t, "assistant" if t % 2 else "user", "word " * 50) for t in range(400)] + [(2, 0, "user", "x" * 200_000), (2, 1, "assistant", "y" * 200_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("example", "loss", "_turn", "n_turns", "prompt", "_id")})
    got = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.prefix_examples(df)).collect()}
    for c in (1, 2):
        mine = [(r, x) for i, _, r, x in turns if i == c]
        assert got[c].n_turns == len(mine) and got[c].loss_chars == sum(len(x) for r, x in mine if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in mine).encode()).hexdigest()
