"""N-gram join and passages against brute force, with odd rows."""

import random
import re

import numpy as np
import pytest

from llm_fixtures import make_docs  # noqa: F401
from paperloom.llm import chaining, ngram_join
from paperloom.llm.graph import components

SYL = ["an", "er", "th", "on", "re", "ti", "en", "ou", "ha", "ble", "sh", "ing"]


def prose(rng, n):
    return ["".join(rng.choice(SYL) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def shingles(text, n):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if len(ws) >= n else ({tuple(ws)} if ws else set())


def brute_components(rows, n, percent):
    """Component of each id, by comparing all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1 :]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in sets}


def families(rng):
    rows, i = [], 0
    for size in (3, 8, 30, 200):
        for _ in range(6):
            base = prose(rng, size)
            for _ in range(rng.randint(1, 12)):
                copy = list(base)
                for _ in range(rng.randint(0, max(1, size // 25))):
                    copy[rng.randrange(len(copy))] = rng.choice(SYL)
                rows.append((i, " ".join(copy)))
                i += 1
    rng.shuffle(rows)
    return rows


ODD = [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "one"), (9005, "One"), (9006, "one  two"), (None, "one"), (9004, "one"), (9007, "é x y z"), (9008, "É x y z")]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_components(spark, make_docs, n, percent):
    rows = families(random.Random(n)) + ODD
    want = brute_components(rows, n, percent)
    got = ngram_join.jaccard_components(make_docs(rows), n=n, percent=percent).collect()
    assert len(got) == len(rows)
    assert {r["id"]: r["component_id"] for r in got if r["id"] is not None} == want
    assert all(r["component_id"] is None for r in got if r["id"] is None)
    sizes = {i: len(shingles(t, n)) for i, t in rows if i is not None}
    assert {r["id"]: r["n_shingles"] for r in got if r["id"] is not None} == sizes


def test_components_over_several_chunks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(ngram_join, "SAMPLED", 1)
    rng = random.Random(4)
    base, rows = prose(rng, 120), []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(SYL)
        rows.append((i, " ".join(copy)))
    got = ngram_join.jaccard_components(make_docs(rows), n=3, percent=90).collect()
    assert {r["id"]: r["component_id"] for r in got} == brute_components(rows, 3, 90)


@pytest.mark.parametrize("percent", [40, 80, 90])
def test_survivors_lose_no_link(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for size in (1, 3, 20, 40, 300, 700):
        for _ in range(8):
            base = rng.integers(0, 2**48, size, dtype=np.uint64)
            sets += [np.unique(np.concatenate([base[: rng.integers(size // 2, size) + 1], rng.integers(0, 2**48, rng.integers(0, size // 3 + 1), dtype=np.uint64)])) for _ in range(3)]
    maps = [ngram_join.bitmap(s, ngram_join.bitmap_bits(len(s))).tobytes() for s in sets]
    sizes, labels = np.array([len(s) for s in sets]), np.arange(len(sets)) // 2
    for sides in (np.full(len(sets), -1), np.arange(len(sets)) % 2):
        kept = ngram_join.survivors(sizes, maps, labels, sides, percent)
        for i in range(len(sets)):
            for j in range(len(sets)):
                apart = labels[i] != labels[j] and (sides[i] < 0 or sides[i] != sides[j])
                if apart and ngram_join.linked(sets[i], sets[j], percent):
                    assert kept[i] and kept[j]
        assert not kept.all()


def test_repeated_id_connects_its_texts(spark, make_docs):
    rng = random.Random(5)
    a, b = " ".join(prose(rng, 40)), " ".join(prose(rng, 40))
    got = ngram_join.jaccard_components(make_docs([(1, a), (5, a), (5, b), (7, b)])).collect()
    assert {r["id"]: r["component_id"] for r in got} == {1: 1, 5: 1, 7: 1}


def test_no_rows(spark, make_docs):
    empty = make_docs([(1, "x")]).where("false")
    assert ngram_join.jaccard_components(empty).count() == 0
    assert ngram_join.drop_near_copies(empty).count() == 0
    assert chaining.repeated_passages(empty).count() == 0


def test_drop_near_copies(spark, make_docs):
    text = " ".join(prose(random.Random(6), 60))
    docs = make_docs([(3, text), (2, text + " x"), (2, text + " x"), (4, "other words"), (None, None), (None, None), (8, None), (9, "")])
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 2), (False, 4), (False, 8), (False, 9), (True, None), (True, None)]


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}}


def test_passages(spark, make_docs):
    rng = random.Random(7)
    part, other = prose(rng, 70), prose(rng, 90)
    edited = list(part)
    edited[30] = "changed"
    del edited[50]
    rows = [(i, prose(rng, rng.randint(5, 150))) for i in range(30)]
    plant = {3: part, 11: part, 20: edited, 5: other, 25: other}
    rows = [(i, ws[: len(ws) // 2] + plant.get(i, []) + ws[len(ws) // 2 :]) for i, ws in rows]
    rows.append((40, part[:49]))
    rows.append((41, ["und"] * 400))
    rows.append((42, ["und"] * 300))
    rows += [(43, other + prose(rng, 10) + other)] * 2
    texts = [(i, " ".join(ws)) for i, ws in rows] + [(50, None), (51, ""), (None, " ".join(part))]
    docs = make_docs(texts)
    found = chaining.repeated_passages(docs)
    spans = {}
    for r in found.collect():
        spans.setdefault(r["id"], []).append((r["start"], r["end"], r["other_id"]))
    assert set(spans) - {42} == {11, 20, 25, 43}
    words = dict(rows)
    for i, source, n in ((11, 3, 70), (20, 3, 69), (25, 5, 90)):
        (a, b, of), = spans[i]
        at = len(words[i]) - n - (len(words[i]) - n + 1) // 2
        assert of == source and abs(a - at) <= 3 and abs(b - at - n) <= 3
    assert len(spans[43]) == 2
    cut = {r["doc_id"]: r["text"] for r in chaining.drop_passages(docs, found).collect()}
    kept = words[25][: spans[25][0][0]] + words[25][spans[25][0][1] :]
    assert cut[25].split() == kept and cut[3] == dict(texts)[3] and cut[50] is None and cut[51] == ""
    assert chaining.drop_passages(docs, found).columns == docs.columns


def test_far_segment_hides_no_near_one():
    """The best-scoring segment lies beyond the gap; the near one is taken."""
    segs = np.array([[a, b, a, b] for a, b in ([0, 500], [700, 720], [732, 762])])
    assert chaining.chains(segs) == [[0], [1, 2]]
    # Near in one text only.
    segs = np.array([[0, 40, 0, 40], [45, 80, 400, 435], [62, 92, 50, 80]])
    assert [0, 2] in chaining.chains(segs)


def test_fenwick_ranges():
    rng = random.Random(13)
    tree, plain = chaining.Fenwick(23), [chaining.NOTHING] * 23
    for _ in range(2000):
        i = rng.randrange(23)
        plain[i] = chaining.NOTHING if rng.random() < 0.3 else (rng.random(), i)
        tree.put(i, plain[i])
        low, high = sorted((rng.randrange(24), rng.randrange(24)))
        assert tree.over(low, high) == max(plain[low:high], default=chaining.NOTHING)


def test_chain_keeps_the_best_order():
    import numpy as np

    segs = np.array([[0, 20, 0, 20], [25, 45, 24, 44], [25, 40, 200, 215], [50, 60, 48, 58]])
    assert chaining.chains(segs) == [[0, 1, 3], [2]]


def passages_of(docs):
    return sorted((r["id"], r["start"], r["end"], r["other_id"]) for r in chaining.repeated_passages(docs).collect())


def test_passages_of_periodic_text(spark, make_docs):
    rng = random.Random(12)
    rows = [(41, ["und"] * 400), (42, ["und"] * 300), (43, ["et"] * 40), (44, ["et"] * 300)]
    want = [(42, 0, 300, 41)]
    for k, d in enumerate((1, 2, 3, 7, 8, 9, 13, 15, 16)):
        part, i = [f"p{k}x{j}" for j in range(d)], 100 + 10 * k
        turned = part[d // 2 :] + part[: d // 2]
        rows += [(i, prose(rng, 30) + (part * 300)[:200] + prose(rng, 30)), (i + 1, prose(rng, 40) + (turned * 400)[:149] + prose(rng, 20)), (i + 2, (turned * 400)[:400])]
        rows += [(i + 3, prose(rng, 9) + part * (49 // d))]
        want += [(i + 1, 40, 189, i), (i + 2, 0, 400, i)]
    found = passages_of(make_docs([(i, " ".join(ws)) for i, ws in rows]))
    assert found == want


def test_passage_that_leaves_a_periodic_stretch(spark, make_docs):
    rng = random.Random(13)
    rows, want = [], []
    for k, d in enumerate((1, 5, 8, 12, 16)):
        part, i = [f"q{k}x{j}" for j in range(d)], 10 * k
        for j, more in enumerate((10, 40)):
            tail = prose(rng, more)
            rows += [(i + 2 * j, prose(rng, 30) + (part * 300)[-45:] + tail + prose(rng, 30)), (i + 2 * j + 1, prose(rng, 30) + (part * 300)[-300:] + tail)]
            want.append((i + 2 * j + 1, 330 - 45, 330 + more, i + 2 * j))
    found = {r[0]: r for r in passages_of(make_docs([(i, " ".join(ws)) for i, ws in rows]))}
    for i, a, b, of in want:
        assert found[i][1] <= a + 3 and found[i][2] == b and found[i][3] <= i, (i, a, b, of, found.get(i))


def test_passage_of_equal_seeds_with_words_between(spark, make_docs):
    """Fixed words every 16 that hold the smallest gram of all windows, other words between."""
    import numpy as np

    from paperloom.llm.bytetext import windows, words

    def least_gram(n):
        ws = prose(random.Random(n), K)
        raw = np.frombuffer(" ".join(ws).encode(), np.uint8)
        return int(windows(words(raw, np.array([0, len(raw)])).hash, K)[0]), ws

    K = chaining.K
    head = min(map(least_gram, range(3000)))[1]
    rng = random.Random(14)
    shared = sum((head + prose(rng, 8) for _ in range(8)), [])
    docs = make_docs([(1, " ".join(prose(rng, 30) + shared)), (2, " ".join(prose(rng, 12) + shared + prose(rng, 20)))])
    assert passages_of(docs) == [(2, 12, 12 + len(shared), 1)]
