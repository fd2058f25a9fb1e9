import random

import numpy as np
import pyarrow as pa

from ledgerloom.llm import order_minhash as om
from ledgerloom.llm.graph import components
from ledgerloom.llm.words import Words
from tests.llm.edge import NASTY


def plain_runs(text):
    w = (text or "").split()
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def plain_share(a, b):
    """Longest common subsequence by the textbook table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], (last + 1 if x == y else max(row[j + 1], row[j]))
    total = len(a) + len(b) - row[-1]
    return row[-1] / total if total else 1.0


def plain_classes(rows, threshold=0.8):
    texts = sorted({" ".join((t or "").split()) for _, t in rows})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    shingles = {t: plain_runs(t) for t in texts}
    links = dict.fromkeys(texts, 0)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            A, B = shingles[a], shingles[b]
            if A and B and min(len(A), len(B)) >= threshold * max(len(A), len(B)) and len(set(A) & set(B)) * 2 > len(set(A)):
                if plain_share(A, B) >= threshold - 1e-12:
                    root[find(a)] = find(b)
    heads = {}
    for i, t in rows:
        heads.setdefault(find(" ".join((t or "").split())), []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in heads.items()}
    return sorted(((i, least[find(" ".join((t or "").split()))]) for i, t in rows), key=str)


def family(seed, n, length, rate):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 9000)}" for _ in range(length)]
    out = [" ".join(base)]
    for _ in range(n):
        words = list(base)
        for _ in range(max(1, int(rate * length))):
            k = rng.randrange(len(words))
            rng.choice([lambda: words.pop(k), lambda: words.insert(k, f"new{rng.random()}"), lambda: words.__setitem__(k, f"x{rng.random()}")])()
        out.append(" ".join(words))
    return out


def test_classes_against_all_pairs(spark):
    rows = list(NASTY)
    for s in range(12):
        rows += [(s * 100 + i, t) for i, t in enumerate(family(s, 12, 60 + 25 * s, 0.005 + 0.003 * (s % 8)))]
    frame = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id bigint, text string, id int, node int, bands int")
    got = om.near_duplicate_classes(frame).collect()
    assert sorted(((r.id, r.class_id) for r in got), key=str) == plain_classes(rows)
    sizes = {}
    for r in got:
        sizes[r.class_id] = sizes.get(r.class_id, 0) + 1
    twice = 900009  # two texts under one id are two classes of that name
    assert all(r.class_size == sizes[r.class_id] for r in got if r.class_id != twice)
    assert sum(r.kept for r in got) == len(sizes) + 1
    left = om.drop_near_duplicates(frame)
    assert left.columns == frame.columns and left.count() == len(sizes) + 1


def test_members_that_miss_their_leader_are_still_linked(spark):
    """A star whose rays have copies of their own: rays and centre are apart, a ray and its copy are not."""
    rng = random.Random(3)
    rows, base = [(0, " ".join(f"b{i}" for i in range(300)))], [f"b{i}" for i in range(300)]
    for ray in range(12):
        words = list(base)
        for k in rng.sample(range(300), 14):
            words[k] = f"r{ray}x{k}"
        rows.append((ray * 2 + 1, " ".join(words)))
        words[150] = f"copy{ray}"
        rows.append((ray * 2 + 2, " ".join(words)))
    got = om.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.id, r.class_id) for r in got), key=str) == plain_classes(rows)


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert om.near_duplicate_classes(frame).collect() == [] and om.drop_near_duplicates(frame).collect() == []


def test_alignment_matches_the_table():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 30, rng.integers(1, 60)).astype(np.uint64)
        b = list(a)
        for _ in range(rng.integers(0, 8)):
            b.insert(rng.integers(0, len(b) + 1), rng.integers(0, 30)) if rng.random() < 0.5 or not b else b.pop(rng.integers(0, len(b)))
        b = np.array(b, np.uint64)
        want = plain_share(a.tolist(), b.tolist())
        assert om.aligned(a, b) == (want if want >= 0.8 else 0.0)


def test_runs_and_labels():
    words = Words(pa.array(["a b c d e a b c d e a", "x y", "", None, "a b c d e"]))
    hashes, first = om.runs(words)
    assert np.diff(first).tolist() == [7, 1, 0, 0, 1] and hashes[0] == hashes[5] == hashes[8]
    marked = om.labelled(hashes, first)
    assert len(set(marked[:7].tolist())) == 7 and marked[0] == marked[8] != marked[5]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (202, 201), (5, 5)]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in [*range(41), 100]}, 200: 200, 201: 200, 202: 200}


def test_verified_links_are_no_degree(spark):
    """One verified link is enough for a class; the column does not claim to count all pairs."""
    frame = spark.createDataFrame(list(enumerate(family(3, 60, 300, 0.004))), "doc_id bigint, text string")
    got = om.near_duplicate_classes(frame)
    assert got.columns == ["id", "class_id", "class_size", "verified_links", "kept", "_path", "_row"]
    rows = got.collect()
    assert {r.class_id for r in rows} == {0} and all(1 <= r.verified_links <= 60 for r in rows)
