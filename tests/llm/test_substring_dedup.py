import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import substring_dedup as sd
from ledgerloom.llm.words import Words
from tests.llm.edge import NASTY


def brute(docs, window):
    """Straight from the definition: dictionary of first window starts, in id order."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, docs[i][1] or ""))
    seen, out = set(), []
    for i in order:
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[i][1] or "")
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if w in seen:
                gone[k : k + window] = [True] * window
            seen.add(w)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((docs[i][0], len(words), sum(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=60):
    rng = random.Random(seed)
    passages = [[f"p{j}w{k}" for k in range(rng.randint(5, 60))] for j in range(6)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.6:
                words += rng.choice(passages)
            words += [rng.choice("abcdefghij") for _ in range(rng.randint(0, 12))]
        docs.append((i * 3, rng.choice([" ", "\n", "\t ", "\x0b"]).join(words)))
    return docs + [(n * 3 + i, docs[0][1]) for i in range(20)]


@pytest.mark.parametrize("window", [1, 2, 5, 20])
@pytest.mark.parametrize("group_bytes,range_bytes", [(1 << 20, 1 << 25), (700, 3000)])
def test_against_brute_force(spark, window, group_bytes, range_bytes):
    docs = made(window) + [(i, t) for i, t in NASTY]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, id string, grp int")
    got = sd.removed_words(frame, window=window, group_bytes=group_bytes, range_bytes=range_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, window)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert sd.removed_words(frame).collect() == []


def test_covers_reach_every_difference():
    for v, cover in sd.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert sd.cover_for(20) == (13, (0, 1, 3, 9), 8)


def test_words_match_the_pattern():
    texts = [t for _, t in NASTY] + ["a b", "", " a", "b ", "é ü x"]
    words = Words(pa.array(texts))
    for i, t in enumerate(texts):
        found = [bytes(words.data[a:b]).decode() for a, b in zip(words.start[words.first[i] : words.first[i + 1]], words.end[words.first[i] :])]
        assert found == re.findall(r"[^\x20\x09-\x0D]+", t or "")
    same = Words(pa.array(["x a b c", "a b c a b c"]))
    h = same.windows(3)[same.fits(3)]
    assert h[1] == h[2] == h[5] and len(np.unique(h)) == 4
