import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from ledgerloom.llm import pieces
from tests.llm.edge import NASTY

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  Hello   world ", "a\n\nb\tc", "日本語 テスト 🙂🙂", "▁marks ▁▁ in text", "é é ﬁ Å 𝕏", " ", "    ", "x", "naïve coöperation", "\x00\x01 z"]


@pytest.fixture(scope="module")
def library():
    """The library's unigram encoder over the pieces and scores of the same file.

    Its single-precision sums lose small differences next to the -1e9 of the file's runs of spaces, which no best
    segmentation uses; they get a score that is only worse than all others.
    """
    model = proto.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -60000.0)
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


@pytest.fixture(scope="module")
def scores():
    code = pieces.coder(PATH)
    names = [code.raw[i].decode().replace(" ", pieces.MARK) for i in range(len(code.raw)) if i not in code.bytes and i != code.unknown]
    return {p: code.automaton.get(p)[0] for p in names if p}


def best_by_table(code, score, text):
    """Plain dynamic programme over all substrings."""
    best = [0.0] + [float("-inf")] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - 48), j):
            p = text[i:j]
            gain = score[p] if p in score else code.penalty if j - i == 1 else None
            if gain is not None and best[i] + gain > best[j]:
                best[j] = best[i] + gain
    return best[-1]


def total(code, ids, text):
    cost, at = 0.0, 0
    k = 0
    while k < len(ids):
        if ids[k] in code.bytes:
            n = len(text[at].encode())
            k, at, cost = k + n, at + 1, cost + code.penalty
        else:
            piece = code.raw[ids[k]].decode().replace(" ", pieces.MARK)
            k, at, cost = k + 1, at + len(piece), cost + code.automaton.get(piece)[0]
    assert at == len(text)
    return cost


def test_segmentation_is_the_best_and_matches_the_library(spark, library, scores):
    code = pieces.coder(PATH)
    texts = ODD + [t for _, t in NASTY if t and len(t) < 2000]
    texts += [w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect() for w in r.text.split(" ")[:40]]
    for text in texts:
        marked = pieces.MARK + text.replace(" ", pieces.MARK)
        ids = memoryview(code.encode(text)).cast("i").tolist()
        assert total(code, ids, marked) == pytest.approx(best_by_table(code, scores, marked))
        if pieces.MARK not in text and "\x00" not in text:
            assert ids == library.encode(text)


def test_round_trip_and_columns(spark):
    rows = NASTY + [(i, t) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame([(i, t, 1.5, [1]) for i, t in rows], "doc_id bigint, text string, c0 double, both array<int>")
    coded = pieces.round_trip(frame, PATH)
    assert coded.columns == ["doc_id", "text", "c0", "both", "piece_ids", "round_trip"]
    got = coded.collect()
    assert len(got) == len(rows) and all(r.round_trip and r.c0 == 1.5 and r.both == [1] for r in got)
    assert all(r.piece_ids == [] for r in got if not r.text)
    back = pieces.decode(coded.select("doc_id", "piece_ids"), PATH, name="back").collect()
    key = lambda x: (str(x[0]), x[1])
    assert sorted(((r.doc_id, r.back) for r in back), key=key) == sorted(((i, (t or "").replace(pieces.MARK, " ")) for i, t in rows), key=key)
    plain = pieces.encode(frame, PATH).collect()
    assert [r.piece_ids for r in plain] == [r.piece_ids for r in got]


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert pieces.round_trip(frame, PATH).collect() == [] and pieces.decode(pieces.encode(frame, PATH), PATH, name="t").collect() == []


def test_ids_are_those_of_the_library_for_a_merge_model(spark):
    """The unchanged file, so the library's own merge order."""
    whole = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ODD + [t for _, t in NASTY if t] + ["aaaaaaaaaa" * 9, " " * 70 + "x" + " " * 33, "x  y   z    \t     a", "Überraschung " * 20]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pieces.encode(frame, PATH).collect():
        assert r.piece_ids == whole.encode(r.text), r.text[:80]


def test_ids_are_those_of_the_library_for_a_unigram_model(spark, library, tmp_path):
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as file:
        file.write(library.serialized_model_proto())
    texts = [t for t in ODD if pieces.MARK not in t and "\x00" not in t]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert all(r.piece_ids == library.encode(r.text) for r in pieces.encode(frame, path).collect())


def test_the_pass_over_the_automaton_leaves_what_the_merges_leave():
    """Every part of the given documents, and random strings of piece characters, with few remembered pairs, too."""
    import random

    import pyarrow.parquet as pq

    code = pieces.MergeCoder(PATH)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    parts = {p for t in texts for p in pieces._PARTS.findall(pieces.MARK + (t or "").replace(" ", pieces.MARK))}
    rng = random.Random(6)
    letters = sorted(code.single)
    for size in range(1, 30):
        parts |= {"".join(rng.choices("aeinrst▁" if size % 2 else letters, k=size)) for _ in range(60)}
    parts |= {"ab\x00cd", "\U000e0001", "x\U000e0001\U000e0001y", "".join(rng.choices("abab", k=3000))}
    assert code.closed and len(parts) > 10_000
    different = [p for p in parts if code.segment(p) != code.merged(p)]
    assert not different, different[:5]
    assert sum(code.pairs.values()) < len(code.pairs)  # some neighbours do not stay apart


def test_remembered_parts_and_pairs_are_dropped_in_generations(monkeypatch):
    code = pieces.MergeCoder(PATH)
    texts = [f"word{i} shared{i % 3} x{i * 7919 % 1000}" for i in range(400)]
    want = [code.encode(t) for t in texts]
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    monkeypatch.setattr(pieces, "PAIRS", 10)
    small = pieces.MergeCoder(PATH)
    assert [small.encode(t) for t in texts] == want
    assert len(small.known) < 40 and len(small.older) < 40 and len(small.pairs) < 60
    assert small.encode("y" * 500) == code.encode("y" * 500) and not any(len(p) >= 100 for p in small.known)
