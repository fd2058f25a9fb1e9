"""The stages against brute force on a small corpus, each on the rows that the stage before it kept."""

import public_tokenizers
import pytest

import corpus_pipeline
from ledgerloom.llm import pieces, toxicity
from ledgerloom.llm.storage import work_folder
from tests.llm.edge import NASTY
from tests.llm.test_order_minhash import family, plain_classes
from tests.llm.test_toxicity import corpus


@pytest.fixture(scope="module")
def folder(spark):
    rows, labels, _ = corpus(260)
    texts = [(i, t) for i, t in rows] + [(10_000 + i, rows[i][1]) for i in range(0, 60, 6)]
    texts += [(20_000 + 100 * s + i, t) for s in range(2) for i, t in enumerate(family(s, 4, 60, 0.01))]
    texts += [r for r in NASTY if r[0] is not None and r[0] != 900009]
    path = work_folder(spark, "corpus")
    frame = [(i, t, "en", f"src{(i or 0) % 4}", len(t or "")) for i, t in texts]
    spark.createDataFrame(frame, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mix", "piece_ids"]
    kept, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, made = kept.collect(), stage(spark, kept, folder)
        path = work_folder(spark, name)
        made.write.parquet(path)
        kept = spark.read.parquet(path)
        after = kept.collect()
        if name != "piece_ids":
            assert kept.columns == columns
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            want = [(r.doc_id, r.text) for r in toxicity.score(docs, model).collect() if r.score < 0.3]
            gone = [r.text.lower() for r in before if r.doc_id not in {x.doc_id for x in after}]
            assert gone and all(any(w in t for w in ("vile", "awful", "nasty", "rotten")) for t in gone)
        elif name == "exact_dedup":
            last = {}
            for r in before:
                last[r.text or ""] = max(r.doc_id, last.get(r.text or "", r.doc_id))
            want = [(r.doc_id, r.text) for r in {(r.doc_id, r.text or ""): r for r in before if last[r.text or ""] == r.doc_id}.values()]
        elif name == "near_dedup":
            want = [(r.doc_id, r.text) for r in before if (r.doc_id, r.doc_id) in set(plain_classes([(r.doc_id, r.text) for r in before]))]
            assert len(want) < len(before)
        elif name == "mix":
            want = [(r.doc_id, r.text) for r in before]
        else:
            code = pieces.coder(public_tokenizers.path("piece_bpe_32k.model"))
            texts = {r.doc_id: r.text for r in before}
            assert all(code.decode(r.piece_ids) == (texts[r.doc_id] or "").replace(pieces.MARK, " ") for r in after)
            assert len({(r.mix_file, r.mix_row) for r in after}) == len(before) == len(after)
            assert made.columns == ["doc_id", "source", "mix_file", "mix_row", "piece_ids", "n_pieces"]
            break
        assert sorted(((r.doc_id, r.text) for r in after), key=str) == sorted(want, key=str)


def test_empty(spark):
    path = work_folder(spark, "nothing")
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, toxic int").write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
