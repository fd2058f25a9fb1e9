import glob
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import token_files as tf
from ledgerloom.llm.storage import work_folder
from tests.llm.edge import NASTY

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (1, "<|endoftext|> a<|startoftext|>b <|x|> <|"),
    (2, "Ünï can't WE'LL\x0bx\x1cy z ΟΔΟΣ Σ"),
    (3, "é ́a Å fi ﬁ 1234 !!! #2"),
    (4, "plain words again and again"),
]


def expected(rows):
    tok = Tokenizer.from_file(PATH)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
    start, out = 0, []
    for i, t in order:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4")), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("range_bytes,length,batch", [(1 << 22, 2048, 256), (600, 8, 3)])
def test_round_trip(spark, range_bytes, length, batch):
    rows = NASTY + ODD + [(10 + i, f"row {i} of many " * (i % 7)) for i in range(80)]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, ids string, range string")
    folder = work_folder(spark, "tokens")
    tf.write_token_files(frame, folder, PATH, length=length, batch=batch, range_bytes=range_bytes)
    got = sorted((tuple(r) for r in tf.read_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert got == expected(rows)
    files = glob.glob(f"{folder}/*.txt")
    assert len(files) > 1 or range_bytes > 600
    for name in files:
        reader = tf.open_file(name)
        firsts = [tf.sequence(reader, k, batch)[0] for k in range(sum(reader.get_batch(i).num_rows for i in range(reader.num_record_batches)))]
        assert {len(x) for x in firsts} == {length} and not any(x.flags.owndata for x in firsts)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = work_folder(spark, "tokens")
    tf.write_token_files(docs, folder, PATH, range_bytes=100_000)
    got = sorted((tuple(r) for r in tf.read_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_empty(spark):
    folder = work_folder(spark, "tokens")
    tf.write_token_files(spark.createDataFrame([], "doc_id bigint, text string"), folder, PATH)
    assert tf.read_token_files(spark, folder).collect() == []
