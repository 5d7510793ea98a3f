from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rainloom.llm import common, token_files
from tests.llm.conftest import HARD_TEXTS, SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def written(docs, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(docs, PATH, path)
    return path, token_files.read_documents(token_files.keys_of(docs), path)


def sort_key(row):
    return (row[1],)


def test_round_trip_equals_plain_encoding(spark, tmp_path):
    docs = common.documents(spark, SF)
    _, result = written(docs, tmp_path)
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, result.collect()), key=sort_key) == want


def test_hard_texts(spark, docs_of, tmp_path):
    rows = HARD_TEXTS + [
        (20, "two  spaces"), (21, " lead"), (22, "trail "), (23, "a \n b"), (24, "it's <|endoftext|> x"), (25, "x<|endoftext|>y z"),
        (26, "nb sp  x"), (27, "tab\tb \tc"), (28, "a\n\n\nb c\n"), (29, "😀 é漢字 12,345 --x"), (30, "\x1c a \x1c"), (31, "  q"), (32, " "),
    ]
    _, result = written(docs_of(rows), tmp_path)
    assert sorted(map(tuple, result.collect()), key=sort_key) == brute(rows)


def test_encoder_equals_the_library_on_random_texts():
    rng = np.random.default_rng(9)
    encoder, tokenizer = token_files.Encoder(PATH), Tokenizer.from_file(PATH)
    bits = ["a", "the", "Über", "élan", "x1", "12", "'s", "'", "it's", "dogs'", ".", ",", "!!", "***", " ", " ", " ", "  ", "\n", "\n", "\n\n",
            "\t", "\r\n", "é́", "漢字", "😀", "ª", "²", "\xa0", "_", "-", "—", "\x85", "<|endoftext|>", "|", "&&&", "I'll", "ſ", "ʰ", "ः"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 14))) for _ in range(20000)]
    for part in (texts[:10000], texts[10000:]):
        for text, ids in zip(part, encoder.encode(part)):
            assert np.frombuffer(ids, "<u2")[:-1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_empty_table_and_unknown_keys(spark, docs_of, tmp_path):
    path, result = written(docs_of([(1, "a")]).limit(0), tmp_path / "none")
    assert result.count() == 0
    path, _ = written(docs_of([(5, "a b"), (9, "c")]), tmp_path / "two")
    asked = spark.createDataFrame([(5,), (6,), (7,), (9,)], "key long")
    assert {r["doc_id"] for r in token_files.read_documents(asked, path).collect()} == {5, 9}


def test_shards_keep_order_and_rows_of_a_key_together(spark, docs_of, tmp_path):
    rows = [(i // 3, f"text {i} " * 20) for i in range(300)]
    path = str(tmp_path / "small")
    token_files.write_shards(docs_of(rows), PATH, path, shard_ids=500)
    token_files.write_index(spark, path, bucket_keys=16)
    shards = spark.read.parquet(f"{path}/shards")
    assert shards.count() > 10
    result = token_files.read_documents(spark.range(100).select(F.col("id").alias("key")), path)
    assert sorted(map(tuple, result.collect()), key=sort_key) == brute(rows)


def test_function_is_minimal_and_perfect():
    for n in (0, 1, 2, 1000, 40000):
        keys = np.random.default_rng(n).permutation(10 * n)[:n] - 5 * n
        sizes, bits = token_files.build_function(keys)
        assert sorted(token_files.slots_of(keys, sizes, bits)) == list(range(n))
