import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow.dataset as ds
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from latticework.llm import packing, token_files, tokens
from latticework.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"
WHOLE, CHUNKED = Tokenizer.from_file(PATH), Encoder(PATH)


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def chunked(text):
    return np.frombuffer(CHUNKED.encode(text.encode()), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])) | st.text("aAéÉé̀ \t\n\x0b\x0c\r\x1c\x85\xa0'sStT09.,Σσİ<|endoftext>"))
def test_chunks_equal_whole_texts(text):
    assert chunked(text) == ids_of(text)


def test_special_strings_and_long_words():
    for text in ("a <|endoftext|> b<|ENDOFTEXT|>", "x" * 3000 + " y " + "é" * 999, "　中文 字 a", " 'S 's"):
        assert chunked(text) == ids_of(text)


def test_plain_runs_are_used():
    assert CHUNKED.plain and CHUNKED.lower
    CHUNKED.encode("Straße l'Été%%% 42nd don't ÀÖØß".encode())
    assert {run.encode() for run in ("straße", "été", "%%%", "4", "'t", "àöøß")} <= CHUNKED.runs.keys()


def test_many_texts_at_once():
    texts = ["It's 'story''s", None, "", "x 'r 're 'real ''re", "œ’s plain 12", "\t", "A\x01b <| c", "'l'll'lx", "d'"] * 50
    texts.append("don't 'd " * 600_000)
    got = CHUNKED.encode_all([None if t is None else t.encode() for t in texts])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [ids_of(t) for t in texts]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        Encoder(public_tokenizers.path("byte_bpe_50k.json"))


ROWS = [(i * 3 % 40, " ".join(f"wörd{j % 977}" for j in range(n))) for i, n in enumerate([0, 1, 5, 40, 400, 3000, 9000] * 5)]
ROWS += [(None, "no id"), (3, None), (3, "twice"), (3, "twice"), (99, "x " * 200_000)]


def test_pieces_hold_each_id_once(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA + "").withColumn("ids", F.lit("clash")).repartition(3)
    got = packing.pack(docs, PATH, 2, group=3).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length > 0
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0 and at < 4096
    for doc_id in {i for i, _ in ROWS}:
        want = sorted(ids_of(t) + [2] for i, t in ROWS if i == doc_id)
        pieces = by_doc[doc_id]
        assert sum(r.length for r in pieces) == sum(map(len, want))
        if len(want) == 1:
            joined = b"".join(r.ids for r in sorted(pieces, key=lambda r: r.start))
            assert joined == np.array(want[0], "<u4").tobytes()
            assert {r.doc_tokens for r in pieces} == {len(want[0])}
            starts = sorted((r.start, r.length) for r in pieces)
            assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_costs_are_balanced():
    rng = random.Random(2)
    lengths = np.array([int(min(1200, rng.lognormvariate(6, 1)) + 1) for _ in range(900)])
    rest = int(lengths.sum()) % 4096
    capacities = np.array([4096] * (int(lengths.sum()) // 4096) + packing.powers(rest))
    cost, fill = np.zeros(len(capacities)), np.zeros(len(capacities), int)
    for _, _, n, at, offset in packing.assign(lengths, capacities, 1.0, 1 / 4096):
        assert offset == fill[at]
        cost[at] += n + n * n / 4096
        fill[at] += n
    assert (fill == capacities).all()
    full = cost[capacities == 4096]
    naive, at, room = [0.0], 0, 4096
    for n in lengths.tolist():
        while n:
            take = min(n, room)
            naive[-1] += take + take * take / 4096
            n, room = n - take, room - take
            if not room:
                naive.append(0.0)
                room = 4096
    assert full.max() / full.mean() < max(naive) / np.mean(naive[:-1])


def test_no_documents(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack(empty, PATH, 2).collect() == []
    token_files.write_tokens(empty, f"{tmp_path}/t", PATH, 1)
    assert token_files.read_tokens(spark, f"{tmp_path}/t").collect() == []


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_read_back(spark, tmp_path, encoding):
    path = f"{tmp_path}/tokens"
    docs = spark.createDataFrame([(i, t, i) for i, t in ROWS], SCHEMA + ", start long").repartition(5)
    token_files.write_tokens(docs, path, PATH, 1, encoding=encoding, row_group_bytes=1 << 20, page_rows=5)
    got = token_files.checksums(token_files.read_tokens(spark, path)).orderBy("start").collect()
    at = 0
    hashed = spark.createDataFrame(ROWS, SCHEMA).withColumn("hash", F.xxhash64("text")).collect()
    ordered = [r[:2] for r in sorted(hashed, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1] is not None, r[1] or ""))]
    for r, (doc_id, text) in zip(got, ordered, strict=True):
        ids = ids_of(text) + [1]
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    files = [f for f in ds.dataset(path).files if pq.ParquetFile(f).metadata.num_rows]
    column = pq.ParquetFile(files[0]).metadata.row_group(0).column(4)
    assert column.path_in_schema == "tokens.list.element"
    assert ("RLE_DICTIONARY" if encoding == "dictionary" else "DELTA_BINARY_PACKED") in column.encodings
    first = pq.ParquetFile(files[0]).metadata.row_group(0).column(0)
    assert first.has_column_index and first.has_offset_index and "DELTA_BINARY_PACKED" in first.encodings


def test_selective_reads(spark, tmp_path):
    path = f"{tmp_path}/tokens"
    token_files.write_tokens(spark.createDataFrame(ROWS, SCHEMA), path, PATH, 1)
    whole = {(r.doc_id, r.start): r.tokens for r in token_files.read_tokens(spark, path).collect()}
    some = token_files.read_tokens(spark, path, F.col("doc_id") == 9)
    assert [(r.doc_id, r.start, r.tokens) for r in some.collect()] == [(*k, v) for k, v in whole.items() if k[0] == 9]
    light = token_files.read_tokens(spark, path, tokens=False)
    assert light.columns == ["doc_id", "start", "n_tokens"]
    assert "tokens:array" not in light._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,9)" in some._jdf.queryExecution().executedPlan().toString()


def test_freed_memory_goes_back():
    code = """
import random, psutil
import public_tokenizers
from latticework.llm import text, tokens
encoder = tokens.Encoder(public_tokenizers.path('word_bpe_49k.json'))
rng = random.Random(3)
data = b" ".join(bytes(rng.choices(b"abcdefghijklmnop", k=7)) for _ in range(250_000))
held = lambda: psutil.Process().memory_info().rss
for at in range(0, len(data), 500_000):
    encoder.encode(data[at : at + 500_000])
before = held()
text.release()
assert before - held() < 30e6, (before, held())
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, env=os.environ | {"PYTHONPATH": ":".join(sys.path)})


def test_new_runs_are_encoded_in_parts(monkeypatch):
    data = " ".join(f"w{at} it's" for at in range(300)).encode()
    want = Encoder(PATH).encode(data)
    monkeypatch.setattr(tokens, "RUNS_AT_ONCE", 7)
    one = Encoder(PATH)
    calls, model = [], one.model
    one.model = type("Model", (), {"encode": lambda self, text, **kw: calls.append(text.count("\n") + 1) or model.encode(text, **kw)})()
    assert one.encode(data) == want and max(calls) <= 7


def encoded_runs(one):
    """The runs that the model of ``one`` will encode from now on."""
    calls, model = [], one.model
    one.model = type("Model", (), {"encode": lambda self, text, **kw: calls.extend(text.split("\n")) or model.encode(text, **kw)})()
    return calls


def letters(rng, n):
    return ["".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(n)]


def test_runs_used_often_are_encoded_once(monkeypatch):
    monkeypatch.setattr(tokens, "RUNS", 200)
    one, rng = Encoder(PATH), random.Random(4)
    calls, often = encoded_runs(one), letters(rng, 50)
    for _ in range(20):
        text = " ".join(often + letters(rng, 60))
        assert np.frombuffer(one.encode(text.encode()), "<u4").tolist() == ids_of(text)
        assert len(one.runs) <= 200
    assert all(calls.count(run) == 1 for run in often)


def test_ids_that_are_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "IDS_BYTES", 4000)
    one, rng = Encoder(PATH), random.Random(5)
    for _ in range(20):
        text = " ".join([*letters(rng, 60), "x" * 3000, "it's 42%", "#%" * 30]) + " \n\t"
        assert np.frombuffer(one.encode(text.encode()), "<u4").tolist() == ids_of(text)
        assert one.ids.nbytes < 5000


def test_gaps_alone_and_upper_case_of_latin_1():
    for text in (" ", "\t\n", "ÀÖØÞßÿ×÷ ÀÉ×é÷ \x80Ã\x97 ÃÂ·", "ÉTÉ <| ÀB", "a\x01É Ê"):
        assert np.frombuffer(Encoder(PATH).encode(text.encode()), "<u4").tolist() == ids_of(text)
    with pytest.raises(UnicodeDecodeError):
        Encoder(PATH).encode(b"ab \x80")
