"""Texts in pieces that the tokenizer never joins."""

import numpy as np

from cabmeter.llm import packing
from cabmeter.llm.queries import tokenizer_path


def test_words_are_encoded_once_whatever_follows_them():
    encoder = packing.Encoder(tokenizer_path())
    words = ["alpha", "Beta", "gamma", "don't", "x1", "é"]
    texts = [f"A {w}{p} b" for w in words for p in (".", ",", "!", ")", "'s", '"', ".\nTo", "\n", "\n\nTo", " \n", "")]
    texts += ["", "\n", "\na", "a\n", ".", "a.́", "<|endoftext|>a", " a.\n　b", "a.\x85b", "a\tb.\r\nc"]
    raw = [t.encode() for t in texts]
    ids, edges = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for i, text in enumerate(texts):
        assert ids[edges[i]: edges[i + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
    more = " ".join(f"word{p}" for p in ".,;:!?)]}").encode()
    encoder._forget()
    encoder.encode(np.frombuffer(more, np.uint8), np.array([0, len(more)]))
    assert len(encoder.names) == 11  # "word" with and without a space, and nine signs


def test_encoding_takes_little_memory_whatever_the_batch(monkeypatch):
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    from pyspark import TaskContext

    monkeypatch.setattr(TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    encoder = packing.Encoder(tokenizer_path())
    monkeypatch.setattr(packing, "Encoder", lambda path: encoder)
    words = np.random.default_rng(3).integers(0, 20_000, (700, 600))
    texts = pa.array([" ".join(f"w{x}" for x in row) for row in words])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], ["id", "text"])
    assert texts.nbytes > 2 << 20
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in packing._cut_batches(tokenizer_path(), 2048, 0)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows >= len(texts)
    assert peak < 60 << 20


def test_workers_are_sent_few_texts_at_once(spark, monkeypatch):
    from cabmeter.llm import minhash

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen, usual = {}, spark.conf.get(key)

    for module in (packing, minhash):
        def write(df, name, done=module.written):
            seen[name] = int(spark.conf.get(key))
            return done(df, name)

        monkeypatch.setattr(module, "written", write)
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, None)], "doc_id long, text string")
    assert packing.pack_documents(docs, tokenizer_path()).count() == 3
    assert minhash.minhash_components(docs).count() == 3
    assert all(seen[name] <= 1024 for name in ("pieces", "signatures", "sets"))
    assert spark.conf.get(key) == usual
