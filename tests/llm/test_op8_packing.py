import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from conftest import SF
from tokenizers import Tokenizer

from gaugeline.llm import packing as op
from gaugeline.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def check(docs, pieces, size):
    """Round trip: pieces laid end to end are the documents, windows have no gap and no excess."""
    windows, texts = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert ids
        windows[p["sequence_id"]].append((p["offset"], len(ids)))
        texts[p["doc_id"]].append((p["start"], p["doc_tokens"], ids))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or at < size and at & (at - 1) == 0
    for doc_id in {d for d, _ in docs}:
        want = sorted(ids_of(t) for d, t in docs if d == doc_id)
        got = sorted(texts[doc_id], key=lambda p: p[0])
        assert sum(len(p[2]) for p in got) == sum(map(len, want))
        if len(want) == 1:
            assert [i for p in got for i in p[2]] == want[0]
            assert all(p[1] == len(want[0]) for p in got)


def test_documents_round_trip(documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    for size in (2048, 256):
        check(docs, op.pack(documents.repartition(3), PATH, size).collect(), size)


def test_odd_documents(odd_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    check(docs, op.pack(odd_documents, PATH).collect(), 2048)
    assert op.pack(odd_documents.limit(0), PATH).count() == 0


def test_encoder_is_the_library():
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}\n \n{chr(c)}  '{chr(c)}s 1{chr(c)}" for c in range(0x400)]
    texts += ["<|endoftext|> a<|endoftext|>", "", "  \t\n ", "一二 \U0001F600", "don't we'll I'm"]
    got = [np.frombuffer(b, "<u4").tolist() for b in op.encoder(PATH).encode(texts)]
    assert got == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_level_has_the_least_sum_of_squares():
    rng = np.random.default_rng(1)
    windows = op.Windows(64, 0)
    for length in rng.integers(1, 65, 2_000).tolist():
        before = windows.counts.copy()

        def squares(level):
            after = before.copy()
            after[level] -= level > 0
            after[level + length] += level + length < 64
            return (after ** 2).sum()
        choices = [0] + [h for h in range(1, 65 - length) if before[h]]
        level = windows.place(length)
        assert squares(level) == min(map(squares, choices))
        assert level == max(h for h in choices if squares(h) == squares(level))
        windows.add((0, 0, b"\0" * 4 * length, length))


def test_query_digests(spark):
    for r in QUERIES["op8_packing"](spark, SF).limit(20).collect():
        text = spark.read.parquet(f"{SF}/documents.parquet").where(
            f"doc_id = {r['doc_id']}").first()["text"]
        ids = ids_of(text)[r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
