import base64
import random
import re
from collections import Counter

import zstandard
from conftest import SF, SPACED

from gaugeline.llm import quality_rules as op
from gaugeline.llm.queries import QUERIES


def brute(text):
    words = SPACED.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k:k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup,
            len(covered), failed)


def verdict(text, bands=op.Bands()):
    """Straight from the definition."""
    data = (text or "").encode()

    def inside(part):
        ratio = len(part) / len(zstandard.ZstdCompressor(level=bands.level).compress(part))
        k = sum(len(part) >= s for s in bands.sizes)
        return bands.low[k] <= ratio <= bands.high[k]

    if not data:
        return False
    parts = [data[k:k + bands.chunk] for k in range(0, len(data), bands.chunk)]
    bad = sum(len(p) for p in parts if not inside(p))
    return inside(data) and (len(parts) == 1 or bad <= bands.share * len(data))


def check(df, docs):
    want = sorted((r["doc_id"], *(b := brute(r["text"])), verdict(r["text"]) and not b[-1])
                  for r in docs if r["doc_id"] is not None)
    got = sorted((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                  r["n_repeat_words"], r["base_failed"], r["kept"])
                 for r in df.collect() if r["doc_id"] is not None)
    assert got == want
    return got


def test_query_as_brute_force(spark, documents):
    got = check(QUERIES["op13_quality_rules"](spark, SF), documents.collect())
    assert any(r[-1] for r in got) and any(r[4] for r in got) and any(r[3] for r in got)


def test_odd_documents(spark, odd_documents):
    found = op.judge_quality(odd_documents)
    check(found, odd_documents.collect())
    assert found.count() == odd_documents.count()
    assert found.where("doc_id IS NULL").count() == 2
    assert op.judge_quality(odd_documents.limit(0)).count() == 0


def test_bands_reject_noise_and_repetition_and_leave_prose(spark, rows_of):
    rng = random.Random(4)
    syllables = "an er th on re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve"
    parts = syllables.split()

    def prose(n):
        return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))

    noise = " ".join(base64.b64encode(rng.randbytes(rng.randint(20, 60))).decode() for _ in range(400))
    boiler = " ".join(f"{prose(8)} terms and conditions apply see the store for details {k}\n"
                      for k in range(3))
    table = "\n".join(f"| {k} | 0 | 0 | 0 | 0 | 0 |" for k in range(4_000))
    half = prose(2_000)
    texts = {1: prose(60), 2: prose(5_000), 3: noise, 4: prose(30_000), 5: table, 6: half + noise,
             7: half + prose(400) + boiler, 8: "ä" + prose(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = op.judge_quality(docs).collect()
    check(op.judge_quality(docs), docs.collect())
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert kept == {1, 2, 4, 7, 8}
    # The chunks tell what the whole does not: half of this text is noise.
    mixed = next(r for r in rows if r["doc_id"] == 6)
    assert mixed["bad_chunk_share"] > 0.25 and not mixed["base_failed"]
    assert op.Bands().holds(len(texts[6]), mixed["ratio"])


def test_very_long_text(spark):
    text = " ".join(str(k * 2_654_435_761 % 99_991) for k in range(400_000)) + "\nx\nx\n" * 3
    row = op.judge_quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_words"] == 400_000 + 6 and row["n_dup_lines"] == 5
