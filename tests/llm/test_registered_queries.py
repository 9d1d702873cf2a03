"""Registered queries, digests included, against results worked out without the library."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from math import log

import public_tokenizers
import xxhash
from conftest import SF
from test_op1_substring_dedup import brute as repeats
from test_op4_minhash import brute as near
from test_op9_embedding_dedup import brute as vectors
from tokenizers import Tokenizer

from gaugeline.llm import secret_scan
from gaugeline.llm.language_id import SCRIPT_STARTS
from gaugeline.llm.queries import QUERIES

MASK = (1 << 64) - 1


def pairs(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def rows(spark, name):
    return sorted(map(tuple, QUERIES[name](spark, SF).collect()), key=repr)


def test_op1(spark, documents):
    docs = pairs(documents, "doc_id", "text")
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest())
            for (d, _), (n, gone, kept) in zip(docs, repeats([t for _, t in docs], 35))]
    assert rows(spark, "op1_substring_dedup") == sorted(want, key=repr)


def test_op4(spark, documents):
    assert rows(spark, "op4_minhash") == near(pairs(documents, "doc_id", "text"), 2)


def test_op5(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = pairs(documents, "doc_id", "text")
    counts = [len(e.ids) for e in library.encode_batch([t or "" for _, t in docs],
                                                       add_special_tokens=False)]
    assert rows(spark, "op5_token_counts") == sorted(
        ((d, len((t or "").encode()), n, n > 2048) for (d, t), n in zip(docs, counts)), key=repr)


def test_op9(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert rows(spark, "op9_embedding_dedup") == vectors(pairs(table, "vec_id", "embedding"))


# op6, worked out with plain integers and sums ------------------------------------------------------

def shape(t):
    kinds = ((t.islower(), 0), (t.istitle() or t.isupper() and len(t) == 1, 1), (t.isupper(), 2),
             (t.isdigit(), 3), (not (t[0].isalnum() or t[0] == "_"), 4), (True, 5))
    return next(k for fits, k in kinds if fits)


def buckets(text):
    tokens = re.findall(r"\w+|[^\w\s]+", text or "")
    words = [xxhash.xxh3_64_intdigest(t.lower()) >> 3 for t in tokens]
    kinds = [15, 15] + [shape(t) | 8 * (w in words[max(0, k - 2):k]) for k, (t, w) in
                        enumerate(zip(tokens, words))]
    prime = 0x9E3779B97F4A7C15
    single = [(w * prime & MASK) >> 52 for w in words]
    double = [((a * prime & MASK ^ b) * 0xC2B2AE3D27D4EB4F & MASK) >> 52 for a, b in zip(words, words[1:])]
    triple = [4096 + (a << 8 | b << 4 | c) for a, b, c in zip(kinds, kinds[1:], kinds[2:])]
    return single + double + triple


def spark_hash(number, text):
    seed = xxhash.xxh64_intdigest(struct.pack("<i", number), 42)
    return seed if text is None else xxhash.xxh64_intdigest(text.encode(), seed)


def importance(docs, quality):
    good_half = [quality.get(d) == 1 and spark_hash(6, t) % 2 == 0 for d, t in docs]
    grams = [buckets(t) for _, t in docs]
    raw, target = [1.0] * 8192, [1.0] * 8192
    for own, good in zip(grams, good_half):
        for b in own:
            raw[b] += 1
            target[b] += good
    sums = [(sum(target[p]), sum(raw[p])) for p in (slice(0, 4096), slice(4096, 8192))]
    ratio = [log(target[k] / sums[k >= 4096][0]) - log(raw[k] / sums[k >= 4096][1]) for k in range(8192)]
    weights = [sum(ratio[b] for b in own) for own in grams]
    held = [(w, quality[d]) for (d, t), w in zip(docs, weights)
            if d in quality and spark_hash(6, t) % 2 == 1]
    good, bad = ([w for w, q in held if (q == 1) == kind] for kind in (True, False))
    values = sorted({w for w, _ in held})
    edges = [values[0] - 1, *((a + b) / 2 for a, b in zip(values, values[1:])), values[-1] + 1]
    cut = min(edges, key=lambda e: (sum(w < e for w in good) / len(good)
                                    + sum(w >= e for w in bad) / len(bad), e))
    keys = []
    for (_, text), w in zip(docs, weights):
        uniform = ((spark_hash(7, text) >> 11) + 0.5) / 2 ** 53
        keys.append(w - log(-log(uniform)))
    k = sum(w >= cut for w in weights)
    least = sorted(keys, reverse=True)[k - 1]
    return [(d, w, key, key >= least) for (d, _), w, key in zip(docs, weights, keys)]


def test_op6(spark, documents):
    labels = {}
    for d, q in pairs(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "quality"):
        labels[d] = min(q, labels.get(d, q))
    want = sorted(importance(pairs(documents, "doc_id", "text"), labels))
    got = sorted(tuple(r) for r in QUERIES["op6_quality"](spark, SF).collect())
    assert [(g[0], g[3]) for g in got] == [(w[0], w[3]) for w in want]
    for g, w in zip(got, want):
        assert abs(g[1] - w[1]) < 1e-6 and abs(g[2] - w[2]) < 1e-6


# op3, worked out with dictionaries and a plain dynamic program --------------------------------------

def grams_of(word):
    code = [2, 2, *map(ord, word.lower()), 3]
    for a, b, c in zip(code, code[1:], code[2:]):
        context = (a * 0x9E3779B97F4A7C15 + b) * 0xC2B2AE3D27D4EB4F & MASK
        yield context >> 48, ((context ^ c) * 0x165667B19E3779F9 & MASK) >> 48


def letter_words(text):
    return [w for w in re.findall(r"[^\W\d_]+", text or "") if any(map(str.isalpha, w))]


def script(word):
    return [name for start, name in SCRIPT_STARTS if start <= ord(word.lower()[0])][-1]


def languages(train, texts, penalty=6.0):
    """(language, share of letters) of each text, from (text, lang) pairs."""
    counts, scripts = defaultdict(Counter), defaultdict(Counter)
    for text, lang in train:
        for word in letter_words(text):
            scripts[lang][script(word)] += 1
            for context, gram in grams_of(word):
                counts[lang]["c", context] += 1
                counts[lang]["g", gram] += 1
    langs = sorted(counts)

    def word_scores(word):
        fits = [scripts[x][script(word)] >= 0.01 * sum(scripts[x].values()) for x in langs]
        sums = [sum(log(counts[x]["g", g] + 0.1) - log(counts[x]["c", c] + 6.4)
                    for c, g in grams_of(word)) if fit else None for x, fit in zip(langs, fits)]
        best = max((s for s in sums if s is not None), default=0)
        return [0 if not any(fits) else max((s if s is not None else -1e9) - best, -25) for s in sums]

    out = []
    for text in texts:
        words = letter_words(text)
        if not words:
            out.append(("und", 0.0))
            continue
        paths = [(0.0, [])] * len(langs)
        for n, word in enumerate(words):
            own = word_scores(word)
            top = max(range(len(langs)), key=lambda k: paths[k][0])
            paths = [(max(paths[k][0], paths[top][0] - penalty * (n > 0)) + own[k],
                      (paths[k] if n == 0 or paths[k][0] >= paths[top][0] - penalty else paths[top])[1]
                      + [k]) for k in range(len(langs))]
        labels = max(paths, key=lambda p: p[0])[1]
        letters = Counter()
        for word, k in zip(words, labels):
            letters[k] += len(word)
        k = min(letters, key=lambda k: (-letters[k], k))
        out.append((langs[k], letters[k] / sum(letters.values())))
    return out


def test_op3(spark, documents):
    docs = [r for r in pairs(documents, "doc_id", "text", "lang")]
    held = {d: zlib.crc32(str(d).encode()) % 3 == 1 for d, _, _ in docs}
    train = {(t, x) for d, t, x in docs if not held[d] and x is not None and letter_words(t)}
    want = languages(train, [t if len(t or "") < 4_000 else None for _, t, _ in docs])
    got = {r["doc_id"]: r for r in QUERIES["op3_language_id"](spark, SF).collect()}
    assert len(got) == len(docs)
    for (doc, text, _), (lang, score) in zip(docs, want):
        assert got[doc]["held_out"] == held[doc]
        if len(text or "") < 4_000:  # the plain program keeps whole paths
            assert got[doc]["lang_pred"] == lang and abs(got[doc]["score"] - score) < 1e-9


# op2's chains ---------------------------------------------------------------------------------------

def test_op2_ratios(spark, documents):
    samples = secret_scan.pattern_labelled(documents.select("doc_id", "text"))
    model = secret_scan.train(samples)
    size = secret_scan.SYMBOLS
    count = {True: Counter(), False: Counter()}
    for value, label in pairs(samples, "value", "label"):
        code = [ord(c) - 32 if 33 <= ord(c) <= 126 else 0 for c in value]
        count[label].update(zip(code, code[1:]))
    chains = []
    for label in (True, False):
        total, after, rows_ = sum(count[label].values()), Counter(), Counter()
        for (a, b), n in count[label].items():
            after[b] += n
            rows_[a] += n
        chains.append([0.95 * (count[label][a, b] + 20 * after[b] / total) / (rows_[a] + 20) + 0.05 / size
                       for a in range(size) for b in range(size)])
    assert all(abs(r - log(x / y)) < 1e-9 for r, x, y in zip(model.ratios, *chains))
