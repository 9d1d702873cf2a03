"""Language of texts, with spans for mixed ones.

Every word is scored under each language by a chain of character trigrams learned from labelled
texts. The script of a word, by ranges of code points, leaves only the languages that are written in
it. A Viterbi pass over the word scores, with a penalty for each change of language, labels the
words; runs of one label are the spans.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gaugeline.llm.common import hash_sample_each

#: First code points of Unicode blocks and the script of what follows.
SCRIPT_STARTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"),
    (0x0780, "other"), (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0x4DC0, "other"), (0x4E00, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"),
    (0xFF00, "other"), (0xFF21, "latin"), (0xFF5B, "other"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0xFFDD, "other"), (0x20000, "han"), (0x32000, "other"))
STARTS = np.array([s for s, _ in SCRIPT_STARTS])
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
SCRIPT_OF_RANGE = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])
WORD = re.compile(r"[^\W\d_]+").findall
#: Hash buckets of the character contexts and trigrams.
BUCKETS = 1 << 16
REMEMBERED = 400_000
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
RESULT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                    ("spans", pa.list_(SPAN))])
COUNTS = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("bucket", pa.int64()),
                    ("count", pa.int64())])


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(script of each word, start of its trigrams, context buckets, trigram buckets)."""
    marked = ["\x02\x02" + w.lower() + "\x03" for w in words]
    sizes = np.array([len(m) for m in marked])
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = code.astype(np.uint64)
    ends = np.cumsum(sizes)
    third = np.ones(len(code), bool)
    third[ends - sizes] = third[ends - sizes + 1] = False
    third = np.flatnonzero(third)
    context = code[third - 2] * np.uint64(0x9E3779B97F4A7C15) + code[third - 1]
    context *= np.uint64(0xC2B2AE3D27D4EB4F)
    gram = (context ^ code[third]) * np.uint64(0x165667B19E3779F9)
    shift = np.uint64(64 - 16)
    script = SCRIPT_OF_RANGE[np.searchsorted(STARTS, code[ends - sizes + 2], side="right") - 1]
    return (script, np.cumsum(sizes - 2) - (sizes - 2), (context >> shift).astype(np.int64),
            (gram >> shift).astype(np.int64))


def letter_words(text: str | None) -> list[str]:
    """Runs of letters. Numerals that count as alphanumeric, such as fractions, are no letters."""
    words = WORD(text) if text else []
    if text and not text.isascii():
        words = [w for w in words if w.isalpha() or any(map(str.isalpha, w))]
    return words


def count_task(batches) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            words.setdefault(lang, Counter()).update(letter_words(text))
    for lang, counted in words.items():
        if not counted:
            continue
        script, starts, context, gram = features(list(counted))
        times = np.array(list(counted.values()))
        each = np.repeat(times, np.diff(np.r_[starts, len(gram)]))
        for kind, where, weight in (("context", context, each), ("gram", gram, each),
                                    ("script", script, times)):
            total = np.bincount(where, weight)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array([kind] * len(at)), pa.array(at, pa.int64()),
                 pa.array(total[at].astype(np.int64))], schema=COUNTS)


@dataclass
class LanguageModel:
    """Log probability of each trigram bucket given its context, and the scripts of each language."""

    langs: list[str]
    contexts: np.ndarray
    grams: np.ndarray
    candidates: np.ndarray
    known: dict[str, int] = field(default_factory=dict)
    scores: list[np.ndarray] = field(default_factory=list)

    def __getstate__(self):
        return {**self.__dict__, "known": {}, "scores": []}

    def score(self, words: list[str]) -> np.ndarray:
        """Log-odds of each word's languages; those not written in its script are ruled out."""
        script, starts, context, gram = features(words)
        total = np.add.reduceat(self.grams[gram] - self.contexts[context], starts, axis=0)
        allowed = self.candidates[script]
        total = np.where(allowed, total, -np.inf)
        best = total.max(axis=1, keepdims=True)
        # A script that no language is written in says nothing.
        best = np.where(np.isfinite(best), best, 0)
        total = np.where(allowed.any(axis=1, keepdims=True), np.maximum(total - best, -25), 0)
        return total.astype(np.float32)

    def lookup(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of the score table for each text's words."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.scores.clear()
        known = self.known
        unseen = list({w for words in texts for w in words}.difference(known))
        if unseen:
            known.update(zip(unseen, range(len(known), len(known) + len(unseen))))
            self.scores.append(self.score(unseen))
            if len(self.scores) > 64:
                self.scores[:] = [np.concatenate(self.scores)]
        get = known.__getitem__
        return [np.fromiter(map(get, words), np.int64, len(words)) for words in texts]


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word of a padded batch (text, word, language) of log-odds."""
    texts, longest, _ = scores.shape
    rows = np.arange(texts)
    best = scores[:, 0].copy()
    stayed = np.zeros(scores.shape, bool)
    source = np.zeros((texts, longest), np.int16)
    for t in range(1, longest):
        top = best.argmax(axis=1)
        source[:, t] = top
        change = best[rows, top] - penalty
        stayed[:, t] = best >= change[:, None]
        best = np.maximum(best, change[:, None]) + np.where((t < lengths)[:, None], scores[:, t], 0)
    labels = np.zeros((texts, longest), np.int16)
    label = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        labels[:, t] = label
        label = np.where(stayed[rows, t, label], label, source[:, t])
    return labels


def train(labelled: DataFrame, size: int = 6_000, least_share: float = 0.01,
          smoothing: float = 0.1, languages: int = 500) -> LanguageModel:
    """Fit on a frame of text and lang.

    Of each language the ``size`` distinct texts with letters and the smallest hashes are used (a
    bound, for the model is small), so every language that has such a text is learned; rows without
    text or language are left out. A column that names more than ``languages`` of them is taken for
    dirty: those with most texts are learned, equal ones by name. A language is a candidate for the scripts that hold
    ``least_share`` of its words.
    """
    # Unassigned code points pass too: Python may know letters that the JVM does not.
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"[\p{L}\p{Cn}]"))
    common = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    usable = usable.join(common.select("lang"), "lang", "left_semi")
    sample = hash_sample_each(usable.select("text", "lang"), "lang", F.struct("text", "lang"), size)
    counted = (sample.select("lang", "text").mapInArrow(count_task, from_arrow_schema(COUNTS))
               .groupBy("lang", "kind", "bucket").agg(F.sum("count").alias("count")).toPandas())
    langs = sorted(counted["lang"].unique())
    tables = {"context": np.zeros((BUCKETS, len(langs))), "gram": np.zeros((BUCKETS, len(langs))),
              "script": np.zeros((len(SCRIPTS), len(langs)))}
    for (kind, lang), rows in counted.groupby(["kind", "lang"]):
        tables[kind][rows["bucket"].to_numpy(), langs.index(lang)] = rows["count"].to_numpy()
    share = tables["script"] / np.maximum(tables["script"].sum(axis=0), 1)
    return LanguageModel(langs, np.log(tables["context"] + 64 * smoothing).astype(np.float32),
                         np.log(tables["gram"] + smoothing).astype(np.float32),
                         share >= least_share)


def label_batch(model: LanguageModel, texts: list[str | None], penalty: float,
                words_at_once: int = 100_000) -> list[tuple[str, float, list]]:
    """(language, share of letters, spans) of each text."""
    words = [letter_words(t) for t in texts]
    out: list = [("und", 0.0, [])] * len(texts)
    if not model.langs:
        return out
    ids = model.lookup(words)
    table = np.concatenate(model.scores) if model.scores else None
    order = sorted((k for k in range(len(texts)) if words[k]), key=lambda k: len(words[k]))
    while order:
        longest = len(words[order[-1]])
        group = order[-max(1, min(256, words_at_once // longest)):]
        del order[-len(group):]
        lengths = np.array([len(words[k]) for k in group])
        scores = np.zeros((len(group), longest, len(model.langs)), np.float32)
        for row, k in enumerate(group):
            scores[row, :lengths[row]] = table[ids[k]]
        labels = viterbi(scores, lengths, penalty)
        for row, k in enumerate(group):
            own = labels[row, :lengths[row]]
            letters = np.bincount(own, np.fromiter(map(len, words[k]), np.int64, len(own)),
                                  minlength=len(model.langs))
            lang = int(letters.argmax())
            ends = np.r_[np.flatnonzero(own[1:] != own[:-1]) + 1, len(own)]
            spans = [{"start": s, "end": e, "lang": model.langs[own[s]]}
                     for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]
            out[k] = (model.langs[lang], float(letters[lang] / letters.sum()), spans)
    return out


def predict_task(batches, model: LanguageModel, penalty: float,
                 rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            part = batch.slice(k, rows)
            found = label_batch(model, part["text"].to_pylist(), penalty)
            columns = [part["doc_id"], *([f[n] for f in found] for n in range(3))]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                 for c, f in zip(columns, RESULT)], schema=RESULT)


def predict(docs: DataFrame, model: LanguageModel, penalty: float = 6.0,
            rows: int = 1_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, spans.

    Only text is looked at. ``spans`` are runs of words (runs of letters, numbered from 0) with
    their language; ``lang_pred`` has most letters, ``score`` is its share of them. A text that is
    null or has no letter, or a model without languages, gives ``und``, 0 and no spans. Texts of any
    length are read whole, repeated rows are predicted each, an empty table gives no rows, and other
    columns are not read, whatever their names. Nothing is shuffled; the model, of fixed size for each language, travels with the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: predict_task(batches, shared.value, penalty, rows),
        from_arrow_schema(RESULT))
