"""Secrets in text: fixed patterns, and character Markov models for everything they miss.

Two chains of characters, one of random strings and one of ordinary tokens, are estimated from
labelled samples. A long unbroken token whose mean log-likelihood ratio favours the random chain is
reported besides the pattern matches. Everything is built-in column functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import log
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hash_sample

#: The base patterns, the capture group whose length counts, and its least length.
BASE = {
    "assign": (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
               r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: One of these, in lower case, is in every text with an assignment; looked for as it is quicker.
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
#: Tokens that are scored. A text without such a run has no match of the other patterns either.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
#: What the base patterns without a keyword match, their least lengths within; not ordinary.
MATCHED = r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}"
KINDS = (*BASE, "markov")
#: Characters are numbered by code from 33 on; anything outside ASCII's visible range shares one.
SYMBOLS = 95
SPAN = "array<struct<start:int,kind:int,end:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column], block: int = 128) -> Column:
    """What ``combine`` makes of 0 and all values before each one.

    Arrays cannot grow in place, so one that grew by every value would cost the square of their number;
    here those of a block grow, and one with an entry for each block.
    """
    def last(done: Column) -> Column:
        return F.element_at(done, -1)

    def grown(parts: Column, start: Column) -> Column:
        return F.slice(F.aggregate(parts, F.array(start), lambda done, v: F.concat(
            done, F.array(combine(last(done), v)))), F.lit(1), F.size(parts))

    def blocks(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int")),
                           lambda k: F.slice(v, k * block + 1, F.lit(block)))

    def all_of(parts: Column) -> Column:
        tops = F.transform(parts, lambda b: F.aggregate(b, F.lit(0), combine))
        return let(grown(tops, F.lit(0)), lambda starts: F.flatten(F.zip_with(parts, starts, grown)))

    none = F.array().cast("array<int>")
    return let(values, lambda v: F.when(F.size(v) == 0, none).otherwise(let(blocks(v), all_of)))


def placed(items: Column, kind: int) -> Column:
    """Spans of the good ones of ``items`` (gap, size, good), which lie end to end, each after its gap."""
    def all_of(x: Column) -> Column:
        begins = running(F.transform(x, lambda i: i["gap"] + i["size"]), lambda a, b: a + b)
        return F.filter(F.zip_with(x, begins, lambda i, at: F.when(i["good"], F.struct(
            (at + i["gap"]).alias("start"), F.lit(kind).alias("kind"),
            (at + i["gap"] + i["size"]).alias("end")))), lambda span: span.isNotNull())

    # Most texts have matches, few have good ones.
    return let(items, lambda x: F.when(F.exists(x, lambda i: i["good"]), all_of(x)).otherwise(
        F.array().cast(SPAN)))


def item(gap: Column, match: Column, good: Column) -> Column:
    return F.struct(F.length(gap).alias("gap"), F.length(match).alias("size"), good.alias("good"))


def spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of a pattern's matches with ``least`` characters in ``group``, leftmost and
    non-overlapping, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    gaps = F.split(text, pattern, -1)
    return placed(let(matches, lambda m: F.zip_with(
        F.arrays_zip(m.alias("m"), values.alias("v")), F.slice(gaps, 1, F.size(m)),
        lambda x, gap: item(gap, x["m"], F.length(x["v"]) >= least))), kind)


def token_spans(text: Column, good: Callable[[Column], Column], kind: int, assigned: Column) -> Column:
    """Spans of the good tokens outside of assignments, which count only where ``assigned``."""
    pattern, _, _ = BASE["assign"]
    segments = F.when(assigned, F.split(text, pattern, -1)).otherwise(F.array(text))
    after = F.when(assigned, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(
        F.array().cast("array<string>"))

    def of_segment(segment: Column, match: Column) -> Column:
        tokens = F.transform(F.regexp_extract_all(segment, F.lit(TOKEN), F.lit(0)), lambda t: F.struct(
            t.alias("t"), good(t).alias("good")))
        end = F.struct(F.coalesce(match, F.lit("")).alias("t"), F.lit(False).alias("good"))
        return F.zip_with(F.concat(tokens, F.array(end)), F.split(segment, TOKEN, -1),
                          lambda x, gap: item(gap, x["t"], x["good"]))

    return placed(F.flatten(F.zip_with(segments, after, of_segment)), kind)


def may_assign() -> Column:
    lower = F.lower(F.coalesce(F.col("text"), F.lit("")))
    return reduce(or_, [lower.contains(w) for w in ASSIGN_WORDS])


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Add ``base_found``, the base patterns' spans by start and then kind, and ``_long``, whether
    the text holds any long token."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(SPAN)
    first = {"assign": may_assign(), "access": F.col("_long") & text.contains("AKIA"), "hex": F.col("_long")}
    found = [F.when(first[name], spans(text, pattern, kind, group, least)).otherwise(none)
             for kind, (name, (pattern, group, least)) in enumerate(BASE.items())]
    return (docs.withColumn("_long", F.coalesce(F.regexp_like("text", F.lit(TOKEN)), F.lit(False)))
            .withColumn("base_found", F.array_sort(F.concat(*found))))


def _code(char: Column) -> Column:
    code = F.ascii(char)
    return F.when(code.between(33, 126), code - 32).otherwise(0)


def _transitions(token: Column) -> Column:
    """Numbers of a token's successive character pairs."""
    codes = F.transform(F.split(token, ""), _code)
    after = F.slice(codes, 2, F.greatest(F.length(token) - 1, F.lit(1)))
    return F.slice(F.zip_with(codes, after, lambda a, b: a * SYMBOLS + F.coalesce(b, F.lit(0))),
                   1, F.greatest(F.length(token) - 1, F.lit(1)))


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratio of each transition, random over ordinary, as one array literal."""

    ratios: tuple[float, ...]
    threshold: float

    def score(self, token: Column) -> Column:
        """Mean log-likelihood ratio per transition."""
        table = F.split(F.lit(",".join(f"{r:.6g}" for r in self.ratios)), ",").cast("array<double>")
        steps = _transitions(token)
        return F.aggregate(steps, F.lit(0.0), lambda s, t: s + F.get(table, t)) / F.size(steps)


def train(samples: DataFrame, threshold: float = 0.6, unseen: float = 0.05,
          fallback: float = 20.0) -> MarkovModel:
    """Fit both chains on a frame of value and label (true: random string).

    In every context of either chain the share ``unseen`` is spread over all characters, whatever
    the number of samples, so a character new to both says nothing. The result has one number per
    pair of characters. Null values and labels are left out; a chain without samples is uniform.
    """
    pairs = (samples.where((F.length("value") >= 2) & F.col("label").isNotNull())
             .select(F.col("label").cast("boolean").alias("label"),
                     F.explode(_transitions(F.col("value"))).alias("pair"))
             .groupBy("label", "pair").count().collect())
    counts = {True: [0.0] * SYMBOLS ** 2, False: [0.0] * SYMBOLS ** 2}
    for label, pair, count in pairs:
        counts[label][pair] += count

    def chain(label: bool) -> list[float]:
        own = counts[label]
        rows = [sum(own[a * SYMBOLS:(a + 1) * SYMBOLS]) for a in range(SYMBOLS)]
        total = sum(rows)
        # How often each character follows any: what a context seen too rarely falls back to.
        overall = [sum(own[b::SYMBOLS]) / total if total else 1 / SYMBOLS for b in range(SYMBOLS)]
        return [(1 - unseen) * (own[p] + fallback * overall[p % SYMBOLS])
                / (rows[p // SYMBOLS] + fallback) + unseen / SYMBOLS for p in range(SYMBOLS ** 2)]

    return MarkovModel(tuple(log(r / o) for r, o in zip(chain(True), chain(False))), threshold)


def pattern_labelled(docs: DataFrame, size: int = 2_000) -> DataFrame:
    """Labelled samples from the texts: matched secrets are random strings, other tokens ordinary.

    Both sides hold what the texts may lack. For each ordinary token there is a random string, the
    letters and digits of its hash in mixed, lower or upper case; and an ordinary one, the token
    between numbers and runs of a separator, as in slugs, dates, constants and rulers. Distinct values,
    drawn from the ``size`` distinct texts with the smallest hashes, so bounded by that number.
    """
    texts = hash_sample(docs.where(F.length("text") > 0).select("text"), F.col("text"), size)
    found = F.concat(*[F.filter(F.regexp_extract_all("text", F.lit(pattern), F.lit(group)),
                                lambda v, n=max(16, least): F.length(v) >= n)
                       for pattern, group, least in BASE.values()])
    matched = texts.select(F.explode(found).alias("value"), F.lit(True).alias("label")).distinct()
    rest = F.regexp_replace(F.regexp_replace("text", BASE["assign"][0], " "), MATCHED, " ")
    words = (texts.select(F.explode(F.regexp_extract_all(rest, F.lit(r"[A-Za-z0-9+/_=-]{4,}"),
                                                         F.lit(0))).alias("value")).distinct())
    value, number = F.col("value"), F.crc32("value")
    digest = F.regexp_replace(F.base64(F.unhex(F.md5("value"))), "[^A-Za-z0-9]", "")
    random = F.when(number % 3 == 0, F.lower(digest)).when(number % 3 == 1, F.upper(digest)) \
        .otherwise(digest)
    mark = F.substring(F.lit("-_/=+"), (number % 5 + 1).cast("int"), F.lit(1))
    digits = F.lpad((number % 10_000).cast("string"), 4, "0")
    name = F.when(number % 2 == 0, F.upper(value)).otherwise(value)
    shaped = F.concat(digits, mark, F.substring(digits, 2, 2), mark, name, mark, digits,
                      F.repeat(mark, (number % 7 + 1).cast("int")))
    both = words.select(F.explode(F.array(
        F.struct(value.alias("value"), F.lit(False).alias("label")),
        F.struct(shaped.alias("value"), F.lit(False).alias("label")),
        F.struct(random.alias("value"), F.lit(True).alias("label")))).alias("s")).select("s.*")
    return matched.unionByName(both).distinct()


def joined(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_secret_spans(docs: DataFrame, model: MarkovModel) -> DataFrame:
    """Add ``base_found`` and ``all_found``: arrays of start, kind (index into KINDS), end.

    Base spans always stay; tokens are looked for outside of assignments, and one that holds another
    base match is not scored. A null or empty text has none. Texts of any length are scanned whole, in
    time that is in proportion to it. One pass without a shuffle; rows, repeated or not, and other
    columns pass unchanged, columns of these names are replaced; an empty table stays empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def random(token: Column) -> Column:
        return ~token.rlike(MATCHED) & (model.score(token) > model.threshold)

    scored = token_spans(text, random, len(BASE), may_assign())
    extra = F.when(F.col("_long"), scored).otherwise(F.array().cast(SPAN))
    return (with_base_spans(docs.drop("_long", "base_found", "all_found"))
            .withColumn("all_found", F.array_sort(F.concat("base_found", extra))).drop("_long"))


def redacted(text: Column, found: Column, mark: str = "[SECRET]", block: int = 256) -> Column:
    """The text with every found span, overlapping ones as one, replaced by a mark.

    The text is cut to blocks first, since a substring is counted from the front of what it is taken
    from."""
    def piece(blocks: Column, begin: Column, end: Column) -> Column:
        first, last = F.floor(begin / block).cast("int"), F.floor((end - 1) / block).cast("int")
        head = F.substring(F.get(blocks, first), begin % block + 1, F.least(F.lit(block), end - begin))
        tail = F.substring(F.get(blocks, last), F.lit(1), (end - 1) % block + 1)
        middle = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        return F.when(begin >= end, "").when(first == last, head).otherwise(
            F.concat(head, middle, tail))

    def pieces(blocks: Column, spans_: Column, before: Column) -> Column:
        kept = F.zip_with(spans_, before, lambda s, done: F.when(s["start"] < done, "").otherwise(
            F.concat(piece(blocks, done, s["start"]), F.lit(mark))))
        end = F.greatest(F.element_at(before, -1), F.element_at(spans_, -1)["end"])
        return F.concat(F.array_join(kept, ""), piece(blocks, end, F.length(text)))

    ends = F.transform(found, lambda s: s["end"])
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return F.when(F.size(found) == 0, text).otherwise(let(
        F.struct(cut.alias("blocks"), running(ends, lambda a, b: F.greatest(a, b)).alias("before")),
        lambda x: pieces(x["blocks"], found, x["before"])))
