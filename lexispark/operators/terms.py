"""Term extraction: token patterns, spans, candidate filters and keyword fallbacks."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions import scoring, text as T, validity
from lexispark.operators import keywords as single
from lexispark.operators import tagging
from lexispark.session import scratch_table

SPAN = "struct<start:int,end:int,text:string>"


def deoverlap(spans: Column) -> Column:
    """Left fold over spans by (start, longest first): a span joins if it starts at or after the last end; else it replaces the last if it ends later.

    spans: array of (start, end, text).
    """
    order = lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0)
    none = F.expr(f"cast(array() as array<{SPAN}>)")

    def step(kept: Column, s: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        joins = last.isNull() | (s["start"] >= last["end"])
        replaces = ~joins & (s["end"] > last["end"])
        head = F.when(replaces, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
        return F.when(joins | replaces, F.concat(head, F.array(s))).otherwise(kept)

    return F.aggregate(F.array_sort(spans.cast(f"array<{SPAN}>"), order), none, step)


# --- token patterns ---

def token_spans(text: Column) -> Column:
    """The words of a text with their places, split at white space and with edge punctuation taken off: array of (start, end, text)."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?U)(?<=\s)|(?=\s)")
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        lead = F.length(p) - F.length(F.regexp_replace(p, r"^[^\p{L}\p{N}]+", ""))
        core = F.regexp_replace(p, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
        at = acc["at"] + lead
        span = F.struct(at.alias("start"), (at + F.length(core)).alias("end"), core.alias("text"))
        return F.struct((acc["at"] + F.length(p)).alias("at"), F.when(core == "", acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def lexicon_tagger(tags: dict[str, str], default: str = "N") -> Callable[[Column], Column]:
    """A tagger of tokens from a small word list: lower-cased word to A (adjective), N (noun) or X (other)."""
    table = F.create_map(*[F.lit(x) for kv in tags.items() for x in kv])
    return lambda token: F.coalesce(F.try_element_at(table, F.lower(token["text"])), F.lit(default))


def pattern_spans(tokens: str, tagger: Callable[[Column], Column], text: str) -> Column:
    """All matches of the token patterns over an array column of (start, end, text). tokens and text name columns."""
    t = F.col(tokens)

    def fits(item: str, token: Column) -> Column:
        if item.isupper():
            return tagger(token).isin(list(item))
        return F.lower(token["text"]).isin(item.split("|"))

    def matches(items: list[str]) -> Column:
        n = len(items)

        def match(i: Column) -> Column:
            at = [F.get(t, i + k) for k in range(n)]
            ok = reduce(lambda x, y: x & y, [fits(item, token) for item, token in zip(items, at, strict=True)])
            start, end = at[0]["start"], at[-1]["end"]
            return F.when(ok, F.struct(start.alias("start"), end.alias("end"), F.substr(F.col(text), start + 1, end - start).alias("text")))

        hits = F.array_compact(F.transform(F.sequence(F.lit(0), F.size(t) - n), match))
        return F.when(F.size(t) >= n, hits).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))

    return F.concat(*[matches(items) for items in fixed.TOKEN_PATTERNS.values()])


# --- term rows ---

def term_rows(spans: DataFrame, key: str, column: str = "spans") -> DataFrame:
    """Spans as terms: valid ones, the first of each lower-cased form per text, with their domain."""
    # posexplode_outer: for posexplode, the optimizer would derive a filter that evaluates the spans once more
    rows = spans.select(key, F.posexplode_outer(column).alias("pos", "s")).filter("s IS NOT NULL")
    if "words" in rows.schema["s"].dataType.names:  # a fitted model's: they have no spaces at their edges, and their words are counted
        rows = rows.filter((F.length("s.text") >= 3) & F.col("s.words").between(1, 6)).select(key, "pos", F.col("s.text").alias("term"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    else:
        rows = rows.select(key, "pos", T.strip(F.col("s.text")).alias("term"), F.col("s.start").alias("start"), F.col("s.end").alias("end")).filter(validity.is_extractable(F.col("term")))
    return _first_by_form(rows, key).withColumn("domain", scoring.domain_of(F.col("normalized_term")))


def _first_by_form(rows: DataFrame, key: str) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    return (
        rows.withColumn("normalized_term", F.lower("term")).groupBy(key, "normalized_term")
        .agg(F.min_by(F.struct(*rest), F.col("pos")).alias("__t"))
        .select(key, *[F.col(f"__t.{c}").alias(c) for c in rest], "normalized_term")
    )


def filter_candidates(terms: DataFrame, key: str) -> DataFrame:
    """Strip numeric prefixes, drop invalid terms, keep the first of each form per text. The domain is not set anew after the strip.

    terms: key, pos (order in the text), term and any other columns.
    """
    own = [c for c in terms.columns if c != "normalized_term"]
    cleaned = terms.select(*own).withColumn("term", T.strip_numeric_prefix(T.strip(F.col("term"))))
    return _first_by_form(cleaned.filter(validity.is_valid(F.col("term"))), key)


def matched(texts: DataFrame, text: str, tagger: Callable[[Column], Column] | tagging.Model) -> DataFrame:
    """Add __spans, the matches of the token patterns; by a fitted model also __chunks, its noun chunks."""
    if not isinstance(tagger, tagging.Model):
        return texts.withColumn("__tokens", token_spans(F.col(text))).withColumn("__spans", pattern_spans("__tokens", tagger, text))
    tagged = tagging.annotate(texts, text, tagger, "__tagged").withColumns({"__tokens": F.col("__tagged.tokens"), "__chunks": F.col("__tagged.chunks")})
    return tagged.withColumn("__spans", pattern_spans("__tokens", lambda token: token["tag"], text))


def kept_spans(texts: DataFrame, key: str, text: str, tagger: Callable[[Column], Column] | tagging.Model, chunks: str | bool = False) -> DataFrame:
    """key and spans: the matches of the token patterns without overlaps, with chunks (an array column, or True for those of a fitted model) or without."""
    if isinstance(tagger, tagging.Model) and isinstance(chunks, bool):
        return tagging.spans(texts, text, tagger, [key], "spans", chunks)
    found = matched(texts, text, tagger)
    every = F.concat(F.col(chunks).cast(f"array<{SPAN}>"), "__spans") if chunks else F.col("__spans")
    return found.select(key, deoverlap(every).alias("spans"))


def extract(texts: DataFrame, key: str, text: str, tagger: Callable[[Column], Column] | tagging.Model, least: int = 3, chunks: str | None = None) -> DataFrame:
    """Terms of each text by patterns and noun chunks (of a fitted model, or an array column).

    Where fewer than `least` are found, keywords follow: those nearest to the whole text, then those by statistics that are new. Terms and such texts are written once, as both are read again.
    """
    spans = kept_spans(texts, key, text, tagger, isinstance(tagger, tagging.Model) if chunks is None else chunks)
    primary = scratch_table(term_rows(spans, key), "terms")
    counts = primary.groupBy(key).agg(F.count("*").alias("__n"))
    poor = scratch_table(texts.select(key, text).join(counts, key, "left").filter(F.coalesce("__n", F.lit(0)) < least).drop("__n"), "poor-texts")
    near, telling = single.embedded(poor, key, text), single.statistical(poor, key, text)
    words = near.select(key, (F.lit(1_000_000) + F.col("rank")).alias("pos"), "term").unionByName(telling.select(key, (F.lit(2_000_000) + F.col("rank")).alias("pos"), "term"))
    words = words.groupBy(key, "term").agg(F.min("pos").alias("pos"))
    words = words.join(poor, key).select(key, "pos", "term", T.find_span(F.col(text), F.col("term")).alias("__s"))
    extra = words.select(key, "pos", "term", F.col("__s.start").alias("start"), F.col("__s.end").alias("end"))
    extra = extra.filter(validity.is_extractable(F.col("term"))).withColumn("domain", scoring.classify_domain(F.col("term"))).withColumn("normalized_term", F.lower("term"))
    if isinstance(tagger, tagging.Model):
        words, closed = T.words(F.col("normalized_term")), sorted(tagger.closed)  # bounded: the stopwords and a few short words
        extra = extra.filter(~F.get(words, F.lit(0)).isin(closed) & ~F.try_element_at(words, F.lit(-1)).isin(closed))
    new = extra.join(primary.select(key, "normalized_term"), [key, "normalized_term"], "left_anti")
    return primary.unionByName(new.select(*primary.columns))


# --- keywords ---

def keywords(texts: DataFrame, key: str, text: str, longest: int = 4, top: int = 15) -> DataFrame:
    """Statistical keywords: n-grams whose edges are no stopwords, by how often and how early they stand, longer ones first on ties.

    score = frequency * words of the n-gram / (1 + log(1 + first position)). Counts are per text and n-gram before any window. Texts are shuffled once; n-grams stay where their text is.
    """
    tokens = F.filter(F.transform(T.words(F.lower(F.col(text))), lambda w: T.strip_punctuation(w)), lambda w: w != "")
    base = single.dealt(texts.select(key, text), key, text).select(key, tokens.alias("__w"))

    def of_size(n: int) -> Column:
        gram = lambda i: F.struct(F.array_join(F.slice(F.col("__w"), i + 1, n), " ").alias("term"), i.alias("at"), F.lit(n).alias("n"), F.get("__w", i).alias("a"), F.get("__w", i + (n - 1)).alias("b"))
        return F.when(F.size("__w") >= n, F.transform(F.sequence(F.lit(0), F.size("__w") - n), gram))

    grams = [of_size(n) for n in range(1, longest + 1)]
    empty = F.expr("cast(array() as array<struct<term:string,at:int,n:int,a:string,b:string>>)")
    rows = base.select(key, F.explode_outer(F.concat(*[F.coalesce(g, empty) for g in grams])).alias("g")).select(key, "g.*")
    rows = rows.filter(~F.col("a").isin(fixed.STOPWORDS) & ~F.col("b").isin(fixed.STOPWORDS) & (F.length("term") >= fixed.LEAST_TERM_CHARS))
    scored = rows.groupBy(key, "term").agg(F.count("*").alias("f"), F.min("at").alias("at"), F.first("n").alias("n"))
    scored = scored.withColumn("score", F.round(F.col("f") * F.col("n") / (1 + F.log1p(F.col("at"))), 6))
    order = Window.partitionBy(key).orderBy(F.desc("score"), F.desc("n"), "term")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(key, "term", "rank", "score")


def yake_features(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Single-word keyness from position, frequency and spread (lower is better), after the published unsupervised method.

    casing, position of the median sentence, frequency against mean plus deviation, and the share of sentences.
    """
    whole = Window.partitionBy(key)
    parts = F.split(F.coalesce(F.col(text), F.lit("")), r"[.!?\n]+")
    # texts are shuffled once, and all that follows keeps their partitioning
    base = single.dealt(texts.select(key, text).filter(F.col(key).isNotNull()), key, text).select(key, parts.alias("x"))
    sentences = base.withColumn("n", F.sum(F.size("x")).over(whole).cast("double")).select(key, "n", F.posexplode_outer("x").alias("s", "sentence"))
    rows = sentences.select(key, "n", "s", F.explode_outer(T.words(F.col("sentence"))).alias("w")).withColumn("term", T.strip_punctuation(F.lower("w"))).filter((F.col("term") != "") & ~F.col("term").isin(fixed.STOPWORDS))
    by_sentence = rows.groupBy(key, "term", "s").agg(F.count("*").alias("tf"), F.count_if(F.col("w").rlike(r"^\p{Lu}")).alias("upper"), F.max("n").alias("n"))
    by_term = by_sentence.groupBy(key, "term").agg(
        F.sum("tf").cast("double").alias("tf"), F.sum("upper").cast("double").alias("upper"), F.percentile("s", 0.5, F.col("tf")).alias("median"), F.count("*").cast("double").alias("spread"), F.max("n").alias("n"),
    )
    joined = by_term.withColumns({"mean": F.avg("tf").over(whole), "dev": F.stddev_pop("tf").over(whole)})
    position = F.log(F.log(F.lit(3.0) + F.col("median")))
    frequency = F.col("tf") / (F.col("mean") + F.col("dev"))
    casing = F.col("upper") / (1 + F.log("tf"))
    spread = F.col("spread") / F.col("n")
    return joined.select(key, "term", F.round(position / (casing + frequency + spread + F.lit(math.ulp(1.0))), 6).alias("keyness"))
