"""Keywords of single texts: by statistics of their words as published (`statistical`), and by nearness of their n-grams to the whole text (`embedded`).

Both read whole texts and know nothing of other texts. `key` must tell the texts apart. Defined results: a null, empty or wordless text has no keywords; equal texts have equal ones; ties go
to the first term in code-point order; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions import text as T
from lexispark.operators.tagging import portions
from lexispark.session import ship

SENTENCE = r"(?<=[.!?])\s+|\n+"
LONGEST_CHARS = 200  # of an n-gram: what is longer is no term
SHORT = 3  # words of fewer characters count as stopwords
DIMENSIONS = 64
BLOCK = 4_096
PART_CHARS = 1 << 21  # of texts whose words or n-grams become rows of one task
WORDS = 4_096  # whose n-grams are hashed together
_STOP = frozenset(fixed.STOPWORDS)


# --- statistics ---

def statistical(texts: DataFrame, key: str, text: str, longest: int = 4, top: int = 15, alike: float = 0.7) -> DataFrame:
    """key, term, rank, score: the `top` n-grams of the least score, without those more alike to a better one than `alike`.

    A word's weight takes its casing, its place (the median sentence that holds it), its frequency against the mean and deviation of the text's words, the spread over sentences, and how many
    different neighbours it has on either side. An n-gram's score is the product of its words' weights over its frequency times one plus their sum; a stopword inside counts by
    the probability of the pairs that it forms. n-grams stay within a run of words without signs between them; none starts or ends with a stopword, or holds a word with digits.

    Texts are shuffled once, by key. Words, weights and n-grams of a portion of texts are arrays of a task, as rows they would be some hundred times the texts; `word_weights` gives the same
    weights as rows. The choice goes through a text's n-grams by score and holds `top` of them.
    """
    ship(texts.sparkSession)
    base = dealt(texts.select(F.col(key).alias("k"), F.col(text).alias("x")), "k", "x")
    kind = base.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in portions(batch.column(1)):
                part = batch.slice(a, b - a)
                row, term, rank, score = _chosen([t or "" for t in part.column(1).to_pylist()], longest, top, alike)
                columns = [part.column(0).take(pa.array(row, pa.int64())), pa.array(term, pa.string()), pa.array(rank, pa.int32()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["k", "term", "rank", "score"])

    chosen = base.mapInArrow(run, f"k {kind}, term string, rank int, score double")
    return chosen.select(F.col("k").alias(key), "term", "rank", "score")


def dealt(texts: DataFrame, key: str, text: str) -> DataFrame:
    """The texts shuffled by key into parts of about PART_CHARS characters each, which a first pass counts.

    What is made of a part, a row for each word or n-gram, is sorted and grouped within it and stays in memory. By the number of the session alone, or where small parts are put together,
    such rows take some hundred times the text and spill over and over.
    """
    chars = texts.agg(F.sum(F.length(text))).first()[0] or 0
    return texts.repartition(max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // PART_CHARS)), key)


def _words(texts: DataFrame, key: str, text: str) -> DataFrame:
    """k, n (sentences of the text), s and at (place), t (lower case), l and r (neighbours of the same run, or null), stop, upper, acronym: words with a letter and without digits."""
    base = dealt(texts.select(F.col(key).alias("k"), F.col(text).alias("x")), "k", "x")
    sentences = base.select("k", F.filter(F.split(F.coalesce("x", F.lit("")), SENTENCE), lambda s: s.rlike(r"[\p{L}\p{N}]")).alias("x"))
    # explode_outer and a filter, here and below: see the README
    rows = sentences.select("k", F.size("x").alias("n"), F.posexplode_outer("x").alias("s", "x")).filter("x IS NOT NULL")
    rows = rows.select("k", "n", "s", F.posexplode_outer(T.words(F.col("x"))).alias("at", "w")).filter("w IS NOT NULL")

    # each end is cut from the front, as a search for signs at the end is quadratic in a run of signs
    cut = lambda c: F.regexp_replace(c, r"^[^\p{L}\p{N}]+", "")
    w = F.col("w")
    plain = w.rlike(r"\p{L}") & ~w.rlike(r"\p{N}")
    rows = rows.select("k", "n", "s", "at", F.reverse(cut(F.reverse(cut(w)))).alias("word"), plain.alias("plain"), w.rlike(r"^[\p{L}\p{N}]").alias("opens"), w.rlike(r"[\p{L}\p{N}]$").alias("closes"))
    # the signs of a word are read once, before its neighbours look at them
    order = Window.partitionBy("k", "s").orderBy("at")
    rows = rows.withColumns({c: f(F.struct("word", "plain", "opens", "closes")).over(order) for c, f in (("b", F.lag), ("a", F.lead))}).filter("plain")
    beside = lambda c, near, own: F.when(F.col(f"{c}.plain") & F.col(f"{c}.{near}") & F.col(own), F.lower(f"{c}.word"))
    rows = rows.select("k", "n", "s", "at", "word", beside("b", "closes", "opens").alias("l"), beside("a", "opens", "closes").alias("r"))
    t, word = F.lower("word"), F.col("word")
    acronym = (F.length(word) > 1) & ~word.rlike(r"[^\p{Lu}]")
    return rows.select(
        "k", "n", "s", "at", t.alias("t"), "l", "r", (t.isin(fixed.STOPWORDS) | (F.length(t) < SHORT)).alias("stop"),
        (~acronym & (F.col("at") > 0) & word.rlike(r"^\p{Lu}")).cast("long").alias("upper"), acronym.cast("long").alias("acronym"),
    )


def word_weights(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, term, frequency, weight of every word of a text that is no stopword; the less, the more telling."""
    found = _weights(_words(texts, key, text)).filter(~F.col("stop"))
    return found.select(F.col("k").alias(key), F.col("t").alias("term"), F.col("tf").cast("long").alias("frequency"), "weight")


def _weights(words: DataFrame) -> DataFrame:
    """k, t, stop, tf, weight (0 for stopwords)."""
    by = words.groupBy("k", "t").agg(
        F.count("*").cast("double").alias("tf"), F.max("n").alias("n"), F.max("stop").alias("stop"), F.greatest(F.sum("upper"), F.sum("acronym")).cast("double").alias("case"),
        F.sort_array(F.collect_set("s")).alias("s"), F.size(F.collect_set("l")).alias("dl"), F.count("l").alias("cl"), F.size(F.collect_set("r")).alias("dr"), F.count("r").alias("cr"),
    )
    whole = Window.partitionBy("k")
    content = lambda c: F.sum(F.when(~F.col("stop"), c).otherwise(F.lit(0.0))).over(whole)
    # counts are whole numbers, so these sums don't depend on the order of the rows
    by = by.withColumns({"most": F.max("tf").over(whole), "m": F.greatest(content(F.lit(1.0)), F.lit(1.0)), "sum": content(F.col("tf")), "squares": content(F.col("tf") * F.col("tf"))})
    mean = F.col("sum") / F.col("m")
    usual = F.greatest(mean + F.sqrt(F.greatest(F.col("squares") / F.col("m") - mean * mean, F.lit(0.0))), F.lit(1.0))
    spread = F.size("s")
    median = (F.get("s", F.floor((spread - 1) / 2).cast("int")) + F.get("s", F.floor(spread / 2).cast("int"))) / 2
    share = lambda d, c: F.col(d) / F.greatest(F.col(c), F.lit(1))
    by = by.withColumn("rel", 1 + (share("dl", "cl") + share("dr", "cr")) * F.col("tf") / F.col("most")).withColumn("place", F.log(F.log(3 + median)))
    rel = F.col("rel")
    weight = rel * F.col("place") / (F.col("case") / (1 + F.log("tf")) + F.col("tf") / usual / rel + spread / F.col("n") / rel)
    return by.select("k", "t", "stop", "tf", F.when(F.col("stop"), 0.0).otherwise(weight).alias("weight"))


# --- statistics of a portion of texts, as arrays ---

LETTER, UPPER, NUMBER, SPACE, BLANK, STOP = 1, 2, 4, 8, 16, 32


@cache
def _kinds() -> np.ndarray:
    """What each code point is: letter, upper-case letter, number, white space (of words), white space of a sentence's end, sign of a sentence's end."""
    out = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for i in range(len(out)):
        kind = unicodedata.category(chr(i))
        out[i] = LETTER | UPPER * (kind == "Lu") if kind[0] == "L" else NUMBER * (kind[0] == "N")
    for i in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        out[i] |= SPACE | BLANK * (i <= 32)
    for c in ".!?":
        out[ord(c)] |= STOP
    return out


@dataclass
class _Words:
    """The words with a letter and without digits, as _words() gives them: the number of their text and sentence, of their lower-case form (in forms), and what the statistics ask of them."""

    of: np.ndarray
    sentence: np.ndarray
    sentences: np.ndarray
    form: np.ndarray
    forms: list[str]
    linked: np.ndarray  # to the word before, without signs between them
    upper: np.ndarray
    acronym: np.ndarray


def _words_of(texts: list[str]) -> _Words:
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = _kinds()[points]
    there = lambda flag: (kinds & flag) > 0
    ends = points == 10
    ends[1:] |= there(BLANK)[1:] & there(STOP)[:-1]
    part = np.cumsum(ends, dtype=np.int32)
    core, solid = np.flatnonzero(there(LETTER | NUMBER)), ~there(SPACE)
    # sentences are parts with a letter or digit, numbered within their text
    parts = np.unique(part[core])
    text_of_part = np.searchsorted(part[np.cumsum([len(t) + 1 for t in texts])[:-1] - 1], parts, "right")
    sentences = np.bincount(text_of_part, minlength=len(texts))
    number = np.arange(len(parts)) - (np.cumsum(sentences) - sentences)[text_of_part]
    edges = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    before = lambda flag: np.concatenate([[0], np.cumsum(there(flag), dtype=np.int32)])
    letters, numbers, uppers = before(LETTER), before(NUMBER), before(UPPER)
    plain = (letters[end] > letters[start]) & (numbers[end] == numbers[start])
    opens, closes = there(LETTER | NUMBER)[start], there(LETTER | NUMBER)[end - 1]
    own = part[start]
    follows = np.append(False, own[1:] == own[:-1])[: len(start)]
    linked = follows & plain & opens
    linked[1:] &= plain[:-1] & closes[:-1]
    start, end, own, follows, linked = (c[plain] for c in (start, end, own, follows, linked))
    a, b = core[np.searchsorted(core, start)], core[np.searchsorted(core, end) - 1] + 1
    high = uppers[b] - uppers[a]
    acronym = (b - a > 1) & (high == b - a)
    upper = ~acronym & follows & there(UPPER)[a]
    code: dict[str, int] = {}
    form = np.fromiter((code.setdefault(joined[x:y].lower(), len(code)) for x, y in zip(a.tolist(), b.tolist(), strict=True)), np.int64, len(a))
    at = np.searchsorted(parts, own)
    return _Words(text_of_part[at], number[at], sentences, form, list(code), linked, upper, acronym)


def _scored(w: _Words, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, last word, size and score of each different n-gram; the weights are those of _weights()."""
    if not len(w.of):
        return (np.zeros(0, dtype=np.int64),) * 4
    size, stops = np.array([len(f) for f in w.forms]), np.array([f in _STOP or len(f) < SHORT for f in w.forms])
    kind, u = np.unique(w.of * len(w.forms) + w.form, return_inverse=True)  # a text's different words
    of, form = np.divmod(kind, len(w.forms))
    many, stop, tf = len(kind), stops[form], np.bincount(u).astype(np.float64)
    sum_of = lambda at, weights=None: np.bincount(at, weights, many)
    j = np.flatnonzero(w.linked)
    pair, pairs, often = np.unique(u[j - 1] * many + u[j], return_inverse=True, return_counts=True)
    left, right = np.divmod(pair, many)
    share = lambda ends, counts: sum_of(ends) / np.maximum(sum_of(ends, counts), 1)
    spot = np.unique(u * (len(w.of) + 1) + w.sentence)
    held, place = np.divmod(spot, len(w.of) + 1)
    spread = sum_of(held)
    first = np.cumsum(spread) - spread
    median = (place[first + (spread - 1) // 2] + place[first + spread // 2]) / 2
    texts = len(w.sentences)
    content = lambda c: np.bincount(of, np.where(stop, 0.0, c), texts)
    m = np.maximum(content(1.0), 1.0)
    mean = content(tf) / m
    usual = np.maximum(mean + np.sqrt(np.maximum(content(tf * tf) / m - mean * mean, 0.0)), 1.0)[of]
    most = np.zeros(texts)
    np.maximum.at(most, of, tf)
    case = np.maximum(sum_of(u, w.upper), sum_of(u, w.acronym))
    rel = 1 + (share(right, often) + share(left, often)) * tf / most[of]
    weight = rel * np.log(np.log(3 + median)) / (case / (1 + np.log(tf)) + tf / usual / rel + spread / w.sentences[of] / rel)
    weight[stop] = 0.0
    # each word's pair with the one before, and how often that stands in the text
    by, count = np.zeros(len(u), dtype=np.int64), np.zeros(len(u))
    by[j], count[j] = pairs, often[pairs]
    out, silent, chars = [], stop[u], size[w.form]
    unbroken = np.ones(len(u), dtype=bool)
    for n in range(1, longest + 1):
        if n > 1:
            unbroken = np.append(False, unbroken[:-1])[: len(u)] & w.linked
            chars = np.append(0, chars[:-1])[: len(u)] + 1 + size[w.form]
        last = np.flatnonzero(unbroken & ~silent & (chars <= LONGEST_CHARS))
        last = last[~silent[last - n + 1]]
        if not len(last):
            continue
        name = u[last] if n == 1 else by[last - n + 2]
        for back in range(n - 3, -1, -1):
            name = np.unique(name, return_inverse=True)[1] * (len(pair) + 1) + by[last - back]
        _, at, times = np.unique(name, return_index=True, return_counts=True)
        last = last[at]
        product = total = np.ones(len(last))
        for i in range(n):
            x = last - n + 1 + i
            value, added = weight[u[x]], weight[u[x]]
            if 0 < i < n - 1:
                p = count[x] / tf[u[x - 1]] * (count[x + 1] / tf[u[x]])
                value, added = np.where(silent[x], 2 - p, value), np.where(silent[x], p - 1, added)
            product, total = product * value, total + added
        # stopwords of unlikely pairs may take the sum to zero or below: such an n-gram goes last
        score = product / np.maximum(total, 1e-9) / times
        # large ones have no twelfth place
        out.append((w.of[last], last, np.full(len(last), n), np.where(score < 1e3, np.round(score, 12), score)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, dtype=np.int64),) * 4


def _chosen(texts: list[str], longest: int, top: int, alike: float) -> tuple[list[int], list[str], list[int], list[float]]:
    """text, term, rank and score: the best terms of each text in the order of score and term, none like a better one."""
    w = _words_of(texts)
    rows: tuple[list[int], list[str], list[int], list[float]] = ([], [], [], [])
    of, last, size, score = _scored(w, longest)
    if not len(of):
        return rows
    order = np.lexsort((score, of))
    of, last, size, score = (c[order] for c in (of, last, size, score))
    new = np.append(True, (of[1:] != of[:-1]) | (score[1:] != score[:-1]))[: len(of)]
    heads = np.flatnonzero(new)
    kept, before = Unlike(alike), -1
    # the n-grams of one text and score at a time
    for a, b, text in zip(heads.tolist(), [*heads[1:].tolist(), len(of)], of[heads].tolist(), strict=True):
        if text != before:
            kept, before = Unlike(alike), text
        if len(kept.places) >= top:
            continue
        for term in sorted(" ".join([w.forms[f] for f in w.form[x - n + 1 : x + 1]]) for x, n in zip(last[a:b].tolist(), size[a:b].tolist(), strict=True)):
            if len(kept.places) < top and not kept.holds_like(term):
                kept.add(term)
                for column, value in zip(rows, (text, term, len(kept.places), float(score[a])), strict=True):
                    column.append(value)
    return rows


class Unlike:
    """Terms of a text, and whether another is more alike to one of them than `alike`, by edit distance.

    The tables of distances to all terms are worked off together: a column of them is two whole numbers, bit by bit whether the distance rises or falls there, and each term has its own
    bits with an empty one behind.
    """

    def __init__(self, alike: float):
        self.alike, self.places, self.width, self.lowest, self.every = alike, [], 0, 0, 0
        self.at: dict[str, int] = {}

    def add(self, term: str) -> None:
        for i, c in enumerate(term, self.width):
            self.at[c] = self.at.get(c, 0) | 1 << i
        bits = (1 << len(term)) - 1
        self.places.append((self.width, bits, len(term)))
        self.lowest |= 1 << self.width
        self.every |= bits << self.width
        self.width += len(term) + 1

    def holds_like(self, term: str) -> bool:
        at, every, lowest, up, down = self.at, self.every, self.lowest, self.every, 0
        for c in term:
            same = at.get(c, 0) | down
            cross = (((same & up) + up) ^ up | same) & every
            rise, fall = (down | every & ~(cross | up)) << 1 | lowest, (up & cross) << 1
            up, down = (fall | ~(cross | rise)) & every, rise & cross & every
        for first, bits, n in self.places:
            far = len(term) + (up >> first & bits).bit_count() - (down >> first & bits).bit_count()
            if 1 - far / max(n, len(term)) > self.alike:
                return True
        return False


def look_alike(a: str, b: str, alike: float) -> bool:
    held = Unlike(alike)
    held.add(a)
    return held.holds_like(b)


# --- nearness to the whole text ---

def word_vector(word: str) -> np.ndarray:
    """A word's vector of length 1 by hashed character n-grams; it needs no model. Equal words get equal vectors."""
    out, padded = np.zeros(DIMENSIONS), f" {word} "
    for n in range(2, 5):
        for i in range(len(padded) - n + 1):
            h = xxhash.xxh64_intdigest(padded[i : i + n])
            out[h % DIMENSIONS] += 1.0 if h >> 63 else -1.0
    norm = np.linalg.norm(out)
    return out / norm if norm else out


def content_words(text: str) -> list[str]:
    """Lower-cased words of two letters or digits and more, without stopwords: n-grams are made of what is left."""
    return [w for w in re.findall(r"\b\w\w+\b", text.lower()) if w not in _STOP]


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def short_hashes(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """XXH64 with seed 0 of the ranges of `size` bytes, under 32, that begin at `starts`."""
    at = lambda i, width: sum(data[starts + i + k].astype(np.uint64) << np.uint64(8 * k) for k in range(width))
    h, i = np.full(len(starts), _P5 + np.uint64(size), dtype=np.uint64), 0
    while size - i >= 8:
        h = _rotated(h ^ _rotated(at(i, 8) * _P2, 31) * _P1, 27) * _P1 + _P4
        i += 8
    if size - i >= 4:
        h = _rotated(h ^ at(i, 4) * _P1, 23) * _P2 + _P3
        i += 4
    for k in range(i, size):
        h = _rotated(h ^ at(k, 1) * _P5, 11) * _P1
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    return h ^ h >> np.uint64(32)


def word_vectors(words: list[str]) -> np.ndarray:
    """The vectors of words as word_vector() makes them, WORDS at a time: most words of a text may stand in no other, so none are kept."""
    if len(words) > WORDS:
        return np.concatenate([word_vectors(words[i : i + WORDS]) for i in range(0, len(words), WORDS)])
    data = np.frombuffer("".join(f" {w} " for w in words).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    starts = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))  # of characters
    chars = np.array([len(w) + 2 for w in words])
    owner, place = np.repeat(np.arange(len(words)), chars), np.arange(chars.sum())
    left, out = np.repeat(np.cumsum(chars), chars) - place, np.zeros(len(words) * DIMENSIONS)
    for n in range(2, 5):
        first = place[left >= n]
        size = starts[first + n] - starts[first]
        for b in np.flatnonzero(np.bincount(size)):
            some = first[size == b]
            h = short_hashes(data, starts[some], int(b))
            cell = owner[some] * DIMENSIONS + (h % np.uint64(DIMENSIONS)).astype(np.int64)
            out += np.bincount(cell, np.where(h >> np.uint64(63), 1.0, -1.0), len(out))
    out = out.reshape(-1, DIMENSIONS)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)


def nearest(text: str, longest: int, top: int) -> list[tuple[str, float]]:
    """The `top` different n-grams of the text by cosine with it, rounded to six places; then in code-point order.

    An n-gram's vector is the sum of its words' vectors, the text's the sum of its n-grams'. Blocks of BLOCK places are multiplied at a time, whatever the text's length,
    and only the n-grams of a block that may be among the best are sorted.
    """
    words = content_words(text)
    if not words:
        return []
    vocabulary = sorted(set(words))
    number = {w: i for i, w in enumerate(vocabulary)}
    vectors = word_vectors(vocabulary)
    ids, n = np.array([number[w] for w in words]), len(words)
    # how often each place's word stands in an n-gram of any size
    places, times = np.arange(n), np.zeros(n)
    for size in range(1, min(longest, n) + 1):
        times += np.minimum(places, n - size) - np.maximum(places - size + 1, 0) + 1
    whole = np.bincount(ids, times, len(vocabulary)) @ vectors
    length = np.linalg.norm(whole)
    best = np.empty((0, longest + 1))  # numbers of the words, -1 behind the last, and the cosine
    for a in range(0, n, BLOCK):
        total, cosines = np.zeros((min(BLOCK, n - a), DIMENSIONS)), []
        for size in range(1, longest + 1):
            m = min(BLOCK, n - a - size + 1)
            if m <= 0:
                break
            total = total[:m] + vectors[ids[a + size - 1 : a + size - 1 + m]]
            norms = np.linalg.norm(total, axis=1) * length
            cosines.append(np.round(np.divide(total @ whole, norms, out=np.zeros(m), where=norms > 0), 6))
        place = np.concatenate([np.arange(a, a + len(c)) for c in cosines])
        sizes = np.repeat(np.arange(1, len(cosines) + 1), [len(c) for c in cosines])
        cosine = np.concatenate(cosines)
        before, some = best, 4 * top
        while True:
            # those as near as the one at the rank `some`, ties with it included; repeats may leave too few, then more are taken
            least = np.partition(cosine, len(cosine) - some)[len(cosine) - some] if len(cosine) > some else -np.inf
            near = np.flatnonzero(cosine >= (max(least, before[-1, -1]) if len(before) == top else least))
            j = np.arange(longest)
            rows = np.where(j < sizes[near, None], ids[np.minimum(place[near, None] + j, n - 1)], -1)
            best = np.vstack([before, np.column_stack([rows, cosine[near]])])
            # word numbers are in the order of the words, and a space stands before all letters
            best = best[np.lexsort([*reversed(best[:, :-1].T), -best[:, -1]])]
            first = np.ones(len(best), dtype=bool)
            first[1:] = (best[1:, :-1] != best[:-1, :-1]).any(axis=1)
            best = best[first][:top]
            if len(best) == top and best[-1, -1] >= least or some >= len(cosine):
                break
            some *= 4
    return [(" ".join(vocabulary[int(i)] for i in row[:-1] if i >= 0), float(row[-1])) for row in best]


def embedded(texts: DataFrame, key: str, text: str, longest: int = 4, top: int = 10) -> DataFrame:
    """key, term, rank, similarity: the `top` n-grams nearest to the whole text. Nothing is shuffled: a text's n-grams stay in its task, and `top` leave it."""
    ship(texts.sparkSession)
    found_type = pa.list_(pa.struct([("term", pa.string()), ("similarity", pa.float64())]))

    def find(column: pa.Array) -> pa.Array:
        rows = ([{"term": t, "similarity": s} for t, s in nearest(x.as_py() or "", longest, top)] for x in column)
        return pa.array(list(rows), found_type)

    near = F.arrow_udf(find, "array<struct<term:string,similarity:double>>")
    rows = texts.select(F.col(key), F.posexplode_outer(near(F.col(text))).alias("rank", "__t")).filter("__t IS NOT NULL")
    return rows.select(key, "__t.term", (F.col("rank") + 1).alias("rank"), "__t.similarity")
