"""Part-of-speech tags and noun chunks by a hidden Markov model that is fitted on the texts themselves.

States: A (adjective), N (noun), V (verb and adverb), X (closed classes). A closed-class word can only be X, and nothing else can; closed classes are seeded with the stopwords and with the
words of few letters that make up a good share of the sample. All other words start with weights of their endings, and expectation maximisation does the rest: in each round Spark
runs forward-backward over the sentences in tasks and sums the expected counts by key; the driver gets one count for each symbol and state, of which there are boundedly many: the
closed words, the `vocabulary` most frequent others, and ENDINGS classes of endings for the rest.

The model is fitted on the `sample_rows` texts with the least hashes (a bounded sample), sent to the workers as a broadcast, which a worker process loads once, and applied to all texts whole.

Tokens are runs without white space, their edge signs taken off. A sentence ends at `.`, `!`, `?` or a line's end. Where other signs stand between two tokens, an empty token of tag O keeps
patterns and chunks from crossing them. A chunk is a run of adjectives and nouns that ends in a noun; it never holds a closed-class word.

Defined results: a null or empty text has no tokens; without texts all words outside the closed classes are N by the starting weights; equal texts get equal tags; ties go to the first state.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexispark import fixed
from lexispark.session import scratch_table, ship

STATES = "ANVX"
K = len(STATES)
ENDINGS = 256
#: Different words whose symbols a task keeps; it starts anew when there are more.
KNOWN = 1 << 18
#: Texts, and characters of them, that are tagged together and leave a task together.
PORTION, PORTION_CHARS = 64, 1 << 18
TOKEN = "struct<start:int,end:int,text:string,tag:string>"
SPAN = "struct<start:int,end:int,text:string>"

# Starting values: what begins a sentence and what follows what, from state (row) to state; and the endings that speak for a state.
START = np.array([0.2, 0.45, 0.1, 0.25])
STEP = np.array([[0.1, 0.75, 0.05, 0.1], [0.05, 0.25, 0.3, 0.4], [0.15, 0.25, 0.1, 0.5], [0.3, 0.5, 0.1, 0.1]])
ADJECTIVE = ("able", "ible", "al", "ful", "ic", "ive", "less", "ous", "ish", "ary", "ant", "ent")
VERB = ("ing", "ed", "ify", "ise", "ize", "ate", "ly")


@dataclass(frozen=True)
class Training:
    sample_rows: int = 2_000
    vocabulary: int = 20_000
    short: int = 3
    share: float = 1 / 500
    rounds: int = 4
    smoothing: float = 0.1


@dataclass(frozen=True)
class Model:
    """closed and words number symbols; behind them come the classes of endings. start, step and emit are probabilities."""

    closed: dict[str, int]
    words: dict[str, int]
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    def symbol(self, word: str) -> int:
        low = word.lower()
        at = self.closed.get(low, self.words.get(low))
        return len(self.closed) + len(self.words) + zlib.crc32(low[-3:].encode()) % ENDINGS if at is None else at


def _core(c: str) -> bool:
    return c.isascii() and c.isalnum() or not c.isascii() and unicodedata.category(c)[0] in "LN"


def tokens(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, gap) of each token; gap is what stands before it: 0 nothing but spaces, 1 other signs, 2 a sentence's end."""
    gap, before = 0, 0
    for m in re.finditer(r"\S+", text):
        a, b = m.span()
        if "\n" in text[before:a]:
            gap = 2
        before = b
        while a < b and not _core(text[a]):
            gap, a = max(gap, 2 if text[a] in ".!?" else 1), a + 1
        if a == b:
            continue
        while not _core(text[b - 1]):
            b -= 1
        yield a, b, gap
        rest = text[b : m.end()]
        gap = 2 if any(c in ".!?" for c in rest) else int(bool(rest))


def sentences(text: str) -> list[list[tuple[int, int, int]]]:
    out: list[list[tuple[int, int, int]]] = []
    for token in tokens(text):
        if token[2] == 2 or not out:
            out.append([])
        out[-1].append(token)
    return out


def by_length(found: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, symbols): sentences of one length together, so that arrays hold them without padding."""
    lengths = np.array([len(s) for s in found])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        for k in range(0, len(at), max(1, (1 << 18) // int(n))):
            some = at[k : k + max(1, (1 << 18) // int(n))]
            yield some, np.array([found[i] for i in some])


def viterbi(model: Model, symbols: np.ndarray) -> np.ndarray:
    """The most probable states of sentences of one length (rows)."""
    with np.errstate(divide="ignore"):
        start, step, emit = np.log(model.start), np.log(model.step), np.log(model.emit)
    best, back = start + emit[:, symbols[:, 0]].T, []
    for t in range(1, symbols.shape[1]):
        through = best[:, :, None] + step
        back.append(through.argmax(axis=1))
        best = through.max(axis=1) + emit[:, symbols[:, t]].T
    path = [best.argmax(axis=1)]
    for pointers in reversed(back):
        path.append(pointers[np.arange(len(symbols)), path[-1]])
    return np.array(path[::-1]).T


def expected(model: Model, symbols: np.ndarray, emit: np.ndarray, step: np.ndarray, start: np.ndarray) -> None:
    """Add the expected counts of sentences of one length to emit, step and start."""
    s, n = symbols.shape
    b = model.emit[:, symbols].transpose(1, 2, 0)
    ahead, scale = np.empty((s, n, K)), np.empty((s, n, 1))
    for t in range(n):
        a = (model.start if t == 0 else ahead[:, t - 1] @ model.step) * b[:, t]
        scale[:, t] = np.maximum(a.sum(axis=1, keepdims=True), 1e-300)
        ahead[:, t] = a / scale[:, t]
    behind = np.ones((s, K))
    for t in range(n - 1, -1, -1):
        posterior = ahead[:, t] * behind
        np.add.at(emit.T, symbols[:, t], posterior)
        if t:
            part = b[:, t] * behind / scale[:, t]
            step += model.step * (ahead[:, t - 1].T @ part)
            behind = part @ model.step.T
        else:
            start += posterior.sum(axis=0)


def fit(texts: DataFrame, text: str, how: Training = Training()) -> Model:
    """Fit the model on a bounded sample of the distinct texts."""
    spark = texts.sparkSession
    ship(spark)
    some = texts.select(F.col(text).alias("text")).filter(F.col(text).isNotNull())
    # the least hashes are found by themselves, so that only their texts are shuffled
    hashes = some.select(F.xxhash64("text").alias("h")).distinct().orderBy("h").limit(how.sample_rows).agg(F.max("h")).first()[0]
    some = some.filter(F.xxhash64("text") <= F.lit(hashes or 0)).distinct().orderBy(F.xxhash64("text"), "text").limit(how.sample_rows)
    sample = scratch_table(some.repartition(min(64, max(1, how.sample_rows // 100)), "text"), "tagging-sample")

    def words(batches):
        for batch in batches:
            found = [t[a:b].lower() for t in batch.column(0).to_pylist() for a, b, _ in tokens(t)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["word"])

    counted = sample.mapInArrow(words, "word string").groupBy("word").count()
    total = counted.agg(F.sum("count")).first()[0] or 0
    frequent = counted.orderBy(F.desc("count"), "word").limit(how.vocabulary).collect()
    seeds = {*fixed.STOPWORDS, *(r["word"] for r in frequent if len(r["word"]) <= how.short and r["count"] >= total * how.share and not r["word"][0].isdigit())}
    closed = {w: i for i, w in enumerate(sorted(seeds))}
    open_ = {w: len(closed) + i for i, w in enumerate(r["word"] for r in frequent if r["word"] not in closed)}
    count = {r["word"]: r["count"] for r in frequent}
    base = np.ones((K, len(closed) + len(open_) + ENDINGS))
    for w, i in (closed | open_).items():
        base[:, i] = count.get(w, 1)
        base[0, i] *= 4 if w.endswith(ADJECTIVE) else 1
        base[1, i] *= 2
        base[2, i] *= 4 if w.endswith(VERB) else 1
    base[1, len(closed) + len(open_) :] = 2
    allowed = np.ones(base.shape, dtype=bool)
    allowed[:3, : len(closed)] = False
    allowed[3, len(closed) :] = False
    scaled = lambda x: x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)
    model = Model(closed, open_, START, STEP, scaled(base * allowed))
    prior = model.emit.copy()
    for _ in range(how.rounds if total else 0):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches, shared=shared):
            held = shared.value
            emit, step, start = np.zeros(held.emit.shape), np.zeros((K, K)), np.zeros(K)
            for batch in batches:
                found = [np.array([held.symbol(t[a:b]) for a, b, _ in s]) for t in batch.column(0).to_pylist() for s in sentences(t)]
                for _, symbols in by_length(found):
                    expected(held, symbols, emit, step, start)
            whole = np.concatenate([start, step.ravel(), emit.ravel()])
            at = np.flatnonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(whole[at])], ["place", "n"])

        # one row for each symbol and state at most; rounded, so that the order of the additions leaves no trace
        rows = sample.mapInArrow(expect, "place long, n double").groupBy("place").agg(F.round(F.sum("n"), 6).alias("n")).collect()
        whole = np.zeros(K + K * K + model.emit.size)
        for place, n in rows:
            whole[place] = n
        start, step, emit = whole[:K], whole[K : K + K * K].reshape(K, K), whole[K + K * K :].reshape(model.emit.shape)
        a = how.smoothing
        model = Model(closed, open_, scaled(start + a), scaled(step + a), scaled((emit + a * prior * emit.sum(axis=1, keepdims=True)) * allowed))
        shared.destroy()
    return model


def tag(model: Model, text: str) -> tuple[list[dict], list[dict]]:
    """Tokens with tags, and chunks, of one text."""
    return _tag_all(model, [text])[0]


def _tag_all(model: Model, texts: list[str]) -> list[tuple[list[dict], list[dict]]]:
    """As tag(), for many texts at once: their sentences of one length share the arrays."""
    cut = [sentences(t) for t in texts]
    flat = [(t, s) for t, found in zip(texts, cut, strict=True) for s in found]
    symbols = [np.array([model.symbol(t[a:b]) for a, b, _ in s]) for t, s in flat]
    states: list[np.ndarray] = [np.zeros(0, dtype=int)] * len(flat)
    for numbers, some in by_length(symbols):
        for i, path in zip(numbers, viterbi(model, some), strict=True):
            states[i] = path
    out, at = [], 0
    for text, found in zip(texts, cut, strict=True):
        made, chunks = [], []
        for s in found:
            for (a, b, gap), k in zip(s, states[at], strict=True):
                if gap and made:
                    made.append({"start": a, "end": a, "text": "", "tag": "O"})
                made.append({"start": a, "end": b, "text": text[a:b], "tag": STATES[k]})
            at += 1
        for m in re.finditer("[AN]*N", "".join(x["tag"] for x in made)):
            a, b = made[m.start()]["start"], made[m.end() - 1]["end"]
            chunks.append({"start": a, "end": b, "text": text[a:b]})
        out.append((made, chunks))
    return out


# --- spans of many texts at once ---

SPACE, CORE, STOP, SIGN, WORDS = 1, 2, 4, 8, 16
FOUND = "struct<start:int,end:int,text:string,words:int>"


@cache
def _kinds() -> np.ndarray:
    """What each code point is: white space, part of a word (core), or another sign; whether it ends a sentence (stop), and whether it parts words in functions.text too."""
    out = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for i in range(len(out)):
        c = chr(i)
        out[i] = SPACE if c.isspace() else CORE if _core(c) else SIGN
    for c in ".!?\n":
        out[ord(c)] |= STOP
    out[(out & SPACE) > 0] |= WORDS
    out[0x1C:0x20] &= ~np.uint8(WORDS)
    return out


def _cut(joined: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, end and gap of all tokens, as tokens() gives them (the first token's gap is 2, and so is what a line's end parts), and the number of each one's word."""
    kinds = _kinds()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    core = np.flatnonzero(kinds & CORE)
    before = lambda flag: np.concatenate([[0], np.cumsum((kinds & flag) > 0, dtype=np.int32)])
    spaces, stops, signs, words = (before(flag) for flag in (SPACE, STOP, SIGN, WORDS))
    new = np.flatnonzero(np.diff(spaces[core], prepend=-1))
    starts, ends = core[new], core[np.append(new[1:], len(core))[: len(new)] - 1] + 1
    gap = np.full(len(starts), 2, dtype=np.int8)
    a, b = ends[:-1], starts[1:]
    gap[1:] = np.where(stops[b] > stops[a], 2, signs[b] > signs[a])
    return starts, ends, gap, np.append(0, np.cumsum(words[b] > words[a]))[: len(starts)]


def paths(model: Model, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The most probable states of sentences that stand one after the other, as viterbi() finds them: the long ones first, so that a step is one for all that reach so far."""
    with np.errstate(divide="ignore"):
        start, step, emit = np.log(model.start), np.log(model.step), np.ascontiguousarray(np.log(model.emit).T)
    order = np.argsort(-lengths, kind="stable")
    first, reach = (np.cumsum(lengths) - lengths)[order], np.bincount(lengths)[::-1].cumsum()[::-1]
    best, back = start + emit[symbols[first]], []
    for t in range(1, len(reach) - 1):
        n = reach[t + 1]
        most, pointer = best[:n, :1] + step[0], np.zeros((n, K), dtype=np.int8)
        for k in range(1, K):
            through = best[:n, k : k + 1] + step[k]
            pointer[through > most] = k
            most = np.maximum(most, through)
        back.append(pointer)
        best[:n] = most + emit[symbols[first[:n] + t]]
    state, out = best.argmax(axis=1), np.empty(len(symbols), dtype=np.int8)
    for t in range(len(reach) - 2, 0, -1):
        n = reach[t + 1]
        out[first[:n] + t] = state[:n]
        state[:n] = back[t - 1][np.arange(n), state[:n]]
    out[first] = state
    return out


def _fits(item: str, states: np.ndarray, literal: np.ndarray, literals: list[str]) -> np.ndarray:
    if item.isupper():
        return reduce(np.logical_or, [states == STATES.index(k) for k in item])
    return reduce(np.logical_or, [literal == literals.index(w) + 1 for w in item.split("|")])


def longest_spans(starts: np.ndarray, ends: np.ndarray, gap: np.ndarray, states: np.ndarray, literal: np.ndarray, literals: list[str], chunks: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the matches of the token patterns, and of the chunks, as terms.deoverlap leaves them.

    Of the spans that start together only the longest counts. Spans that overlap one after the other are a chain, in which a span replaces the last one where it ends later: the first of those that
    end last stays.
    """
    follows, n = gap == 0, len(starts)
    longest = np.zeros(n, dtype=np.int64)
    items = {item: _fits(item, states, literal, literals) for pattern in fixed.TOKEN_PATTERNS.values() for item in pattern}
    for pattern in fixed.TOKEN_PATTERNS.values():
        m = n - len(pattern) + 1
        if m > 0:
            fit = items[pattern[0]][:m].copy()
            for k in range(1, len(pattern)):
                fit &= items[pattern[k]][k : m + k] & follows[k : m + k]
            longest[:m] = np.maximum(longest[:m], np.where(fit, ends[len(pattern) - 1 :], 0))
    if chunks:
        name = (states == STATES.index("A")) | (states == STATES.index("N"))
        opens = name.copy()
        opens[1:] &= ~(name[:-1] & follows[1:])
        run, nouns = np.cumsum(opens) - 1, np.flatnonzero(states == STATES.index("N"))
        last = nouns[np.flatnonzero(np.diff(run[nouns], append=-1))]
        first = np.flatnonzero(opens)[run[last]]
        longest[first] = np.maximum(longest[first], ends[last])
    found = np.flatnonzero(longest)
    if not len(found):
        return found, found
    a, b = starts[found], longest[found]
    top = np.maximum.accumulate(b)
    heads = np.flatnonzero(np.concatenate([[True], a[1:] >= top[:-1]]))
    chain = np.cumsum(np.bincount(heads, minlength=len(a))) - 1
    ending = np.flatnonzero(b == np.maximum.reduceat(b, heads)[chain])
    kept = ending[np.flatnonzero(np.diff(chain[ending], prepend=-1))]
    return a[kept], b[kept]


def _coded(model: Model, literals: list[str]) -> Callable[[list[str]], np.ndarray]:
    """A function from words to their symbols and literals (0: none), one number for both, which keeps those of words that it met."""
    known: dict[str, int] = {}
    width = len(literals) + 1
    number = {w: i + 1 for i, w in enumerate(literals)}

    def code(words: list[str]) -> np.ndarray:
        if len(known) > KNOWN:
            known.clear()
        for w in set(words) - known.keys():
            known[w] = model.symbol(w) * width + number.get(w.lower(), 0)
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    return code


def spans(texts: DataFrame, text: str, model: Model, keep: list[str], out: str, chunks: bool) -> DataFrame:
    """The columns to keep and an array of (start, end, text, words, how many they are): the pattern matches of each text, with its chunks or without, as terms.deoverlap leaves them.

    What annotate() and the Column expressions of terms find, without a row or an object for each token: the texts of a portion are one array of code points, and their sentences are tagged together.
    """
    ship(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast(model)
    literals = sorted({w for pattern in fixed.TOKEN_PATTERNS.values() for item in pattern if not item.isupper() for w in item.split("|")})
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("words", pa.int32())])

    def find(held: list[str], code) -> pa.Array:
        joined = "\n".join(held)
        begin = np.cumsum([0, *(len(t) + 1 for t in held)])
        starts, ends, gap, words = _cut(joined)
        coded = code([joined[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        symbols, literal = np.divmod(coded, len(literals) + 1)
        heads = np.flatnonzero(gap == 2)
        states = paths(shared.value, symbols, np.diff(np.append(heads, len(starts)))) if len(starts) else np.zeros(0, dtype=np.int8)
        a, b = longest_spans(starts, ends, gap, states, literal, literals, chunks)
        found = pa.array([joined[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.string())
        n = words[np.searchsorted(ends, b)] - words[np.searchsorted(starts, a)] + 1
        offsets = np.searchsorted(a, begin)
        base = np.repeat(begin[:-1], np.diff(offsets))
        rows = pa.StructArray.from_arrays([pa.array((a - base).astype(np.int32)), pa.array((b - base).astype(np.int32)), found, pa.array(n.astype(np.int32))], fields=list(span))
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _coded(shared.value, literals)
        for batch in batches:
            for a, b in portions(batch.column("__text")):
                part = batch.slice(a, b - a)
                made = find([t or "" for t in part.column("__text").to_pylist()], code)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), made], [*keep, out])

    added = StructType([*(texts.schema[c] for c in keep), *StructType.fromDDL(f"`{out}` array<{FOUND}>")])
    return texts.select(*keep, F.col(text).alias("__text")).mapInArrow(run, added)


def portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of consecutive texts: at most PORTION of them, and about PORTION_CHARS characters or one longer text."""
    first, chars = 0, 0
    for i, n in enumerate(pc.utf8_length(texts).to_pylist()):
        if i > first and (i - first == PORTION or chars + (n or 0) > PORTION_CHARS):
            yield first, i
            first, chars = i, 0
        chars += n or 0
    if first < len(texts):
        yield first, len(texts)


def annotate(texts: DataFrame, text: str, model: Model, out: str) -> DataFrame:
    """Add a struct: tokens (start, end, text, tag) and chunks (start, end, text).

    A portion of a batch is tagged and leaves the task at a time: as Python objects, tokens take some hundred times their text, and a batch has up to 10,000 texts.
    """
    ship(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast(model)
    span = [("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]
    kind = pa.struct([("tokens", pa.list_(pa.struct([*span, ("tag", pa.string())]))), ("chunks", pa.list_(pa.struct(span)))])
    rest = [c for c in texts.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in portions(batch.column(text)):
                part = batch.slice(a, b - a)
                made = [{"tokens": t, "chunks": c} for t, c in _tag_all(shared.value, [t or "" for t in part.column(text).to_pylist()])]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(made, kind)], [*rest, out])

    added = StructType([*(texts.schema[c] for c in rest), *StructType.fromDDL(f"`{out}` struct<tokens:array<{TOKEN}>,chunks:array<{SPAN}>>")])
    return texts.select(*rest).mapInArrow(run, added)
