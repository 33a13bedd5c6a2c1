"""Language identification: scripts narrow the candidates, then a Viterbi path over the words labels spans."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
# Hashed trigrams: the model has BUCKETS numbers per language, however many texts it has seen.
BUCKETS = 1 << 16
PER_LANGUAGE = 2_000
SWITCH_PENALTY = 8.0
FLOOR = -12.0
# A language is a candidate for words of a script if at least this share of its training letters is in that script.
SCRIPT_SHARE = 0.001
CHARS_AT_ONCE = 1 << 20
TOP = 0x32400

# First and last code points of the blocks of each script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "ethiopic": [(0x1200, 0x137F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS) + 1


@dataclass(frozen=True)
class Alphabet:
    """Per code point: script (0 where no word goes on), lower case, and whether it is a letter."""

    script: np.ndarray
    lower: np.ndarray
    letter: np.ndarray

    @staticmethod
    def build() -> Alphabet:
        points = range(TOP)
        letter = np.fromiter((chr(c).isalpha() for c in points), bool, TOP)
        part = letter | np.fromiter((unicodedata.category(chr(c)) in ("Mn", "Mc") for c in points), bool, TOP)
        script = np.full(TOP, OTHER, np.uint8)
        for number, ranges in enumerate(SCRIPTS.values(), 1):
            for first, last in ranges:
                script[first : last + 1] = number
        script[~part] = 0
        low = [chr(c).lower() for c in points]
        lower = np.fromiter((ord(x) if len(x) == 1 else c for c, x in enumerate(low)), np.uint32, TOP)
        return Alphabet(script, lower, letter)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # (BUCKETS, languages): log-probabilities of hashed trigrams
    candidates: np.ndarray  # (scripts, languages)
    alphabet: Alphabet


@dataclass(frozen=True)
class Words:
    """Words of some texts in one buffer: bounds, text number, script, and the trigrams of all words in a row."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray
    first: np.ndarray  # of each word's trigrams
    trigram: np.ndarray
    origin: np.ndarray  # where each text begins
    lettered: np.ndarray  # per text


def split_words(texts: list[str], alphabet: Alphabet) -> Words:
    """Whole texts into words: runs of letters and marks. Every letter gives one trigram with its neighbours in the word."""
    buffer = np.frombuffer(("\0" + "\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.minimum(buffer, TOP - 1)
    script = alphabet.script[points]
    inside = script > 0
    lower = np.where(inside, alphabet.lower[points], 0).astype(np.uint32)
    at = np.flatnonzero(inside)
    mixed = lower[at - 1] * np.uint32(0x9E3779B1) ^ lower[at] * np.uint32(0x85EBCA77) ^ lower[at + 1] * np.uint32(0xC2B2AE3D)
    trigram = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    origin = np.cumsum(lengths + 1) - lengths
    text = np.searchsorted(origin, start, "right") - 1
    lettered = np.zeros(len(texts), bool)
    lettered[text[np.logical_or.reduceat(alphabet.letter[points[at]], np.searchsorted(at, start))] if len(at) else []] = True
    return Words(start, end, text, script[start], np.searchsorted(at, start), trigram, origin, lettered)


def in_parts(texts: list[str]) -> Iterator[list[int]]:
    """Numbers of texts, together at most CHARS_AT_ONCE characters unless one text alone is longer."""
    part: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        if part and size + len(text) > CHARS_AT_ONCE:
            yield part
            part, size = [], 0
        part.append(number)
        size += len(text)
    if part:
        yield part


def word_scores(words: Words, model: Model) -> np.ndarray:
    """(words, languages): log-likelihoods relative to the best candidate of the word's script, not below FLOOR.

    Languages that do not use the script get FLOOR; where none is known to use it, the word says nothing.
    """
    if not len(words.start):
        return np.zeros((0, len(model.languages)))
    sums = np.add.reduceat(model.scores[words.trigram], words.first, axis=0).astype(float)
    allowed = model.candidates[words.script]
    sums = np.where(allowed, sums, -np.inf)
    best = sums.max(1, keepdims=True)
    known = np.isfinite(best)
    return np.where(known, np.maximum(sums - np.where(known, best, 0.0), FLOOR), 0.0)


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word, for sequences of words that begin at ``starts``; a change of label costs ``penalty``.

    A sequence in which no stretch favours any other label over the overall best by half the penalty has the constant
    path as its best, which running sums tell at once. The others go through the recursion together, word by word.
    """
    n = len(scores)
    if not n:
        return np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, n))
    number = np.repeat(np.arange(len(starts)), lengths)
    best = np.add.reduceat(scores, starts, axis=0).argmax(1)
    gain = scores - scores[np.arange(n), best[number]][:, None]
    total = np.cumsum(gain, axis=0)
    before = np.vstack([np.zeros((1, scores.shape[1])), total[:-1]])
    apart = number[:, None] * (2 * np.abs(total).max() + 1)
    lowest = np.minimum.accumulate(before - apart, axis=0) + apart
    most = np.maximum.reduceat((total - lowest).max(1), starts)
    labels = best[number]
    hard = np.flatnonzero(most >= penalty / 2 - 1e-3)
    if len(hard):
        hard = hard[np.argsort(-lengths[hard], kind="stable")]
        long, begin = lengths[hard], starts[hard]
        value = scores[begin].copy()
        steps = int(long[0])
        came = [np.zeros(0, np.int8)]
        active = np.searchsorted(-long, -np.arange(steps), "left")  # sequences longer than t
        own = np.arange(scores.shape[1])
        for t in range(1, steps):
            a = active[t]
            now = value[:a]
            top = now.argmax(1)
            change = now[np.arange(a), top][:, None] - penalty
            moved = change > now
            came.append(np.where(moved, top[:, None], own).astype(np.int8 if len(own) < 128 else np.int32))
            value[:a] = np.maximum(now, change) + scores[begin[:a] + t]
        label = value.argmax(1)
        for t in range(steps - 1, -1, -1):
            a = active[t]
            labels[begin[:a] + t] = label[:a]
            if t:
                label[:a] = came[t][np.arange(a), label[:a]]
    return labels


def label_words(words: Words, model: Model, penalty: float) -> np.ndarray:
    starts = np.flatnonzero(np.diff(words.text, prepend=-1))
    return viterbi(word_scores(words, model), starts, penalty)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``docs(doc_id, text, lang)``: rows without text or lang teach nothing.

    Of each language about ``per_language`` rows, picked by a hash of id and text, are counted whole; fewer rows are all
    taken. That bound is the documented sample; the model has BUCKETS numbers per language and nothing else grows.
    """
    labelled = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(sizes))
    alphabet = Alphabet.build()
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((OTHER + 1, 0), bool), alphabet)
    number = F.create_map(*[F.lit(x) for pair in ((lang, i) for i, lang in enumerate(languages)) for x in pair])[F.col("lang")]
    rate = F.array(*[F.lit(min(1.0, per_language / sizes[lang])) for lang in languages])[number]
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.filter(draw < rate).select(number.alias("lang"), "text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, own in frame.groupby("lang")["text"]:
                texts = own.tolist()
                counts = np.zeros(BUCKETS + OTHER + 1, np.int64)
                for part in in_parts(texts):
                    words = split_words([texts[i] for i in part], alphabet)
                    counts[:BUCKETS] += np.bincount(words.trigram, minlength=BUCKETS)
                    counts[BUCKETS:] += np.bincount(words.script, weights=words.end - words.start, minlength=OTHER + 1).astype(np.int64)
                seen = np.flatnonzero(counts)
                yield pd.DataFrame({"lang": lang, "feature": seen, "n": counts[seen]})

    counted = sample.mapInPandas(count, "lang int, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((BUCKETS + OTHER + 1, len(languages)))
    table[counted["feature"].to_numpy(np.int64), counted["lang"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    grams, scripts = table[:BUCKETS] + 0.5, table[BUCKETS:]
    shares = scripts / np.maximum(scripts.sum(0), 1)
    return Model(languages, np.log(grams / grams.sum(0)).astype(np.float32), shares >= SCRIPT_SHARE, alphabet)


def predict(text: Column, model: Model, penalty: float = SWITCH_PENALTY) -> Column:
    """struct(lang, score): the language of most letters along the Viterbi path, and its share of the letters (0 to 1).

    ``und`` with score 0 for null texts, texts without a letter, and a model that has seen no language. Ties go to the
    language that sorts first. Only the text is read, and all of it.
    """

    @F.pandas_udf("struct<lang string, score double>")
    def of(texts: pd.Series) -> pd.DataFrame:
        values = texts.fillna("").tolist()
        lang = np.full(len(values), UNKNOWN, object)
        score = np.zeros(len(values))
        for part in in_parts(values) if model.languages else ():
            words = split_words([values[i] for i in part], model.alphabet)
            letters = np.zeros((len(part), len(model.languages)))
            np.add.at(letters, (words.text, label_words(words, model, penalty)), words.end - words.start)
            rows = np.flatnonzero(words.lettered)
            top = letters[rows].argmax(1)
            here = np.asarray(part)[rows]
            lang[here] = np.asarray(model.languages, object)[top]
            score[here] = letters[rows, top] / letters[rows].sum(1)
        return pd.DataFrame({"lang": lang, "score": score})

    return of(text)


def spans(text: Column, model: Model, penalty: float = SWITCH_PENALTY) -> Column:
    """array of struct(begin, end, lang), in code points: neighbouring words with one label form a span. Empty without words."""

    @F.pandas_udf("array<struct<begin: long, end: long, lang: string>>")
    def of(texts: pd.Series) -> pd.Series:
        values = texts.fillna("").tolist()
        out: list[list] = [[] for _ in values]
        for part in in_parts(values) if model.languages else ():
            words = split_words([values[i] for i in part], model.alphabet)
            labels = label_words(words, model, penalty)
            if not len(labels):
                continue
            new = np.flatnonzero(np.diff(words.text, prepend=-1).astype(bool) | np.diff(labels, prepend=-1).astype(bool))
            last = np.append(new[1:], len(labels)) - 1
            for a, b in zip(new.tolist(), last.tolist(), strict=True):
                at = words.origin[words.text[a]]
                out[part[words.text[a]]].append(
                    {"begin": int(words.start[a] - at), "end": int(words.end[b] - at), "lang": model.languages[labels[a]]}
                )
        return pd.Series(out)

    return of(text)


def taught(docs: DataFrame, folds: int = 4, held_out: int = 2) -> Column:
    """True for rows to learn from: those whose crc32 of the id as text does not fall into the held-out fold, or without id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held_out, F.lit(True))
