"""Runs of words that repeat with a period, found by minimizers at several scales; every run is found, none is guessed."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A run has at least this many words, and at least this many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
# Periods below that of the first scale are looked for lag by lag.
FIRST_SCALE = 15
# Texts are searched together until they have this many words.
WORDS_AT_ONCE = 400_000
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
RESULT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
Run = tuple[int, int, int]


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, cut at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a tenth of the ids, the original word that stands at each place once a tail was made periodic; else None."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


def scales(longest: int) -> list[tuple[int, int, int]]:
    """(k, w, least) until periods reach a third of ``longest`` words: minimizers of k words, in windows of w of them.

    A run of period q has 3 q words or more. If w + k - 1 <= 2 q, a window and the same one a period later both lie in
    it, so a minimizer and its copy a period later do. If q <= k, no other copy lies between them, as a repeat by less
    than q of k words would give the run a smaller period. A scale serves q from least = (k + w - 1) / 2 to k, and the
    scales leave no period out.
    """
    out, k = [], FIRST_SCALE
    while not out or out[-1][0] < longest // LEAST_PERIODS:
        w = k // 3
        out.append((k, w, (k + w) // 2))
        k = k * 3 // 2
    return out


def _slide(values: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every w neighbours, by doubling."""
    done = 1
    while done < w:
        step = min(done, w - done)
        values = pick(values[: len(values) - step], values[step:])
        done += step
    return values


def minimizers(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions that hold the smallest hash of some w neighbours; all of several equal ones."""
    if len(hashes) < w:
        return np.empty(0, np.int64)
    lowest = _slide(hashes, w, np.minimum)
    edge = np.zeros(w - 1, hashes.dtype)  # windows that begin before the first position or end behind the last don't count
    return np.flatnonzero(hashes == _slide(np.concatenate([edge, lowest, edge]), w, np.maximum))


def _seeds(words: np.ndarray, sums: np.ndarray, unshift: np.ndarray, k: int, w: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of consecutive equal minimizers that are ``least`` to k words apart."""
    if len(words) < k:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = (sums[k:] - sums[:-k]) * unshift[: len(words) - k + 1]
    hashes ^= hashes >> np.uint64(29)  # low bits of a product say little of its high ones
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    at = minimizers(hashes, w)
    order = np.lexsort((at, hashes[at]))
    at = at[order]
    gap = np.diff(at)
    near = (hashes[at[1:]] == hashes[at[:-1]]) & (gap <= k) & (gap >= least)
    return at[:-1][near], gap[near]


def _reach(words: np.ndarray, low: int, high: int, at: int, q: int) -> tuple[int, int]:
    """The stretch within [low, high) around ``at`` in which words q apart are equal: [start, end)."""
    end, step = at, 64
    while end + q < high:
        upto = min(high - q, end + step)
        other = np.flatnonzero(words[end:upto] != words[end + q : upto + q])
        if len(other):
            end += int(other[0])
            break
        end, step = upto, 2 * step
    start, step = at, 64
    while start > low:
        upto = max(low, start - step)
        other = np.flatnonzero(words[upto:start] != words[upto + q : start + q])
        if len(other):
            start = upto + int(other[-1]) + 1
            break
        start, step = upto, 2 * step
    return start, end + q


def _smallest(words: np.ndarray, start: int, end: int, q: int) -> bool:
    """Whether no divisor of q is a period of the stretch; with two periods or more any smaller period divides q."""
    rest, factor = q, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            d = q // factor
            if np.array_equal(words[start : end - d], words[start + d : end]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def _short(words: np.ndarray, q: int) -> list[Run]:
    """Runs of a period below all scales, from a scan of one lag."""
    same = np.flatnonzero(words[q:] == words[:-q])
    least = max(LEAST_WORDS, LEAST_PERIODS * q) - q
    if len(same) < least:
        return []
    breaks = np.flatnonzero(np.diff(same) != 1)
    first, last = np.append(0, breaks + 1), np.append(breaks, len(same) - 1)
    long = last - first + 1 >= least
    found = [(int(same[a]), int(same[b]) + 1 + q, q) for a, b in zip(first[long], last[long], strict=True)]
    return [r for r in found if _smallest(words, *r)]


def runs_together(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[Run]:
    """(start, end, period) of every run in texts laid out one behind the other, longest first, a word of its own after each.

    ``words`` are numbers that are equal for equal words; the words between texts occur once, so nothing reaches over them.
    """
    found: list[Run] = []
    if not len(lengths) or lengths[0] < LEAST_WORDS:
        return found
    all_scales = scales(int(lengths[0]))
    used = int(starts[np.searchsorted(-lengths, -LEAST_WORDS, "right") - 1] + lengths[np.searchsorted(-lengths, -LEAST_WORDS, "right") - 1])
    for q in range(1, min(all_scales[0][2], int(lengths[0]) // LEAST_PERIODS + 1)):
        found += _short(words[:used], q)
    mixed = words.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    powers = np.full(len(words), BASE)
    powers[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * np.cumprod(powers))])
    powers[1:] = INVERSE
    unshift = np.cumprod(powers)
    for k, w, least in all_scales:
        fit = int(np.searchsorted(-lengths, -LEAST_PERIODS * least, "right"))  # texts long enough for such a period
        if not fit:
            break
        used = int(starts[fit - 1] + lengths[fit - 1])
        at, gap = _seeds(words[:used], sums[: used + 1], unshift, k, w, least)
        known: dict[int, int] = {}  # where the last stretch of a period ends
        for m, q in sorted(zip(at.tolist(), gap.tolist(), strict=True)):
            if m < known.get(q, 0):
                continue
            text = int(np.searchsorted(starts, m, "right")) - 1
            start, end = _reach(words, int(starts[text]), int(starts[text] + lengths[text]), m, q)
            known[q] = end - q
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * q) and _smallest(words, start, end, q):
                found.append((start, end, q))
    return sorted(set(found))


def describe(doc_id: int | None, words: list[bytes], runs: list[Run]) -> tuple:
    """A row of RESULT; ``runs`` are (start, end, period) in order."""
    keep = np.ones(len(words), bool)
    best = None
    listed = hashlib.sha256()
    for start, end, q in runs:
        keep[start + q : end] = False
        listed.update(b"%d,%d,%d\n" % (start, end - start, q))
        if best is None or (end - start) * best[2] > best[1] * q:
            best = (start, end - start, q)
    kept = words if not runs else [words[i] for i in np.flatnonzero(keep)]
    shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *shown, listed.hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def search(texts: list[tuple[int | None, list[bytes]]]) -> list[tuple]:
    """Rows of RESULT for (doc_id, words), searched together."""
    sizes = np.array([len(words) for _, words in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    lengths = sizes[order]
    codes = pd.factorize(np.array([x for _, words in texts for x in words] + [b""], object))[0][:-1]
    first = np.append(0, np.cumsum(sizes))
    laid, starts = [], np.append(0, np.cumsum(lengths + 1))[:-1]
    for i, t in enumerate(order):
        laid += [codes[first[t] : first[t + 1]], np.array([len(codes) + 1 + i])]  # codes are below their number: no word has this one
    words = np.concatenate(laid).astype(np.int64) if laid else np.empty(0, np.int64)
    by_text: dict[int, list[Run]] = {}
    for start, end, q in runs_together(words, starts, lengths):
        i = int(np.searchsorted(starts, start, "right")) - 1
        by_text.setdefault(int(order[i]), []).append((start - int(starts[i]), end - int(starts[i]), q))
    return [describe(doc_id, words, by_text.get(t, [])) for t, (doc_id, words) in enumerate(texts)]


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """One row of RESULT per row of ``docs(doc_id, text)``: its runs counted, the strongest, and digests of all and of the rest.

    A run is a stretch of words with smallest period q, of max(24, 3 q) words or more, that no neighbouring word extends.
    Word numbers start at 0. ``runs_sha256`` is over a line ``start,length,period`` per run, by start, then period. The
    strongest run has the greatest length / period (ties: smallest start, then period); without a run its columns are null.
    ``collapsed_sha256`` is over the words no run repeats, joined by one space: of every run its first q words stay.

    Null and empty texts have no words. A long text is held by one task as numbers, a few times its own size. Repeated rows
    each give a row; other columns are not read; no rows give no rows. ``planted`` first makes a tail of every text periodic
    whose id (null: none) falls into a tenth by :func:`planted_order`; such a document is judged as it is then.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int | None, list[bytes]]] = []
        size = 0

        def flush() -> pd.DataFrame:
            out = pd.DataFrame(search(held), columns=[c.split()[0] for c in RESULT.split(", ")])
            return out.assign(**{c: pd.array(out[c].tolist(), "Int64") for c in out.columns[1:6]}, doc_id=pd.array([i for i, _ in held], "Int64"))

        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                words = words_of(text)
                number = None if doc_id is None else int(doc_id)  # as text, since pandas holds integers beside nulls as floats
                if planted and (places := planted_order(number, len(words))) is not None:
                    words = [words[i] for i in places]
                held.append((number, words))
                size += len(words)
                if size >= WORDS_AT_ONCE:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(rows, RESULT)
