"""Personal data: fixed patterns, and a trained character tagger that adds what is written in other ways."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.tagger import PAD, Tagger, classes_of, train, viterbi
from threadloom.session import cut, discard

KINDS = ("email", "ip", "card", "phone")
# The tagger sees windows of WINDOW characters, one every STEP, over the stretches within CONTEXT of a place that may belong to such data.
WINDOW, STEP, CONTEXT = 64, 32, 40
WINDOWS_AT_ONCE = 2048
# Training: about so many documents are looked through, of which at most so many spans a kind and places without one are learned.
SAMPLE_DOCS, EXAMPLES, EPOCHS = 4000, 300, 8
# Weight of the windows' votes against the transitions when they are reconciled.
FLOOR = 0.02

Span = tuple[int, int, int]  # start, end, number of the kind

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# What :func:`plausible` asks of a span: a digit, or a sign written out or not, before a name and a dot written out or not.
_DOT = r"(?:\.|[\[({<]\s?dot\s?[\])}>]|\bdot\b)"
_SEED = re.compile(
    rf"\d|(?P<sign>[@＠]|[\[({{<]\s?at\s?[\])}}>]|\bat\b(?=\s{{0,2}}[\w-]{{1,253}}+\s{{0,2}}{_DOT}))|\b(?:at|dot)\b(?=\s\S+\s(?:at|dot)\b)|\bdot\b", re.IGNORECASE
)
_LOOSE_DOMAIN = re.compile(rf"\s{{0,2}}[\w-]+(?:\s{{0,2}}{_DOT}\s{{0,2}}[\w-]+)+", re.IGNORECASE)
_LOOSE_EMAIL = re.compile(rf"[\w.%+-]+\s{{0,2}}(?:[@＠]|[\[({{<]\s?at\s?[\])}}>]|\bat\b){_LOOSE_DOMAIN.pattern}", re.IGNORECASE)
# Longest name before a sign, and longest host name, that are looked for.
LONGEST = 253


def _luhn(digits: str) -> bool:
    values = [int(c) for c in digits]
    return (sum(values[-1::-2]) + sum(sum(divmod(2 * v, 10)) for v in values[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdecimal())


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        # A failed sign ends every local part before it, so what follows begins behind it.
        done = found.end() if found else at + 1
        at = text.find("@", done)


def _fits(kind: int, text: str) -> bool:
    """Whether the digits in a span are right for its kind."""
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))
    digits = _digits(text)
    return 10 <= len(digits) <= 15 if kind == 3 else 14 <= len(digits) <= 19 and _luhn(digits)


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, by start, then kind: leftmost and non-overlapping for each kind; failing matches drop out.

    The work is linear in the text: a pattern starts at the first character of a run only, and takes a run whole.
    """
    found = [(a, b, 0) for a, b in _emails(text)]
    if any(c in text for c in "0123456789"):
        for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if _fits(kind, m.group())]
    return sorted(found, key=lambda s: (s[0], s[2]))


def _before(text: str, sign: int) -> int:
    """Where the name before a sign may begin."""
    first, at = max(0, sign - LONGEST), sign
    while at > max(first, sign - 2) and text[at - 1].isspace():
        at -= 1
    while at > first and (text[at - 1] in ".%+-_" or text[at - 1].isalnum()):
        at -= 1
    return at


def stretches(text: str) -> list[tuple[int, int]]:
    """[start, end) around places that may belong to personal data, joined where they overlap.

    Every span that is :func:`plausible`, up to LONGEST characters on either side of a sign, lies within one of them, so what
    lies in none cannot add a span.
    """
    out: list[list[int]] = []
    far = 0  # end of the last host name: signs within it end no later
    for m in _SEED.finditer(text):
        start, end = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if m["sign"]:
            start = min(start, _before(text, m.start()))
            if m.end() >= far:
                host = _LOOSE_DOMAIN.match(text, m.end())
                far = host.end() if host else far
            end = max(end, min(far, m.end() + LONGEST))
        while out and start <= out[-1][1]:
            before = out.pop()
            start, end = min(start, before[0]), max(end, before[1])
        out.append([start, end])
    return [(a, b) for a, b in out]


def windows(start: int, end: int) -> list[int]:
    """Where the overlapping windows over a stretch begin; the last one ends with it, so only a short stretch is padded."""
    if end - start <= WINDOW:
        return [start]
    return [*range(start, end - WINDOW, STEP), end - WINDOW]


def plausible(kind: int, text: str) -> bool:
    """Whether a span that the tagger found has what its kind must have, with whatever separators."""
    if kind == 0:
        return bool(_LOOSE_EMAIL.fullmatch(text))
    parts = [_digits(p) for p in re.split(r"\D+", text) if p]
    if kind == 1:
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)
    return not any(c.isalpha() for c in text) and _fits(kind, text)


def _snap(text: str, start: int, end: int, kind: int) -> tuple[int, int]:
    """The span without separators at its ends, and with the whole of the words it ends in."""
    inner = LOCAL if kind == 0 else ""
    inside = lambda c: c.isalnum() or c in inner
    while start < end and not (inside(text[start]) or kind == 3 and text[start] in "+("):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    while start < end and start > 0 and end - start < 400 and inside(text[start]) and inside(text[start - 1]):
        start -= 1
    while start < end < len(text) and end - start < 400 and text[end].isalnum():
        end += 1
    if kind == 3 and start > 0 and text[start - 1] in "+(":
        start -= 1
    return start, end


def reconcile(votes: np.ndarray, step: np.ndarray) -> list[Span]:
    """Spans of one best path over a whole stretch, from the votes (place, label) of all its windows and the CRF's transitions."""
    scores = np.log(votes / votes.sum(1, keepdims=True) + FLOOR)
    labels = viterbi(scores[None], step)[0]
    edges = np.flatnonzero(np.diff(labels, prepend=0, append=0))
    return [(int(a), int(b), int(labels[a]) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True) if labels[a]]


def tag(texts: list[str], model: Tagger) -> list[list[Span]]:
    """What the tagger finds in each text: its windows decoded, their votes weighted by how central a place is, and reconciled."""
    places = [(t, a, b) for t, text in enumerate(texts) for a, b in stretches(text)]
    spots = [(s, w) for s, (_, a, b) in enumerate(places) for w in windows(a, b)]
    coded = [classes_of(texts[t][a:b]) for t, a, b in places]
    votes = [np.full((b - a, len(KINDS) + 1), 1e-9) for _, a, b in places]
    middle = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float64)
    for at in range(0, len(spots), WINDOWS_AT_ONCE):
        some = spots[at : at + WINDOWS_AT_ONCE]
        x = np.full((len(some), WINDOW), PAD)
        for row, (s, w) in zip(x, some, strict=True):
            part = coded[s][w - places[s][1] :][:WINDOW]
            row[: len(part)] = part
        for labels, (s, w) in zip(model.decode(x), some, strict=True):
            first = w - places[s][1]
            size = min(WINDOW, len(votes[s]) - first)
            votes[s][np.arange(first, first + size), labels[:size]] += middle[:size]
    out: list[list[Span]] = [[] for _ in texts]
    for s, (t, a, _) in enumerate(places):
        out[t] += [(a + i, a + j, kind) for i, j, kind in reconcile(votes[s], model.params["step"])]
    return out


def all_spans(texts: list[str], model: Tagger | None) -> list[list[tuple[int, int, int, bool]]]:
    """(start, end, kind, base) by start, then kind. The tagger adds spans that are plausible and touch no base span."""
    found = tag(texts, model) if model else [[] for _ in texts]
    out = []
    for text, more in zip(texts, found, strict=True):
        base = base_spans(text)
        taken = sorted((a, b) for a, b, _ in base)
        added = []
        for a, b, kind in more:
            a, b = _snap(text, a, b, kind)
            if a < b and plausible(kind, text[a:b]) and all(b <= x or y <= a for x, y in _near(taken, a, b)):
                added.append((a, b, kind, False))
                taken = sorted([*taken, (a, b)])
        out.append(sorted([(*s, True) for s in base] + added, key=lambda s: (s[0], s[2])))
    return out


def _near(taken: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    return [(x, y) for x, y in taken if x < b and a < y]


def variants(kind: int, text: str, rng: random.Random) -> str:
    """The same datum, written as people write it to dodge patterns or by other customs."""
    if kind == 0:
        name, _, host = text.partition("@")
        at = rng.choice([" at ", " [at] ", "[at]", " (at) ", "(at)", " @ ", "{at}", " AT "])
        dot = rng.choice([" dot ", "[dot]", " (dot) ", "(dot)", " . ", "."]) if "." not in at else "."
        return name + at + host.replace(".", dot)
    if kind == 1:
        return text.replace(".", rng.choice([" . ", "[.]", "(.)", ", ", " ", "-", "·"]))
    if kind == 2:
        digits = _digits(text)
        return rng.choice([".", "/", "_", "  ", " - ", " "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    digits = _digits(text)
    cut_at = sorted(rng.sample(range(2, len(digits) - 2), 2))
    parts = digits[: cut_at[0]], digits[cut_at[0] : cut_at[1]], digits[cut_at[1] :]
    return rng.choice(["00{} {} {}", "({}) {} {}", "{}/{}-{}", "+ {} {} {}", "00{}-{}-{}", "+{}/{}/{}", "{} {} {}"]).format(*parts)


def examples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, most: int = EXAMPLES) -> list[tuple[int, str, str, str]]:
    """(kind, before, span, after) of base spans in about ``sample_docs`` documents, at most ``most`` a kind; kind -1: a place without one.

    Documents are picked by a hash of id and text, examples by a hash of themselves, each different one once.
    """
    rate = min(1.0, sample_docs / max(1, docs.count()))

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame["text"]:
                base = base_spans(text)
                rows += [(k, text[max(0, a - WINDOW) : a], text[a:b], text[b : b + WINDOW]) for a, b, k in base if b - a <= 2 * WINDOW]
                for a, b in stretches(text):
                    if not _near([s[:2] for s in base], a, b):
                        rows += [(-1, "", text[w : w + WINDOW], "") for w in windows(a, b)]
            yield pd.DataFrame(rows, columns=["kind", "before", "span", "after"])

    picked = docs.filter(F.col("text").isNotNull() & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(rate * (1 << 20)))).select("text")
    found = cut(picked.mapInPandas(look, "kind int, before string, span string, after string").distinct())
    order = F.xxhash64("before", "span", "after")
    rows = [
        tuple(r) for kind in range(-1, len(KINDS))
        for r in found.filter(F.col("kind") == kind).orderBy(order, "before", "span", "after").limit(most * (1 if kind >= 0 else 2)).collect()
    ]
    discard(found)
    return rows


def training_windows(rows: list[tuple[int, str, str, str]], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their labels: each span once as it stands and twice as a variant, at a random place of a window."""
    rng = random.Random(seed)
    x, y = [], []
    for kind, before, span, after in rows:
        for text in [span] if kind < 0 else [span, variants(kind, span, rng), variants(kind, span, rng)]:
            whole = before + text + after
            codes = classes_of(whole)
            labels = np.zeros(len(whole), np.int64)
            labels[len(before) : len(before) + len(text)] = kind + 1
            low, high = max(0, len(before) + min(12, len(text)) - WINDOW), min(max(0, len(whole) - WINDOW), len(before) + max(0, len(text) - 12))
            start = rng.randint(min(low, high), high) if kind >= 0 else 0
            row = np.full(WINDOW, PAD), np.zeros(WINDOW, np.int64)
            part = codes[start : start + WINDOW]
            row[0][: len(part)], row[1][: len(part)] = part, labels[start : start + WINDOW]
            x.append(row[0])
            y.append(row[1])
    return np.array(x), np.array(y)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, most: int = EXAMPLES, epochs: int = EPOCHS) -> Tagger | None:
    """A tagger learned from the base spans of a bounded sample of ``docs(doc_id, text)`` and variants of them; None if there are none."""
    rows = examples(docs, sample_docs, most)
    if not any(r[0] >= 0 for r in rows):
        return None
    model = Tagger.fresh(len(KINDS) + 1)
    train(model, *training_windows(rows), epochs)
    return model


def find(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """(doc_id, spans): for each row of ``docs(doc_id, text)`` its personal data, by start, then kind.

    ``spans`` is an array of (kind, start, end, base), in code points, end exclusive. Base spans are those of the fixed
    patterns; all of them stay. The tagger reads every stretch of the whole text that can hold a span it may add (:func:`stretches`),
    and adds spans of a kind's right make-up that touch no base span. Without a model only base spans are found. Null
    texts count as empty and have none. Repeated rows each give a row, other columns are not read, no rows give no rows.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = all_spans([t or "" for t in frame["text"]], model)
            yield pd.DataFrame({
                "doc_id": pd.array([None if i is None else int(i) for i in frame["doc_id"]], "Int64"),
                "spans": [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for a, b, k, base in spans] for spans in found],
            })

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(rows, "doc_id long, spans array<struct<kind string, start int, end int, base boolean>>")


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask(text: Column, spans: Column) -> Column:
    """The text with ``<kind>`` in place of each span; of overlapping spans, from the first start to the last end."""
    begin = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    text = F.coalesce(text, F.lit(""))

    def put(state: Column, s: Column) -> Column:
        between = F.substr(text, state["at"] + 1, F.greatest(F.lit(0), s["start"] - state["at"]))
        name = F.when((s["start"] >= state["at"]) | (state["at"] == 0), F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise("")
        return F.struct(F.concat(state["done"], between, name).alias("done"), F.greatest(state["at"], s["end"]).alias("at"))

    return F.aggregate(spans, begin, put, lambda state: F.concat(state["done"], F.substr(text, state["at"] + 1)))
