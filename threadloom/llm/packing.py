"""Tokenising documents and packing their pieces into sequences by vector best-fit."""

from __future__ import annotations

import array
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import cut

MAX_TOKENS = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
# Two white-space characters in a row are the only place where the splitting pattern needs to look ahead.
_RUN = re.compile(r"\s\s")
_AHEAD = r"\s+(?!\S)|"


@dataclass(frozen=True)
class Capacities:
    """What one sequence holds; a piece of n tokens takes n tokens, one document and n * n of attention cost.

    ``weights`` weigh the three in the choice of a sequence. With the defaults only tokens bind: 1,024 pieces of at least
    one token, and squares that add up to at most the square of the sum.
    """

    tokens: int = MAX_TOKENS
    documents: int = MAX_TOKENS
    attention: int = MAX_TOKENS * MAX_TOKENS
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"


class Encoder:
    """Ids by the public byte-level BPE, equal to its ``tokenizers`` file without added special tokens.

    The rank file of the same vocabulary gives the same ids several times faster; a text that spells a special token goes
    through the ``tokenizers`` file itself. Where no two white-space characters touch, the pattern's look-ahead can never
    match, and the pattern without it splits alike.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import base64

        import public_tokenizers
        import tiktoken

        self.json = public_tokenizers.path(f"{vocabulary}.json")
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN
        self.plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.quick = tiktoken.Encoding("quick", pat_str=pattern.replace(_AHEAD, ""), mergeable_ranks=ranks, special_tokens={})
        self.full = None

    def ids(self, text: str | None) -> array.array:
        text = text or ""
        if "<|endoftext|>" in text:
            if self.full is None:
                from tokenizers import Tokenizer

                self.full = Tokenizer.from_file(self.json)
            return array.array("I", self.full.encode(text, add_special_tokens=False).ids)
        return array.array("I", (self.plain if _RUN.search(text) else self.quick).encode_ordinary(text))


def piece_bounds(n: int, most: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document of n ids: only longer ones are cut, and the first piece takes what is left over."""
    first = n % most or most
    yield 0, min(n, first)
    for start in range(first, n, most):
        yield start, most


def pieces(docs: DataFrame, most: int = MAX_TOKENS, end_id: int = END_ID, vocabulary: str = VOCABULARY, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of each row of ``docs(doc_id, text)``; the whole text is tokenised.

    A null or empty text is one piece that holds the end id alone. The vocabulary comes from the installed package; each
    worker loads it once a task.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            row, number, start, length, crc, parts = [], [], [], [], [], []
            for at, text in enumerate(batch.column("text").to_pylist()):
                ids = encoder.ids(text)
                ids.append(end_id)
                for k, (begin, size) in enumerate(piece_bounds(len(ids), most)):
                    part = ids[begin : begin + size]
                    row.append(at)
                    number.append(k)
                    start.append(begin)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        parts.append(np.frombuffer(part, "i4"))
            longs = [pa.array(x, pa.int64()) for x in (start, length, crc)]
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), *longs]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(parts, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tokenise, schema)


def plan(histogram: dict[int, int], capacities: Capacities) -> list[tuple[int, int, int, int, int]]:
    """Vector best-fit decreasing over counts of equal pieces: (length, from rank, to rank, first sequence, offset).

    Pieces of one length are alike, and so are sequences in one state (tokens, documents and attention cost left), so the
    plan moves whole runs: the longest pieces first, each to the fitting state with the smallest weighted norm of what is
    left after it (rule "norm") or the largest weighted dot-product of demand and residual ("dot"); where none fits, new
    sequences open. Work and plan grow with the number of lengths, not with the number of pieces.
    """
    total = np.array([capacities.tokens, capacities.documents, capacities.attention], float)
    weights = np.array(capacities.weights, float)
    states = np.zeros((0, 3), np.int64)  # residuals of each run of sequences
    runs = np.zeros((0, 2), np.int64)  # first sequence and their number
    opened = 0
    moves = []
    for length in sorted(histogram, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if (need > [capacities.tokens, capacities.documents, capacities.attention]).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        rank, left = 0, histogram[length]
        while left:
            fits = (states >= need).all(1)
            if fits.any():
                after = (states[fits] - need) / total
                if capacities.rule == "dot":
                    score = -(weights * (need / total) * (states[fits] / total)).sum(1)
                else:
                    score = (weights * after * after).sum(1)
                at = int(np.flatnonzero(fits)[score.argmin()])
                first, many = (int(x) for x in runs[at])
                take = min(left, many)
                state = states[at].copy()
                if take == many:
                    states, runs = np.delete(states, at, 0), np.delete(runs, at, 0)
                else:
                    runs[at] = first + take, many - take
            else:
                # As many as the pieces at hand would fill, so that they go on filling the same run.
                each = int(min((total // need).min(), left))
                take = -(-left // each)
                first, state = opened, total.astype(np.int64)
                opened += take
            moves.append((length, rank, rank + take, first, capacities.tokens - int(state[0])))
            rank, left = rank + take, left - take
            state = state - need
            if state[0] > 0 and state[1] > 0 and state[2] > 0:
                states, runs = np.vstack([states, state]), np.vstack([runs, [first, take]])
    return moves


# Pieces of one length are ranked in parts: so many at least, and more such that a part has about so many pieces.
RANK_PARTS, RANK_ROWS = 256, 1_000_000


def pack(rows: DataFrame, capacities: Capacities = Capacities()) -> DataFrame:
    """``rows(length, ids_crc32, doc_id, piece, ...)`` with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    Each piece gets its rank among the pieces of its length: the pieces of a length are dealt to buckets by hash,
    counted, and numbered within. The histogram of lengths (at most ``capacities.tokens`` rows) is all that reaches the
    driver, and the plan it gives is looked up by length and rank. ``rows`` must be repeatable (a written table). Rows
    alike in everything get places of their own. No rows give no rows; lengths must be between 1 and the capacity.
    """
    buckets = max(RANK_PARTS, -(-rows.count() // RANK_ROWS))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = cut(dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")))
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    moves = plan(histogram, capacities)
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("length", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece"))
    ranked = dealt.withColumn("_number", number - 1).join(offsets, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_number")).drop("_bucket", "_before", "_number")
    columns = {name: np.array([m[i] for m in moves], np.int64) for i, name in enumerate(("length", "start", "stop", "first", "offset"))}
    order = np.lexsort((columns["start"], columns["length"]))
    table = {name: values[order] for name, values in columns.items()}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.drop("_rank").schema.fields)
    names = ranked.drop("_rank").columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts = np.unique(table["length"], return_index=True)
        ends = np.append(firsts[1:], len(table["length"]))
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.zeros(len(length), np.int64)
            for value in np.unique(length):
                here = np.flatnonzero(length == value)
                k = int(np.searchsorted(lengths, value))
                at[here] = firsts[k] + np.searchsorted(table["start"][firsts[k] : ends[k]], rank[here], "right") - 1
            places = [pa.array(table["first"][at] + rank - table["start"][at]), pa.array(table["offset"][at])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *places], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) of ``packed(sequence_id, offset, doc_id, ids)``: a sequence is at most its capacity long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(parts.alias("_p")).select(
        "sequence_id", F.flatten(F.col("_p.ids")).alias("ids"), F.col("_p.doc_id").alias("doc_ids")
    )


def packed_pieces(docs: DataFrame, capacities: Capacities = Capacities(), vocabulary: str = VOCABULARY) -> DataFrame:
    """The pieces of ``docs`` (without their ids) and their places. Results of the tokeniser are written once."""
    return pack(cut(pieces(docs, capacities.tokens, vocabulary=vocabulary, with_ids=False)), capacities)
