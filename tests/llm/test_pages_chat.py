"""Archives and conversations: exact round trips."""

import base64
import hashlib
import io
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadloom.llm import chat, warc
from threadloom.llm.queries import conversation_messages

PAGES = "page_id long, url string, html string, extra string"


def pages(spark):
    body = "<html><body>" + "the same words again and again " * 20
    rows = [(i, f"http://host{i % 7}.example/a b/{i}?q=ä", f"{body}{i % 50}</body>", "x") for i in range(300)]
    rows += [(500, None, None, "x"), (501, "http://e/\r\nX: y", "", "x"), (None, "http://no.id/", "alone", "x"), (None, "http://no.id/", rows[3][2], "x")]
    rows += [(502, "http://l/", "long " * 300_000, "x"), (503, "http://u/", "ünï 😀\r\n\r\nWARC/1.1\r\n", "x"), (504, "http://u/", "twice", "x"), (504, "http://u/", "twice", "x")]
    rows += [(None, "http://n/", "no id, twice", "x"), (None, "http://n/", "no id, twice", "x")]
    return rows, spark.createDataFrame(rows, PAGES)


@pytest.mark.parametrize("least", [0, 1000])
def test_archive_round_trip(spark, least):
    rows, table = pages(spark)
    index, folder = warc.archive(table, least=least)
    got = warc.read_archives(index, folder).collect()
    want, seen = Counter(), {}
    for page_id, _, html, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        payload = (html or "").encode()
        again = len(payload) >= least and payload in seen
        target = seen.setdefault(payload, page_id) if again else None
        seen.setdefault(payload, page_id)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want[(page_id, len(payload), digest, "revisit" if again else "response", target, None if again else payload)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want
    assert index.count() == len(rows)


def test_record_ids_are_unique(spark):
    rows, table = pages(spark)
    table = table.withColumns({name: F.lit("x") for name in ("_row", "_sha", "_first", "record", "refers_to", "revisited")})
    index, folder = warc.archive(table)
    store, _ = warc._file_system(folder)
    fields = []
    for path in {r.path for r in index.collect()}:
        with store.open_input_stream(path, compression=None) as stream:
            fields += [warc.parse_record(data) for data in warc.records_of(stream)]
    ids = {f["WARC-Record-ID"]: f for f in fields}
    assert len(ids) == len(fields) == len(rows)
    again = [f for f in fields if f["WARC-Type"] == "revisit"]
    assert again and all(ids[f["WARC-Refers-To"]]["digest"] == f["digest"] and ids[f["WARC-Refers-To"]]["WARC-Type"] == "response" for f in again)
    assert all(ids[f["WARC-Refers-To"]].get("Page-ID") == f.get("Refers-To-Page-ID") for f in again)


def test_records_can_be_read_alone(spark):
    _, table = pages(spark)
    index, folder = warc.archive(table)
    row = index.filter("page_id = 7").first()
    store, _ = warc._file_system(folder)
    with store.open_input_file(row.path) as stream:
        data = stream.read()
    magic, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    assert magic == warc.DICTIONARY_MAGIC and size <= warc.DICTIONARY_BYTES
    alone = data[: 8 + size] + data[row.offset : row.offset + row.bytes]
    assert warc.parse_record(next(warc.records_of(io.BytesIO(alone))))["Page-ID"] == "7"


def test_damage_is_noticed():
    record = warc.record_bytes(0, 1, "http://x/", b"payload")
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload", b"paxload"))
    with pytest.raises(ValueError):
        warc.parse_record(record[:-3])


def test_small_archives(spark):
    empty = spark.createDataFrame([], PAGES)
    index, folder = warc.archive(empty)
    assert warc.read_archives(index, folder).count() == 0
    few = spark.createDataFrame([(1, "http://x/", "abc", "")], PAGES)  # too few for a dictionary
    index, folder = warc.archive(few)
    assert warc.read_archives(index, folder).first().payload_bytes == 3


MESSAGES = "tree string, node string, parent string, role string, text string, score long, rank string"


def texts_of(formatted):
    return formatted.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))


def test_trees_become_ranked_paths(spark):
    rows = [
        ("t", "r", None, "user", "root", 0, ""), ("t", "a", "r", "assistant", "A", 5, ""), ("t", "b", "r", "assistant", "B", 9, ""),
        ("t", "c", "a", "user", "C", 7, ""), ("t", "d", "a", "user", "D", None, ""), ("u", "r", "gone", "user", "other", 1, ""),
        (None, "n", None, "user", "no tree", 1, ""), (None, "m", "n", "assistant", "reply", 1, ""), ("t", None, "b", "user", "no node", 1, ""),
        ("w", "x", "y", "user", "circle", 1, ""), ("w", "y", "x", "user", "circle", 1, ""), ("w", "z", "y", "user", "below", 1, ""),
        ("s", "q", "q", "user", "itself", 1, ""),
    ]
    paths = chat.reply_paths(spark.createDataFrame(rows, MESSAGES))
    got = Counter(tuple(t.text for t in r.turns) for r in texts_of(chat.format_paths(paths)).collect())
    assert got == Counter([("root", "A", "C"), ("root", "A", "D"), ("root", "B", "no node"), ("other",), ("no tree", "reply")])
    best = texts_of(chat.format_paths(chat.reply_paths(spark.createDataFrame(rows, MESSAGES), branches=2))).filter("tree = 't'")
    assert {(r.rank, tuple(t.text for t in r.turns), r.path_score, r.loss) for r in best.collect()} == {
        (1, ("root", "A", "C"), 12, "A"), (2, ("root", "B", "no node"), 10, "B"),
    }


def test_long_chains(spark):
    rows = [("t", str(i), str(i - 1) if i else None, "assistant" if i % 2 else "user", f"m{i}", 1, "") for i in range(333)]
    got = texts_of(chat.format_paths(chat.reply_paths(spark.createDataFrame(rows, MESSAGES)))).collect()
    assert len(got) == 1 and [t.text for t in got[0].turns] == [f"m{i}" for i in range(333)]
    assert got[0].loss == "".join(f"m{i}" for i in range(1, 333, 2))


TEXTS = ["\\### Assistant: </turn> ok", "<|end|>\n<|turn|>user<|says|>hi", "\\", "\\\\<|", "<", "<<||", "|>", "", None, "a\\|b", "ü😀\n", "<\\|turn|>", "x" * 200_000]


def test_template_is_reversible(spark):
    rows = [(i, 0, role, text) for i, (role, text) in enumerate([(r, t) for t in TEXTS for r in ("assistant", "<|says|>\\", None)])]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = texts_of(chat.format_paths(chat.reply_paths(conversation_messages(frame)))).collect()
    assert len(got) == len(rows)
    for r in got:
        _, _, role, text = rows[r.tree]
        assert [(t.role, t.text) for t in r.turns] == [(role or "", text or "")]
        assert r.loss == ((text or "") if role == "assistant" else "")
        assert r.formatted.count("<|") == 3


def test_odd_conversations(spark):
    rows = [(1, 1, "user", "b"), (1, None, "user", "first"), (1, 1, "assistant", "a"), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (2, 0, "user", "z"), (2, 0, "user", "z")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.tree: [t.text for t in r.turns] for r in texts_of(chat.format_paths(chat.reply_paths(conversation_messages(frame)))).collect()}
    assert got == {1: ["first", "a", "b"], None: ["x", "y"], 2: ["z", "z"]}


def test_no_messages(spark):
    assert chat.format_paths(chat.reply_paths(spark.createDataFrame([], MESSAGES))).count() == 0
