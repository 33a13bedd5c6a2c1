import datetime as dt
import base64
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from threadloom import fixtures as fx
from threadloom.functions.coerce import iso_timestamp, to_long
from threadloom.functions.text import cut_query, has_text, trim_ws, words
from threadloom.schemas import QUORA_DATA, QUORA_WIRE, REDDIT_DATA, REDDIT_DATASET_ID, REDDIT_WIRE, fields
from threadloom.sources.drops import read_raw_json, with_drop_metadata
from threadloom.sources.envelopes import decode_envelopes
from threadloom.sources.links import clean_links, scrape_manifest, selection
from threadloom.sources.normalize import normalize_quora, normalize_reddit
from threadloom.sources.routing import route
from threadloom.sources.search import serp_results, serp_searches


def drop(tmp_path, name, value):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))
    return path


def normalized(spark, tmp_path, *posts, wire=REDDIT_WIRE, normalize=normalize_reddit):
    drop(tmp_path, "d/s.json", list(posts))
    return normalize(read_raw_json(spark, str(tmp_path), wire).withColumn("snapshot_id", F.lit("s")))


@pytest.mark.parametrize(
    "value,number",
    [(12, 12), (12.7, 12), (-1.5, -1), ("12", 12), (" 12 ", 12), ("12.5", None), ("", None), ("n/a", None), (None, None),
     (True, 1), ({}, None), ([1], None), ("1e3", None)],
)
def test_to_long(spark, value, number):
    df = spark.createDataFrame([(json.dumps(value),)], "j string").select(to_long(F.parse_json("j")))
    assert df.first()[0] == number


@pytest.mark.parametrize(
    "text,expected",
    [("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"), ("2024-01-02T03:04:05.123+02:00", "2024-01-02 01:04:05"),
     ("2024-01-02 03:04:05", "2024-01-02 03:04:05"), ("2024-01-02", "2024-01-02 00:00:00"), ("2024", None), ("12:30:00", None),
     ("soon", None), ("2024-13-01", None), ("", None), (None, None)],
)
def test_iso_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(F.date_format(iso_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss"))
    assert df.first()[0] == expected


def test_text_functions(spark):
    df = spark.createDataFrame([("  a b \n",), (" \t ",), (None,)], "t string")
    assert [r[0] for r in df.select(trim_ws(F.col("t"))).collect()] == ["a b", "", None]
    assert [r[0] for r in df.select(has_text(F.col("t"))).collect()] == [True, False, False]
    one = spark.createDataFrame([("Été d'ARC — 3 x2!",)], "t string").select(words(F.col("t"))).first()[0]
    assert one == ["été", "d", "arc", "3", "x2"]
    urls = spark.createDataFrame([(" http://a/b#c?x=1?y ",), ("?q",)], "u string").select(cut_query(F.col("u"))).collect()
    assert [r[0] for r in urls] == ["http://a/b#c", ""]


def test_a_bad_field_costs_only_itself(spark, tmp_path):
    df = normalized(
        spark, tmp_path,
        {"post_id": "a", "num_upvotes": "x", "photos": "p", "comments": "oops", "community_rank": {}, "input": {"url": "i"},
         "date_posted": 5, "title": "kept"},
        {"post_id": "b", "num_upvotes": 7, "photos": ["p", "q"], "community_rank": {"community_rank_type": "top"},
         "comments": [{"comment": "c", "num_upvotes": "3", "replies": None, "date_of_comment": "bad"}]},
    )
    assert df.schema.simpleString() == fields(REDDIT_DATA).simpleString()
    got = rows(df, "post_id", "title", "num_upvotes", "photos", "community_rank", "input", "date_posted", "comments")
    assert got[0] == ("a", "kept", None, [], None, ("i",), None, [])
    assert got[1][2:5] == (7, ["p", "q"], (None, "top")) and got[1][5] is None
    (only,) = got[1][7]
    assert (only["comment"], only["num_upvotes"], only["replies"], only["date_of_comment"]) == ("c", 3, [], None)


def test_quora_fields_keep_their_names(spark, tmp_path):
    df = normalized(
        spark, tmp_path,
        {"post_id": "q", "extarnal_urls": ["a"], "upvotes": "5", "pictures_urls": None, "videos_urls": "v", "post_date": "2024-01-01",
         "top_comments": [{"commenter_name": "n", "comment": "c", "comment_date": "2024-01-02T00:00:00Z", "replys": [{"comment": "r"}]}]},
        wire=QUORA_WIRE, normalize=normalize_quora,
    )
    assert df.schema.simpleString() == fields(QUORA_DATA).simpleString()
    row = df.first()
    assert (row["extarnal_urls"], row["upvotes"], row["pictures_urls"], row["videos_urls"]) == ('["a"]', 5, [], "v")
    assert row["top_comments"][0]["replys"][0]["comment"] == "r" and row["post_date"].year == 2024


def test_drop_metadata_from_real_files(spark, tmp_path):
    drop(tmp_path, f"{REDDIT_DATASET_ID}/s_1.json", [{"post_id": "a"}, {"post_id": "b"}])
    drop(tmp_path, f"{REDDIT_DATASET_ID}/deep/s_2.json", [{"post_id": "c"}])
    drop(tmp_path, "lost.json", [{"post_id": "d"}])
    accepted, rejected = with_drop_metadata(read_raw_json(spark, str(tmp_path), REDDIT_WIRE), root=str(tmp_path))
    assert rows(accepted, "post_id", "dataset_id", "snapshot_id") == [
        ("a", REDDIT_DATASET_ID, "s_1"), ("b", REDDIT_DATASET_ID, "s_1"), ("c", REDDIT_DATASET_ID, "s_2"),
    ]
    assert rows(rejected, "post_id", "reject_reason") == [("d", "path_too_short")]


def message(data, **attributes):
    return (data if isinstance(data, str) else base64.b64encode(json.dumps(data).encode()).decode(), attributes)


def test_envelopes(spark):
    posts = [{"post_id": "a", "num_upvotes": 1.5}, {"post_id": "b"}]
    messages = [
        message(posts, job_id="j", dataset_id="d"), message(posts[:1], dataset_id="d"), message({"post_id": "lone"}, job_id="j1"),
        message("%%%", job_id="j2"), message(base64.b64encode(b"[{").decode(), job_id="j3"), message([], job_id="j4"),
    ]
    df = spark.createDataFrame(messages, "data string, attributes map<string,string>")
    accepted, rejected = decode_envelopes(df, REDDIT_WIRE)
    assert rows(accepted, "post_id", "snapshot_id", "warning_reason") == [
        ("a", "j", None), ("a", None, "missing_job_id"), ("b", "j", None),
    ]
    assert rows(rejected, "snapshot_id", "reject_reason") == [("j1", "not_a_list"), ("j2", "bad_base64"), ("j3", "bad_json")]


def test_messages_and_files_give_the_same_rows(spark, sf, tmp_path):
    from threadloom import fixtures as fx

    texts = [r["post"] for r in fx.reddit_wire(spark, sf).orderBy("conv_id", "snap").limit(20).collect()]
    drop(tmp_path, "d/s.json", "[" + ",".join(texts) + "]")
    by_file = normalize_reddit(read_raw_json(spark, str(tmp_path), REDDIT_WIRE).withColumn("snapshot_id", F.lit("s")))
    data = base64.b64encode(("[" + ",".join(texts) + "]").encode()).decode()
    sent = spark.createDataFrame([(data, {"job_id": "s", "dataset_id": "d"})], "data string, attributes map<string,string>")
    by_message = normalize_reddit(decode_envelopes(sent, REDDIT_WIRE)[0])
    assert rows(by_file) == rows(by_message) and by_file.count() == 20


def test_route(spark):
    df = route(spark.createDataFrame([(REDDIT_DATASET_ID,), ("x",), (None,)], "dataset_id string"))
    assert rows(df, "platform", "reject_reason") == [("Reddit", None), (None, "unknown_dataset_id"), (None, "unknown_dataset_id")]


def test_search_responses(spark):
    body = {
        "input": {"request_id": "r"},
        "general": {"search_engine": "g", "results_cnt": 3, "search_time": 0.5, "language": "en", "mobile": True, "timestamp": "2024-01-01T00:00:00Z"},
        "organic": [{"link": "a", "title": "A", "rank": 1, "global_rank": 1}, {"link": "b", "description": None}, {"description": "text"}],
    }
    without = {**body, "input": {"request_id": "r2"}}
    del without["organic"]
    raw = spark.createDataFrame(
        [("q", "0", json.dumps({"body": json.dumps(b)})) for b in (body, without)] + [("q", "0", "{}"), ("q", "0", "junk")],
        "search_query string, pagination_start string, response string",
    )
    searches = serp_searches(raw)
    assert rows(searches, "request_id", "is_mobile", "results_count") == [("r", "True", 3), ("r2", "True", 3)]
    assert rows(serp_results(raw), "link", "description") == [("a", ""), ("b", None), (None, "text")]
    assert rows(serp_results(raw), "id") == rows(serp_results(raw.repartition(3)), "id")


def test_links_keep_duplicates_unless_asked(spark):
    df = spark.createDataFrame([(" http://a?x ",), ("http://a",), ("",), (None,), ("?x",)], "url string")
    assert rows(clean_links(df, "url")) == [("",), ("http://a",), ("http://a",)]
    assert rows(clean_links(df, "url", distinct=True)) == [("",), ("http://a",)]


def test_a_batch_is_a_header_and_its_links(spark):
    links = spark.range(25).select(
        F.lit("d").alias("dataset_id"), F.lit("s").alias("snapshot_id"), F.col("id").alias("position"),
        F.concat(F.lit("u"), F.col("id") % 5).alias("url"),
    )
    headers, each = scrape_manifest(links.repartition(5), dt.datetime(2024, 3, 1))
    assert rows(headers) == [("d", "s", 25, dt.datetime(2024, 3, 1))]
    assert [r["url"] for r in each.orderBy("position").collect()] == [f"u{i % 5}" for i in range(25)]


def test_selection(spark):
    df = spark.createDataFrame([(" a ",), ("a",), ("\t",), (None,), ("b",)], "id string")
    assert rows(selection(df, "id")) == [("a",), ("b",)]


def test_documents_in_many_parts_are_not_copied(spark, tmp_path):
    """One small file is dealt over as many as there are cores; a table that has so many parts is read where it is. The items are the same."""
    texts = [(i, f"text {i}" if i % 3 else None, "en", "a", 6) for i in range(200)]
    given = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    many = spark.sparkContext.defaultParallelism
    given.coalesce(1).write.parquet(f"{tmp_path}/one/documents.parquet")
    given.repartition(3 * many).write.parquet(f"{tmp_path}/many/documents.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a part for each file
    try:
        one, parts = (fx.document_items(spark, f"{tmp_path}/{name}") for name in ("one", "many"))
        assert rows(one) == rows(parts) and len(rows(one)) == 200
        assert all("/many/documents.parquet" in name for name in parts.inputFiles())
        assert len(one.inputFiles()) == many and not any("/one/documents.parquet" in name for name in one.inputFiles())
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
