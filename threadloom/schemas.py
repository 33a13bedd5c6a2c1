"""Declared schemas, as DDL text. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import StructType


def fields(ddl: str) -> StructType:
    """The parsed schema (needs a running session)."""
    return StructType.fromDDL(ddl)


# --- fixed values: field names and types of the incoming records and of the tables ---

# A post as scraped. Numbers stay variants and times stay text until they are coerced.
REDDIT_WIRE = """
  post_id string, url string, user_posted string, title string, description string,
  num_comments variant, date_posted string, community_name string, num_upvotes variant,
  photos array<string>, videos array<string>, tag string,
  related_posts array<struct<num_comments:variant, num_upvotes:variant, thumbnail:string, url:string,
    title:string, community_url:string, community:string>>,
  comments array<struct<
    replies:array<struct<num_replies:variant, num_upvotes:variant, date_of_reply:string, user_url:string,
      reply:string, user_replying:string>>,
    num_replies:variant, user_commenting:string, num_upvotes:variant, date_of_comment:string, url:string,
    user_url:string, comment:string>>,
  community_url string, community_description string, community_members_num variant,
  community_rank struct<community_rank_value:string, community_rank_type:string>,
  post_karma variant, bio_description string, embedded_links array<string>, timestamp string,
  input struct<url:string>, error_code string, error string, warning_code string, warning string
"""

REDDIT_DATA = """
  error_code string, error string, warning_code string, user_posted string, community_members_num bigint,
  input struct<url:string>, community_url string, post_karma bigint,
  community_rank struct<community_rank_value:string, community_rank_type:string>,
  comments array<struct<
    replies:array<struct<num_replies:bigint, num_upvotes:bigint, date_of_reply:timestamp, user_url:string,
      reply:string, user_replying:string>>,
    num_replies:bigint, user_commenting:string, num_upvotes:bigint, date_of_comment:timestamp, url:string,
    user_url:string, comment:string>>,
  embedded_links array<string>, community_description string,
  related_posts array<struct<num_comments:bigint, num_upvotes:bigint, thumbnail:string, url:string,
    title:string, community_url:string, community:string>>,
  bio_description string, date_posted timestamp, videos array<string>, num_upvotes bigint, timestamp timestamp,
  url string, community_name string, description string, photos array<string>, num_comments bigint,
  tag string, title string, warning string, post_id string, snapshot_id string
"""

QUORA_WIRE = """
  timestamp string, author_education string, post_id string,
  top_comments array<struct<commenter_name:string, comment:string, comment_date:string,
    replys:array<struct<commenter_name:string, comment:string, comment_date:string>>>>,
  views variant, shares variant, author_content_views variant, post_date string, upvotes variant,
  extarnal_urls string, pictures_urls array<string>, header string, author_joined_date string, input string,
  post_text string, videos_urls string, over_all_answers variant, originally_answered string,
  author_name string, author_about string, error string, url string, error_code string,
  author_active_spaces string, title string
"""

QUORA_DATA = """
  timestamp timestamp, author_education string, post_id string,
  top_comments array<struct<commenter_name:string, comment:string, comment_date:timestamp,
    replys:array<struct<commenter_name:string, comment:string, comment_date:timestamp>>>>,
  views bigint, shares bigint, author_content_views bigint, post_date timestamp, upvotes bigint,
  extarnal_urls string, pictures_urls array<string>, header string, author_joined_date string, input string,
  post_text string, videos_urls string, over_all_answers bigint, originally_answered string,
  author_name string, author_about string, error string, url string, error_code string,
  author_active_spaces string, title string, snapshot_id string
"""

UNIFIED_ITEMS = """
  source string, content_type string, content_item_id string, parent_content_item_id string,
  top_level_post_id string, content_item_url string, author_username string, primary_text string,
  full_text_context string, engagement_score bigint, content_timestamp timestamp,
  community_or_channel_name string, hashtags array<string>, mentions array<string>,
  media_urls array<string>, video_urls array<string>, record_load_timestamp timestamp, snapshot_id string
"""

EMBEDDINGS_CACHE = """
  unified_id string, embeddings array<double>, embedding_model_name string, embedding_task_type string,
  embedding_generated_at timestamp, sentiment_score double, sentiment_magnitude double
"""

TOPIC_ASSIGNMENTS = """
  run_id string, assigned_at timestamp, unified_id string, source string, content_type string,
  content_timestamp timestamp, primary_text string, topic_id bigint, assignment_score double,
  sentiment_score double, sentiment_magnitude double
"""

TOPIC_LABELS = """
  run_id string, topic_id bigint, created_at timestamp, topic_label string, topic_description string,
  confidence_score double, num_documents_used bigint, avg_assignment_score double, model_metadata string
"""

COORDINATES = "run_id string, created_at timestamp, unified_id string, umap_x double, umap_y double"

PREDICTIONS = "run_id string, unified_id string, predicted_cluster bigint, distance double, created_at timestamp"

RUNS = """
  run_id string, created_at timestamp, num_topics bigint, description string, model_name string,
  model_creation_job_id string, predict_job_id string, labeling_job_id string, status string,
  error_message string, embedding_model string
"""

ENRICHED = """
  run_id string, processing_type string, source string, content_type string, content_item_id string,
  parent_content_item_id string, top_level_post_id string, analysis_timestamp timestamp,
  text_analyzed_for_nlp string, sentiment_label string, sentiment_score double, topic_id bigint,
  topic_label string, keyword_list array<string>
"""

WATERMARKS = "table_name string, last_processed_timestamp timestamp, updated_at timestamp"

SEARCH_BODY = """
  input struct<request_id:string>,
  general struct<search_engine:string, results_cnt:bigint, search_time:double, language:string,
    mobile:boolean, timestamp:string>,
  organic array<struct<link:string, title:string, description:variant, rank:bigint, global_rank:bigint>>
"""

# Dataset ids of the two scrapers.
REDDIT_DATASET_ID = "gd_lvz8ah06191smkebj4"
QUORA_DATASET_ID = "gd_lvz1rbj81afv3m6n5y"
DATASET_PLATFORMS = {REDDIT_DATASET_ID: "Reddit", QUORA_DATASET_ID: "Quora"}

# Columns that must be set, and keys that must be unique, per table.
REQUIRED = {
    "reddit_data": ["snapshot_id"],
    "embeddings_cache": ["unified_id"],
    "topic_labels": ["run_id", "topic_id", "created_at", "topic_label", "confidence_score", "num_documents_used",
                     "avg_assignment_score"],
    "social_content_enriched": ["processing_type", "source", "content_type", "content_item_id", "top_level_post_id",
                                "analysis_timestamp"],
    "nlp_processing_watermark": ["table_name"],
}
PRIMARY_KEYS = {
    "document_topic_assignments": ["run_id", "unified_id"],
    "topic_labels": ["run_id", "topic_id"],
    "kmeans_predictions": ["run_id", "unified_id"],
    "document_umap_coordinates": ["run_id", "unified_id"],
}
# Date column and sort columns of the partitioned tables.
LAYOUTS = {
    "document_topic_assignments": ("assigned_at", ["run_id", "topic_id"]),
    "topic_labels": ("created_at", ["run_id"]),
    "kmeans_predictions": ("created_at", ["run_id", "predicted_cluster"]),
    "document_umap_coordinates": ("created_at", ["run_id"]),
    "social_content_enriched": ("analysis_timestamp", ["source", "content_type", "topic_id"]),
}
# The declared columns of the partitioned tables.
DECLARED = {
    "document_topic_assignments": TOPIC_ASSIGNMENTS,
    "topic_labels": TOPIC_LABELS,
    "kmeans_predictions": PREDICTIONS,
    "document_umap_coordinates": COORDINATES,
    "social_content_enriched": ENRICHED,
}
