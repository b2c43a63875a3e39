"""Schemas of the inputs and of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

# Field names and types of the input records.
ATTENDEE = "name string, email string, company string, source string, event_url string, created_at timestamp"
MENTION = (
    "url string, title string, body string, timestamp string, image_url string, source string, "
    "source_id string, author string, author_avatar_url string, author_profile_link string, "
    "relevance_score string, relevance_comment string, language string, keyword string, bookmarked boolean"
)
CALL_EVENT = (
    "id bigint, recording struct<url: string, duration_in_minutes: double>, "
    "meeting struct<scheduled_start_time: timestamp, scheduled_end_time: timestamp, "
    "scheduled_duration_in_minutes: int, join_url: string, title: string, has_external_invitees: boolean, "
    "external_domains: array<struct<domain_name: string>>, "
    "invitees: array<struct<name: string, email: string, is_external: boolean>>>, "
    "fathom_user struct<name: string, email: string, team: string>, "
    "transcript struct<plaintext: string>"
)
SPEAKER = "name string, email string, aliases array<string>"
SPEAKER_STORAGE = "speakers_internal array<struct<name: string, email: string, aliases: array<string>>>"
TRANSACTION = (
    "id bigint, amount bigint, at timestamp, description string, user_id bigint, payer_id bigint, payee_id bigint"
)
RECEIPT = "id bigint, at timestamp, user_id bigint, body string"
PRODUCT = "title string, id bigint"
PRODUCT_DESCRIPTION = (
    "title string, id string, product_category_id string, hid bigint, product_category_hid bigint, description string"
)
CONTACT = (
    "first_name string, last_name string, url string, email_address string, company string, position string, "
    "connected_on timestamp, timestamp timestamp"
)
MESSAGE = (
    "id string, recording_id string, message_id int, url string, title string, date timestamp, timestamp int, "
    "speaker string, organization string, message string, action_item string, watch_link string"
)

# Warehouse columns in table order, with type and whether a value is required.
MENTION_TABLE = {
    "url": ("string", True),
    "title": ("string", False),
    "body": ("string", True),
    "timestamp": ("timestamp", True),
    "image_url": ("string", False),
    "source": ("string", True),
    "source_id": ("string", True),
    "author": ("string", True),
    "author_avatar_url": ("string", False),
    "author_profile_link": ("string", False),
    "relevance_score": ("string", True),
    "relevance_comment": ("string", True),
    "language": ("string", True),
    "keyword": ("string", True),
    "bookmarked": ("boolean", False),
}
CALL_TABLE = {
    "fathom_user_email": ("string", False),
    "fathom_user_name": ("string", False),
    "fathom_user_team": ("string", False),
    "id": ("string", True),
    "recording_id": ("string", True),
    "meeting_external_domains": ("string", False),
    "meeting_external_domains_domain_name": ("string", False),
    "meeting_has_external_invitees": ("boolean", False),
    "meeting_invitees": ("string", False),
    "meeting_invitees_email": ("string", False),
    "meeting_invitees_is_external": ("boolean", False),
    "meeting_invitees_name": ("string", False),
    "meeting_join_url": ("string", False),
    "meeting_scheduled_duration_in_minutes": ("bigint", False),
    "meeting_scheduled_end_time": ("timestamp", False),
    "meeting_scheduled_start_time": ("timestamp", False),
    "meeting_title": ("string", False),
    "recording_duration_in_minutes": ("double", False),
    "recording_url": ("string", False),
    "transcript_plaintext": ("string", False),
}
MESSAGE_TABLE = {
    "id": ("string", True),
    "recording_id": ("string", True),
    "message_id": ("bigint", True),
    "url": ("string", True),
    "title": ("string", True),
    "date": ("timestamp", True),
    "timestamp": ("bigint", True),
    "speaker": ("string", True),
    "organization": ("string", False),
    "message": ("string", True),
    "action_item": ("string", False),
    "watch_link": ("string", False),
}

# Accepted spellings of a mention's fields, the preferred one first.
MENTION_SPELLINGS = {
    "url": ("url", "URL"),
    "title": ("title", "Title"),
    "body": ("body", "Body"),
    "timestamp": ("timestamp", "Timestamp"),
    "image_url": ("image_url", "Image URL", "imageUrl"),
    "source": ("source", "Source"),
    "source_id": ("source_id", "Source ID", "sourceId"),
    "author": ("author", "Author"),
    "author_avatar_url": ("author_avatar_url", "Author Avatar URL", "authorAvatarUrl"),
    "author_profile_link": ("author_profile_link", "Author Profile Link", "authorProfileLink"),
    "relevance_score": ("relevance_score", "Relevance Score", "relevanceScore"),
    "relevance_comment": ("relevance_comment", "Relevance Comment", "relevanceComment"),
    "language": ("language", "Language"),
    "keyword": ("keyword", "Keyword"),
    "bookmarked": ("bookmarked",),
}

EMBEDDING_DIM = 768


def struct_type(ddl: str) -> StructType:
    """The schema of a DDL string."""
    return StructType.fromDDL(ddl)


def with_embedding(ddl: str) -> StructType:
    """A record schema with its vector column."""
    return StructType(struct_type(ddl).fields + [StructField("embedding", ArrayType(FloatType()), True)])


def has_dimension(vector: Column, dim: int) -> Column:
    """Spark has no fixed-size list, so the length of a vector is checked; null passes."""
    return F.coalesce(F.size(vector) == dim, F.lit(True)) | vector.isNull()


def column_names(ddl: str) -> list[str]:
    return struct_type(ddl).fieldNames()


def table_columns(df: DataFrame, table: dict[str, tuple[str, bool]]) -> list[str]:
    """The warehouse columns in order, cast, as SQL; a column the frame lacks is null."""
    present = set(df.columns)
    return [
        f"{f'try_cast(`{name}` AS {kind})' if name in present else f'CAST(NULL AS {kind})'} AS `{name}`"
        for name, (kind, _) in table.items()
    ]
