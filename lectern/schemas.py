"""Schemas of the exchanged tables. Readers never infer."""

TOPICS = (
    "topic_id string, stream string, subject string, chapter string, topic string, "
    "status string, video_url string, created_time timestamp, completed_at timestamp"
)
TOPICS_WIRE = (
    "id string, created_time timestamp, properties struct<"
    "Topic: struct<title: array<struct<plain_text: string>>>, "
    "Subject: struct<select: struct<name: string>>, "
    "Chapter: struct<select: struct<name: string>>, "
    "Status: struct<select: struct<name: string>>>"
)
# chapter entries may be objects or bare strings; both arrive as text
SYLLABUS_WIRE = "map<string, map<string, array<string>>>"
CHAPTER = "chapter string, topics array<string>"
SEARCH_ITEMS = (
    "array<struct<id: struct<kind: string, videoId: string, playlistId: string>, "
    "snippet: struct<title: string, description: string, channelTitle: string>>>"
)
WORD = "struct<word: string, start: double, end: double>"
TRANSCRIPT = (
    "video_id string, duration double, full_text string, "
    f"segments array<struct<id: int, start: double, end: double, text: string, words: array<{WORD}>>>, "
    f"words array<{WORD}>"
)
THUMBNAIL = "struct<url: string, width: int, height: int>"
FILES = "path string, modificationTime timestamp, length bigint"
