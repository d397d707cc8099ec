"""Row types of the engine's tables, as DDL, and a function that gives a table such a type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANNEL = "name string, url string, group_name string, logo string, tvg_id string, source string, source_line int, group_raw string, source_section string, protocol string, channel_key string, quality string, lines array<string>"
SOURCE = "source string, source_line int, effective_url string, kind string, status string, http_status int, content_type string, bytes bigint, detail string, sites array<string>, lives array<string>, python_files map<string,binary>"
FETCH = "source string, source_line int, effective_url string, http_status int, content_type string, data binary, error string, via_relay boolean, redirects array<string>, attempts int"
ITEM = (
    "kind string, name string, url string, status string, http_status int, detail string, checked_at timestamp, source string, source_line int, channel_key string, category string, url_hash string, final_url string, "
    "content_type string, failure_class string, evidence string, attempts int, host string, redirect_count int"
)
ATTEMPT = "url string, status int, detail string, final_url string, content_type string, body binary, redirects array<string>, user_agent string, attempts int, error string, failure_class string"
LINE = "url string, url_hash string, source string, source_line int, group_raw string, source_section string, protocol string, quality string"
LEDGER = f"channel_key string, name string, category string, quality string, line_count bigint, sources array<string>, source_lines array<int>, groups_raw array<string>, source_sections array<string>, protocols array<string>, lines array<struct<{LINE.replace(' string', ':string').replace(' int', ':int')}>>"
HEALTH = (
    "url_hash string, url string, name string, channel_key string, category string, source string, source_line int, status string, http_status int, final_url string, content_type string, failure_class string, evidence string, "
    "attempts int, host string, redirect_count int, detail string, checked_at timestamp, decisive_failures int, soft_failure boolean, internal boolean, verdict string"
)
STREAK = "url string, name string, source string, count int, history array<struct<checked_at:timestamp,status:string,detail:string,failure_class:string,http_status:int,host:string>>, removable boolean, whitelisted boolean, failure_class string, host string"
URL_STATE = "url_hash string, url string, name string, kind string, host string, status string, failure_class string, http_status int, content_type string, attempts int, last_checked timestamp, last_success timestamp, last_evidence string"
REMOVED = "url string, name string, category string, host string, source string, source_line int, failure_class string, http_status int, evidence string, decisive_failures int, removed_at timestamp, last_checked timestamp"
VOD = "vod_id string, vod_name string, vod_pic string, vod_remarks string, vod_content string, vod_year string, vod_area string, vod_actor string, type_name string, vod_play_from string, vod_play_url string"


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a row type, in its order: cast where a column is there, null where it is not or where a value does not fit; all other columns are left out."""
    fields = T.StructType.fromDDL(ddl).fields
    have = {f.name: f.dataType for f in df.schema.fields}
    simple = (T.StringType, T.NumericType, T.BooleanType, T.TimestampType, T.TimestampNTZType, T.DateType)

    def column(f: T.StructField):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f"`{f.name}`")
        return (c.try_cast(f.dataType) if isinstance(have[f.name], simple) and isinstance(f.dataType, simple) else c.cast(f.dataType)).alias(f.name)

    return df.select(*map(column, fields))
