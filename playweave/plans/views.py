"""The content methods of a catalogue as SQL table functions: home, category, detail, search and player over one table of items.

Items: vod_id, vod_name, type_id, type_name, vod_pic, vod_remarks, vod_play_from, vod_play_url. After `register(spark, items)` any SQL may say
SELECT * FROM category_content('7', 2); the functions are plain queries, so that filters and pages reach the table's scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PAGE = 30
ITEM = "vod_id STRING, vod_name STRING, vod_pic STRING, vod_remarks STRING"
_SHORT = "CAST(vod_id AS STRING), vod_name, vod_pic, vod_remarks"


def register(spark: SparkSession, items: DataFrame, page: int = PAGE, prefix: str = "") -> None:
    """Make the table functions `home_content`, `category_content`, `detail_content`, `search_content` and `player_content` of a catalogue, and its view `catalogue`."""
    view = f"{prefix}catalogue"
    items.createOrReplaceTempView(view)
    functions = {
        "home_content()": ("type_id STRING, type_name STRING, items BIGINT", f"SELECT CAST(type_id AS STRING), min(type_name), count(*) FROM {view} GROUP BY type_id"),
        "category_content(tid STRING, pg INT)": (f"{ITEM}, page INT, pagecount BIGINT, total BIGINT", f"""SELECT {_SHORT}, pg, CAST(ceil(total / {page}) AS BIGINT), total FROM (SELECT *, row_number() OVER (PARTITION BY type_id ORDER BY vod_name, vod_id) AS rn,
            count(*) OVER (PARTITION BY type_id) AS total FROM {view} WHERE CAST(type_id AS STRING) = tid) WHERE rn > (pg - 1) * {page} AND rn <= pg * {page}"""),
        "detail_content(id STRING)": (f"{ITEM}, type_name STRING, vod_play_from STRING, vod_play_url STRING", f"SELECT {_SHORT}, type_name, vod_play_from, vod_play_url FROM {view} WHERE CAST(vod_id AS STRING) = id"),
        "search_content(key STRING)": (ITEM, f"SELECT {_SHORT} FROM {view} WHERE trim(key) <> '' AND contains(lower(vod_name), lower(trim(key)))"),
        "player_content(id STRING, flag STRING)": ("line STRING, title STRING, url STRING", f"""SELECT line, split_part(e, '$', 1), split_part(e, '$', 2) FROM (SELECT line, explode(split(urls, '#')) AS e FROM (SELECT inline(arrays_zip(split(vod_play_from, '[$][$][$]'), split(vod_play_url, '[$][$][$]')))
            AS (line, urls) FROM {view} WHERE CAST(vod_id AS STRING) = id) WHERE line = flag)"""),
    }
    for head, (columns, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{head} RETURNS TABLE ({columns}) RETURN {body}")
