"""Literal relations and records turned into tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The base topics from which collection starts.
BASE_TOPICS = (
    "生活方式",
    "经济学",
    "运动",
    "互联网",
    "艺术",
    "阅读",
    "美食",
    "动漫",
    "汽车",
    "教育",
    "摄影",
    "历史",
    "文化",
    "旅行",
    "职业发展",
    "金融",
    "游戏",
    "篮球",
    "生物学",
    "物理学",
    "化学",
    "科技",
    "体育",
    "商业",
    "健康",
    "创业",
    "设计",
    "自然科学",
    "法律",
    "电影",
    "音乐",
    "投资",
)


def base_topics(spark: SparkSession) -> DataFrame:
    """The base topics with their position in the list."""
    return spark.createDataFrame(
        list(enumerate(BASE_TOPICS)), "position long, topic string"
    )


def rows_to_frame(spark: SparkSession, rows: Iterable, schema: StructType) -> DataFrame:
    """Records (dicts, tuples or rows) as a table under a stated schema."""
    return spark.createDataFrame(list(rows), schema)


def flatten_structs(frame: DataFrame) -> DataFrame:
    """Replace each struct column by its fields, named ``parent.child`` at every depth."""

    def leaves(schema: StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    picked = []
    for path in leaves(frame.schema, ()):
        quoted = ".".join(f"`{part}`" for part in path)
        picked.append(F.col(quoted).alias(".".join(path)))
    return frame.select(*picked)
