"""Sources by platform name; an unknown name is the generic one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import files, shapes, social

Source = Callable[[SparkSession, dict], DataFrame]
SOURCES: dict[str, Source] = {}


def register(name: str, source: Source) -> None:
    """Add a source, or replace one: (spark, platform section of the configuration) -> conversations."""
    SOURCES[name] = source


register("generic", lambda spark, conf: shapes.standardise(files.read_generic(spark, conf["input_path"])))
register("facebook", lambda spark, conf: social.transform_threads(social.read_threads(spark, conf["platform_data_path"]), conf.get("user_name"), conf.get("platform") or "facebook", bool(conf.get("owner_by_frequency"))))


def source_of(conf: dict) -> Source:
    return SOURCES.get(conf.get("type") or conf.get("platform") or "generic", SOURCES["generic"])
