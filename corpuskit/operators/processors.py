"""Processors of conversations by name: what is done to messages before cleaning."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame

from . import messages

Processor = Callable[[DataFrame, dict], DataFrame]
PROCESSORS: dict[str, Processor] = {}


def register(name: str, processor: Processor) -> None:
    """Add a processor, or replace one: (conversations, data_processing section) -> conversations."""
    PROCESSORS[name] = processor


def default(df: DataFrame, conf: dict) -> DataFrame:
    """Listed words and empty messages go, then roles are turned over."""
    roles = conf.get("role_transfer") or {}
    out = df.transform(messages.drop_blocked, conf.get("filter_words"))
    return out.transform(messages.transfer_roles, roles.get("assistant_to_user"), roles.get("user_to_assistant"), conf.get("compat") or "intended")


register("default", default)


def processor_of(conf: dict) -> Processor:
    """The processor that a data_processing section names; an unknown name is the default one."""
    name = conf.get("type") or "default"
    if name not in PROCESSORS:
        logging.getLogger(__name__).warning("no processor %s; taking the default one", name)
        name = "default"
    return PROCESSORS[name]
