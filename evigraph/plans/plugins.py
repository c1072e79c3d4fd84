"""Extension points: layers that add rows, loaded by name, each checked before it is written."""

from __future__ import annotations

import importlib
import logging
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


class Layer(Protocol):
    """Adds rows (kind, data, seq) to a graph from its tables."""

    name: str

    def enabled(self, settings: dict) -> bool: ...

    def rows(self, spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame: ...


REGISTRY: dict[str, Callable[[], Layer]] = {}


def register(name: str):
    """Register a layer under a short name."""

    def put(make):
        REGISTRY[name] = make
        return make

    return put


def load(names: Iterable[str]) -> list[Layer]:
    """Layers by registered name or ``module:callable``; a name given twice is loaded once."""
    found = []
    for name in dict.fromkeys(n.strip() for n in names if n.strip()):
        if name in REGISTRY:
            found.append(REGISTRY[name]())
            continue
        module, _, attribute = name.partition(":")
        if not attribute:
            raise ValueError(f"{name!r} is neither registered nor module:callable")
        found.append(getattr(importlib.import_module(module), attribute)())
    return found


def apply(layers: list[Layer], spark: SparkSession, tables: dict[str, DataFrame], settings: dict, write: Callable[[str, DataFrame], None]) -> dict[str, str]:
    """Write each enabled layer's rows; a layer that fails is skipped with a warning. Returns each layer's status."""
    status = {}
    for layer in layers:
        if not layer.enabled(settings):
            status[layer.name] = "disabled"
            continue
        try:
            write(layer.name, layer.rows(spark, tables))
            status[layer.name] = "written"
        except Exception as error:  # one layer must not stop the others
            log.warning("layer %s skipped: %s", layer.name, error)
            status[layer.name] = "failed"
    return status
