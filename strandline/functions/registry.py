"""User-defined measurement functions by name: stateless ones are column functions, stateful ones fold a series."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from strandline.operators import sequence
from strandline.streaming import stateful


@dataclass(frozen=True)
class Measure:
    """A named function of (df, series, seq, value) that adds `accepted`; failures are rows, not exceptions."""

    name: str
    version: str
    stateful: bool
    apply: Callable[[DataFrame, str, str, str], DataFrame]
    configuration: dict = field(default_factory=dict)


_FACTORIES: dict[str, Callable[[], Measure]] = {}
_OWN: set[str] = set()


def register(name: str, factory: Callable[[], Measure]) -> None:
    if name in _FACTORIES:
        raise ValueError(f"{name} is registered already")
    _FACTORIES[name] = factory


def unregister(name: str) -> None:
    if name in _OWN:
        raise ValueError(f"{name} is built in")
    if _FACTORIES.pop(name, None) is None:
        raise KeyError(name)


def names() -> list[str]:
    return sorted(_FACTORIES)


def create(name: str) -> Measure:
    if name not in _FACTORIES:
        raise KeyError(f"{name} is not one of {', '.join(names())}")
    made = _FACTORIES[name]()
    if made.name != name:
        raise ValueError(f"the factory of {name} made {made.name}")
    return made


register("local-median", lambda: Measure("local-median", "1", False, lambda df, a, b, v: sequence.local_median_gate(df, a, b, v, 45.0), {"limit": 45.0}))
register("rolling-model", lambda: Measure("rolling-model", "1", True, stateful.rolling_model, {"seed": stateful.SEED, "window": stateful.WINDOW, "tolerance": stateful.TOLERANCE}))
_OWN.update(_FACTORIES)
