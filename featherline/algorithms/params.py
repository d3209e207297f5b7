"""Hyperparameters: declared as ML params whose converters check the accepted range."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any, ClassVar

from pyspark.ml.param import Param, Params


def declare(name: str, doc: str, convert: Callable[[Any], Any]) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)


def _reject(value: Any, accepted: str) -> ValueError:
    return ValueError(f"{value!r} is not accepted; {accepted} expected")


def whole(low: int | None = None, high: int | None = None) -> Callable[[Any], int]:
    """Whole numbers between two bounds, both included."""

    def convert(value: Any) -> int:
        fine = not isinstance(value, bool) and isinstance(value, (int, float)) and int(value) == value
        if not fine or (low is not None and value < low) or (high is not None and value > high):
            raise _reject(value, f"a whole number in [{low}, {high}]")
        return int(value)

    return convert


def real(low: float = float("-inf"), high: float = float("inf"), above: bool = False, below: bool = False):
    """Numbers between two bounds; ``above`` and ``below`` leave the bounds themselves out."""

    def convert(value: Any) -> float:
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise _reject(value, "a number")
        if value < low or value > high or (above and value == low) or (below and value == high):
            raise _reject(value, f"a number in {'(' if above else '['}{low}, {high}{')' if below else ']'}")
        return float(value)

    return convert


def choice(*options: str, either: dict[str, str] | None = None) -> Callable[[Any], str]:
    """One of some words; ``either`` maps further spellings to them."""

    def convert(value: Any) -> str:
        word = (either or {}).get(value, value)
        if word not in options:
            raise _reject(value, f"one of {', '.join(options)}")
        return word

    return convert


def words_or(number: Callable[[Any], Any], *words: str) -> Callable[[Any], str]:
    """One of some words, or a number (also as text), kept as text."""

    def convert(value: Any) -> str:
        if value in words:
            return value
        if isinstance(value, str):
            try:
                value = float(value)
            except ValueError:
                raise _reject(value, f"a number or one of {', '.join(words)}") from None
        return str(number(value))

    return convert


def flag(value: Any) -> str:
    """True or False, kept as the words."""
    if str(value) not in ("True", "False"):
        raise _reject(value, "True or False")
    return str(value)


def flag_or_auto(value: Any) -> str:
    return value if value == "auto" else flag(value)


def listed(*options: str) -> Callable[[Any], list[str]]:
    """A list, or comma-separated text, of some words."""

    def convert(value: Any) -> list[str]:
        items = [v.strip() for v in value.strip("[]").split(",")] if isinstance(value, str) else list(value)
        for item in items:
            if item not in options:
                raise _reject(item, f"any of {', '.join(options)}")
        return items

    return convert


def matching(pattern: str) -> Callable[[Any], list[str]]:
    """A list, or comma-separated text, of words of a pattern."""

    def convert(value: Any) -> list[str]:
        items = [v.strip() for v in value.strip("[]").split(",")] if isinstance(value, str) else list(value)
        for item in items:
            if not re.fullmatch(pattern, item):
                raise _reject(item, f"words like {pattern}")
        return items

    return convert


def text(value: Any) -> str:
    if not isinstance(value, str):
        raise _reject(value, "text")
    return value


class HyperParams(Params):
    """Params with generated getters and setters, and defaults a trainer assumes without stating them."""

    # Values used when a param is neither set nor has a default; not part of the string map.
    assumed: ClassVar[dict[str, Any]] = {}
    required: ClassVar[tuple[str, ...]] = ()
    # Params that say where columns and files are, not how to train.
    wiring: ClassVar[tuple[str, ...]] = ("featuresCol", "labelCol", "keepInput", "trainingColumns", "exportPath",
                                         "exportFormat", "keepExport", "checkRows")

    def __init_subclass__(cls, **kwargs: Any) -> None:
        super().__init_subclass__(**kwargs)
        for name in dir(cls):
            if not isinstance(cls.__dict__.get(name), Param):
                continue
            camel = "".join(part[:1].upper() + part[1:] for part in name.split("_"))
            if not hasattr(cls, f"set{camel}"):
                setattr(cls, f"set{camel}", lambda self, value, _name=name: self._set(**{_name: value}))
                setattr(cls, f"get{camel}", lambda self, _name=name: self.getOrDefault(_name))

    def setting(self, name: str) -> Any:
        """The value set, the default, or what is assumed without one."""
        param = self.getParam(name)
        return self.getOrDefault(param) if self.isDefined(param) else self.assumed.get(name)

    def require_params(self) -> None:
        missing = [name for name in self.required if not self.isDefined(self.getParam(name))]
        if missing:
            raise ValueError(f"{type(self).__name__} needs {', '.join(missing)}")

    def hyperparameters(self, base: dict[str, str] | None = None) -> dict[str, str]:
        """A map of strings: ``base``, overlaid by every param that is set or has a default."""
        values = dict(base or {})
        for param in self.params:
            if param.name not in self.wiring and self.isDefined(param):
                value = self.getOrDefault(param)
                values[param.name] = f"[{','.join(value)}]" if isinstance(value, list) else str(value)
        return values
