"""Tools an agent may call: described by their docstrings, listed as text, and registered as SQL functions.

A docstring is a description, a line ``---`` and one line ``<type> <name>: text`` a parameter.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, MapType, StringType, StructField, StructType

#: Spark types of the type words; other words are text.
TYPES: dict[str, DataType] = {"str": StringType(), "int": LongType(), "float": DoubleType(), "bool": BooleanType(), "list": ArrayType(StringType()), "dict": MapType(StringType(), StringType())}


@dataclass(frozen=True)
class Parameter:
    kind: str
    text: str
    required: bool
    default: object = None


@dataclass(frozen=True)
class Tool:
    name: str
    description: str
    parameters: dict[str, Parameter]
    call: Callable

    def schema(self) -> StructType:
        """Arguments as a row; optional ones may be null."""
        return StructType([StructField(n, TYPES[p.kind], not p.required) for n, p in self.parameters.items()])

    def catalogue(self) -> str:
        need = lambda p: "REQUIRED" if p.required else f"optional (default: {p.default})"
        lines = [f"  - {n} ({p.kind}): {p.text} [{need(p)}]" for n, p in self.parameters.items()]
        return "\n".join([f"Tool: {self.name}", f"Description: {self.description}", "Parameters:", *lines, ""])


def unwrapped(tool: object) -> Callable:
    """The plain function behind ``func``, ``coroutine``, ``_target`` or ``__wrapped__``."""
    for name in ("func", "coroutine", "_target"):
        inner = getattr(tool, name, None)
        if callable(inner):
            return inspect.unwrap(inner)
    return inspect.unwrap(tool)


def described(tool: Callable) -> Tool:
    """A function as a tool; ValueError where docstring and signature disagree."""
    call = unwrapped(tool)
    description, dash, listed = (call.__doc__ or "").partition("---")
    if not dash or not description.strip():
        raise ValueError(f"{call.__name__}: the docstring needs a description and '---'")
    told = {}
    for line in filter(None, map(str.strip, listed.split("\n"))):
        head, colon, text = line.partition(":")
        words = head.split(None, 1)
        if not colon or len(words) != 2:
            raise ValueError(f"{call.__name__}: no parameter line: {line!r}")
        told[words[1].strip()] = (words[0].lower() if words[0].lower() in TYPES else "str", text.strip())
    signature = {n: p for n, p in inspect.signature(call).parameters.items() if n not in ("self", "cls")}
    if odd := sorted(set(told) ^ set(signature)):
        raise ValueError(f"{call.__name__}: only in the docstring or only in the signature: {', '.join(odd)}")
    made = {}
    for n, p in signature.items():
        required = p.default is inspect.Parameter.empty
        made[n] = Parameter(*told[n], required, None if required else p.default)
    return Tool(getattr(tool, "name", call.__name__), description.strip(), made, call)


def catalogue(tools: Iterable[Tool]) -> str:
    made = [t.catalogue() for t in tools]
    return "\n".join(["AVAILABLE TOOLS:\n", *made]) if made else "No tools available."


def register(spark: SparkSession, tool: Tool, returns: DataType | None = None) -> None:
    """Make a tool callable from SQL under its name; text unless ``returns`` says otherwise."""
    spark.udf.register(tool.name, tool.call, returns or StringType())
