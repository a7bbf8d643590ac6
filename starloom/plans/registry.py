"""Operator registry: name -> (callable, tags, documentation)."""

from __future__ import annotations

import importlib.util
import inspect
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Tool:
    name: str
    target: Callable
    tags: frozenset[str] = field(default_factory=frozenset)

    @property
    def doc(self) -> str:
        return inspect.getdoc(self.target) or ""

    @property
    def signature(self) -> str:
        return f"{self.name}{inspect.signature(self.target)}"


_TOOLS: dict[str, Tool] = {}


def tool(*tags: str):
    """Register a function or class under its own name."""

    def register(target):
        _TOOLS[target.__name__] = Tool(target.__name__, target, frozenset(tags))
        return target

    return register


def get_tool(name: str) -> Tool:
    return _TOOLS[name]


def tools_with_tag(tag: str) -> dict[str, Tool]:
    return {n: t for n, t in _TOOLS.items() if tag in t.tags}


def tools_matching(tags: set[str]) -> list[Tool]:
    """Tools sharing a tag with the request, most shared tags first."""
    hits = [(len(t.tags & tags), t) for t in _TOOLS.values() if t.tags & tags]
    return [t for _, t in sorted(hits, key=lambda h: (-h[0], h[1].name))]


def load_tools(path: str) -> list[str]:
    """Import a Python file so that its decorated tools register; return the new names."""
    known = set(_TOOLS)
    spec = importlib.util.spec_from_file_location("starloom_user_tools", path)
    spec.loader.exec_module(importlib.util.module_from_spec(spec))
    return sorted(set(_TOOLS) - known)
