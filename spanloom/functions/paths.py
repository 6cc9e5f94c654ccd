"""Paths into objects and arrays: ``["key"]`` and ``[0]`` steps after a selector's name."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import member, present

STEP = re.compile(r'\[(?:(?P<key>"(?:[^"\\]|\\.)*")|(?P<index>[0-9]+))\]')


def parse(selector: str) -> tuple[str, list[str | int]]:
    """A selector's name and the steps of its path; ValueError for anything else."""
    name = re.match(r"[a-z_.]+", selector)
    at, steps = (name.end() if name else 0), []
    while at < len(selector):
        step = STEP.match(selector, at)
        if not step:
            raise ValueError(f"selector {selector!r} can't be read at {at}")
        steps.append(json.loads(step["key"]) if step["key"] else int(step["index"]))
        at = step.end()
    if not name:
        raise ValueError(f"selector {selector!r} has no name")
    return name[0], steps


def follow(v: Column, steps: list[str | int]) -> Column:
    """The value at a path of a variant; null where a step has no such key, index or kind of value."""
    for step in steps:
        if isinstance(step, str) and "'" in step and '"' in step:
            raise ValueError(f"a key with both kinds of quotes can't be read: {step!r}")
        v = F.try_variant_get(v, f"$[{step}]", "variant") if isinstance(step, int) else member(v, step)
    return present(v)
