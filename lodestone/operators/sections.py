"""Heading stacks: the path of headings above each block of a document, in one pass per document."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed patterns: a numbered heading's depth, roman numerals as first level, letters as second.
NUMBERED, ROMAN, LETTER = re.compile(r"((?:\d+\.)*\d+)\.?\s+\S"), re.compile(r"[IVX]+\.\s+\S"), re.compile(r"[A-H]\.\s+\S")


def printed_level(text: str) -> int | None:
    """Level that the heading itself shows."""
    if m := NUMBERED.match(text):
        return len(m[1].split("."))
    return 1 if ROMAN.match(text) else 2 if LETTER.match(text) else None


def paths(blocks) -> list[list[str]]:
    """Heading path of each (is_heading, level, text); a heading's path ends with itself. Headings without number or level go below the deepest open numbered one."""
    open_: dict[int, tuple[str, bool]] = {}
    out = []
    for heading, level, text in blocks:
        if heading:
            text = " ".join((text or "").split())
            shown = printed_level(text)
            level = level or shown or 1 + max((n for n, (_, numbered) in open_.items() if numbered), default=0)
            open_ = {n: x for n, x in open_.items() if n < level} | {level: (text, shown is not None)}
        out.append([open_[n][0] for n in sorted(open_)])
    return out


def section_paths(blocks: Column) -> Column:
    """Column form: array of structs (heading boolean, level int, text) in reading order to an array of paths. Null gives null."""

    @F.pandas_udf("array<array<string>>")
    def run(docs: pd.Series) -> pd.Series:
        return docs.map(lambda d: None if d is None else paths((b["heading"], b["level"], b["text"]) for b in d))

    return run(blocks)
