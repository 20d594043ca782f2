"""Articles as sections: a flat table, or a nested tree as JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from spindrift.functions.text import lines, trim

_SECTION = ArrayType(StructType([*[StructField(n, IntegerType()) for n in ("idx", "parent_idx", "depth")], StructField("section_name", StringType()), StructField("text", StringType())]))
_ARROW = pa.list_(pa.struct([("idx", pa.int32()), ("parent_idx", pa.int32()), ("depth", pa.int32()), ("section_name", pa.string()), ("text", pa.string())]))


def listed(title: str | None, text: str | None, prune: bool = True) -> list[dict]:
    """The sections of an article in their order, the article itself as idx 0 of depth 1; without those that hold no text,
    nor any below them, if prune is set.

    A section belongs to the nearest one before it of less depth: a stack holds those that are open, so a line is looked
    at once, however many sections there are and however deep they lie.
    """
    rows = [{"idx": 0, "parent_idx": None, "depth": 1, "section_name": title, "text": []}]
    open_ = [0]
    for line in filter(None, map(trim, lines(text or ""))):
        if line.startswith("=="):
            depth = len(line) - len(line.lstrip("="))
            while len(open_) > 1 and rows[open_[-1]]["depth"] >= depth:
                open_.pop()
            name = trim(line[depth : len(line) - depth]) if len(line) > 2 * depth else "Unknown"
            rows.append({"idx": len(rows), "parent_idx": open_[-1], "depth": depth, "section_name": name, "text": []})
            open_.append(len(rows) - 1)
        else:
            rows[open_[-1]]["text"].append(line + "\n")
    holds = [bool(r["text"]) for r in rows]
    for r in reversed(rows[1:]):
        if holds[r["idx"]]:
            holds[r["parent_idx"]] = True
    return [r | {"text": "".join(r["text"])} for r in rows if not prune or holds[r["idx"]] or not r["idx"]]


@F.arrow_udf(_SECTION)
def _listed(titles: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for title, text in titles:
        yield pa.array([listed(a, b) for a, b in zip(title.to_pylist(), text.to_pylist(), strict=True)], _ARROW)


@F.arrow_udf(_SECTION)
def _listed_whole(titles: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for title, text in titles:
        yield pa.array([listed(a, b, prune=False) for a, b in zip(title.to_pylist(), text.to_pylist(), strict=True)], _ARROW)


def sections(docs: DataFrame, key: str, title: str, text: str, prune: bool = True) -> DataFrame:
    """(key, title, idx, parent_idx, depth, section_name, text): a row a section, as listed() gives them.

    All of a document is worked on in its own row: no shuffle.
    """
    made = (_listed if prune else _listed_whole)(F.col(title), F.col(text))
    d = docs.select(F.col(key).alias("key"), F.col(title).alias("title"), F.explode(made).alias("s"))
    return d.select(F.col("key").alias(key), "title", "s.idx", "s.parent_idx", "s.depth", "s.section_name", "s.text")


def tree(title: str, text: str) -> dict:
    """The nested sections of one article: section_name, text, children."""
    nodes: dict[int, dict] = {}
    for r in listed(title, text):
        nodes[r["idx"]] = {"section_name": r["section_name"], "text": r["text"], "children": []}
        if r["idx"]:
            nodes[r["parent_idx"]]["children"].append(nodes[r["idx"]])
    return nodes[0]


def tree_json(title: str, text: str) -> str:
    """The tree as JSON, indented by two; written from the flat list, so that nesting may be of any depth. Of a section d
    levels down each line begins with 4 d spaces, which the form asks for."""
    rows = listed(title, text)
    level = {0: 0}
    for r in rows[1:]:
        level[r["idx"]] = level[r["parent_idx"]] + 1
    out, quoted = [], lambda s: json.dumps(s, ensure_ascii=False)
    for i, r in enumerate(rows):
        at = level[r["idx"]]
        pad, after = "  " * (2 * at), level[rows[i + 1]["idx"]] if i + 1 < len(rows) else -1
        out.append(f'{pad}{{\n{pad}  "section_name": {quoted(r["section_name"])},\n{pad}  "text": {quoted(r["text"])},\n{pad}  "children": [')
        if after > at:
            out.append("\n")
            continue
        out.append("]\n" + pad + "}")
        for k in range(at - 1, max(after, 0) - 1, -1):  # those that end with this section
            out.append("\n" + "  " * (2 * k + 1) + "]\n" + "  " * (2 * k) + "}")
        if after > 0:
            out.append(",\n")
    return "".join(out)


@F.pandas_udf(StringType())
def section_tree(title: pd.Series, text: pd.Series) -> pd.Series:
    """The tree as JSON, indented by two."""
    return pd.Series([None if t is None or x is None else tree_json(t, x) for t, x in zip(title, text, strict=True)])


def as_variant(trees: Column) -> Column:
    return F.parse_json(trees)
