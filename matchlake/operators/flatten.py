"""Nested JSON documents to typed tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from ..functions.columns import from_text

DOC = "doc"


@dataclass(frozen=True)
class Model:
    """How one table is read out of a document.

    ``fields`` and ``parent`` list ``name=path:type`` (``name:type`` when both agree). ``fields`` are read from the
    exploded element, or from the document when nothing is exploded; ``parent`` from the document. A path starting with
    ``@`` names an envelope column. ``explode`` lists the array to unnest at each level; ``middle`` lists fields of the outer
    element when there are two levels.
    """
    doc: str
    key: tuple[str, ...]
    fields: str
    parent: str = ""
    explode: tuple[str, ...] = ()
    required: str = ""
    middle: str = ""

    def columns(self, part: str) -> list[tuple[str, str, str]]:
        out = []
        for item in part.split():
            name, kind = item.rsplit(":", 1)
            name, _, path = name.partition("=")
            out.append((name, path or name, kind))
        return out


def _tree(models: Sequence[Model]) -> dict:
    root: dict = {}

    def put(node: dict, path: str) -> None:
        if path.startswith("@"):
            return
        *parents, leaf = path.split(".")
        for step in parents:
            node = node.setdefault(step, {})
        node.setdefault(leaf, None)

    for model in models:
        for _, path, _ in model.columns(model.parent):
            put(root, path)
        if model.required and not any(p.startswith(model.required) for _, p, _ in model.columns(model.fields)):
            root.setdefault(model.required, None)
        node = root
        for level, step in enumerate(model.explode):
            node = node.setdefault(step, [{}])[0]
            if level == 0:
                for _, path, _ in model.columns(model.middle):
                    put(node, path)
        for _, path, _ in model.columns(model.fields):
            put(node, path)
    return root


def _type(node) -> DataType:
    if node is None:
        return StringType()
    if isinstance(node, list):
        return ArrayType(_type(node[0]))
    return StructType([StructField(name, _type(child)) for name, child in node.items()])


def document_schema(models: Sequence[Model]) -> StructType:
    """The part of a document that the given models read. Leaves stay text, they are cast per column."""
    return _type(_tree(models))


def parse_documents(docs: DataFrame, models: Sequence[Model]) -> DataFrame:
    """Parse ``raw_json`` once for several models; unread parts of the document are skipped by the parser."""
    return docs.withColumn(DOC, F.from_json("raw_json", document_schema(models))).drop("raw_json")


def flatten_parsed(parsed: DataFrame, model: Model) -> DataFrame:
    """One table out of parsed documents. Absent, NULL and empty arrays give no rows."""
    df, at = parsed, DOC
    if model.required:
        df = df.filter(F.col(f"{DOC}.{model.required}").isNotNull())
    for level, array in enumerate(model.explode):
        df = df.withColumn(f"_e{level}", F.explode(f"{at}.{array}"))
        at = f"_e{level}"
    pick = lambda path, base: F.col(path[1:]) if path.startswith("@") else F.col(f"{base}.{path}")
    read = lambda path, kind, base: pick(path, base) if path.startswith("@") else from_text(pick(path, base), kind)
    return df.select(*[read(path, kind, DOC).alias(name) for name, path, kind in model.columns(model.parent)],
                     *[read(path, kind, "_e0").alias(name) for name, path, kind in model.columns(model.middle)],
                     *[read(path, kind, at).alias(name) for name, path, kind in model.columns(model.fields)],
                     "_ingested_at")


def wrap_arrays(docs: DataFrame, name: str = "items") -> DataFrame:
    """Documents that are a bare array become objects holding the array under ``name``."""
    return docs.withColumn("raw_json", F.concat(F.lit(f'{{"{name}":'), "raw_json", F.lit("}")))


def flatten(docs: DataFrame, model: Model) -> DataFrame:
    return flatten_parsed(parse_documents(docs, [model]), model)


def explode_path(df: DataFrame, path: Sequence[str], keep: Sequence[str], out: str, position: str | None = None) -> DataFrame:
    """Unnest arrays level by level; ``path`` is relative to the previous element. The last level may carry positions."""
    base = ""
    for level, step in enumerate(path):
        last = level == len(path) - 1
        column = F.col(f"{base}{step}") if step else F.col(base.rstrip("."))
        name = out if last else f"_x{level}"
        carried = [*keep, *[f"_x{i}" for i in range(level)]]
        if last and position:
            df = df.select(*carried, F.posexplode(column).alias(position, name))
        else:
            df = df.select(*carried, F.explode(column).alias(name))
        base = f"{name}."
    return df
