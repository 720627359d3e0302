"""Landed search pages: one response per JSON line."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from harvest.schemas import LANDED, MALFORMED, NODE, PAGE_BODY

#: Begins the keys that number the nodes of a page.
_MARK = "harvest#node#"
_PAGE_NODES = T.MapType(T.StringType(), NODE)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Scan landed pages. A malformed line becomes a row of NULLs that keeps its text in `malformed`."""
    return spark.read.schema(LANDED).option("columnNameOfCorruptRecord", MALFORMED).json(path)


def parse_pages(df: DataFrame, body_col: str) -> DataFrame:
    """Parse response text held in a column; `text` keeps the raw response for the status rules.

    The struct is unpacked from an array of one. Filters on it then stay above the parsing, where Spark would otherwise
    copy the parser into every term of a pushed-down condition and parse each page many times.
    """
    keep = [c for c in df.columns if c not in (body_col, "text", "body")]
    body = F.explode(F.array(F.from_json(body_col, PAGE_BODY)))
    return df.select(*keep, F.col(body_col).alias("text"), body.alias("body"))


def nodes_of(body: Column | str = "body") -> Column:
    body = F.col(body) if isinstance(body, str) else body
    return body["data"]["search"]["nodes"]


def _pair(raw: Column, node: Column) -> Column:
    return F.struct(raw.alias("raw"), node.alias("node"))


def parsed_nodes(nodes: Column, told: Callable[[Column, Column], Column] = _pair) -> Column:
    """An array of raw nodes as an array of (raw JSON text, parsed node), or of what `told` makes of the two.

    A parser for each node costs more than the node, so the nodes of a page are parsed together, as the values of one JSON object whose
    keys number them. That is taken only if every key is ours, none is missing, no raw text holds the mark of our keys, and no node
    lacks a stored field: then each value is one whole node. The nodes of all other pages are parsed one by one.
    """
    alone = F.transform(F.transform(nodes, lambda raw: _pair(raw, F.from_json(raw, NODE))), lambda n: told(n["raw"], n["node"]))
    entries = F.transform(nodes, lambda raw, i: F.concat(F.lit(f'"{_MARK}'), i.cast("string"), F.lit('":'), raw))
    page = F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))

    def taken(found: Column) -> Column:
        whole = (
            (F.size(found) == F.size(nodes))
            & F.forall(F.map_keys(found), lambda key: key.startswith(_MARK))
            & ~F.exists(nodes, lambda raw: raw.contains(_MARK))
            & F.forall(F.map_values(found), _has_stored_fields)
        )
        return F.when(whole, F.zip_with(nodes, F.map_values(found), told)).otherwise(alone)

    # An array of one keeps the parsed page, which would otherwise be parsed again at every use.
    return F.transform(F.array(F.from_json(page, _PAGE_NODES)), taken)[0]


def _has_stored_fields(node: Column) -> Column:
    stored = (node["databaseId"], node["name"], node["owner"]["login"], node["url"], node["stargazerCount"], node["createdAt"])
    return reduce(and_, (value.isNotNull() for value in stored))


def explode_nodes(pages: DataFrame) -> DataFrame:
    """One row per node with its position in the page: page columns, pos, raw (JSON text), node (parsed).

    Nodes are parsed before they are unpacked, for the reason given in `parse_pages`.
    """
    keep = [c for c in pages.columns if c not in ("body", "text", MALFORMED)]
    rows = pages.select(*keep, F.posexplode(parsed_nodes(nodes_of())).alias("pos", "n"))
    return rows.select(*keep, "pos", "n.raw", "n.node")
