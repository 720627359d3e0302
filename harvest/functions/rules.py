"""Validity rules as one reason column: NULL for a good row, else the first rule it breaks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from harvest.functions.timestamps import bad_ts
from harvest.schemas import INT_MAX, PARTITION_WIDTH

Rule = tuple[str, Column]


def first_broken(rules: list[Rule]) -> Column:
    """Name of the first rule whose condition holds; a NULL condition does not hold."""
    chain = F.when(rules[0][1], F.lit(rules[0][0]))
    for name, broken in rules[1:]:
        chain = chain.when(broken, F.lit(name))
    return chain


def _empty(value: Column) -> Column:
    return value.isNull() | (value == "")


def _not_positive(value: Column) -> Column:
    return value.isNull() | (value <= 0)


def _negative(value: Column) -> Column:
    return value.isNull() | (value < 0)


def repo_rules(id: Column, name: Column, owner: Column, stars: Column) -> list[Rule]:
    """Blanks are a valid name; only the empty string is not."""
    return [
        ("id_not_positive", _not_positive(id)),
        ("name_or_owner_empty", _empty(name) | _empty(owner)),
        ("stars_negative", _negative(stars)),
    ]


def stats_rules(repo_id: Column, stars: Column) -> list[Rule]:
    return [("repo_id_not_positive", _not_positive(repo_id)), ("stars_negative", _negative(stars))]


def query_rules(query_string: Column) -> list[Rule]:
    """White space of any kind counts as blank."""
    return [("query_blank", ~F.coalesce(query_string, F.lit("")).rlike(r"\S"))]


def node_rules(raw: Column, node: Column, created_at: Column) -> list[Rule]:
    """Structure of one search node: `raw` is its JSON text, `node` the parsed struct, `created_at` its parsed time.

    The keys of the text are looked at only where a parsed value is NULL, so good nodes are parsed once.
    """
    keys = F.json_object_keys(raw)

    def missing(value: Column, key: str) -> Column:
        return F.when(value.isNull(), ~F.array_contains(keys, key))

    owner = node["owner"]["login"]
    id_rule, name_rule, stars_rule = repo_rules(node["databaseId"], node["name"], owner, node["stargazerCount"])
    return [
        ("not_an_object", F.when(node["databaseId"].isNull(), keys.isNull())),
        ("created_at_invalid", bad_ts(node["createdAt"], created_at)),
        ("id_missing", missing(node["databaseId"], "databaseId")),
        ("name_missing", missing(node["name"], "name")),
        ("owner_missing", owner.isNull()),
        ("url_missing", missing(node["url"], "url")),
        ("stars_missing", missing(node["stargazerCount"], "stargazerCount")),
        ("id_wrong_type", node["databaseId"].isNull()),
        id_rule,
        name_rule,
        ("stars_wrong_type", node["stargazerCount"].isNull()),
        stars_rule,
    ]


def sound_node(node: Column, created_at: Column) -> Column:
    """True only where no rule of `node_rules` is broken: a short way past all of them for the many good nodes."""
    time_fine = created_at.isNotNull() | node["createdAt"].isNull() | (node["createdAt"] == "")
    named = (node["name"] != "") & (node["owner"]["login"] != "") & node["url"].isNotNull()
    return (node["databaseId"] > 0) & (node["stargazerCount"] >= 0) & named & time_fine


def repo_table_rules(
    id: Column, name: Column, owner: Column, url: Column, partition: Column | None = None, width: int = PARTITION_WIDTH
) -> list[Rule]:
    """NOT NULL columns and the width of the partition label, counted in characters."""
    rules = [(f"{label}_null", value.isNull()) for label, value in (("id", id), ("name", name), ("owner", owner), ("url", url))]
    if partition is not None:
        rules.append(("partition_too_long", F.length(partition) > width))
    return rules


def stats_table_rules(repo_id: Column, fetched_date: Column, stars: Column) -> list[Rule]:
    return [
        ("repo_id_null", repo_id.isNull()),
        ("fetched_date_null", fetched_date.isNull()),
        ("stars_null", stars.isNull()),
        ("stars_out_of_range", ~stars.between(-INT_MAX - 1, INT_MAX)),
    ]
