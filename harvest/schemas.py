"""Fixed schemas of the landed pages and of the tables built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_LONG, _INT, _TEXT, _BOOL, _TIME = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Key names of a search response and of the tables built from it.
NODE = _struct(
    databaseId=_LONG,
    name=_TEXT,
    url=_TEXT,
    createdAt=_TEXT,
    stargazerCount=_LONG,
    forkCount=_LONG,
    primaryLanguage=_struct(name=_TEXT),
    owner=_struct(login=_TEXT),
    licenseInfo=_struct(name=_TEXT),
    pushedAt=_TEXT,
    updatedAt=_TEXT,
)
# Nodes stay raw JSON text, so that an absent key and a null value can be told apart. rateLimit is a map for the
# same reason: a page without `remaining` is unusable, a page whose `remaining` is null is usable and ends its chain.
PAGE_BODY = _struct(
    data=_struct(
        search=_struct(
            pageInfo=_struct(endCursor=_TEXT, hasNextPage=_BOOL),
            repositoryCount=_LONG,
            nodes=T.ArrayType(_TEXT),
        ),
        rateLimit=T.MapType(_TEXT, _TEXT),
    ),
    errors=T.ArrayType(_TEXT),
)
# `text` is the raw response of a request that did not answer with the JSON body (an error page). `run` names the run that
# fetched the page and `fetched_date` its UTC day; both are NULL where only one run was landed.
PAGE = _struct(
    run=_TEXT, fetched_date=T.DateType(), http_status=_INT, job=_INT, query_idx=_INT, page_idx=_INT, attempt=_INT, text=_TEXT, body=PAGE_BODY
)
REPO_RECORD = _struct(
    id=_LONG,
    name=_TEXT,
    owner=_TEXT,
    url=_TEXT,
    stars=_LONG,
    created_at=_TIME,
    pushed_at=_TIME,
    updated_at=_TIME,
    primary_language=_TEXT,
    fork_count=_LONG,
    license_name=_TEXT,
)
QUERY = _struct(job=_LONG, query_idx=_INT, query_string=_TEXT, description=_TEXT, expected_results=_INT)
EXPORT_COLUMNS = ["id", "name", "name_with_owner", "url", "created_at", "stars", "crawled_at"]

PAGE_KEY = ["job", "query_idx", "page_idx"]
#: Column of `LANDED` that holds a line which is not JSON.
MALFORMED = "malformed"
LANDED = T.StructType([*PAGE.fields, T.StructField(MALFORMED, _TEXT)])


def run_key(df: DataFrame) -> list[str]:
    """What tells the runs of `df` apart: its `run` column, if it has one."""
    return ["run"] if "run" in df.columns else []


def page_key(df: DataFrame) -> list[str]:
    """What tells pages apart; the attempts of a page share it."""
    return [*run_key(df), *PAGE_KEY]


INT_MAX = 2147483647
PARTITION_WIDTH = 100  # characters; the first table version allowed 10


def _column(name: str, kind: T.DataType, nullable: bool, comment: str) -> T.StructField:
    return T.StructField(name, kind, nullable, {"comment": comment})


REPO = T.StructType(
    [
        _column("id", T.LongType(), False, "primary key, the service's numeric id"),
        _column("name", T.StringType(), False, "short name"),
        _column("owner", T.StringType(), False, "login of the owner"),
        _column("url", T.StringType(), False, "address of the record"),
        _column("created_at", T.TimestampNTZType(), True, "creation time without zone"),
        _column("alphabet_partition", T.StringType(), True, "label of the partition that found the row, such as matrix_0"),
        _column("name_with_owner", T.StringType(), True, "owner/name"),
    ]
)
STATS = T.StructType(
    [
        _column("repo_id", T.LongType(), False, "id of the row in the repo table"),
        _column("fetched_date", T.DateType(), False, "UTC day of the fetch"),
        _column("stars", T.IntegerType(), False, "star count on that day"),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of `schema` in its order, with its types and comments; columns an older table lacks become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )
