"""What several operators of this folder share."""

from __future__ import annotations

import math
from itertools import count, islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 5


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, number: int) -> list[str]:
    """So many column names that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    return list(islice((n for k in count() if (n := f"__{k}") not in taken), number))


def uniform(*keys: Column) -> Column:
    """A number in (0, 1) that depends on the keys alone."""
    return (F.shiftrightunsigned(F.xxhash64(*keys), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept away from every fit. A null id is not held out, and never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, max_rows: int, inner_folds: int) -> DataFrame:
    """(text, label, fold) of about `max_rows` labelled documents at most (a tenth more by chance), none of them held out.

    The rows are chosen by a hash of their id, so a rerun takes the same. Labels other than 0 and 1 are ignored; of
    several labels of a document the largest counts. The chosen labels are a bounded set, so they are broadcast and the
    texts are not shuffled. Where ids repeat and the chosen ids have more rows than that, rows are chosen once more, by a hash of id
    and text, and equal rows enter once.
    """
    usable = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    share = max_rows / max(1, usable.count())
    chosen = usable.where(uniform(F.col("doc_id"), F.lit("sample")) < share)
    chosen = chosen.groupBy(F.col("doc_id").alias("__id")).agg(F.max(column).cast("int").alias("label"))
    texts = docs.select(F.col("doc_id").alias("__doc"), F.coalesce("text", F.lit("")).alias("text"))
    fold = F.pmod(F.xxhash64(F.col("__id"), F.lit("fold")), F.lit(inner_folds)).cast("int")
    joined = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
    rows = joined.select("__doc").count()
    if rows > 1.1 * max_rows:
        joined = joined.where(uniform(F.col("__doc"), F.col("text"), F.lit("row")) < max_rows / rows).dropDuplicates(["__doc", "text"])
    return joined.select("text", "label", fold.alias("fold"))


def parts_for(rows: int, per_part: int, most: int = 1 << 16) -> int:
    """So many parts that each holds about `per_part` rows."""
    return max(1, min(most, math.ceil(rows / per_part)))


def with_running(df: DataFrame, amounts: dict[str, Column], group: list[str], part: str, order: list[Column]) -> DataFrame:
    """Exclusive running sums of `amounts` in each group, in the order of (part, *order).

    Each part of a group is summed in a task of its own, and only one row for each part meets in the group: a group with
    a third of all rows is spread over as many tasks as it has parts. Group columns may be null.
    """
    inner = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, part).agg(*(F.sum(c).alias(f"__sum_{n}") for n, c in amounts.items()))
    zero = {n: F.lit(0) for n in amounts}
    bases = totals.select(
        *(F.col(g).alias(f"__g_{g}") for g in [*group, part]),
        *(F.coalesce(F.sum(f"__sum_{n}").over(outer), zero[n]).alias(f"__base_{n}") for n in amounts),
    )
    local = df.withColumns({f"__local_{n}": F.coalesce(F.sum(c).over(inner), zero[n]) for n, c in amounts.items()})
    match = [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in [*group, part]]
    out = local.join(bases, match)
    return out.select(*(quoted(c) for c in df.columns), *((F.col(f"__base_{n}") + F.col(f"__local_{n}")).alias(n) for n in amounts))


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]
