"""Document fingerprints: a Merkle tree over paragraphs and sections. DataFrame functions only.

A paragraph is a line; its leaves are pieces of at most `PIECE` code points. A section is a run of `SECTION` paragraphs. Each
node is the SHA-256 of a mark of its level and of the nodes below it; the root is the fingerprint. Equal roots mean equal texts.
If roots differ, only sections that differ are entered, and only paragraphs that differ in them: these locate the edit. The
likeness of two texts is the share of different pieces of the larger one that both have.

Null texts count as empty; the empty text has one empty paragraph and no pieces, and two empty texts are alike to 1. Repeated
rows follow each other in the order of their texts. An empty table gives an empty table; columns of any other name are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvest.llm.common import let, parts_for

PIECE = 48
SECTION = 8
#: Rows of neighbouring ids that one task holds.
ROWS = 2048


def _hash(mark: str, below: Column) -> Column:
    return F.sha2(F.concat(F.lit(mark), below), 256)


def tree(text: Column) -> Column:
    """Struct of root, sections, paragraphs (hashes in order) and pieces (different leaf hashes)."""

    def of_lines(leaves: Column) -> Column:
        paragraphs = F.transform(leaves, lambda x: _hash("p", F.array_join(x, "")))

        def of_paragraphs(p: Column) -> Column:
            starts = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / SECTION).cast("int"))
            sections = F.transform(starts, lambda i: _hash("s", F.array_join(F.slice(p, i * SECTION + 1, F.lit(SECTION)), "")))
            return let(
                sections,
                lambda s: F.struct(
                    _hash("r", F.array_join(s, "")).alias("root"), s.alias("sections"), p.alias("paragraphs"), F.array_distinct(F.flatten(leaves)).alias("pieces")
                ),
            )

        return let(paragraphs, of_paragraphs)

    pieces = lambda line: F.regexp_extract_all(line, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return let(F.transform(F.split(text, "\n"), lambda line: F.transform(pieces(line), lambda x: _hash("l", x))), of_lines)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 for two trees."""
    larger = F.greatest(F.size(a["pieces"]), F.size(b["pieces"]))
    common = F.size(F.array_intersect(a["pieces"], b["pieces"]))
    return F.when(a["root"] == b["root"], F.lit(1.0)).when(larger == 0, F.lit(1.0)).otherwise(common / larger)


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Numbers of the paragraphs that differ, from 0; sections with equal hashes are not entered."""
    count = F.greatest(F.size(a["sections"]), F.size(b["sections"]))
    entered = F.filter(F.sequence(F.lit(0), count - 1), lambda s: ~F.get(a["sections"], s).eqNullSafe(F.get(b["sections"], s)))
    inside = F.flatten(F.transform(entered, lambda s: F.transform(F.sequence(F.lit(0), F.lit(SECTION - 1)), lambda k: s * SECTION + k)))
    return F.filter(inside, lambda p: ~F.get(a["paragraphs"], p).eqNullSafe(F.get(b["paragraphs"], p)))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text (of the next document in descending doc_id; the first again after the last).

    Ids are dealt into ranges of about `ROWS` rows, and the largest id of a range is also put behind the range above it, so
    each range finds its successors alone and texts move once. At most 65,536 range ends reach the driver.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("doc_id").where(F.col("doc_id").isNotNull())
    parts = parts_for(ids.count(), ROWS)
    ends: list[int] = []
    if parts > 1:
        cuts = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], max(10_000, 50 * parts))).first()[0]
        tops = ids.groupBy(_range(F.col("doc_id"), sorted(set(cuts))).alias("part")).agg(F.max("doc_id").alias("top")).collect()
        ends = sorted(r["top"] for r in tops)[:-1]
    top = ids.agg(F.max("doc_id")).first()[0]
    part = F.coalesce(_range(F.col("doc_id"), ends), F.lit(0))
    ghost = F.when(F.col("doc_id") == F.lit(top), F.lit(0)).when(_range(F.col("doc_id") + 1, ends) > part, part + 1)
    if top is None:
        ghost = F.lit(0)  # no row has an id: all lie in one range, and the first follows the last
    places = F.array(F.struct(F.lit(False).alias("ghost"), part.alias("part")), F.struct(F.lit(True).alias("ghost"), ghost.cast("int").alias("part")))
    dealt = rows.select("doc_id", "text", F.explode(F.filter(places, lambda p: p["part"].isNotNull())).alias("p")).select("doc_id", "text", "p.*")
    order = Window.partitionBy("part").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.withColumn("next_text", F.lead("text").over(order)).where("not ghost").select("doc_id", "text", "next_text")


def _range(value: Column, ends: list[int]) -> Column:
    """How many of the sorted `ends` are below the value; two steps, so that a row compares few of many."""
    if not ends:
        return F.lit(0)
    step = max(1, int(len(ends) ** 0.5))
    numbers = F.array(*(F.lit(e).cast("long") for e in ends)) if len(ends) <= 256 else F.from_json(F.lit(str(ends)), "array<long>")
    coarse_ends = ends[step - 1 :: step]
    coarse = F.array(*(F.lit(e).cast("long") for e in coarse_ends))
    below = F.size(F.filter(coarse, lambda e: e < value))
    near = lambda c: c * step + F.size(F.filter(F.slice(numbers, c * step + 1, F.lit(step)), lambda e: e < value))
    return F.when(value.isNotNull(), let(below, near)).cast("int")


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, text, edited, and the trees of the text, of the edited text and of the next document.

    Edited: the last third of the code points is replaced by the first as many of the next document.
    """
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 3) as int))"), F.substring(F.col("next_text"), F.lit(1), third))
    rows = with_next(docs).withColumn("edited", edited)
    trees = F.struct(tree(F.col("text")).alias("own"), tree(F.col("edited")).alias("edited"), tree(F.col("next_text")).alias("next"))
    # The generator keeps Spark from building the trees again for each column that is taken out of them.
    return rows.select("doc_id", "text", F.col("edited").alias("edited_text"), F.explode(F.array(trees)).alias("tree"))


def _sql_tree(text: str) -> str:
    leaves = f"list_transform(string_split({text}, chr(10)), lambda l: list_transform(regexp_extract_all(l, '(?s).{{1,{PIECE}}}'), lambda x: sha256('l' || x)))"
    return leaves


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
x AS (SELECT *, coalesce(lead(t) OVER o, first_value(t) OVER o) AS nx FROM d WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, t)),
e AS (SELECT *, left(t, length(t) - length(t) // 3) || left(nx, length(t) // 3) AS ed FROM x),
l AS (SELECT *, {_sql_tree("t")} AS lt, {_sql_tree("ed")} AS le, {_sql_tree("nx")} AS ln FROM e),
p AS (SELECT *, list_transform(lt, lambda x: sha256('p' || array_to_string(x, ''))) AS pt, list_transform(le, lambda x: sha256('p' || array_to_string(x, ''))) AS pe,
      list_transform(ln, lambda x: sha256('p' || array_to_string(x, ''))) AS pn,
      list_distinct(flatten(lt)) AS st, list_distinct(flatten(le)) AS se, list_distinct(flatten(ln)) AS sn FROM l),
r AS (SELECT *, {", ".join(f"sha256('r' || array_to_string(list_transform(range(0, (len({p}) - 1) // {SECTION} + 1), lambda i: sha256('s' || array_to_string({p}[i * {SECTION} + 1 : i * {SECTION} + {SECTION}], ''))), '')) AS {n}" for p, n in (("pt", "rt"), ("pe", "re"), ("pn", "rn")))} FROM p)
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(ed) AS edited_sha256, rt AS fingerprint, re AS edited_fingerprint,
       CASE WHEN rt = re OR greatest(len(st), len(se)) = 0 THEN 1.0 ELSE len(list_intersect(st, se)) / greatest(len(st), len(se)) END::DOUBLE AS near_edited,
       CASE WHEN rt = rn OR greatest(len(st), len(sn)) = 0 THEN 1.0 ELSE len(list_intersect(st, sn)) / greatest(len(st), len(sn)) END::DOUBLE AS near_next,
       len(list_filter(range(0, greatest(len(pt), len(pe))), lambda i: pt[i + 1] IS DISTINCT FROM pe[i + 1]))::INTEGER AS n_differing
FROM r
"""
