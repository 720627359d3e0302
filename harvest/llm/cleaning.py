"""Line-first quality rules. DataFrame functions only.

Each line of a text is judged alone: by its punctuation, as navigation, as boilerplate, by its symbols, capitals and repeated
words. Lines that fail are removed; a text that loses too many of its words is rejected. Base figures of the whole text are
computed beside it, and a text that fails them is rejected whatever its lines.

Null and empty texts have no words: all figures are 0, the base fails, nothing is kept. Lines without words are dropped with the
lines that fail. Repeated rows are judged alike; an empty table gives an empty table; columns of any other name are left alone.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm.common import WORD, let, quoted

LEAST_WORDS = 50
#: Percent of the words that may lie in repeated windows of three.
MOST_REPEATED = 50
#: A text is rejected if it keeps a smaller share of its words.
LEAST_LEFT = 0.5
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]+"
SHORT = 8
ENDS = r"[.!?…:;。！？][\"'”’»)\]]*$"
MARKS = r"[.!?…:;。！？,]"
SEPARATING = "|>»•·/"
SEPARATORS = r"^[|>»•·/]+$"
CAPITALS = r"[A-ZÀ-ÖØ-Þ]{2}"
SHOUTED = r"^[^a-zß-öø-ÿ]*[A-ZÀ-ÖØ-Þ]{2}[^a-zß-öø-ÿ]*$"
MENU = r"^(home|menu|next|previous|log ?in|log ?out|sign ?up|sign ?in|share|search|read more|click here|skip to|back to top|contact us|about us)($|[^a-z])"
BOILERPLATE = (
    r"all rights reserved|privacy policy|terms of (use|service)|cookie policy|use cookies|enable javascript|javascript is (disabled|required)"
    r"|lorem ipsum|licensed under|released under|subscribe to our|newsletter|copyright (\(c\)|©|[0-9]{4})"
)
#: Each alternative of BOILERPLATE holds one of these.
STEMS = ("all rights", "policy", "terms of", "use cookies", "javascript", "lorem", "licensed", "released", "subscribe", "newsletter", "copyright")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def repeated_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more, each word once. Windows are compared by their 64-bit hashes."""

    def of_hashes(hashes: Column) -> Column:
        def of_sorted(pairs: Column) -> Column:
            key = lambda i: F.get(pairs, i)["h"]
            twice = F.filter(pairs, lambda p, i: (p["h"] == key(i - 1)) | (p["h"] == key(i + 1)))
            places = F.sort_array(F.transform(twice, lambda p: p["i"]))

            def covered(at: Column) -> Column:
                each = F.transform(at, lambda p, i: F.coalesce(F.least(F.get(at, i + 1) - p, F.lit(3)), F.lit(3)))
                return F.aggregate(each, F.lit(0), lambda total, n: total + n)

            return let(places, covered)

        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), F.lit(0)).otherwise(let(pairs, of_sorted))

    def of_words(w: Column) -> Column:
        windows = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(let(F.transform(w, lambda x: F.xxhash64(x)), windows), of_hashes))

    return let(words, of_words)


def traits(text: Column) -> Column:
    """What a text holds at all. A line of a text that lacks a trait cannot fail the rule that needs it, and is not asked."""
    any_stem = lambda low: reduce(or_, (low.contains(stem) for stem in STEMS))
    return F.struct(
        text.rlike(f"[{SYMBOLS}]").alias("symbols"),
        text.rlike(f"[{SEPARATING}]").alias("separators"),
        text.rlike(CAPITALS).alias("capitals"),
        let(F.lower(text), any_stem).alias("boilerplate"),
    )


def line_failure(line: Column, has: Column) -> Column:
    """The rule that a line with words fails, or null. `has` are the `traits` of its text."""

    def judged(w: Column) -> Column:
        n, bare = F.size(w), F.btrim(line, F.lit(WHITE))
        chars = lambda: F.length(F.translate(line, WHITE, ""))
        symbols = lambda: chars() - F.length(F.translate(line, WHITE + SYMBOLS, ""))
        separators = F.size(F.filter(w, lambda x: x.rlike(SEPARATORS)))
        shouted = F.size(F.filter(w, lambda x: x.rlike(SHOUTED)))
        unpunctuated = F.when(n < SHORT, ~bare.rlike(ENDS)).otherwise(~line.rlike(MARKS))
        return (
            F.when(has["symbols"] & (symbols() * 10 > chars()), "symbols")
            .when(has["separators"] & (separators >= 2) & (separators * 10 >= n), "navigation")
            .when((n <= SHORT) & F.lower(bare).rlike(MENU), "navigation")
            .when(has["boilerplate"] & F.lower(line).rlike(BOILERPLATE), "boilerplate")
            .when(has["capitals"] & (n >= SHORT) & (shouted * 10 > n * 6), "capitals")
            .when((n >= SHORT) & (F.size(F.array_distinct(w)) * 10 < n * 3), "repetition")
            .when(unpunctuated, "punctuation")
        )

    return let(words_of(line), judged)


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words_left, removed (rules that removed lines), clean_text, base_failed and kept."""
    whole = F.coalesce(quoted(text), F.lit(""))

    def figures(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))

    def by_line(lines: Column, has: Column) -> Column:
        marked = F.transform(lines, lambda line: F.struct(line.alias("line"), line_failure(line, has).alias("failed")))

        def outcome(m: Column) -> Column:
            good = F.filter(m, lambda x: x["failed"].isNull())
            return F.struct(
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                F.aggregate(good, F.lit(0), lambda total, x: total + F.size(words_of(x["line"]))).cast("long").alias("words_left"),
                F.array_distinct(F.array_compact(F.transform(m, lambda x: x["failed"]))).alias("removed"),
                F.array_join(F.transform(good, lambda x: x["line"]), "\n").alias("clean_text"),
            )

        return let(marked, outcome)

    per_line = let(traits(whole), lambda has: let(lines_of(whole), lambda lines: by_line(lines, has)))
    measured = F.struct(let(words_of(whole), figures).alias("words"), per_line.alias("lines"))
    # The generator keeps Spark from computing the figures again for each column that is taken out of them.
    rows = docs.select(*(quoted(c) for c in docs.columns), whole.alias("__whole"), F.explode(F.array(measured)).alias("__m"))
    out = rows.select(
        *(quoted(c) for c in docs.columns),
        F.col("__m.words.n_words").alias("n_words"),
        F.length(F.translate("__whole", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("__whole") - F.length(F.translate("__whole", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.col("__m.lines.n_dup_lines").alias("n_dup_lines"),
        F.col("__m.words.n_repeat_words").alias("n_repeat_words"),
        F.col("__m.lines.words_left").alias("words_left"),
        F.col("__m.lines.removed").alias("removed"),
        F.col("__m.lines.clean_text").alias("clean_text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = ~failed & (F.col("words_left") >= LEAST_LEFT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", kept)


_BARE = "trim(l, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))"
_WS = r"[\x20\x09-\x0D]+"


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


#: The result of the query, for DuckDB.
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, {_sql_text(_WS)}), lambda x: x <> '') AS w,
      list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, {_sql_text(WORD)})) AS ls FROM d),
u AS (SELECT r, unnest(range(0, len(w) - 2)) AS i, w FROM w WHERE len(w) >= 3),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i+1] || ' ' || w[i+2] || ' ' || w[i+3]) AS c FROM u),
p AS (SELECT DISTINCT r, i + unnest([0, 1, 2]) AS i FROM g WHERE c > 1),
n AS (SELECT r, count(*) AS n_repeat_words FROM p GROUP BY r),
j AS (SELECT r, l, list_filter(regexp_split_to_array(l, {_sql_text(_WS)}), lambda x: x <> '') AS lw FROM (SELECT r, unnest(ls) AS l FROM w)),
k AS (SELECT r, l, len(lw) AS n, length(regexp_replace(l, {_sql_text(_WS)}, '', 'g')) AS chars,
      length(regexp_replace(l, '[^#*$%&|<>]+', '', 'g')) AS symbols,
      len(list_filter(lw, lambda x: regexp_matches(x, {_sql_text(SEPARATORS)}))) AS separators,
      len(list_filter(lw, lambda x: regexp_matches(x, {_sql_text(SHOUTED)}))) AS shouted, len(list_distinct(lw)) AS different FROM j),
f AS (SELECT r, n, NOT (symbols * 10 > chars
      OR (separators >= 2 AND separators * 10 >= n) OR (n <= {SHORT} AND regexp_matches(lower({_BARE}), {_sql_text(MENU)}))
      OR regexp_matches(lower(l), {_sql_text(BOILERPLATE)})
      OR (n >= {SHORT} AND shouted * 10 > n * 6) OR (n >= {SHORT} AND different * 10 < n * 3)
      OR CASE WHEN n < {SHORT} THEN NOT regexp_matches({_BARE}, {_sql_text(ENDS)}) ELSE NOT regexp_matches({_BARE}, {_sql_text(MARKS)}) END) AS good FROM k),
s AS (SELECT r, sum(n) FILTER (good) AS words_left FROM f GROUP BY r),
o AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, {_sql_text(_WS)}, '', 'g'))::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
      coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(words_left, 0)::BIGINT AS words_left
      FROM w LEFT JOIN n USING (r) LEFT JOIN s USING (r))
SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND words_left >= {LEAST_LEFT} * n_words AS kept FROM o
"""
