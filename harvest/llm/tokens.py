"""Token ids and exact counts of tokens.

The lengths of all texts are aggregated to a histogram; its running sums answer how many documents and tokens there are up to
and beyond every length, hence totals, quantiles and the tokens that remain when texts are cut at a context limit.

Null and empty texts have length 0 and are counted. Repeated rows count each. An empty table gives an empty histogram.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from harvest.llm.common import quoted, with_running
from harvest.sources.scratch import written

VOCABULARY = "word_bpe_49k.json"
#: Pieces of lower-case Latin-1 text, as the pre-tokenizer of the vocabulary cuts them.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\x09-\x0d\x20\x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
#: What lies between white space; the separators U+001C to U+001F are no white space to the vocabulary.
SPACED = re.compile(r"(?:\S|[\x1c-\x1f])+")
#: Pieces whose ids a task keeps at once, and words beyond Latin-1.
MOST_PIECES = 300_000
MOST_WORDS = 75_000
LONG = 64


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary uses for each byte: itself if it can be printed, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Kept(dict):
    """Ids of short strings: `make` is asked for those that are not held, and of these the last `most` at most are held."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, text: str) -> bytes:
        ids = self.make(text)
        if len(text) <= LONG:
            if len(self) >= self.most:
                self.clear()
            self[text] = ids
        return ids


class Encoder:
    """Ids of whole texts by a vocabulary of the `tokenizers` library.

    Merges never cross the pieces into which the vocabulary cuts a text, so the ids of a text are those of its pieces, and the
    ids of pieces that were seen are kept, up to a bound. The short way holds for Latin-1 text; words with other
    characters are encoded by the library as a whole.

    `special_as_text` encodes added tokens in a text (such as <|endoftext|>) like any other characters. Without it the library
    is left as loaded: a text that holds an added token goes to it whole, and the token gets its own id.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [] if special_as_text else self.tokenizer.get_added_tokens_decoder().values()
        # Some added tokens are sought in the normalized text; more matches than the library finds only cost time.
        self.added = re.compile("|".join(re.escape(t.content) for t in added), re.IGNORECASE) if added else None
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.known = Kept(self._piece, MOST_PIECES)
        self.words = Kept(self._whole, MOST_WORDS)

    def _piece(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()
        mapped = piece if plain else "".join(self.letters[b] for b in piece.encode())
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped)])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _latin(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, PIECES.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        try:
            word.encode("latin-1")
            return self._latin(word)
        except UnicodeEncodeError:
            return self.words[word]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if self.added and self.added.search(text):
            return self._whole(text)
        try:
            text.encode("latin-1")
            return self._latin(text)
        except UnicodeEncodeError:
            return b"".join(map(self._word, SPACED.findall(text)))


def with_length(docs: DataFrame, to: str = "length", text: str = "text", path: str | None = None) -> DataFrame:
    """`docs` with the number of tokens of each text."""
    where = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("long")
    def length(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(where, special_as_text=False)
        for texts in batches:
            yield pd.Series([len(encoder.ids(t)) // 4 for t in texts], dtype="int64")

    return docs.withColumn(to, length(F.coalesce(quoted(text), F.lit(""))))


def length_histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row for each length that occurs: n_docs, and what running sums over the lengths give.

    docs_upto, tokens_upto: documents of this length or shorter and their tokens; docs_over, tokens_over: longer ones;
    truncated_tokens: tokens of all documents if each is cut at this length; share_upto: of the documents.
    """
    lengths = with_length(docs.select("text"), path=path).groupBy("length").agg(F.count("*").alias("n_docs"))
    counts = written(lengths.withColumn("tokens", F.col("length") * F.col("n_docs")), "lengths").withColumn("__part", F.floor(F.col("length") / 512))
    total = counts.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("all_docs"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("all_tokens")).first()
    sums = with_running(counts, {"docs_before": F.col("n_docs"), "tokens_before": F.col("tokens")}, [], "__part", [F.col("length")])
    upto, tokens = F.col("docs_before") + F.col("n_docs"), F.col("tokens_before") + F.col("tokens")
    over = F.lit(total["all_docs"]) - upto
    return sums.select(
        "length",
        "n_docs",
        upto.alias("docs_upto"),
        tokens.alias("tokens_upto"),
        over.alias("docs_over"),
        (F.lit(total["all_tokens"]) - tokens).alias("tokens_over"),
        (tokens + over * F.col("length")).alias("truncated_tokens"),
        (upto / F.lit(float(max(1, total["all_docs"])))).alias("share_upto"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_over, truncated_tokens) for context limits, whether or not a text has that length."""
    spark = histogram.sparkSession
    wanted = spark.range(1).select(F.explode(F.array(*(F.lit(x).cast("long") for x in limits))).alias("limit"))
    below = histogram.select("*", F.explode(F.array(*(F.lit(x).cast("long") for x in limits))).alias("limit"))
    below = below.where("length <= limit").groupBy("limit").agg(F.max(F.struct("length", "tokens_upto", "docs_over")).alias("last"))
    known = wanted.join(below, "limit", "left")
    all_docs = histogram.agg(F.sum("n_docs")).first()[0] or 0
    over = F.coalesce(F.col("last.docs_over"), F.lit(all_docs))
    return known.select("limit", over.alias("docs_over"), (F.coalesce(F.col("last.tokens_upto"), F.lit(0)) + over * F.col("limit")).alias("truncated_tokens"))


def quantile(histogram: DataFrame, share: float) -> DataFrame:
    """(length): the smallest length that holds `share` of the documents."""
    return histogram.where(F.col("share_upto") >= share).agg(F.min("length").alias("length"))
